"""Campaigns: work units from nested metadata, their target masks, counts, and what is still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import safe, stable_key

#: Category names by type id.
CATEGORIES = ("explicit", "implicit", "nonexistent")


def category(type_id: Column) -> Column:
    return F.get(F.array(*map(F.lit, CATEGORIES)), F.when(type_id >= 0, type_id.cast("int")))


def frame_lists(values: Column) -> Column:
    """(frames, ignored): ids without blanks at their ends; empty ones and those with a part that begins with a dot go."""
    plain = F.transform(values, lambda v: F.regexp_replace(v.cast("string"), r"^\s+|\s+$", ""))
    hidden = lambda v: (v == "") | F.exists(F.split(v, "/"), lambda p: F.startswith(p, F.lit(".")) & ~p.isin("."))
    return F.struct(F.filter(plain, lambda v: ~hidden(v)).alias("frames"), F.filter(plain, hidden).alias("ignored"))


def object_ids(raw: Column) -> Column:
    """Ids of a JSON value that is one number (or text), a list of them, or null."""
    text = F.regexp_replace(F.coalesce(raw, F.lit("")), r'[\[\]\s"]', "")
    parts = F.filter(F.split(text, ","), lambda x: x != "")
    return F.transform(F.when(text == "null", F.slice(parts, 1, 0)).otherwise(parts), lambda x: x.cast("int"))


def units(expressions: DataFrame, dataset: str, split: str, objects: DataFrame | None = None, annotated: bool = False) -> DataFrame:
    """Work units of one split: expressions (video_id, expression_id, exp, frames, obj_id, anno_id, type_id).

    Blank expressions and videos without frames go. In the dataset with categories (revos) unknown types go, too,
    the nonexistent are negative and have no target; in the other a unit's category is that of its first object,
    from `objects` (video_id, object_id, category), and official masks are expected where there are annotations.
    """
    revos = dataset == "revos"
    e = expressions.withColumn("text", F.regexp_replace("exp", r"^\s+|\s+$", "")).withColumn("frame_ids", frame_lists(F.col("frames"))["frames"])
    e = e.where((F.coalesce("text", F.lit("")) != "") & (F.size("frame_ids") > 0)).withColumn("target_object_ids", object_ids(F.col("obj_id")))
    e = e.withColumn("cohort", category(F.col("type_id")) if revos else F.lit("full_video")).where("cohort is not null")
    e = e.withColumn("negative", F.col("cohort") == "nonexistent")
    none = F.array().cast("array<int>")
    if revos:
        e = e.withColumn("target_annotation_ids", object_ids(F.col("anno_id"))).withColumn("target_category", F.lit(None).cast("string"))
        source = F.when(F.col("negative"), "none").otherwise("official_dataset_ground_truth")
    else:
        e = e.withColumn("target_annotation_ids", none).withColumn("_first", F.get("target_object_ids", F.lit(0)))
        if objects is not None:
            known = objects.select("video_id", F.col("object_id").cast("int").alias("_first"), F.col("category").alias("_cat"))
            e = e.join(known, ["video_id", "_first"], "left")
        e = e.withColumn("target_category", F.coalesce("_cat", F.lit("unknown")) if objects is not None else F.lit("unknown"))
        source = F.when(F.lit(annotated) & (F.size("target_object_ids") > 0), "official_dataset_ground_truth").otherwise("sam3.1_multiplex")
    name = F.concat(F.lit(f"{'revos' if revos else 'refytvos'}__{split}__"), "cohort", F.lit("__"), safe("video_id"), F.lit("__e"), safe("expression_id"))
    return e.select(
        name.alias("sample_id"), F.lit("revos" if revos else "ref_youtube_vos").alias("dataset"), F.lit(split).alias("split"), "cohort",
        F.lit("official_revos_reasoning_expression" if revos else "public_full_video_expression").alias("annotation_protocol"),
        "video_id", "expression_id", "text", "frame_ids", "target_category", "target_object_ids", "target_annotation_ids", source.alias("target_source_expected"), "negative",
    )


def drawn(rows: DataFrame, group: str | None, limit: int, seed: str, one_per_video: bool = False) -> DataFrame:
    """`limit` rows (of each group) in the seed's hash order, of each video its first one only if asked.

    Fewer than `limit` end the job. A row's hash first picks a shard, so a large group is cut before it meets.
    """
    r = rows.withColumn("_k", stable_key(seed, F.col("video_id"), F.col("expression_id"))).withColumn("_g", F.col(group).cast("string") if group else F.lit(""))
    if one_per_video:
        r = r.join(r.groupBy("_g", "video_id").agg(F.min("_k").alias("_k")), ["_g", "video_id", "_k"], "left_semi").select(*r.columns)
    shard = Window.partitionBy("_g", F.pmod(F.xxhash64("_k"), F.lit(64))).orderBy("_k")
    r = r.withColumn("_n", F.row_number().over(shard)).where(F.col("_n") <= limit)
    all_of = Window.partitionBy("_g")
    r = r.withColumn("_n", F.row_number().over(all_of.orderBy("_k"))).where(F.col("_n") <= limit).withColumn("_c", F.count("*").over(all_of))
    short = F.concat(F.lit(f"{limit} rows asked for, fewer there: "), "_g")
    return r.where(F.when(F.col("_c") >= limit, True).otherwise(F.raise_error(short))).select(*rows.columns)


def statistics(rows: DataFrame) -> DataFrame:
    """(key, kind, n): instructions by dataset, split and cohort, and distinct videos by dataset and split."""
    said = rows.groupBy(F.concat_ws("::", "dataset", "split", "cohort").alias("key")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("instructions"))
    seen = rows.groupBy(F.concat_ws("::", "dataset", "split").alias("key")).agg(F.count_distinct("video_id").alias("n")).withColumn("kind", F.lit("videos"))
    return said.unionByName(seen)


def count_faults(counted: DataFrame, expected: DataFrame) -> DataFrame:
    """Keys whose count is not the one expected, or that only one side has."""
    e = expected.withColumnRenamed("n", "wanted")
    return counted.join(e, ["key", "kind"], "full").where(~F.col("n").eqNullSafe(F.col("wanted")))


def label_targets(units_: DataFrame, labels: DataFrame) -> DataFrame:
    """(sample_id, object_id, frames): of each target object its visible pixels a frame, null where it has none or the
    frame has no labels. labels: video_id, frame_id, pixels (array of labels)."""
    u = units_.where("target_source_expected = 'official_dataset_ground_truth'").select("sample_id", "video_id", "frame_ids", F.explode("target_object_ids").alias("object_id"))
    u = u.select("sample_id", "video_id", "object_id", F.posexplode("frame_ids").alias("place", "frame_id"))
    got = u.join(labels, ["video_id", "frame_id"], "left")
    on = F.aggregate("pixels", F.lit(0).cast("long"), lambda a, x: a + (x == F.col("object_id")).cast("long"))
    got = got.withColumn("on", F.when(on > 0, on))
    return got.groupBy("sample_id", "object_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "on"))), lambda f: f["on"]).alias("frames"))


def sequence_targets(units_: DataFrame, sequences: DataFrame) -> DataFrame:
    """(sample_id, annotation_id, masks): the stored sequence of each target annotation, one place for each frame, cut
    or filled up with nulls. sequences: annotation_id, masks. Negative units have none; a missing one ends the job."""
    u = units_.where("not negative").select("sample_id", F.size("frame_ids").alias("n"), F.explode("target_annotation_ids").alias("annotation_id"))
    got = u.join(sequences.withColumn("_there", F.lit(True)), "annotation_id", "left")
    got = got.where(F.when(F.col("_there"), True).otherwise(F.raise_error(F.concat(F.lit("no mask sequence "), F.col("annotation_id").cast("string")))))
    return got.select("sample_id", "annotation_id", F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get("masks", i)).alias("masks"))


def out_of_memory(error_type: Column, message: Column) -> Column:
    return F.coalesce((error_type == "OutOfMemoryError") & message.contains("CUDA out of memory"), F.lit(False))


def still_open(units_: DataFrame, records: DataFrame, errors: DataFrame, retry: bool, most_attempts: int = 3) -> DataFrame:
    """The units to run: without a record, and without an error or with one that may be tried again.

    An error is tried up to `most_attempts` times; one of memory once more, with one frame a batch and at most
    8 objects, unless it has had that. An attempt that is no number counts as one.
    """
    a = F.when(F.col("error_type").isNull() & F.col("attempt").isNull(), 0).when(F.col("attempt").isNull(), 0).otherwise(F.coalesce(F.expr("try_cast(attempt AS INT)"), F.lit(1)))
    had = F.coalesce("memory_safe_mode", F.lit(False)) & (F.coalesce("grounding_batch_size", F.lit(999)) <= 1) & (F.coalesce("max_num_objects", F.lit(999)) <= 8)
    again = out_of_memory(F.col("error_type"), F.coalesce("message", F.lit(""))) & (F.col("_a") >= most_attempts) & ~had
    e = errors.select("sample_id", "error_type", "message", "attempt", "memory_safe_mode", "grounding_batch_size", "max_num_objects")
    u = units_.join(records.select("sample_id").distinct(), "sample_id", "left_anti").join(e, "sample_id", "left").withColumn("_a", a)
    return u.where((F.col("_a") == 0) | (F.lit(retry) & ((F.col("_a") < most_attempts) | again))).select(*units_.columns)


def object_limit(units_: DataFrame, errors: DataFrame) -> DataFrame:
    """(video_key, most_objects): 16, or 8 where a unit ran out of memory even with one frame a batch."""
    bad = F.coalesce((F.col("error_type") == "OutOfMemoryError") & F.col("memory_safe_mode") & (F.coalesce("grounding_batch_size", F.lit(999)) <= 1), F.lit(False))
    e = errors.select("sample_id", bad.alias("_bad"))
    return units_.join(e, "sample_id", "left").groupBy("video_key").agg(F.when(F.max(F.coalesce("_bad", F.lit(False))), 8).otherwise(16).alias("most_objects"))


def needs_model(negative: Column, expected: Column, prompts: Column) -> Column:
    return ~negative & ((expected != "official_dataset_ground_truth") | (F.coalesce(F.size(prompts), F.lit(0)) > 0))


def claim(video_key: Column) -> Column:
    return F.substring(F.sha2(video_key, 256), 1, 24)
