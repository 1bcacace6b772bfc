"""What reviewers look at: public rows, mask atlases, label places, before and after, filters and tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .requests import numbered

#: Public names of the stored columns.
PUBLIC = {
    "sample_id": "sample_id", "dataset": "source_dataset", "split": "source_split", "video_id": "video_id", "expression_id": "expression_id", "text": "caption", "negative": "is_nonexistent",
    "cohort": "annotation_category", "annotation_protocol": "annotation_protocol", "target_source": "target_mask_source", "disposition": "annotation_status", "frame_ids_json": "frame_ids_json",
    "frame_files_json": "frame_paths_json", "tracklets_json": "object_tracks_json", "groups_json": "text_entities_json", "span_links_json": "caption_object_links_json", "dataset_root": "source_media_root",
    "frame_source": "source_media_location", "provenance_warning": "provenance_note", "extraction_json": "original_entity_extraction_json", "sam_prompt_audit_json": "segmentation_audit_json", "runtime_seconds": "generation_runtime_seconds",
}
LINKS = "array<struct<start:bigint,end:bigint,text:string,tracklet_ids:array<string>>>"
#: Masks that one atlas holds, a bit each.
ATLAS = 24


def public_rows(rows: DataFrame, decisions: DataFrame, variant: bool = False) -> DataFrame:
    """Stored rows under their public names, with the frames, links and counts as columns of their own and each
    sample's decision. Other columns than the stored ones end the job. A variant calls the status disposition."""
    if set(rows.columns) != set(PUBLIC):
        raise ValueError(f"unexpected columns: {sorted(set(rows.columns) ^ set(PUBLIC))}")
    links = F.from_json("span_links_json", LINKS)
    own = F.transform(links, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text"), x["tracklet_ids"].alias("object_ids")))
    named = [F.col(c).alias("disposition" if variant and n == "annotation_status" else n) for c, n in PUBLIC.items()]
    tracks = F.size(F.from_json("tracklets_json", "array<struct<tracklet_id:string>>"))
    more = [F.from_json("frame_ids_json", "array<string>").alias("frame_ids"), own.alias("caption_links"), tracks.alias("object_count"), F.size(own).alias("linked_phrase_count")]
    d = decisions.select("sample_id", F.col("decision").alias("refinement_decision"))
    return rows.select(*named, *more).join(d, "sample_id")


def decoded(rows: DataFrame, schemas: dict[str, str]) -> DataFrame:
    """JSON text columns as values under their names without the suffix; text that is no such JSON ends the job."""
    out = [F.from_json(c, schemas[c], {"mode": "FAILFAST"}).alias(c.removesuffix("_json")) if c in schemas else F.col(c) for c in rows.columns]
    return rows.select(*out)


def atlases(masks: DataFrame) -> DataFrame:
    """(frame, atlas, ids, pixels): masks by id, ATLAS to one atlas, each a bit of its pixels' numbers. masks: frame, id,
    pixels (0 or 1 each)."""
    rank = F.row_number().over(Window.partitionBy("frame").orderBy("id")) - 1
    m = masks.withColumn("_r", rank).withColumn("atlas", F.floor(F.col("_r") / ATLAS).cast("int"))
    bits = F.transform("pixels", lambda p: F.call_function("shiftleft", p.cast("int"), (F.col("_r") % ATLAS).cast("int")))
    each = m.select("frame", "atlas", "id", F.posexplode(bits).alias("place", "v"))
    one = each.groupBy("frame", "atlas", "place").agg(F.bit_or("v").alias("v"))
    pixels = one.groupBy("frame", "atlas").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda x: x["v"]).alias("pixels"))
    ids = m.groupBy("frame", "atlas").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    return ids.join(pixels, ["frame", "atlas"])


def in_atlas(pixels: Column, bit: Column) -> Column:
    """One mask of an atlas again."""
    return F.transform(pixels, lambda p: p.bitwiseAND(F.call_function("shiftleft", F.lit(1), bit)) != 0)


def label_place(runs: Column, height: Column, width: Column) -> Column:
    """(x, y) for a mask's label: the medians of its pixels' places, kept within the picture. Runs go down the columns,
    so the median column is that of the middle pixel; rows are counted from the runs."""
    pixels = F.flatten(F.transform(runs, lambda r: F.when(r["stop"] > r["start"], F.sequence(r["start"], r["stop"] - 1)).otherwise(F.array().cast("array<bigint>"))))
    middle = lambda s: (F.element_at(s, F.floor((F.size(s) - 1) / 2).cast("int") + 1) + F.element_at(s, F.floor(F.size(s) / 2).cast("int") + 1)) / 2
    xs, ys = F.array_sort(F.transform(pixels, lambda p: F.floor(p / height))), F.array_sort(F.transform(pixels, lambda p: p % height))
    place = F.struct(F.greatest(F.lit(0), F.least(F.floor(middle(xs)).cast("int"), width - 40)).alias("x"), F.greatest(F.lit(22), F.floor(middle(ys)).cast("int")).alias("y"))
    return F.when(F.size(pixels) > 0, place)


def hue(track: Column) -> Column:
    return (track * 47) % 180


def palette_place(name: Column, colours: int) -> Column:
    """The place in a palette: a hash that takes each character's code to 33 times what was before, in 32 bits."""
    codes = F.transform(F.filter(F.split(name, ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
    return (F.aggregate(codes, F.lit(0).cast("long"), lambda a, c: (a * 33 + c).bitwiseAND(F.lit(0xFFFFFFFF))) % colours).cast("int")


def before_after(original: DataFrame, repaired: DataFrame, refined: DataFrame) -> DataFrame:
    """Each original with what repair and refinement left of it, and the groups whose tracks repair removed.

    original: sample_id, tracks (ids), groups; repaired and refined: sample_id, decision, tracks.
    """
    r = repaired.select("sample_id", F.col("decision").alias("nlp_decision"), F.col("tracks").alias("_left"))
    v = refined.select("sample_id", F.col("decision").alias("_decision"), F.col("tracks").alias("_kept"))
    j = original.join(r, "sample_id", "left").join(v, "sample_id", "left")
    gone = F.when(F.col("_left").isNotNull(), F.array_except("tracks", "_left"))
    lost = lambda g: F.size(F.array_intersect(F.array_distinct(g["tracklet_ids"]), gone))
    removed = F.transform(F.filter("groups", lambda g: lost(g) > 0), lambda g: F.struct(g["identity"].alias("identity"), F.transform(g["text_spans"], lambda s: s["text"]).alias("phrases"), lost(g).alias("track_count")))
    return j.select("sample_id", "nlp_decision", F.coalesce("_decision", F.lit("pending")).alias("decision"), F.size("tracks").alias("original_tracks"), F.when(F.col("_left").isNotNull(), F.size("_left")).alias("nlp_tracks"), F.coalesce(F.size("_kept"), F.lit(0)).alias("retained"), F.coalesce(removed, F.slice(F.transform("groups", lambda g: F.struct(g["identity"].alias("identity"), F.transform(g["text_spans"], lambda s: s["text"]).alias("phrases"), F.lit(0).alias("track_count"))), 1, 0)).alias("removed"))


def matching(samples: DataFrame, dataset: str = "", density: str = "", decision: str = "", repair: str = "", query: str = "") -> DataFrame:
    """The samples of a list that pass all filters set; "removed" as repair asks for samples that lost tracks, and the
    query is looked for in texts, id and reasons, whatever its case."""
    keep = F.lit(True)
    for name, want in (("dataset", dataset), ("density_bin", density), ("decision", decision)):
        keep = keep & (F.col(name) == want) if want else keep
    if repair:
        keep = keep & ((F.col("nlp_tracks") < F.col("original_tracks")) if repair == "removed" else F.col("nlp_decision") == repair)
    if query:
        said = F.concat_ws(" ", "original_text", "refined_text", "sample_id", F.array_join("nlp_reasons", " "), F.array_join("reason_codes", " "))
        keep = keep & F.contains(F.lower(said), F.lit(query.lower()))
    return samples.where(F.coalesce(keep, F.lit(False)))


def rotated(keys: DataFrame, key: str, shard: int, shards: int) -> DataFrame:
    """place: where a shard comes to each key if it begins in its own part of the sorted queue. Keys, one row a video, are
    numbered by range, so no task sorts them all."""
    n = keys.agg(F.count("*").alias("_all"))
    start = (F.lit(shard) * F.greatest(F.lit(1), F.floor(F.col("_all") / shards))) % F.col("_all")
    return numbered(keys, key).crossJoin(F.broadcast(n)).withColumn("place", F.pmod(F.col("place") - start, F.col("_all")).cast("int")).drop("_all")  # one row of one count


def recovered(submissions: DataFrame, batches: DataFrame) -> DataFrame:
    """(submission_id, batch_id) of uncertain submissions: the one batch with both their ticket and their file; none or
    several end the job, for another submission would be paid twice."""
    j = submissions.join(batches.select("batch_id", F.col("ticket").alias("submission_id"), "input_file_id"), ["submission_id", "input_file_id"], "left")
    one = j.groupBy("submission_id").agg(F.count("batch_id").alias("n"), F.min("batch_id").alias("batch_id"))
    return one.where(F.when(F.col("n") == 1, True).otherwise(F.raise_error(F.concat(F.lit("uncertain submission "), F.col("submission_id").cast("string"))))).select("submission_id", "batch_id")


def unreferenced(assets: DataFrame, references: DataFrame) -> DataFrame:
    return assets.join(references.select("name").distinct(), "name", "left_anti")


def by_sample(packets: DataFrame) -> DataFrame:
    """Each sample's entry in the last packet that has it; packets that repeat others for a retry are left out.
    packets: place, request_id, validation_retry_of, transport_retry_of, expressions (sample_id, existing_text)."""
    first = packets.where("validation_retry_of is null and transport_retry_of is null")
    each = first.select("place", "request_id", F.explode("expressions").alias("e"))
    return each.groupBy(F.col("e.sample_id").alias("sample_id")).agg(F.max_by(F.struct("request_id", "e.existing_text"), F.struct("place", "request_id")).alias("m")).select("sample_id", "m.request_id", "m.existing_text")


def reused(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """The images wanted (video_key, ids, frame) with the path of one made before of the same video, ids and frame."""
    key = F.array_join(F.array_sort(F.array_distinct(F.col("ids").cast("array<string>"))), ",")
    have = cached.withColumn("_k", key).groupBy("video_key", "_k", "frame").agg(F.min("path").alias("path"))
    return wanted.withColumn("_k", key).join(have, ["video_key", "_k", "frame"], "left").drop("_k")


def asked_once(prompts: DataFrame) -> DataFrame:
    """Each prompt of a video once, whatever its case and outer blanks: what a model has to be asked."""
    return prompts.select("video_key", F.lower(F.trim("prompt")).alias("prompt")).where("prompt <> ''").distinct()


def answered(prompts: DataFrame, answers: DataFrame) -> DataFrame:
    """The prompts with the answer to their key."""
    return prompts.withColumn("_k", F.lower(F.trim("prompt"))).join(answers.select("video_key", F.col("prompt").alias("_k"), "answer"), ["video_key", "_k"]).drop("_k")


def video_documents(rows: DataFrame) -> DataFrame:
    """One row a video: its instructions in order of their ids and how many there are. rows: video_key, sample_id, text,
    status."""
    item = F.struct("sample_id", "text", "status")
    return rows.groupBy("video_key").agg(F.array_sort(F.collect_list(item)).alias("instructions"), F.count("*").alias("n"), F.count_if(F.col("status") == "rejected").alias("rejected"))


def canonical(fields: dict[str, Column]) -> Column:
    """SHA-256 of the fields as compact JSON in order of their names, nulls included."""
    return F.sha2(F.to_json(F.struct(*[fields[n].alias(n) for n in sorted(fields)]), {"ignoreNullFields": "false"}), 256)


def prompt_parts(text: str) -> tuple[str, str]:
    """Front matter and body of a prompt file: between two lines of three dashes, and after them; both are needed."""
    head, mark, body = text.removeprefix("---\n").partition("\n---\n")
    if not text.startswith("---\n") or not mark or not body.strip():
        raise ValueError("a prompt file needs front matter between --- lines and a body")
    return head, body.strip()
