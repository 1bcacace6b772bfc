"""Sinks: refined splits, two variants, mask indexes, request files, named assets."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .records import _fs, rename, write_text
from .release import sharded

NAME = r"^[A-Za-z0-9][A-Za-z0-9_.-]*$"


def write_splits(rows: DataFrame, out: str, splits: list[str]) -> None:
    """A folder split=... for each split, those without rows with an empty file, so that readers find every one.

    Names that are no plain file names end the job, and so do rows of other splits. All is staged and renamed at the end.
    """
    spark = rows.sparkSession
    if bad := [s for s in splits if not spark.range(1).select(F.lit(s).rlike(NAME)).first()[0]]:
        raise ValueError(f"unsafe split names {bad}")
    known = F.col("split").isin(splits)
    rows = rows.where(F.when(F.coalesce(known, F.lit(False)), True).otherwise(F.raise_error(F.concat(F.lit("unknown split "), F.coalesce("split", F.lit("null"))))))
    stage = f"{out.rstrip('/')}.{uuid.uuid4().hex}.part"
    rows.write.partitionBy("split").option("compression", "zstd").parquet(stage)
    there = {r[0] for r in spark.read.schema(rows.schema).parquet(stage).select("split").distinct().collect()}
    for s in sorted(set(splits) - there):
        rows.limit(0).drop("split").write.parquet(f"{stage}/split={s}")
    rename(spark, stage, out)


def write_variants(public: DataFrame, out: str) -> None:
    """train_all and train_filtered (complete ones) from one table, which is checked to be of the training split alone and
    to hold no sample twice."""
    twice = public.groupBy("sample_id").count().where("count > 1").limit(1)
    if not twice.isEmpty() or not public.where("not source_split <=> 'train'").limit(1).isEmpty():
        raise ValueError("duplicate or non-training row in export")
    stage = f"{out.rstrip('/')}.{uuid.uuid4().hex}.part"
    public.write.option("compression", "zstd").parquet(f"{stage}/train_all")
    public.where("disposition = 'complete_bcc'").write.option("compression", "zstd").parquet(f"{stage}/train_filtered")
    rename(public.sparkSession, stage, out)


def write_mask_index(sequences: DataFrame, table: str, buckets: int = 64) -> None:
    """Mask sequences by annotation id, bucketed and sorted by it, so that joins on it need no shuffle of them."""
    sequences.write.mode("error").bucketBy(buckets, "annotation_id").sortBy("annotation_id").saveAsTable(table)


def request_lines(requests: DataFrame, most_bytes: int, most: int) -> DataFrame:
    """(file, place, line): request lines packed into files by bytes and number, in order of their ids.

    The numbers are first those of fixed shards of the id order, so that each shard is packed by itself.
    requests: shard, request_id, line.
    """
    from .packets import greedy

    sized = requests.withColumn("bytes", F.octet_length("line") + 1)
    packs = greedy(sized, "shard", ["request_id"], "bytes", most_bytes, most)
    upto = Window.partitionBy("shard").orderBy("batch").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = packs.withColumn("upto", F.sum("n").over(upto)).select("shard", "batch", (F.col("upto") - F.col("n")).alias("from"), "upto")
    placed = sized.withColumn("r", F.row_number().over(Window.partitionBy("shard").orderBy("request_id")))
    j = placed.join(ends, "shard").where((F.col("r") > F.col("from")) & (F.col("r") <= F.col("upto")))
    return j.select(F.concat_ws("-", "shard", "batch").alias("file"), (F.col("r") - F.col("from")).alias("place"), "request_id", "line")


def write_request_files(lines: DataFrame, out: str) -> list[dict]:
    """Each file of `request_lines` as one JSONL file under `out`, and requests.json, which says name, number of lines,
    bytes and SHA-256 of each; returns that list. A file is one task; it is bounded by the limits it was packed under."""
    spark = lines.sparkSession
    stage = f"{out.rstrip('/')}.{uuid.uuid4().hex}.part"
    packed = lines.repartition("file").sortWithinPartitions("file", "place").select("file", F.col("line").alias("value"))
    packed.write.partitionBy("file").option("lineSep", "\n").text(f"{stage}/data")
    made = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(f"{stage}/data")
    count = {r["file"]: r["count"] for r in lines.groupBy("file").count().collect()}  # a row for each file
    files = made.select(F.regexp_extract("path", r"file=([^/]+)/", 1).alias("file"), "path", F.sha2("content", 256).alias("sha256"), "length").orderBy("file").collect()
    listed = []
    for f in files:
        (old, fs), (new, _) = _fs(spark, f["path"]), _fs(spark, f"{stage}/{f['file']}.jsonl")
        if not fs.rename(old, new):
            raise OSError(f"{f['path']} can't be moved")
        listed.append({"name": f"{f['file']}.jsonl", "requests": count[f["file"]], "bytes": f["length"], "sha256": f["sha256"]})
    data, fs = _fs(spark, f"{stage}/data")
    fs.delete(data, True)
    write_text(spark, f"{stage}/requests.json", json.dumps(listed, sort_keys=True))
    rename(spark, stage, out)
    return listed


def named_assets(payloads: DataFrame, suffix: str) -> DataFrame:
    """(name, payload): payloads under the SHA-256 of their bytes, each once."""
    return payloads.select(F.concat(F.sha2("payload", 256), F.lit(suffix)).alias("name"), "payload").dropDuplicates(["name"])


def write_shards(rows: DataFrame, out: str, size: str, most: int, order: list[str], counted: str | None = None, **said) -> dict:
    """Files train-00000.parquet and so on under `out`, each of about `most` units of the column `size` in this order, and
    processing.json, which says each file's rows and SHA-256, rows by `counted`, and what else is `said`; returns it.

    A shard is one task and one file; digests are those of the bytes that lie there. All is staged and renamed at the
    end. No rows end the job, for nothing would be published.
    """
    spark = rows.sparkSession
    stage = f"{out.rstrip('/')}.{uuid.uuid4().hex}.part"
    placed = sharded(rows, size, most, order)
    placed.repartition("shard").sortWithinPartitions("shard", *order).write.partitionBy("shard").option("compression", "zstd").parquet(f"{stage}/data")
    made = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(f"{stage}/data")
    files = made.select(F.regexp_extract("path", r"shard=(\d+)", 1).cast("int").alias("shard"), "path", F.sha2("content", 256).alias("sha256"), "length").orderBy("shard").collect()  # a row for each file
    if not files:
        raise ValueError("no rows to publish")
    there = spark.read.parquet(f"{stage}/data")
    count = {r["shard"]: r["count"] for r in there.groupBy("shard").count().collect()}
    tally = {r[0]: r["count"] for r in there.groupBy(counted).count().orderBy(counted).collect()} if counted else {}
    listed = []
    for n, f in enumerate(files):  # one for each shard
        name = f"train-{n:05d}.parquet"
        (old, fs), (new, _) = _fs(spark, f["path"]), _fs(spark, f"{stage}/{name}")
        if not fs.rename(old, new):
            raise OSError(f"{f['path']} can't be moved")
        listed.append({"name": name, "rows": count[f["shard"]], "bytes": f["length"], "sha256": f["sha256"]})
    data, fs = _fs(spark, f"{stage}/data")
    fs.delete(data, True)
    manifest = {"files": listed, "retained_rows": sum(x["rows"] for x in listed), "rows_by_dataset": tally, **said}
    write_text(spark, f"{stage}/processing.json", json.dumps(manifest, sort_keys=True))
    rename(spark, stage, out)
    return manifest


def audited(selected: DataFrame, results: DataFrame, early: DataFrame) -> DataFrame:
    """(sample_id, decision, reason_codes, stage, request_id) of every selected sample: a model's result, else what structure
    decided, else pending. What a packet kept of it, and what the model said word for word, stay out.

    results: those of `replies.waves`. early: sample_id, decision, reason_codes, stage.
    """
    r = results.select("sample_id", F.col("outcome").alias("_decision"), F.when(F.col("error").isNotNull(), F.array("error")).otherwise(F.array().cast("array<string>")).alias("_codes"), F.col("stage").alias("_stage"), "request_id")
    j = selected.select("sample_id").join(r, "sample_id", "left").join(early.select("sample_id", "decision", "reason_codes", "stage"), "sample_id", "left")
    return j.select("sample_id", F.coalesce("_decision", "decision", F.lit("pending")).alias("decision"), F.coalesce("_codes", "reason_codes", F.array().cast("array<string>")).alias("reason_codes"), F.coalesce("_stage", "stage").alias("stage"), "request_id")


def write_refined(selected: DataFrame, records: DataFrame, results: DataFrame, early: DataFrame, out: str, cost: float = 0.0) -> dict:
    """Records that stay, by split, in the columns of `records`, every split of the selected samples with a table of its own;
    the audit; and summary.json, which is returned: it is complete without errors and open samples.

    selected: sample_id, split. records: with sample_id and split; results: with their columns as they became.
    """
    spark = records.sparkSession
    names = [r[0] for r in selected.select("split").distinct().orderBy("split").collect()]  # a few
    keep = results.where(F.col("outcome").isin("keep", "rewrite"))
    changed = [c for c in keep.columns if c in records.columns and c not in ("sample_id", "split")]
    base = records.select("sample_id", *[c for c in records.columns if c not in ("sample_id", *changed)])
    rows = base.join(keep.select("sample_id", *changed), "sample_id").join(selected.select("sample_id"), "sample_id", "left_semi").select(*records.columns)
    write_splits(rows, f"{out.rstrip('/')}", names)
    audit = audited(selected, results, early)
    audit.write.option("compression", "zstd").parquet(f"{out.rstrip('/')}/_audit")
    counts = {r["decision"]: r["count"] for r in spark.read.parquet(f"{out.rstrip('/')}/_audit").groupBy("decision").count().orderBy("decision").collect()}
    summary = {"selected": sum(counts.values()), "counts": counts, "cost_upper_usd": round(cost, 6), "complete": not (counts.get("pending") or counts.get("error"))}
    write_text(spark, f"{out.rstrip('/')}/summary.json", json.dumps(summary, sort_keys=True))
    return summary
