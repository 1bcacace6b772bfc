"""Correspondence records (tracks and their text spans): validation, flat tables, the run's ledger and its export.

A record has text, frame_ids, frame_files, tracklets (tracklet_id, masks, ...), groups (role, identity,
tracklet_ids, text_spans), span_links, negative and disposition.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import masks, spans

#: The version that records carry by default; whoever has records of another one says so.
VERSION = "tracklet-bcc-v2"
RECORD = """sample_id string, schema_version string, dataset string, split string, cohort string, annotation_protocol string, provenance_warning string,
dataset_root string, frame_source string, video_id string, expression_id string, text string, negative boolean, target_source string, disposition string,
frame_ids array<string>, frame_files array<string>, unresolved_required_prompts array<string>, extraction string, sam_prompt_audit string, pipeline string, runtime_seconds double,
tracklets array<struct<tracklet_id:string,source:string,source_annotation_id:string,sam_prompt:string,confidence:double,max_confidence:double,present_frames:int,masks:array<struct<size:array<int>,counts:array<bigint>>>>>,
groups array<struct<group_id:string,role:string,identity:string,text_spans:array<struct<start:int,end:int,text:string>>,tracklet_ids:array<string>>>,
span_links array<struct<start:int,end:int,text:string,tracklet_ids:array<string>>>"""


def _any(items: Column, test) -> Column:
    return F.coalesce(F.exists(items, test), F.lit(False))


def _empty(items: Column) -> Column:
    return F.coalesce(F.size(items) == 0, F.lit(True))


def bad_mask(m: Column) -> Column:
    """A mask that is there but whose size is no positive pair or whose runs don't sum to it."""
    total = F.aggregate(m["counts"], F.lit(0).cast("long"), lambda a, x: a + x)
    size_ok = (F.size(m["size"]) == 2) & F.forall(m["size"], lambda x: x > 0)
    fine = size_ok & (total == F.get(m["size"], F.lit(0)).cast("long") * F.get(m["size"], F.lit(1)))
    return m.isNotNull() & ~F.coalesce(fine, F.lit(False))


def fault(version: str | None = VERSION) -> Column:
    """The first rule that a record breaks, or null: what a run has to refuse before it exports anything."""
    tracks, groups, frames, text = F.col("tracklets"), F.col("groups"), F.col("frame_ids"), F.coalesce("text", F.lit(""))
    ids, linked = F.transform(tracks, lambda t: t["tracklet_id"]), spans.ids_of(groups)
    wanted = F.when(F.size(tracks) > 0, "negative_with_context").otherwise("negative_unsegmentable")
    rules = [
        ("no_frames", _empty(frames)),
        ("frame_files_differ", ~_empty(F.col("frame_files")) & (F.size("frame_files") != F.size(frames))),
        ("duplicate_tracklet", F.size(F.array_distinct(ids)) < F.size(ids)),
        ("mask_count", _any(tracks, lambda t: F.size(t["masks"]) != F.size(frames))),
        ("mask_runs", _any(tracks, lambda t: F.exists(t["masks"], bad_mask))),
        ("group_without_tracklets", _any(groups, lambda g: _empty(g["tracklet_ids"]))),
        ("unknown_tracklet", F.size(F.array_except(linked, ids)) > 0),
        ("group_without_spans", _any(groups, lambda g: _empty(g["text_spans"]))),
        ("span_mismatch", _any(groups, lambda g: F.exists(g["text_spans"], lambda s: spans.cut(text, s["start"], s["end"]) != s["text"]))),
        ("unlinked_tracklet", F.size(F.array_except(ids, linked)) > 0),
        ("span_links_differ", F.col("span_links") != spans.links(groups)),
        ("negative_disposition", F.col("negative") & (F.col("disposition") != wanted)),
        ("negative_target", F.col("negative") & _any(groups, lambda g: g["role"] != "context_entity")),
        ("positive_without_tracklets", ~F.col("negative") & (F.size(tracks) == 0) & (F.col("disposition") != "missing_main_referent")),
        ("no_main_referent", ~F.col("negative") & (F.size(tracks) > 0) & ~_any(groups, lambda g: g["role"] == "main_referent")),
    ]
    if version:
        rules.insert(0, ("schema_version", F.coalesce(F.col("schema_version") != version, F.lit(True))))
    return F.coalesce(*[F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in rules])


def refused(records: DataFrame, version: str | None = VERSION) -> DataFrame:
    """The records, each checked as it is read: one that breaks a rule ends the job with its id and the rule."""
    why = fault(version)
    return records.where(F.when(why.isNull(), True).otherwise(F.raise_error(F.concat(F.lit("record "), F.col("sample_id"), F.lit(": "), why))))


def _json(c: Column | str) -> Column:
    return F.to_json(c, {"ignoreNullFields": "false"})


_HEAD = "sample_id dataset split cohort annotation_protocol provenance_warning dataset_root frame_source video_id expression_id text".split()


def _head() -> list[Column]:
    out = [F.coalesce(c, F.lit("")).alias(c) if c == "annotation_protocol" else F.col(c) for c in _HEAD]
    return [*out, F.coalesce("negative", F.lit(False)).alias("negative"), F.coalesce("target_source", F.lit("unknown")).alias("target_source"), F.col("disposition")]


def _said(name: str, default: str) -> Column:
    return F.coalesce(name, F.lit(default))


def _files() -> Column:
    return F.coalesce("frame_files", F.array().cast("array<string>"))


def sample_rows(records: DataFrame) -> DataFrame:
    """One row for each record, its tracks only counted (24 columns)."""
    return records.select(
        *_head(),
        F.size("frame_ids").alias("frame_count"),
        F.size("tracklets").alias("tracklet_count"),
        F.coalesce(F.size("unresolved_required_prompts"), F.lit(0)).alias("unresolved_context_count"),
        _json("frame_ids").alias("frame_ids_json"),
        _json(_files()).alias("frame_files_json"),
        _json("span_links").alias("span_links_json"),
        _said("extraction", "{}").alias("extraction_json"),
        _said("sam_prompt_audit", "[]").alias("sam_prompt_audit_json"),
        _said("pipeline", "{}").alias("pipeline_json"),
        F.coalesce("runtime_seconds", F.lit(0.0)).alias("runtime_seconds"),
    )


def verification_rows(records: DataFrame) -> DataFrame:
    """One row for each record with all that a reviewer needs (22 columns)."""
    return records.select(
        *_head(),
        _json("frame_ids").alias("frame_ids_json"),
        _json(_files()).alias("frame_files_json"),
        *[_json(c).alias(c + "_json") for c in ("tracklets", "groups", "span_links")],
        _said("extraction", "{}").alias("extraction_json"),
        _said("sam_prompt_audit", "[]").alias("sam_prompt_audit_json"),
        F.coalesce("runtime_seconds", F.lit(0.0)).alias("runtime_seconds"),
    )


def tracklet_rows(records: DataFrame) -> DataFrame:
    """One row for each track with what its groups say of it (22 columns). Only what the rows need is carried along."""
    keep = ["sample_id", "dataset", "split", "cohort", "video_id", "expression_id", "text", "disposition"]
    one = records.select(*keep, "groups", "frame_ids", _files().alias("frame_files"), F.explode("tracklets").alias("t")).withColumn("own", spans.owner(F.col("groups"), F.col("t.tracklet_id")))
    return one.select(
        *keep,
        F.col("t.tracklet_id").alias("tracklet_id"),
        "own.role",
        "own.identity",
        "t.source",
        "t.source_annotation_id",
        "t.sam_prompt",
        F.coalesce("t.confidence", F.lit(0.0)).alias("confidence"),
        F.coalesce("t.max_confidence", "t.confidence", F.lit(0.0)).alias("max_confidence"),
        F.col("t.present_frames").alias("present_frames"),
        F.size("frame_ids").alias("frame_count"),
        _json("frame_ids").alias("frame_ids_json"),
        _json("frame_files").alias("frame_files_json"),
        _json("own.text_spans").alias("text_spans_json"),
        _json("t.masks").alias("masks_rle_json"),
    )


def link_rows(records: DataFrame) -> DataFrame:
    """One row for each linked span (6 columns)."""
    one = records.select("sample_id", "text", F.explode("span_links").alias("l"))
    return one.select("sample_id", "text", F.col("l.start").alias("span_start"), F.col("l.end").alias("span_end"), F.col("l.text").alias("span_text"), _json("l.tracklet_ids").alias("tracklet_ids_json"))


def ledger_rows(units: DataFrame, records: DataFrame, errors: DataFrame) -> DataFrame:
    """One row for each unit: completed with its record, else failed with its error, else pending (13 columns)."""
    done = records.select("sample_id", F.lit(True).alias("_done"), "disposition", F.size("tracklets").alias("_tracks"))
    failed = errors.select("sample_id", F.lit(True).alias("_failed"), "error_type", F.col("message").alias("error_message"))
    status = F.when(F.col("_done"), "completed").when(F.col("_failed"), "failed").otherwise("pending")
    said = lambda c: F.when(F.col("_done"), F.lit("")).otherwise(F.coalesce(c, F.lit(""))).alias(c)
    return (
        units.join(done, "sample_id", "left")
        .join(failed, "sample_id", "left")
        .select(
            "sample_id", "dataset", "split", "cohort", "video_id", "expression_id",
            status.alias("status"),
            F.coalesce("disposition", F.lit("")).alias("disposition"),
            "target_source_expected",
            F.coalesce(F.size("sam_prompt_groups"), F.lit(0)).alias("context_prompt_count"),
            F.coalesce("_tracks", F.lit(0)).alias("tracklet_count"),
            said("error_type"),
            said("error_message"),
        )
    )


def export_campaign(units: DataFrame, records: DataFrame, errors: DataFrame, out: str, campaign: str, version: str | None = VERSION) -> dict:
    """Writes the four flat tables, the ledger as CSV and the manifest under `out`, and returns the manifest.

    Every record is validated once, as it is written to a staging folder beside `out`; tables and ledger are made from what
    lies there, and all counts from what was written. The folder takes its name only when the last table is complete, so
    a failed run leaves nothing half written.
    """
    spark = records.sparkSession
    stage = f"{out.rstrip('/')}.{uuid.uuid4().hex}.part"
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{stage}/{name}")
    refused(records, version).write.option("compression", "zstd").parquet(f"{stage}/_checked")
    checked = read("_checked", records.schema)
    tables = {"samples": sample_rows(checked), "verification": verification_rows(checked), "tracklets": tracklet_rows(checked), "links": link_rows(checked)}
    for name, table in tables.items():
        table.write.option("compression", "zstd").parquet(f"{stage}/{name}.parquet")
    ledger = ledger_rows(units, checked, errors)
    ledger.write.option("compression", "zstd").parquet(f"{stage}/_ledger")
    ledger = read("_ledger", ledger.schema)
    ledger.orderBy("dataset", "split", "video_id", "expression_id").write.option("header", True).csv(f"{stage}/run_ledger.csv")
    tally = lambda df, c: {r[c]: r["count"] for r in df.groupBy(c).count().orderBy(c).collect()}
    status = tally(ledger, "status")
    manifest = {
        "campaign_id": campaign,
        "worklist_units": sum(status.values()),
        **{name.rstrip("s") + "_rows": read(f"{name}.parquet", table.schema).count() for name, table in tables.items()},
        "status_counts": status,
        "disposition_counts": tally(read("samples.parquet", tables["samples"].schema), "disposition"),
        "tables": {name: f"{name}.parquet" for name in tables} | {"ledger": "run_ledger.csv"},
    }
    for name in ("_checked", "_ledger"):
        at, fs = _fs(spark, f"{stage}/{name}")
        fs.delete(at, True)
    write_text(spark, f"{stage}/manifest.json", json.dumps(manifest, sort_keys=True))
    rename(spark, stage, out)
    return manifest


def _fs(spark: SparkSession, at: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Puts a finished folder in its place, on whatever file system holds it; one that is there already is not replaced."""
    src, fs = _fs(spark, old)
    dst, _ = _fs(spark, new)
    if fs.exists(dst) or not fs.rename(src, dst):
        raise FileExistsError(f"{new} is there already, or {old} can't be moved")


def write_text(spark: SparkSession, at: str, text: str) -> None:
    """A small file under a name of its own, which takes the place of what is there in one step when it is complete."""
    part, fs = _fs(spark, f"{at}.{uuid.uuid4().hex}.part")
    dst, _ = _fs(spark, at)
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    sc = spark.sparkContext
    kind = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
    over = sc._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    whole = fs.makeQualified(part)
    sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(whole.toUri(), fs.getConf()).rename(whole, fs.makeQualified(dst), over)


def present(tracklets: Column) -> Column:
    """Frames with a pixel for each track."""
    return F.transform(tracklets, lambda t: F.size(masks.visible(t["masks"])))
