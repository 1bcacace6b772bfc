"""Worklists: the units of whole campaigns with what their instructions ask for, counted before anything is written."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import language, spans
from ..functions.binding import bound
from . import campaign
from .records import rename, write_text

# Names of the version and of a target that only a model can find; counts of the public releases.
VERSION, MODEL_TARGET = "concor-video-worklist-v3", "target_sam"
EXPECTED = "official_dataset_ground_truth"
COMPACT = 1000
COUNTS = {
    "evaluation": {"ref_youtube_vos::val::full_video": 834, "ref_youtube_vos::test::full_video": 1262, "revos::val::explicit": 3130, "revos::val::implicit": 2475, "revos::val::nonexistent": 217},
    "train": {"ref_youtube_vos::train::full_video": 12913, "revos::train::explicit": 16941, "revos::train::implicit": 12203, "revos::train::nonexistent": 108},
}
VIDEOS = {"evaluation": {"ref_youtube_vos::val": 202, "ref_youtube_vos::test": 305, "revos::val": 416}, "train": {"ref_youtube_vos::train": 3471, "revos::train": 626}}
KEY = ("dataset", "split", "video_id", "expression_id")
PLACES = ("provenance_warning", "dataset_root", "frame_source", "annotation_source", "mask_dict_path")


def placed(units: DataFrame, **places: str | None) -> DataFrame:
    """Units with where their media lie: provenance_warning, dataset_root, frame_source, annotation_source and
    mask_dict_path, null where not said."""
    if unknown := sorted(set(places) - set(PLACES)):
        raise ValueError(f"unknown places {unknown}")
    return units.withColumns({p: F.lit(places.get(p)).cast("string") for p in PLACES})


def extracted(units: DataFrame, parsed: DataFrame) -> DataFrame:
    """Units with extraction (target, target_coreference_spans, contexts, ignored, notes) and prompt_groups.

    parsed: sample_id, tokens and chunks, as a parser gives them (see functions.language); a unit without a row has none,
    and then its whole text is the target. A target that has no official mask says so by its role. Negative units have
    no target, no contexts and no prompts.
    """
    p = parsed.select("sample_id", "tokens", "chunks")
    tokens, chunks = parsed.schema["tokens"].dataType, parsed.schema["chunks"].dataType
    d = units.join(p, "sample_id", "left").withColumns({"tokens": F.coalesce("tokens", F.array().cast(tokens)), "chunks": F.coalesce("chunks", F.array().cast(chunks))})
    d = bound(d, x=language.extraction(F.col("text"), F.col("negative"), F.col("tokens"), F.col("chunks"), F.col("target_category")))
    target = F.col("x.target")
    role = F.when(F.col("target_source_expected") == EXPECTED, target["role"]).otherwise(MODEL_TARGET)
    own = F.when(F.col("negative") | target.isNull(), F.lit(None)).otherwise(target.withField("role", role))
    none = F.array().cast(f"array<{spans.SPAN}>")
    kinds = d.schema["x"].dataType
    contexts, ignored = (F.when(F.col("negative"), F.array().cast(kinds[c].dataType)).otherwise(F.col(f"x.{c}")) for c in ("contexts", "ignored"))
    whole = F.struct(own.alias("target"), F.when(F.col("negative"), none).otherwise(F.col("x.coreferences")).alias("target_coreference_spans"), contexts.alias("contexts"), ignored.alias("ignored"), F.array().cast("array<string>").alias("notes"))
    d = bound(d, extraction=whole)
    return bound(d, prompt_groups=language.grouped_prompts(F.col("extraction.contexts"))).select(*units.columns, "extraction", "prompt_groups")


def campaign_units(parts: list[DataFrame], parsed: DataFrame) -> DataFrame:
    """All parts as one campaign, in canonical order, with their extraction."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return extracted(rows, parsed).orderBy(*KEY)


def count_check(units: DataFrame, counts: dict[str, int], videos: dict[str, int]) -> tuple[dict[str, int], dict[str, int]]:
    """Instructions by dataset, split and cohort, and videos by dataset and split; others than those said end it."""
    got: dict[str, dict[str, int]] = {"instructions": {}, "videos": {}}
    for r in campaign.statistics(units).orderBy("kind", "key").collect():  # a row for each cohort
        got[r["kind"]][r["key"]] = r["n"]
    for kind, wanted in (("instructions", counts), ("videos", videos)):
        if got[kind] != wanted:
            raise ValueError(f"{kind} are not those of the release: expected {wanted}, got {got[kind]}")
    return got["instructions"], got["videos"]


def audit_lines(units: DataFrame) -> DataFrame:
    """(sample_id, lines): what was extracted of each unit, as Markdown."""
    t = F.col("extraction.target")
    code = lambda c: F.concat(F.lit("`"), c, F.lit("`"))
    first = F.when(t.isNull(), F.lit("- Main referent: intentionally absent")).otherwise(F.concat(F.lit("- Main referent: "), code(t["surface"]), F.lit(" → "), code(t["sam_prompt"]), F.lit(" ("), "target_source_expected", F.lit(")")))
    prompts = F.transform("prompt_groups", lambda g: F.concat(F.lit("- Context SAM3.1 prompt "), code(g["sam_prompt"]), F.lit(" ← "), F.array_join(F.transform(g["candidates"], lambda c: code(c["surface"])), ", ")))
    ignored = F.transform("extraction.ignored", lambda c: F.concat(F.lit("- Ignored "), code(c["surface"]), F.lit(": "), c["decision"]))
    head = F.array(F.concat(F.lit("## "), "sample_id"), F.lit(""), F.concat(F.lit("- Text: "), code(F.col("text"))), first)
    return units.select("sample_id", F.concat(head, prompts, ignored, F.array(F.lit(""))).alias("lines"))


def write_worklist(units: DataFrame, out: str, campaign_id: str, counts: dict[str, int] | None = None, videos: dict[str, int] | None = None, **said) -> dict:
    """The units as Parquet under `out`, worklist.json with counts and what else is `said`, and an audit in Markdown, in full
    up to 1000 units and as counts beyond; returns what worklist.json says.

    With `counts` and `videos` these are checked before anything takes its name. All is staged and renamed at the end.
    """
    spark = units.sparkSession
    stage = f"{out.rstrip('/')}.{uuid.uuid4().hex}.part"
    units.write.option("compression", "zstd").parquet(f"{stage}/units.parquet")
    kept = spark.read.schema(units.schema).parquet(f"{stage}/units.parquet")
    stats: dict[str, dict[str, int]] = {"instructions": {}, "videos": {}}
    for r in campaign.statistics(kept).orderBy("kind", "key").collect():
        stats[r["kind"]][r["key"]] = r["n"]
    if counts is not None:
        count_check(kept, counts, videos or {})
    n = sum(stats["instructions"].values())
    head = [f"# Extraction audit: {campaign_id}", "", "Exact surface spans and normalized prompts are stored separately.", "Ignored candidates are recorded instead of being silently discarded.", ""]
    if n > COMPACT:
        body = [f"This campaign contains {n:,} instructions; what was extracted of each is in units.parquet.", "", "## Instruction counts", "", *(f"- {k}: {v:,}" for k, v in stats["instructions"].items())]
    else:
        body = [line for r in audit_lines(kept.orderBy(*KEY)).collect() for line in r["lines"]]
    write_text(spark, f"{stage}/extraction-audit.md", "\n".join(head + body))
    value = {"schema_version": VERSION, "campaign_id": campaign_id, "counts": stats["instructions"], "video_counts": stats["videos"], "units": n, **said}
    write_text(spark, f"{stage}/worklist.json", json.dumps(value, sort_keys=True))
    rename(spark, stage, out)
    return value
