"""Packets of instructions for a model: text-only ones over all records, visual ones within each video."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import masks
from . import refine
from .steps import running


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """place: each row's number from 0 in this order; no task sorts all rows."""
    return running(df, list(order), place=F.lit(1))


def request_id(*parts: Column) -> Column:
    named = F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])
    return F.substring(F.sha2(F.to_json(named, {"ignoreNullFields": "false"}), 256), 1, 24)


def rejected(inspected: DataFrame) -> DataFrame:
    """The decisions that structure alone makes."""
    bad = inspected.where("reason is not null")
    return bad.select("sample_id", F.lit("reject").alias("decision"), F.array("reason").alias("reason_codes"), F.lit("heuristic").alias("stage"))


def text_packets(inspected: DataFrame, prompt: str, size: int = refine.PACKET) -> DataFrame:
    """(request_id, samples, expressions, mapping, max_output_tokens): sound records in order of their ids, `size` to a
    packet. An expression says what a model may see; the mapping keeps the tracks of its groups."""
    sound = refine.merged_groups(inspected.where("reason is null"))
    shown = F.transform("entries", lambda e: F.struct(e["id"].alias("id"), e["role"].alias("role"), e["identity"].alias("identity"), e["text_spans"].alias("text_spans"), e["candidates"].alias("candidate_count")))
    mains = F.transform(F.filter("entries", lambda e: e["role"] == "main_referent"), lambda e: e["id"])
    entry = F.struct("sample_id", F.col("text").alias("existing_text"), "negative", F.transform("entries", lambda e: e["id"]).alias("allowed_ids"), mains.alias("main_ids"), shown.alias("existing_groups"))
    one = numbered(sound.select("sample_id", entry.alias("entry"), F.struct("sample_id", "entries", mains.alias("main_ids")).alias("kept")), "sample_id")
    packs = one.groupBy(F.floor(F.col("place") / size).alias("packet")).agg(F.array_sort(F.collect_list(F.struct("place", "entry", "kept"))).alias("rows"))
    rows = lambda name: F.transform("rows", lambda r: r[name])
    p = packs.select("packet", F.transform("rows", lambda r: r["entry"]["sample_id"]).alias("samples"), rows("entry").alias("expressions"), rows("kept").alias("mapping"))
    return p.select(request_id(F.lit("nlp"), F.lit(prompt), F.col("expressions")).alias("request_id"), "samples", "expressions", "mapping", refine.reply_tokens(F.size("samples")).alias("max_output_tokens"))


def visual_tracks(inspected: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(video_key, sample_id, place, tracklet_id, source, sam_prompt, visible, sign, visual_id) of sound records' kept
    tracks, mains first. Tracks alike in all frames have one visual id in all records of a video."""
    sound = inspected.where("reason is null").withColumn("video_key", F.concat_ws("::", "dataset", "split", "video_id"))
    own = F.transform("kept", lambda k: F.get(F.filter("tracklets", lambda t: t["tracklet_id"] == k), F.lit(0)))
    each = sound.select("video_key", "sample_id", "frame_ids", F.posexplode(own).alias("place", "t"))
    sign = F.sha2(F.to_json(F.struct(F.col("frame_ids").alias("f"), F.col("t.masks").alias("m")), {"ignoreNullFields": "false"}), 256)
    each = each.select("video_key", "sample_id", "place", "t.tracklet_id", "t.source", "t.sam_prompt", masks.visible(F.col("t.masks")).alias("visible"), sign.alias("sign"))
    return each.join(refine.visual_ids(each, known), ["video_key", "sign"])


def visual_packets(inspected: DataFrame, prompt: str, known: DataFrame | None = None) -> DataFrame:
    """(request_id, video_key, samples, ids, max_output_tokens): a video's sound records in order, packed by number and by
    the union of their tracks. Tracks alike in all frames have one visual id in all records of a video."""
    sound = inspected.where("reason is null").withColumn("video_key", F.concat_ws("::", "dataset", "split", "video_id"))
    named = visual_tracks(inspected, known)
    ids = named.groupBy("video_key", "sample_id").agg(F.array_sort(F.collect_set("visual_id")).alias("ids"))
    items = sound.select("video_key", "sample_id").join(ids, ["video_key", "sample_id"], "left").withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    packed = refine.chunks(items, "video_key", "sample_id", "ids")
    p = packed.groupBy("video_key", "chunk").agg(F.array_sort(F.collect_list("sample_id")).alias("samples"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"))
    return p.select(request_id(F.lit(prompt), F.col("video_key"), F.col("samples"), F.col("ids")).alias("request_id"), "video_key", "samples", "ids", refine.reply_tokens(F.size("samples")).alias("max_output_tokens"))
