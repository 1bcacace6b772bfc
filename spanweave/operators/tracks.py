"""Tracks: assembly from detections, quality, runs, overlap and duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.masks import area, bits_in, run_lengths, sign_words


def assembled(detections: DataFrame, most_pixels: int = 64) -> DataFrame:
    """One track for each object and prompt: frames present, mean and greatest confidence, and pixels up to the number
    that a filter asks for. The mean is that of an exact decimal sum, which the order of rows doesn't change."""
    mean = F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count("*")
    pixels = F.least(F.lit(most_pixels).cast("long"), F.sum(F.floor("value").cast("long")))
    return detections.groupBy("user_id", "event_type").agg(F.count("*").alias("present"), mean.alias("confidence"), F.max("value").alias("max_confidence"), pixels.alias("pixels"))


def judged(frames: Column, present: Column, pixels: Column, most: Column, mean: Column) -> Column:
    """Why a track goes, the first reason that applies, or "retained": too few frames (one of up to four, else a
    twentieth, two at least), too few pixels, or too little confidence."""
    fewest = F.when(frames <= 4, 1).otherwise(F.greatest(F.lit(2), F.floor((frames + 19) / 20)))
    return (
        F.when(present < fewest, F.concat(F.lit("present_frames<"), fewest.cast("string")))
        .when(pixels < 64, "total_pixels<64")
        .when((most < 0.55) | (mean < 0.45), "confidence_below_threshold")
        .otherwise("retained")
    )


def settled(context: DataFrame, same_as_target: float = 0.65, same_as_context: float = 0.80) -> DataFrame:
    """Context tracks in order against their record's targets and each other: outcome, and the track each merges into.

    context: sample_id, place, target_overlap (greatest with any target), overlaps (place, iou) with those before it.
    A track too like a target goes; one like an earlier track that stayed merges into the first such one. The order
    matters, so a record's tracks, which are few, are folded in one array.
    """
    item = F.struct("place", "target_overlap", "overlaps")
    one = context.groupBy("sample_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    start = F.array().cast("array<struct<place:int,outcome:string,into:int>>")

    def step(done: Column, x: Column) -> Column:
        stayed = F.transform(F.filter(done, lambda d: d["outcome"] == "retained"), lambda d: d["place"])
        like = F.array_min(F.transform(F.filter(x["overlaps"], lambda o: (o["iou"] >= same_as_context) & F.array_contains(stayed, o["place"])), lambda o: o["place"]))
        target = x["target_overlap"] >= same_as_target
        outcome = F.when(target, "duplicates_main_referent").when(like.isNotNull(), "merged_duplicate_context_tracklet").otherwise("retained")
        return F.concat(done, F.array(F.struct(x["place"].cast("int").alias("place"), outcome.alias("outcome"), F.when(~target, like).cast("int").alias("into"))))

    return one.select("sample_id", F.explode(F.aggregate("items", start, step)).alias("r")).select("sample_id", "r.place", "r.outcome", "r.into")


def encoded(vectors: DataFrame) -> DataFrame:
    """Run lengths as text and the area of each sign mask."""
    runs = run_lengths(F.col("embedding"))
    return vectors.select("vec_id", F.array_join(runs.cast("array<string>"), ",").alias("runs"), area(runs).alias("area"))


def runs_table(vectors: DataFrame) -> DataFrame:
    """(vec_id, first, length) of every run that is on."""
    each = vectors.select("vec_id", run_lengths(F.col("embedding")).alias("runs"))
    at = F.transform("runs", lambda n, i: F.struct((F.aggregate(F.slice("runs", F.lit(1), i), F.lit(0), lambda a, x: a + x)).alias("first"), n.alias("length"), (i % 2).alias("on")))
    return each.select("vec_id", F.explode(at).alias("r")).where("r.on = 1").select("vec_id", "r.first", "r.length")


def overlaps(vectors: DataFrame, per_video: int, least: float) -> DataFrame:
    """(a, b, inter, total) of mask pairs of one video whose volume overlap reaches `least`.

    A video holds `per_video` tracks, so its pairs are bounded; the overlap is counted on packed bits, all of them.
    """
    m = vectors.select(F.floor(F.col("vec_id") / per_video).alias("video"), "vec_id", sign_words(F.col("embedding")).alias("bits"))
    x, y = m.toDF("video", "a", "p"), m.toDF("video", "b", "q")
    both = x.join(y, "video").where("a < b")
    both = both.select("video", "a", "b", bits_in(F.zip_with("p", "q", lambda x, y: x.bitwiseAND(y))).alias("inter"), bits_in(F.zip_with("p", "q", lambda x, y: x.bitwiseOR(y))).alias("total"))
    return both.where((F.col("total") > 0) & (F.col("inter") >= least * F.col("total")))


def duplicates(vectors: DataFrame, per_video: int) -> DataFrame:
    """(vec_id, alias_of): the first track of the same video with the same mask; a map-side least joined back."""
    m = vectors.select(F.floor(F.col("vec_id") / per_video).alias("video"), "vec_id", sign_words(F.col("embedding")).alias("bits"))
    first = m.groupBy("video", "bits").agg(F.min("vec_id").alias("alias_of"))
    return m.join(first, ["video", "bits"]).select("vec_id", "alias_of")


def span_links(groups: DataFrame, record: str, span: str, member: str) -> DataFrame:
    """The inverse of groups: for each record's span, all members of groups on it, sorted, as text."""
    g = groups.select(record, span, member).distinct().groupBy(record, span)
    return g.agg(F.array_join(F.sort_array(F.collect_list(member)).cast("array<string>"), ",").alias("members"))
