"""Review: which instructions a video suggests, what reviewers decided, and records with their edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import spans


def suggestion_key(video: Column, sample: Column) -> Column:
    """Order of suggestions: the SHA-256 of key, a zero byte and id, in hexadecimal, which orders as its bytes do."""
    return F.sha2(F.concat(video, F.lit("\u0000"), sample.cast("string")), 256)


def ranked(rows: DataFrame, video: str, sample: str, bears: Column) -> DataFrame:
    """rank: place among a video's instructions, those with tracks (and not negative) first."""
    order = Window.partitionBy(video).orderBy((~bears).cast("int"), suggestion_key(F.col(video), F.col(sample)), sample)
    return rows.withColumn("rank", F.row_number().over(order))


def preview(ranked_rows: DataFrame, video: str, cohort: str) -> DataFrame:
    """All nonexistent instructions of a video and its first explicit and first implicit one by rank, in this order.

    The first of a cohort is a map-side least, so no video's rows are sorted.
    """
    c = F.lower(cohort)
    best = ranked_rows.where(c.isin("explicit", "implicit")).groupBy(video, c.alias("_c")).agg(F.min("rank").alias("_first"))
    rows = ranked_rows.withColumn("_c", c).join(best, [video, "_c"], "left").where((c == "nonexistent") | (F.col("rank") == F.col("_first")))
    turn = F.when(c == "nonexistent", 0).when(c == "explicit", 1).otherwise(2)
    order = Window.partitionBy(video).orderBy(turn, "rank")
    return rows.withColumn("place", F.row_number().over(order)).drop("_c", "_first")


def eligible(edit_status: Column, discarded: Column) -> Column:
    return ~(F.coalesce(discarded, F.lit(False)) | (F.coalesce(edit_status, F.lit("")) == "rejected"))


def selection_faults(rows: DataFrame, decisions: DataFrame, edits: DataFrame) -> DataFrame:
    """(video_key, fault): the first rule that a video's selection breaks.

    decisions: video_key, status, allow_multiple, selected and accepted (arrays or null); edits: video_key,
    sample_id, status, discarded.
    """
    own = rows.groupBy("video_key").agg(F.collect_set("sample_id").alias("own"))
    out = edits.where(~eligible(F.col("status"), F.col("discarded"))).groupBy("video_key").agg(F.collect_set("sample_id").alias("out"))
    d = decisions.join(own, "video_key", "left").join(out, "video_key", "left")
    none = F.array().cast("array<string>")
    held, gone = F.coalesce("own", none), F.coalesce("out", none)
    wrong = lambda c: (F.size(F.array_distinct(c)) < F.size(c)) | (F.size(F.array_except(c, held)) > 0)
    taken = F.col("status") == "accepted"
    rule = (
        F.when(F.col("accepted").isNotNull() & wrong(F.col("accepted")), "accepted_duplicate_or_foreign")
        .when(F.col("selected").isNull() & taken & (F.coalesce(F.size("accepted"), F.lit(0)) <= 0), "nothing_confirmed")
        .when(F.col("selected").isNotNull() & wrong(F.col("selected")), "selected_duplicate_or_foreign")
        .when((F.size("selected") > 1) & ~F.coalesce("allow_multiple", F.lit(False)), "several_without_leave")
        .when(taken & (F.size("selected") == 0), "nothing_confirmed")
        .when(taken & F.coalesce(F.arrays_overlap("selected", gone), F.lit(False)), "discarded_selected")
    )
    return d.select("video_key", rule.alias("fault")).where("fault is not null")


def exported(ranked_rows: DataFrame, decisions: DataFrame, edits: DataFrame) -> DataFrame:
    """(video_key, sample_id): of each accepted video, its first eligible candidate by rank.

    Candidates are those selected, else those accepted before, else all.
    """
    d = decisions.where("status = 'accepted'").select("video_key", F.coalesce("selected", "accepted").alias("_chosen"))
    e = edits.select("video_key", "sample_id", F.col("status").alias("_status"), "discarded")
    rows = ranked_rows.join(d, "video_key").join(e, ["video_key", "sample_id"], "left")
    rows = rows.where(eligible(F.col("_status"), F.col("discarded")) & (F.col("_chosen").isNull() | F.array_contains("_chosen", F.col("sample_id"))))
    return rows.groupBy("video_key").agg(F.min_by("sample_id", "rank").alias("sample_id"))


def normalised(groups: Column, ids: Column, text: Column) -> Column:
    """Groups with the surviving ids, sorted, and the spans that say what the text says; empty ones go."""
    own = F.transform(groups, lambda g: F.struct(g["group_id"].alias("group_id"), F.coalesce(g["role"], F.lit("manual_link")).alias("role"), g["identity"].alias("identity"), F.filter(g["text_spans"], lambda s: spans.literal(text, s)).alias("text_spans"), F.array_sort(F.array_intersect(F.array_distinct(g["tracklet_ids"]), ids)).alias("tracklet_ids")))
    some = F.filter(own, lambda g: (F.size(g["text_spans"]) > 0) & (F.size(g["tracklet_ids"]) > 0))
    named = lambda g, i: F.struct(F.coalesce(g["group_id"], F.concat(F.lit("manual-"), F.lpad((i + 1).cast("string"), 3, "0"))).alias("group_id"), g["role"].alias("role"), F.coalesce(g["identity"], F.array_join(g["tracklet_ids"], "/")).alias("identity"), g["text_spans"].alias("text_spans"), g["tracklet_ids"].alias("tracklet_ids"))
    return F.transform(some, named)


def overlaid(records: DataFrame, edits: DataFrame, status: DataFrame) -> DataFrame:
    """The records with their edits: new text, tracks deleted, groups replaced, then links made anew.

    edits: sample_id, new_text, deleted (array), new_groups (array or null), edit_status; status: video_key,
    status. Records without an edit keep what they have.
    """
    r = records.join(edits, "sample_id", "left").join(status.withColumnRenamed("status", "_video"), "video_key", "left")
    gone = F.coalesce("deleted", F.array().cast("array<string>"))
    r = r.withColumn("text", F.coalesce("new_text", "text")).withColumn("tracklets", F.filter("tracklets", lambda t: ~F.array_contains(gone, t["tracklet_id"])))
    ids = F.transform("tracklets", lambda t: t["tracklet_id"])
    r = r.withColumn("groups", normalised(F.coalesce("new_groups", "groups"), ids, F.col("text")))
    r = r.withColumn("span_links", spans.links(F.col("groups"))).withColumn("verification_status", F.coalesce("edit_status", "_video", F.lit("undecided")))
    return r.select(*records.columns, "verification_status")


def media_candidates(roots: list[str], sources: Column) -> Column:
    """Where a stored path may lie now: each root, each tail of each path under each root, then the paths as they
    were; each once, in this order."""
    def under(root: str) -> Column:
        def one(path: Column) -> Column:
            parts = F.filter(F.split(path, "/"), lambda p: p != "")
            tails = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1))), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))
            return F.transform(F.filter(tails, lambda x: x != ""), lambda x: F.concat(F.lit(root.rstrip("/") + "/"), x))

        return F.flatten(F.transform(known, one))

    known = F.array_compact(sources)
    every = [F.concat(F.array(F.lit(r.rstrip("/"))), under(r)) for r in roots]
    return F.array_distinct(F.concat(*every, known))
