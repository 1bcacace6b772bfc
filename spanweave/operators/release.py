"""Samples for pilots, what a full run may cost, and what may be published."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import stable_key
from .steps import running

#: Upper ends of the density bins; a batch's price beside single requests, and the margin on it.
BINS = ((2, "0–2"), (5, "3–5"), (12, "6–12"))
BATCH, MARGIN = 0.5, 1.5


def density(count: Column) -> Column:
    out = F.lit("13+")
    for most, name in reversed(BINS):
        out = F.when(count <= most, name).otherwise(out)
    return out


def pilot(rows: DataFrame, per_dataset: int, seed: str, per_video: int = 2) -> DataFrame:
    """At most `per_dataset` instructions of each dataset: its first negative one, then videos in hash order, that of
    the negative one first, `per_video` instructions of each beside it.

    rows: dataset, video_key, sample_id, negative. A video's rows are ranked among themselves; of a dataset only
    its first videos, as many as can be needed, are ranked together.
    """
    r = rows.withColumn("_s", stable_key(seed, F.col("sample_id"))).withColumn("_v", stable_key(seed, F.col("video_key")))
    lead = r.where("negative").groupBy("dataset").agg(F.min(F.struct("_s", "sample_id", "video_key")).alias("_lead")).select("dataset", F.col("_lead.sample_id").alias("_first"), F.col("_lead.video_key").alias("_home"))
    r = r.join(lead, "dataset", "left").withColumn("_is", F.coalesce(F.col("sample_id") == F.col("_first"), F.lit(False))).withColumn("_own", F.coalesce(F.col("video_key") == F.col("_home"), F.lit(False)))
    within = Window.partitionBy("dataset", "video_key").orderBy("_is", "_s", "sample_id")
    r = r.withColumn("_n", F.row_number().over(within)).where(F.col("_is") | (F.col("_n") <= per_video))
    # whole videos in order until the quota is full: each holds at least one row, so the first per_dataset rows decide
    order = [F.desc("_is"), F.desc("_own"), F.col("_v"), F.col("_n")]
    shard = Window.partitionBy("dataset", F.pmod(F.xxhash64("video_key"), F.lit(64))).orderBy(*order)
    r = r.withColumn("_m", F.row_number().over(shard)).where(F.col("_m") <= per_dataset)
    r = r.withColumn("place", F.row_number().over(Window.partitionBy("dataset").orderBy(*order))).where(F.col("place") <= per_dataset)
    return r.select(*rows.columns, "place")


def dense_videos(rows: DataFrame, per_dataset: int, seed: str, featured: list[str]) -> DataFrame:
    """`per_dataset` videos of each dataset, spread over the density bins of their densest instructions.

    rows: dataset, video_key, video_id, sample_id, candidates. Featured videos count first; each bin has a quarter
    of the quota (the first ones one more where it does not divide), and what a bin lacks is taken from the rest
    in hash order. Videos are reduced to one row each before they are ranked.
    """
    best = rows.groupBy("dataset", "video_key", "video_id").agg(F.max_by(F.struct("sample_id", "candidates"), F.struct("candidates", F.translate(stable_key(seed, F.col("sample_id")), "0123456789abcdef", "fedcba9876543210"))).alias("b"))
    v = best.select("dataset", "video_key", "video_id", "b.sample_id", "b.candidates", density(F.col("b.candidates")).alias("bin"), F.col("video_id").isin(featured).alias("featured"), stable_key(seed, F.col("video_key")).alias("_k"))
    names = [*[n for _, n in BINS], "13+"]
    quota = F.lit(0)
    for i, name in enumerate(names):
        quota = F.when(F.col("bin") == name, per_dataset // 4 + (i < per_dataset % 4)).otherwise(quota)
    of_bin = Window.partitionBy("dataset", "bin").orderBy(F.desc("featured"), "_k")
    v = v.withColumn("_n", F.row_number().over(of_bin)).withColumn("_turn", F.when(F.col("featured"), 0).when(F.col("_n") <= quota, 1).otherwise(2))
    v = v.where(F.col("_n") <= per_dataset)  # no more of a bin can be needed
    place = F.row_number().over(Window.partitionBy("dataset").orderBy("_turn", "_k"))
    return v.withColumn("place", place).where(F.col("place") <= per_dataset).select("dataset", "video_key", "video_id", "sample_id", "candidates", "bin", "featured")


def shared_charges(packets: DataFrame, charges: DataFrame) -> DataFrame:
    """(sample_id, cost): each packet's charge in equal parts on its samples, summed over packets."""
    each = packets.join(charges, "request_id", "left").select(F.explode("samples").alias("sample_id"), (F.coalesce("amount", F.lit(0.0)) / F.size("samples")).alias("part"))
    return each.groupBy("sample_id").agg(F.sum("part").alias("cost"))


def estimated(pilot_costs: DataFrame, population: DataFrame, strata: list[str]) -> DataFrame:
    """Each stratum's mean, expected and buffered cost of the full run: half price in batches, two standard errors and
    half as much again. A stratum of the population that the pilot lacks ends the job.

    pilot_costs: strata, cost (decimal sums, so the order of addition has no part); population: strata.
    """
    c = F.col("cost").cast("decimal(18,4)")
    one = pilot_costs.groupBy(*strata).agg(F.count("*").alias("pilot_rows"), F.sum(c).cast("double").alias("_s"), F.sum((c * c).cast("decimal(38,8)")).cast("double").alias("_q"))
    rows = population.groupBy(*strata).agg(F.count("*").alias("rows"))
    j = rows.join(one, strata, "left")
    j = j.where(F.when(F.col("pilot_rows").isNotNull(), True).otherwise(F.raise_error(F.concat(F.lit("the pilot lacks stratum "), F.concat_ws("/", *strata)))))
    n = F.col("pilot_rows")
    j = j.withColumn("mean", F.col("_s") / n)
    spread = F.greatest(F.col("_q") - n * F.col("mean") * F.col("mean"), F.lit(0.0)) / F.greatest(n - 1, F.lit(1))
    upper = F.col("mean") + 2 * F.sqrt(spread / n)
    return j.select(*strata, "rows", "pilot_rows", "mean", (F.col("rows") * F.col("mean") * BATCH).alias("expected"), (F.col("rows") * upper * BATCH * MARGIN).alias("buffered"))


def reserved(charges: DataFrame, asked: DataFrame, limit: float) -> DataFrame:
    """The charges with those asked for reserved, all or none: beyond the limit, or against one already charged with
    another amount, the job ends. charges and asked: id, amount (asked's states are reserved); unsubmitted ones are free."""
    a = asked.select("id", F.col("amount").alias("_new"))
    both = charges.join(a, "id", "full")
    clash = F.col("_new").isNotNull() & F.col("state").isNotNull() & (F.col("state") != "unsubmitted") & ~((F.col("state") == "reserved") & (F.col("amount") == F.col("_new")))
    free = F.col("_new").isNotNull() & (F.col("state").isNull() | (F.col("state") == "unsubmitted"))
    after = both.select("id", F.when(free, F.col("_new")).otherwise(F.col("amount")).alias("amount"), F.when(free, "reserved").otherwise(F.col("state")).alias("state"), clash.alias("clash"))
    total = after.agg(F.sum(F.col("amount").cast("decimal(18,6)")).alias("_total"), F.max("clash").alias("_clash"))
    why = F.when(F.col("_clash"), "reservation conflicts with an earlier charge").when(F.col("_total") > limit, "budget limit reached")
    return after.drop("clash").crossJoin(F.broadcast(total)).where(F.when(why.isNull(), True).otherwise(F.raise_error(why))).select("id", "amount", "state")


def publication_faults(audit: DataFrame, selected: DataFrame) -> DataFrame:
    """(fault, n): what keeps an audit (sample_id, decision) of the selected samples from publication."""
    a = audit.groupBy("sample_id").agg(F.count("*").alias("times"), F.max("decision").alias("decision"))
    both = a.join(selected.select("sample_id", F.lit(True).alias("_chosen")).distinct(), "sample_id", "full")
    why = (
        F.when(F.col("times").isNull(), "not_audited")
        .when(F.col("_chosen").isNull(), "not_selected")
        .when(F.col("times") > 1, "audited_twice")
        .when(~F.coalesce(F.col("decision").isin("keep", "rewrite", "reject", "error"), F.lit(False)), "unknown_outcome")
        .when(F.col("decision") == "error", "unresolved")
    )
    return both.groupBy(why.alias("fault")).agg(F.count("*").alias("n")).where("fault is not null")


def variant_stats(rows: DataFrame) -> DataFrame:
    """Rows, tracks, links, negatives and literal "(s)" of each variant: all rows, and those that are complete.

    rows: caption, disposition, object_count, linked_phrase_count, is_nonexistent. Both variants come from one pass.
    """
    which = F.when(F.col("disposition") == "complete_bcc", F.array(F.lit("train_all"), F.lit("train_filtered"))).otherwise(F.array(F.lit("train_all")))
    return rows.withColumn("variant", F.explode(which)).groupBy("variant").agg(*_stats(F.lit(True)))


def _stats(on: Column, suffix: str = "") -> list[Column]:
    add = lambda c: F.coalesce(F.sum(F.when(on, c)), F.lit(0)).cast("long")
    return [
        F.count_if(on).alias("rows" + suffix),
        add(F.col("object_count")).alias("tracklets" + suffix),
        add(F.col("linked_phrase_count")).alias("span_links" + suffix),
        F.count_if(on & F.col("is_nonexistent")).alias("negative" + suffix),
        F.count_if(on & F.contains("caption", F.lit("(s)"))).alias("literal_s_rows" + suffix),
    ]


def source_stats(rows: DataFrame, retained: DataFrame) -> DataFrame:
    """One row: the statistics of all rows and of those retained, in one pass."""
    j = rows.join(retained.select("sample_id", F.lit(True).alias("_kept")).distinct(), "sample_id", "left")
    return j.agg(*_stats(F.lit(True)), *_stats(F.coalesce("_kept", F.lit(False)), "_retained"))


def split_faults(rows: DataFrame, split: str = "train") -> DataFrame:
    return rows.agg(F.count_if(~F.col("split").eqNullSafe(F.lit(split))).alias("foreign_rows"))


def inventory_faults(before: DataFrame, after: DataFrame, archived: dict[str, str], uploads: DataFrame) -> DataFrame:
    """(name, fault): files (name, identity) that are not as they should be after a publication: archived ones under
    their new names unchanged and gone from the old, uploads as made, all others as before."""
    pairs = F.create_map(*[F.lit(x) for kv in archived.items() for x in kv]) if archived else None
    moved = pairs[F.col("name")] if archived else F.lit(None).cast("string")
    b = before.select(F.coalesce(moved, F.col("name")).alias("name"), F.col("identity").alias("_old"), moved.isNotNull().alias("_moved"))
    u = uploads.select("name", F.col("identity").alias("_new"))
    j = after.join(b, "name", "full").join(u, "name", "full")
    old_name = F.col("name").isin(list(archived)) & F.col("_new").isNull() if archived else F.lit(False)
    why = (
        F.when(F.coalesce("_moved", F.lit(False)) & ~F.col("identity").eqNullSafe(F.col("_old")), "archived_differs")
        .when(F.col("_new").isNotNull() & ~F.col("identity").eqNullSafe(F.col("_new")), "upload_differs")
        .when(F.col("_new").isNull() & old_name & F.col("identity").isNotNull(), "not_moved")
        .when(F.col("_new").isNull() & F.col("_old").isNotNull() & ~F.col("identity").eqNullSafe(F.col("_old")), "unrelated_changed")
    )
    return j.select("name", why.alias("fault")).where("fault is not null")


def decided(ids: DataFrame, decisions: DataFrame, early: DataFrame) -> DataFrame:
    """Each id's decision: the stored one, else that of the structural rules, else pending."""
    d = decisions.select("sample_id", F.col("decision").alias("_d"))
    e = early.select("sample_id", F.col("decision").alias("_e"))
    return ids.join(d, "sample_id", "left").join(e, "sample_id", "left").select("sample_id", F.coalesce("_d", "_e", F.lit("pending")).alias("decision"))


def covered(replies: DataFrame, packets: DataFrame) -> DataFrame:
    """(request_id, covers): whether a reply names each sample of its packet, and no other, exactly once."""
    j = packets.join(replies, "request_id")
    return j.select("request_id", (F.array_sort("samples") == F.array_sort("answered")).alias("covers"))


def sharded(rows: DataFrame, size: str, most: int, order: list[str]) -> DataFrame:
    """shard: rows in order of `order`, a shard of about `most` units of `size`: a row's shard is that in which it begins."""
    before = f"_before_{uuid.uuid4().hex}"
    r = running(rows, order, **{before: F.coalesce(size, F.lit(0))})
    return r.withColumn("shard", F.floor(F.col(before) / most).cast("int")).select(*rows.columns, "shard")
