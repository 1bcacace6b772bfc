"""Decisions over records: lookups, overlays, ledgers, audits, releases and costs."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_category(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Category of each record by its label; unlabelled ones keep their place."""
    name = F.when(F.col("quality") == 1, "explicit").when(F.col("quality") == 0, "implicit").otherwise("nonexistent")
    return docs.join(labels, "doc_id", "left").select("doc_id", name.alias("category"))


def ledger(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Records by language and status."""
    status = F.when(F.col("toxic") == 1, "rejected").when(F.col("toxic") == 0, "accepted").otherwise("pending")
    return docs.join(labels, "doc_id", "left").groupBy("lang", status.alias("status")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def overlaid(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Edits replace what they touch; discarded records go."""
    kept = F.coalesce(F.col("toxic"), F.lit(0)) == 0
    lang = F.when(F.col("quality") == 1, F.upper("lang")).otherwise(F.col("lang"))
    return docs.join(labels, "doc_id", "left").where(kept).select("doc_id", lang.alias("lang"), F.col("quality").isNotNull().alias("edited"))


def audited(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many keys are in both, or in one side only, and how many of them some side has more than once."""
    a, b = left.groupBy(key).agg(F.count("*").alias("l")), right.groupBy(key).agg(F.count("*").alias("r"))
    side = F.when(F.col("r").isNull(), "left_only").when(F.col("l").isNull(), "right_only").otherwise("both")
    return a.join(b, key, "full").groupBy(side.alias("side")).agg(F.count("*").alias("n"), F.count_if((F.col("l") > 1) | (F.col("r") > 1)).alias("repeated"))


def fingerprint(docs: DataFrame, block: int = 1000) -> DataFrame:
    """A SHA-256 for each block of ids over id and text in order; blocks bound what one task holds."""
    item = F.struct("doc_id", F.concat_ws("\u0000", F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))).alias("x"))
    lines = F.array_join(F.transform(F.sort_array(F.collect_list(item)), lambda r: r["x"]), "\u0000")
    return docs.groupBy(F.floor(F.col("doc_id") / block).cast("long").alias("block")).agg(F.sha2(lines, 256).alias("digest"), F.count("*").alias("n"))


def whole_fingerprint(rows: DataFrame, order: list[str], id_col: str, text_col: str) -> str:
    """One SHA-256 over id, zero byte, text and zero byte of all rows in order. Such a digest can only be made in
    sequence; rows are sorted on the cluster and pass the driver one partition at a time."""
    digest = hashlib.sha256()
    for r in rows.orderBy(*order).select(F.col(id_col).cast("string"), F.coalesce(text_col, F.lit(""))).toLocalIterator():
        digest.update(r[0].encode() + b"\0" + r[1].encode() + b"\0")
    return digest.hexdigest()


def charges(orders: DataFrame) -> DataFrame:
    return orders.groupBy(F.col("o_orderstatus").alias("state")).agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("amount"))


def cost_by_stratum(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Mean cost of each stratum and its projection; the small tables are left to the optimizer's size check."""
    j = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return j.groupBy("n_name").agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 2).alias("mean_cost"), F.round(F.sum("o_totalprice") * 1.1, 0).alias("buffered"))


def published(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Public names; train_all holds all records, train_filtered the good ones."""
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    d = docs.join(labels, "doc_id", "left").select(F.col("doc_id").alias("id"), F.col("lang").alias("dataset"), F.col("source").alias("video"), F.length("text").cast("long").alias("caption_length"), good.alias("good"))
    return d.select("*", F.explode(F.when(F.col("good"), F.array(F.lit("train_all"), F.lit("train_filtered"))).otherwise(F.array(F.lit("train_all")))).alias("variant")).drop("good")
