"""Work units: ids, gates, first rows, stable ranks and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank, safe, stable_key


def units(docs: DataFrame) -> DataFrame:
    """One work unit for each expression, with its composed id."""
    name = F.concat(F.lit("corpus__"), "lang", F.lit("__full__"), safe("source"), F.lit("__e"), F.col("doc_id").cast("string"))
    return docs.select("doc_id", name.alias("sample_id"), blank(F.col("text")).alias("is_blank"), F.length("text").cast("long").alias("length"))


def without(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_anti")


def counted(df: DataFrame, by: str, expected: dict[str, int] | None = None) -> DataFrame:
    """Rows by cohort, and whether each count is the one expected (null: none is)."""
    n = df.groupBy(by).agg(F.count("*").alias("n"))
    if not expected:
        return n
    pairs = F.create_map(*[F.lit(x) for kv in expected.items() for x in kv])
    return n.withColumn("as_expected", F.col("n") == F.element_at(pairs, F.col(by)))


def first_of(df: DataFrame, group: str, *order: Column) -> DataFrame:
    """Each group's first row: a map-side least of the row behind its order, without a sort."""
    row = F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)], *[F.col(c) for c in df.columns])
    return df.groupBy(group).agg(F.min(row).alias("_r")).select(*[F.col("_r").getField(c).alias(c) for c in df.columns])


def stable_rank(df: DataFrame, group: str, seed: str, *key: Column) -> DataFrame:
    """rank: each row's place in its group in an order that the seed decides."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(stable_key(seed, *key), *key)))


def density_bins(items: DataFrame, group: str, edges: list[int]) -> DataFrame:
    """n items in each group and the bin of n: the number of edges that it reaches."""
    n = items.groupBy(group).agg(F.count("*").alias("n"))
    return n.withColumn("bin", sum((F.col("n") >= e).cast("int") for e in edges))


def stratified(df: DataFrame, stratum: str, seed: str, most: int, key: str) -> DataFrame:
    """At most `most` rows of each stratum, in the seed's order. A row's hash first picks a shard, so that a
    large stratum is cut to the least of each shard before its own rows meet."""
    k = stable_key(seed, F.col(key))
    shard = Window.partitionBy(stratum, F.pmod(F.xxhash64(key), F.lit(64))).orderBy(k, key)
    part = df.withColumn("_n", F.row_number().over(shard)).where(F.col("_n") <= most).drop("_n")
    whole = Window.partitionBy(stratum).orderBy(k, key)
    return part.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= most)


def evenly(df: DataFrame, group: str, order: list[str], most: int) -> DataFrame:
    """At most `most` rows of each group, evenly from its first to its last."""
    w = Window.partitionBy(group)
    at = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    hit = F.floor(F.ceil(F.col("_i") * (most - 1) / (F.col("_n") - 1)) * (F.col("_n") - 1) / (most - 1)) == F.col("_i")
    return at.where((F.col("_n") <= most) | hit).drop("_i", "_n")


def chunked(df: DataFrame, group: str, order: list[str], size: int) -> DataFrame:
    """chunk: rows of each group, numbered in bounded packets of `size`."""
    n = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("chunk", F.floor((n - 1) / size).cast("int"))
