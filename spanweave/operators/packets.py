"""Greedy packing of ordered items under limits, as a fold within each group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def greedy(df: DataFrame, group: str, order: list[str], weight: str, most_weight: float, most_items: int) -> DataFrame:
    """(group, batch, n, weight): items in order; one that would exceed a limit opens the next batch.

    An item above the weight limit has a batch of its own. A group is one request file and must be bounded
    by its caller; items of equal order are taken by weight.
    """
    item = F.struct(*order, F.col(weight).cast("double").alias("_w"))
    empty = F.array().cast("array<struct<n:int,weight:double>>")

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        fits = (F.size(done) > 0) & (last["n"] < most_items) & (last["weight"] + x["_w"] <= most_weight)
        grown = F.array(F.struct((last["n"] + 1).alias("n"), (last["weight"] + x["_w"]).alias("weight")))
        new = F.array(F.struct(F.lit(1).alias("n"), x["_w"].alias("weight")))
        return F.when(fits, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), grown)).otherwise(F.concat(done, new))

    packs = df.groupBy(group).agg(F.sort_array(F.collect_list(item)).alias("items")).select(group, F.posexplode(F.aggregate("items", empty, step)).alias("batch", "b"))
    return packs.select(group, "batch", F.col("b.n").alias("n"), F.col("b.weight").alias("weight"))
