"""Tables between steps, and running sums over a global order."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share, spark.checkpoint.dir; a local session without one uses its machine's own."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: tables between steps need a folder that all machines share")
    return (at or f"{tempfile.gettempdir()}/spanweave-{os.getpid()}").rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: what is read from it twice is the same twice, and lost executors take
    nothing with them."""
    at = f"{shared_dir(df.sparkSession)}/spanweave/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def running(rows: DataFrame, order: list[str], **sizes: Column) -> DataFrame:
    """The rows with, under each name, the sum of its size over all rows before each one in this order, exact at any size.

    Rows are dealt by range of the order and written with the number of their range, so that the sums of ranges and those
    within them come from one dealing; a second one would draw other borders. No task sees more than its range. Rows
    equal in the whole order lie in one range and follow in any order there.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    mark = uuid.uuid4().hex
    part, own = f"_part_{mark}", {n: f"_own_{i}_{mark}" for i, n in enumerate(sizes)}
    base = {n: f"_base_{i}_{mark}" for i, n in enumerate(sizes)}
    dealt = rows.repartitionByRange(parts, *order)
    r = written(dealt.withColumns({part: F.spark_partition_id()} | {own[n]: c.cast("long") for n, c in sizes.items()}), "ranges")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = r.groupBy(part).agg(*[F.sum(own[n]).alias(base[n]) for n in sizes]).select(part, *[F.coalesce(F.sum(base[n]).over(before), F.lit(0)).alias(base[n]) for n in sizes])
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = r.join(F.broadcast(bases), part)  # a row for each range, which the setting bounds
    return out.withColumns({n: F.coalesce(F.sum(own[n]).over(inside), F.lit(0)) + F.col(base[n]) for n in sizes}).select(*rows.columns, *sizes)
