"""Rows by their place in the source: a narrow scan of keys and places, wide columns for chosen rows, source order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLACE = ("source_file", "source_row")


def places(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The given columns alone, and source_file and source_row of each row: the file's path and the row's number in it."""
    at = [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("source_row")]
    return spark.read.parquet(path).select(*columns, *at)


def fetched(spark: SparkSession, path: str, chosen: DataFrame, *columns: str) -> DataFrame:
    """Wide columns of the chosen rows (source_file, source_row), with their places. Spark sends the places to the scan if
    they are few, and otherwise meets both by place; a chosen place that isn't there returns nothing."""
    return places(spark, path, *columns).join(chosen.select(*PLACE).distinct(), list(PLACE), "left_semi")


def in_source_order(rows: DataFrame) -> DataFrame:
    """Rows as they lie in the source: by file, then by number."""
    return rows.orderBy(*PLACE)


def snapshot(spark: SparkSession, path: str, keys: DataFrame, key: str, out: str) -> None:
    """The rows of `path` whose key is among `keys`, each once or the job ends, written in source order."""
    there = places(spark, path, key)
    mine = there.join(keys.select(key).distinct(), key, "left_semi")
    twice = mine.groupBy(key).count().where("count > 1").select(key).limit(1).collect()
    if twice:
        raise ValueError(f"{key} {twice[0][0]} lies in the source more than once")
    columns = spark.read.parquet(path).columns
    in_source_order(fetched(spark, path, mine, *columns)).drop(*PLACE).write.option("compression", "zstd").parquet(out)
