"""Queries by name, each beside its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Tables of one folder by name, and where they lie."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"


def query(sql: str | None = None):
    """Registers f(tables) under its own name."""

    def add(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Tables(spark, sf_dir))

        QUERIES[f.__name__] = run
        if sql:
            ORACLE[f.__name__] = sql
        return run

    return add
