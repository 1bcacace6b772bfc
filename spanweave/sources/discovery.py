"""Which files an input names, and their rows under one schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import located

#: Where a downloaded release keeps its unfiltered tables. They are taken before all else, so that the subset
#: that was verified by hand never joins the rows it was made from.
STANDARD = ("train/verification.parquet", "eval/unfiltered/verification.parquet")


def inputs(spark: SparkSession, path: str) -> list[str]:
    """The tables that a path names: itself if it is one, the two standard ones of a release's root, or else all *.parquet
    in it, by name."""
    path = path.rstrip("/")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if path.endswith(".parquet"):
        if not fs.exists(hadoop(path)):
            raise ValueError(f"there is no {path}")
        return [path]
    if standard := [at for name in STANDARD if fs.exists(hadoop(at := f"{path}/{name}"))]:
        return standard
    names = sorted(s.getPath().getName() for s in fs.listStatus(hadoop(path))) if fs.exists(hadoop(path)) else []
    if found := [f"{path}/{n}" for n in names if n.endswith(".parquet")]:
        return found
    raise ValueError(f"{path} is no table, no folder of tables and no release")


def indexed(spark: SparkSession, paths: list[str], columns: list[str], required: list[str], key: str = "sample_id") -> DataFrame:
    """The given columns and place of every row of all tables. Tables of other columns or kinds than the first, a required
    column that is missing, and a key that repeats end it."""
    first = spark.read.parquet(paths[0]).schema
    if missing := sorted(set(required) - set(first.names)):
        raise ValueError(f"missing columns: {missing}")
    kinds = [(f.name, f.dataType) for f in first.fields]
    for p in paths[1:]:
        if [(f.name, f.dataType) for f in spark.read.parquet(p).schema.fields] != kinds:
            raise ValueError(f"the columns of {p} are not those of {paths[0]}")
    rows = located.places(spark, paths[0], *columns)
    for p in paths[1:]:
        rows = rows.unionByName(located.places(spark, p, *columns))
    if twice := rows.groupBy(key).count().where(F.col("count") > 1).select(key).first():
        raise ValueError(f"{key} {twice[0]} repeats: raw and verified copies don't go together")
    return rows
