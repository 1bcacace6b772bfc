"""Nested annotation metadata as flat expressions, with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "videos MAP<STRING, STRUCT<frames: ARRAY<STRING>, expressions: MAP<STRING, STRUCT<exp: STRING, obj_id: STRING, anno_id: STRING, type_id: INT>>>>"
OBJECTS = "videos MAP<STRING, STRUCT<objects: MAP<STRING, STRUCT<category: STRING>>>>"


def first_existing(spark: SparkSession, candidates: list[str], kind: str) -> str:
    """The first path that is there, on whatever file system; else an error that names all."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for at in candidates:
        path = hadoop(at)
        if path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
            return at
    raise FileNotFoundError(f"could not find {kind}; checked: " + ", ".join(candidates))


def _json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")


def expressions(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, expression_id, exp, frames, obj_id, anno_id, type_id) of a metadata file, as they stand.

    Ids may be a number, a list or null: they are read as their JSON text, which campaign.units turns into lists.
    """
    v = _json(spark, path, SCHEMA).select(F.explode("videos").alias("video_id", "v"))
    e = v.select("video_id", F.col("v.frames").alias("frames"), F.explode("v.expressions").alias("expression_id", "e"))
    return e.select("video_id", "expression_id", "e.exp", "frames", "e.obj_id", "e.anno_id", "e.type_id")


def objects(spark: SparkSession, path: str) -> DataFrame:
    """(video_id, object_id, category) of an object metadata file."""
    v = _json(spark, path, OBJECTS).select(F.explode("videos").alias("video_id", "v"))
    return v.select("video_id", F.explode("v.objects").alias("object_id", "o")).select("video_id", F.col("object_id").cast("int").alias("object_id"), "o.category")


def verification_rows(spark: SparkSession, paths: list[str], required: list[str]) -> DataFrame:
    """The rows of all files in canonical order; a missing column or an id that repeats ends the job."""
    parts = [spark.read.parquet(p) for p in paths]
    for p, d in zip(paths, parts, strict=True):
        if missing := sorted(set(required) - set(d.columns)):
            raise ValueError(f"{p} lacks {missing}")
    rows = parts[0]
    for d in parts[1:]:
        rows = rows.unionByName(d, allowMissingColumns=True)
    if twice := rows.groupBy("sample_id").count().where("count > 1").select("sample_id").first():
        raise ValueError(f"sample_id {twice[0]} repeats")
    return rows.orderBy("dataset", "split", "video_id", "expression_id")
