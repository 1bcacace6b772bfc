"""Registered queries over files and streams, each beside its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import requests
from ..operators.steps import shared_dir
from ..sources import located
from ..streaming import arrivals
from .registry import query


@query("""SELECT doc_id, row_number() OVER () - 1 AS place, length(text) AS len FROM (SELECT doc_id, text FROM documents WHERE doc_id % 7 = 3)""")
def source_order(t):
    chosen = located.places(t.spark, t.path("documents"), "doc_id").where("doc_id % 7 = 3")
    numbered = requests.numbered(chosen, *located.PLACE).drop("doc_id")
    wide = located.fetched(t.spark, t.path("documents"), chosen, "doc_id", "text")
    return wide.join(numbered, list(located.PLACE)).select("doc_id", "place", F.length("text").cast("long").alias("len"))


@query("""SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id FROM events GROUP BY user_id""")
def arriving_records(t):
    at = f"{shared_dir(t.spark)}/spanweave/arrivals-{uuid.uuid4().hex}"
    schema = t("events").select("user_id", "event_id", "event_type").schema
    stream = t.spark.readStream.schema(t("events").schema).parquet(t.path("events") + "*").select("user_id", "event_id", "event_type")
    for run in range(2):  # the second run reads the same files anew, and each row is still there once
        arrivals.upsert(stream, f"{at}/table", f"{at}/checkpoint-{run}", once=True).awaitTermination()
    return arrivals.current(t.spark, f"{at}/table", schema, "user_id", "event_id").select("user_id", "event_type", "event_id")


_LEASES = """SELECT user_id AS sample_id, event_id AS id, 'w' || (event_id % 3) AS owner, CASE WHEN event_id % 4 < 2 THEN 'claim' WHEN event_id % 4 = 2 THEN 'beat' ELSE 'release' END AS kind, epoch_us(ts) AS us FROM events"""


@query(f"""WITH RECURSIVE e AS ({_LEASES}), k AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY us, CAST(kind <> 'claim' AS INT), owner, id) AS n FROM e),
f AS (SELECT DISTINCT sample_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS holder, CAST(0 AS BIGINT) AS beat, 0 AS attempts, CAST(NULL AS VARCHAR) AS owner, CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS BIGINT) AS us, false AS granted FROM k UNION ALL
SELECT k.sample_id, k.n, CASE WHEN k.kind = 'claim' AND (f.holder IS NULL OR f.holder = k.owner OR k.us - f.beat > 1800000000) THEN k.owner WHEN k.kind = 'release' AND f.holder = k.owner THEN NULL ELSE f.holder END,
CASE WHEN k.kind = 'claim' AND (f.holder IS NULL OR f.holder = k.owner OR k.us - f.beat > 1800000000) THEN k.us WHEN k.kind <> 'claim' AND f.holder = k.owner THEN k.us ELSE f.beat END,
f.attempts + CASE WHEN k.kind = 'claim' AND (f.holder IS NULL OR f.holder = k.owner OR k.us - f.beat > 1800000000) THEN 1 ELSE 0 END, k.owner, k.kind, k.us,
CASE WHEN k.kind = 'claim' THEN f.holder IS NULL OR f.holder = k.owner OR k.us - f.beat > 1800000000 ELSE coalesce(f.holder = k.owner, false) END FROM f JOIN k ON k.sample_id = f.sample_id AND k.n = f.n + 1)
SELECT sample_id, owner, kind, us, granted, attempts FROM f WHERE n > 0""")
def lease_grants(t):
    at = f"{shared_dir(t.spark)}/spanweave/leases-{uuid.uuid4().hex}"
    k = F.col("event_id")
    kind = F.when(k % 4 < 2, "claim").when(k % 4 == 2, "beat").otherwise("release")
    stream = t.spark.readStream.schema(t("events").schema).parquet(t.path("events") + "*")
    events = stream.select(F.col("user_id").cast("string").alias("sample_id"), F.concat(F.lit("w"), (k % 3).cast("string")).alias("owner"), kind.alias("kind"), F.col("ts").cast("timestamp").alias("at"))
    arrivals.upsert(arrivals.leases(events), f"{at}/table", f"{at}/checkpoint", once=True).awaitTermination()
    out = t.spark.read.schema(arrivals.GRANT).parquet(f"{at}/table")
    return out.select(F.col("sample_id").cast("long").alias("sample_id"), "owner", "kind", F.unix_micros("at").alias("us"), "granted", "attempts")
