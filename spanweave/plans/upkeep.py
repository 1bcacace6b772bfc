"""Registered queries over a run's upkeep: claims, limits after errors, draws, prices, refusals and redaction, each beside its
SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import campaign, refine
from .registry import query


@query("""SELECT doc_id, NOT (doc_id % 5 = 0) AND (doc_id % 3 <> 0 OR doc_id % 4 > 0) AS needs_model, substr(sha256('d::t::v' || (doc_id // 4)), 1, 24) AS claim FROM documents""")
def work_claims(t):
    i = F.col("doc_id")
    prompts = F.when(i % 4 > 0, F.array_repeat(F.lit("p"), (i % 4).cast("int")))
    expected = F.when(i % 3 == 0, "official_dataset_ground_truth").otherwise("sam3.1_multiplex")
    key = F.concat(F.lit("d::t::v"), F.floor(i / 4).cast("string"))
    return t("documents").select(i, campaign.needs_model(i % 5 == 0, expected, prompts).alias("needs_model"), campaign.claim(key).alias("claim"))


@query("""WITH u AS (SELECT o_orderkey AS k, o_custkey AS video_key FROM orders) SELECT video_key, CASE WHEN max(CAST(k % 12 = 0 AS INT)) = 1 THEN 8 ELSE 16 END AS most_objects FROM u GROUP BY 1""")
def object_limits(t):
    k = F.col("o_orderkey")
    units = t("orders").select(k.cast("string").alias("sample_id"), F.col("o_custkey").alias("video_key"))
    errors = t("orders").where("o_orderkey % 2 = 0").select(k.cast("string").alias("sample_id"), F.when(k % 3 == 0, "OutOfMemoryError").otherwise("ValueError").alias("error_type"), (k % 4 < 3).alias("memory_safe_mode"), F.when(k % 4 == 0, F.lit(1)).when(k % 4 == 2, F.lit(2)).alias("grounding_batch_size"))
    return campaign.object_limit(units, errors)


@query("""WITH d AS (SELECT lang, 'v' || (doc_id // 3) AS video_id, CAST(doc_id AS VARCHAR) AS expression_id, sha256('7:v' || (doc_id // 3) || ':' || doc_id) AS k FROM documents WHERE lang IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, video_id ORDER BY k) AS nth FROM d), a AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY k) AS n FROM d), b AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY k) AS n FROM o WHERE nth = 1)
SELECT 'all' AS kind, lang, expression_id FROM a WHERE n <= 9 UNION ALL SELECT 'one', lang, expression_id FROM b WHERE n <= 9""")
def drawn_units(t):
    d = t("documents").where("lang is not null").select("lang", F.concat(F.lit("v"), F.floor(F.col("doc_id") / 3).cast("string")).alias("video_id"), F.col("doc_id").cast("string").alias("expression_id"))
    kinds = [campaign.drawn(d, "lang", 9, "7", one).select(F.lit(name).alias("kind"), "lang", "expression_id") for name, one in (("all", False), ("one", True))]
    return kinds[0].union(kinds[1])


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, (l_orderkey * 977 + l_linenumber * 31) % 400000 AS input, (l_orderkey * 13) % 5000 AS cached, CASE WHEN l_orderkey % 2 = 0 THEN (l_orderkey * 7) % 3000 END AS written, l_orderkey % 9000 AS reply FROM lineitem)
SELECT l_orderkey, l_linenumber, round(CAST(0.5 AS DOUBLE) * ((greatest(input - cached - coalesce(written, 0), 0) * CASE WHEN written IS NULL THEN CAST(0.125 AS DOUBLE) ELSE 0.1 END + cached * CAST(0.01 AS DOUBLE) + coalesce(written, 0) * CAST(0.125 AS DOUBLE)) * CASE WHEN input > 272000 THEN 2 ELSE 1 END + reply * CASE WHEN input > 272000 THEN CAST(0.75 AS DOUBLE) ELSE 0.5 END) / 1e6, 10) AS cost FROM l""")
def reply_costs(t):
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    cost = refine.used_cost((k * 977 + n * 31) % 400000, (k * 13) % 5000, F.when(k % 2 == 0, (k * 7) % 3000), k % 9000)
    return t("lineitem").select("l_orderkey", "l_linenumber", F.round(cost, 10).alias("cost"))


@query("""SELECT event_id, event_id % 5 = 0 OR event_id % 3 = 1 AS queued, CASE WHEN (event_id % 5 = 0 OR event_id % 3 = 1) AND event_id % 2 = 0 THEN 1000 + event_id END AS limit_tokens FROM events""")
def queue_refusals(t):
    i = F.col("event_id")
    code = F.when(i % 5 == 0, "token_limit_exceeded").otherwise("other")
    thousand = F.format_number(1000 + i, 0)
    said = F.concat(F.when(i % 3 == 1, "Enqueued Token count is over.").when(i % 3 == 2, "queue limit").otherwise("no"), F.when(i % 2 == 0, F.concat(F.lit(" Limit: "), thousand, F.lit(" units"))).otherwise(" unlimited: 5"))
    r = refine.queue_limit(code, said)
    return t("events").select("event_id", r["queued"].alias("queued"), r["limit"].alias("limit_tokens"))


@query(r"""SELECT doc_id, sha256(regexp_replace(coalesce(text, '') || ' sk-' || doc_id || '_a-b; xhf_1 hf_Z9', '\b(?:sk-|hf_)[A-Za-z0-9_-]+', '[redacted]', 'g')) AS digest FROM documents""")
def redacted_texts(t):
    text = F.concat(F.coalesce("text", F.lit("")), F.lit(" sk-"), F.col("doc_id").cast("string"), F.lit("_a-b; xhf_1 hf_Z9"))
    return t("documents").select("doc_id", F.sha2(refine.redacted(text), 256).alias("digest"))
