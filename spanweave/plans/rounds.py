"""Registered queries over rounds with a model: replies and retries, charges, sets under limits, each beside its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import records, replies, submission
from ..operators.ledger import Ledger
from ..operators.steps import shared_dir
from .registry import query

GROUPS = "array<struct<group_id:string,role:string,identity:string,text_spans:array<struct<start:int,end:int,text:string>>,tracklet_ids:array<string>>>"


def _group(role: str, number: int, name: str, start: int, end: int, said: str) -> Column:
    return F.struct(F.lit(f"g{number}").alias("group_id"), F.lit(role).alias("role"), F.lit(name).alias("identity"), F.array(F.struct(F.lit(start).alias("start"), F.lit(end).alias("end"), F.lit(said).alias("text"))).alias("text_spans"), F.array(F.lit(f"t{number}")).alias("tracklet_ids"))


def _groups() -> tuple[Column, Column]:
    return _group("main_referent", 0, "fox", 0, 7, "red fox"), _group("context_entity", 1, "dog", 12, 15, "dog")


def answered_records(docs: DataFrame) -> DataFrame:
    """A record of two tracks for each document, every tenth a negative one."""
    mask = F.struct(F.array(F.lit(1), F.lit(4)).alias("size"), F.array(F.lit(0), F.lit(4)).cast("array<bigint>").alias("counts"))
    track = lambda n: F.struct(F.lit(f"t{n}").alias("tracklet_id"), F.lit(f"p{n}").alias("sam_prompt"), F.array(mask).alias("masks"))
    negative, (fox, dog) = F.col("doc_id") % 10 == 9, _groups()
    groups = F.when(negative, F.array(dog)).otherwise(F.array(fox, dog)).cast(GROUPS)
    return docs.select(F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("sample_id"), F.lit(records.VERSION).alias("schema_version"), F.concat(F.lit("red fox and dog "), F.col("doc_id").cast("string")).alias("text"), negative.alias("negative"), F.array(F.lit("f0")).alias("frame_ids"), F.array(F.lit("v/f0.jpg")).alias("frame_files"), F.array(track(0), track(1)).alias("tracklets"), groups.alias("groups"), F.array().cast("array<struct<start:int,end:int,text:string,tracklet_ids:array<string>>>").alias("span_links"), F.lit("as it was").alias("disposition"))


def packets(docs: DataFrame) -> DataFrame:
    """Five documents a packet; every other packet is of the text stage."""
    entry = lambda n, g: F.struct(F.lit(n).alias("id"), *[g[c].alias(c) for c in ("role", "identity", "text_spans", "tracklet_ids")])
    negative, (fox, dog) = F.col("doc_id") % 10 == 9, _groups()
    entries = F.when(negative, F.array(entry(2, dog))).otherwise(F.array(entry(2, dog), entry(1, fox)))
    mains = F.when(negative, F.array().cast("array<int>")).otherwise(F.array(F.lit(1)))
    sample = F.concat(F.lit("s"), F.col("doc_id").cast("string")).alias("sample_id")
    one = docs.select(F.floor(F.col("doc_id") / 5).alias("k"), F.struct(sample, mains.alias("main_ids"), entries.alias("entries")).cast(replies.MAPPING).alias("m"), F.struct(sample, F.lit("x").alias("existing_text")).alias("e"))
    p = one.groupBy("k").agg(F.array_sort(F.collect_list("m")).alias("mapping"), F.array_sort(F.collect_list("e")).alias("expressions"))
    return p.select(F.concat(F.lit("k"), F.col("k").cast("string")).alias("request_id"), F.when(F.col("k") % 2 == 1, "nlp").otherwise("visual").alias("stage"), "mapping", "expressions")


def _answers(asked: DataFrame) -> DataFrame:
    """What a model might say: the first time each kind of fault somewhere, the second time right for every third id."""
    first = F.col("retry_of").isNull()
    one = asked.select("request_id", first.alias("first"), F.explode("mapping").alias("m")).select("request_id", "first", F.substring("m.sample_id", 2, 20).cast("long").alias("i"))
    i = F.col("i")
    kind = F.when(F.col("first") | (i % 3 != 0), i % 8).when(i % 10 == 9, 3).otherwise(0)
    tail = F.concat(F.lit(" "), i.cast("string"))
    said = [("keep", "[1]red fox[/1] and [2]dog[/2]", True), ("reject", "", False), ("reject", "x", False), ("keep", "red fox and [2]dog[/2]", True), ("rewrite", "[1]red foxes[/1] and dog", False), ("keep", "[7]red[/7] fox and dog", True), ("keep", "red fox and dog", True), ("keep", "[1]red [2]fox[/1] and dog[/2]", True)]
    pick = lambda of: F.element_at(F.array(*[of(x) for x in said]), (kind + 1).cast("int"))
    result = F.struct(F.concat(F.lit("s"), i.cast("string")).alias("sample_id"), pick(lambda x: F.lit(x[0])).alias("decision"), pick(lambda x: F.concat(F.lit(x[1]), tail) if x[2] else F.lit(x[1])).alias("tagged_caption"), F.array(F.lit("r")).alias("reason_codes"))
    k = F.floor(i / 5)
    one = one.withColumns({"k": k, "result": result}).where(~(F.col("first") & (k % 11 == 5) & (i % 5 == 0)))
    p = one.groupBy("request_id", "first", "k").agg(F.collect_list("result").alias("results"))
    text = F.when(F.col("first") & (F.col("k") % 13 == 6), "no json").otherwise(F.to_json(F.struct("results")))
    content = F.array(F.struct(F.lit("output_text").alias("type"), text.alias("text")), F.struct(F.lit("refusal").alias("type"), F.lit("-").alias("text")))
    body = F.struct(F.when(F.col("first") & (F.col("k") % 7 == 3), "incomplete").otherwise("completed").alias("status"), F.array(F.struct(F.lit("reasoning").alias("type"), F.lit(None).cast("array<struct<type:string,text:string>>").alias("content")), F.struct(F.lit("message").alias("type"), content.alias("content"))).alias("output"))
    p = p.where(~(F.col("first") & (F.col("k") % 17 == 8)))
    return p.groupBy("request_id").agg(F.first(F.to_json(body)).alias("body"))


_SAID = """CASE WHEN nlp AND kind IN (1, 2) THEN 'not_a_repair' WHEN kind = 2 THEN 'rejected_with_caption' WHEN kind = 1 THEN NULL WHEN kind = 6 AND neg THEN NULL WHEN kind = 5 OR (neg AND kind IN (0, 4, 7)) THEN 'unknown_id' WHEN kind = 7 THEN 'crossed' WHEN kind = 4 AND nlp THEN 'text_changed' WHEN kind IN (3, 6) AND NOT neg THEN 'main_referent_dropped' END"""


@query(f"""WITH d AS (SELECT doc_id AS i, doc_id // 5 AS k, (doc_id // 5) % 2 = 1 AS nlp, doc_id % 10 = 9 AS neg, doc_id % 8 AS kind FROM documents),
a AS (SELECT *, CASE WHEN k % 7 = 3 THEN 'model response incomplete or failed' WHEN k % 13 = 6 THEN 'unreadable response' WHEN k % 11 = 5 THEN 'missing, duplicate or unexpected sample_id in grouped response' ELSE {_SAID} END AS error FROM d WHERE k % 17 <> 8),
b AS (SELECT i, k, nlp, neg, CASE WHEN i % 3 <> 0 THEN kind WHEN neg THEN 3 ELSE 0 END AS kind FROM a WHERE error IS NOT NULL),
e AS (SELECT i, nlp, neg, kind, error, false AS again FROM a WHERE error IS NULL UNION ALL SELECT i, nlp, neg, kind, {_SAID}, true FROM b)
SELECT 's' || i AS sample_id, CASE WHEN nlp THEN 'nlp' ELSE 'visual' END AS stage, again, CASE WHEN error IS NOT NULL THEN 'error' WHEN kind = 1 THEN 'reject' WHEN kind = 4 THEN 'rewrite' ELSE 'keep' END AS outcome, error,
CASE WHEN error IS NULL AND kind = 4 THEN 'red foxes and dog' ELSE 'red fox and dog ' || i END AS text, CASE WHEN error IS NOT NULL OR kind = 1 OR nlp THEN 'as it was' WHEN NOT neg THEN 'complete_bcc' WHEN kind = 6 THEN 'negative_unsegmentable' ELSE 'negative_with_context' END AS disposition,
CASE WHEN error IS NOT NULL OR kind = 1 THEN 't0,t1' WHEN kind = 0 THEN 't0,t1' WHEN kind = 4 THEN 't0' WHEN kind = 3 THEN 't1' ELSE '' END AS tracklets,
CASE WHEN error IS NOT NULL OR kind = 1 THEN CASE WHEN neg THEN 'g1=dog@12-15' ELSE 'g0=fox@0-7;g1=dog@12-15' END WHEN kind = 0 THEN p || '-001=fox@0-7;' || p || '-002=dog@12-15' WHEN kind = 4 THEN p || '-001=fox@0-9' WHEN kind = 3 THEN p || '-002=dog@12-15' ELSE '' END AS groups,
CASE WHEN error IS NOT NULL OR kind IN (1, 6) THEN 0 WHEN kind = 0 THEN 2 ELSE 1 END AS links FROM (SELECT *, CASE WHEN nlp THEN 'nlp' ELSE 'refined' END AS p FROM e)""")
def reply_rounds(t):
    results, _, _ = replies.waves(packets(t("documents")), answered_records(t("documents")), _answers)
    place = lambda g: F.concat(g["group_id"], F.lit("="), g["identity"], F.lit("@"), F.array_join(F.transform(g["text_spans"], lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ","))
    return results.select("sample_id", "stage", F.col("retry_of").isNotNull().alias("again"), "outcome", "error", "text", "disposition", F.array_join(F.transform("tracklets", lambda x: x["tracklet_id"]), ",").alias("tracklets"), F.array_join(F.transform("groups", place), ";").alias("groups"), F.size("span_links").alias("links"))


@query("""SELECT o_orderkey AS id, CAST(CASE WHEN o_orderkey % 18 = 9 THEN 7 WHEN o_orderkey % 9 = 0 THEN CASE WHEN o_orderkey % 6 = 0 THEN o_orderkey % 10 ELSE 0 END WHEN o_orderkey % 6 = 0 THEN o_orderkey % 10 ELSE o_orderkey % 100 + 1 END AS DOUBLE) AS amount,
CASE WHEN o_orderkey % 18 = 9 THEN 'reserved' WHEN o_orderkey % 6 = 0 THEN 'completed' ELSE 'reserved' END AS state FROM orders WHERE o_orderkey % 3 = 0""")
def ledger_history(t):
    o = t("orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderkey").alias("k"))
    spark = o.sparkSession
    ledger = Ledger(spark, f"{shared_dir(spark)}/spanweave/ledger-{uuid.uuid4().hex}", 1e12)
    ledger.reserve(o.where("k % 3 = 0").select("id", (F.col("k") % 100 + 1).alias("amount")))
    ledger.settle(o.where("k % 6 = 0").select("id", (F.col("k") % 10).alias("amount")))
    ledger.release(o.where("k % 9 = 0"))
    ledger.reserve(o.where("k % 18 = 9").select("id", F.lit(7).alias("amount")))
    return ledger.charges().select(F.col("id").cast("long").alias("id"), F.col("amount").cast("double").alias("amount"), "state")


_SUMS = "SELECT o_orderkey, ceil(CAST(o_totalprice AS DECIMAL(18,6)) * 1000000) AS c, 500 + o_orderkey % 700 AS b, row_number() OVER w AS n, sum(ceil(CAST(o_totalprice AS DECIMAL(18,6)) * 1000000)) OVER w AS cost, sum(500 + o_orderkey % 700) OVER w AS bytes FROM orders WINDOW w AS (ORDER BY o_orderkey)"


@query(f"""WITH s AS ({_SUMS}) SELECT 'budget' AS bound, o_orderkey AS request_id FROM s WHERE cost <= 9000000 * 1000000.0 UNION ALL SELECT 'bytes', o_orderkey FROM s WHERE bytes <= 100000 UNION ALL SELECT 'number', o_orderkey FROM s WHERE n <= 77""")
def next_submission(t):
    p = t("orders").select(F.col("o_orderkey").alias("request_id"), F.col("o_totalprice").alias("amount"), (500 + F.col("o_orderkey") % 700).alias("bytes"))
    runs = {"budget": (9e6, submission.MOST_REQUESTS, submission.MOST_BYTES), "bytes": (1e12, submission.MOST_REQUESTS, 100_000), "number": (1e12, 77, submission.MOST_BYTES)}
    each = [submission.next_set(p, budget, n, b, ("request_id",)).select(F.lit(name).alias("bound"), "request_id") for name, (budget, n, b) in runs.items()]
    return each[0].union(each[1]).union(each[2])


@query("""WITH RECURSIVE k AS (SELECT o_custkey AS queue, o_orderkey AS tick, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders),
x AS (SELECT queue, tick, n, list_filter(['s' || (n - 1), 's' || (n - 2), 's' || (n // 4)], lambda s: tick % 4 > 0) AS active, 't' || (n // 2) AS ticket, tick % 40 + 1 AS requests, tick % 5 = 0 AS rate, tick % 3 > 0 AS has FROM k),
f AS (SELECT DISTINCT queue, CAST(0 AS BIGINT) AS tick, CAST(0 AS BIGINT) AS n, CAST(100 AS BIGINT) AS ceiling, CAST([] AS VARCHAR[]) AS at, CAST([] AS VARCHAR[]) AS seen FROM x UNION ALL
SELECT x.queue, x.tick, x.n, CASE WHEN x.has AND NOT x.rate AND NOT list_contains(f.seen, x.ticket) THEN greatest(1, least(CASE WHEN len(list_filter(f.at, lambda s: NOT list_contains(x.active, s))) > 0 THEN 100 ELSE f.ceiling END, x.requests // 2)) WHEN len(list_filter(f.at, lambda s: NOT list_contains(x.active, s))) > 0 THEN 100 ELSE f.ceiling END,
CASE WHEN x.has AND NOT x.rate AND NOT list_contains(f.seen, x.ticket) THEN x.active WHEN len(list_filter(f.at, lambda s: NOT list_contains(x.active, s))) > 0 THEN [] ELSE f.at END, CASE WHEN x.has AND NOT list_contains(f.seen, x.ticket) THEN list_append(f.seen, x.ticket) ELSE f.seen END FROM f JOIN x ON x.queue = f.queue AND x.n = f.n + 1)
SELECT queue, tick, CAST(ceiling AS INT) AS ceiling FROM f WHERE n > 0""")
def queue_ceilings(t):
    from pyspark.sql import Window

    n, k = F.col("n"), F.col("o_orderkey")
    o = t("orders").select("o_custkey", "o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).alias("n"))
    s = lambda c: F.concat(F.lit("s"), c.cast("string"))
    active = F.when(k % 4 > 0, F.array(s(n - 1), s(n - 2), s(F.floor(n / 4)))).otherwise(F.array().cast("array<string>"))
    refusal = F.struct(F.concat(F.lit("t"), F.floor(n / 2).cast("string")).alias("ticket"), (k % 40 + 1).alias("requests"), (k % 5 == 0).alias("rate"))
    refusals = F.filter(F.array(F.when(k % 3 > 0, refusal)), lambda x: x.isNotNull())
    return submission.ceilings(o.select(F.col("o_custkey").alias("queue"), k.alias("tick"), active.alias("active"), refusals.alias("refusals")), 100)
