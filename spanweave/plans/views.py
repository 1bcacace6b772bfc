"""Registered queries of what reviewers see and runs keep, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import masks
from ..operators import release, sinks, viewer
from .registry import query


@query("""WITH m AS (SELECT vec_id // 40 AS frame, vec_id AS id, embedding, row_number() OVER (PARTITION BY vec_id // 40 ORDER BY vec_id) - 1 AS r FROM embeddings),
p AS (SELECT frame, r // 24 AS atlas, place, CAST(sum(CASE WHEN embedding[place + 1] > 0 THEN CAST(1 AS BIGINT) << CAST(r % 24 AS INT) ELSE 0 END) AS BIGINT) AS v FROM m, range(64) q(place) GROUP BY 1, 2, 3),
i AS (SELECT frame, r // 24 AS atlas, string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS ids FROM m GROUP BY 1, 2)
SELECT p.frame, CAST(p.atlas AS INT) AS atlas, ids, string_agg(CAST(v AS VARCHAR), ',' ORDER BY place) AS pixels FROM p JOIN i ON i.frame = p.frame AND i.atlas = p.atlas GROUP BY 1, 2, 3""")
def mask_atlases(t):
    e = t("embeddings").select(F.floor(F.col("vec_id") / 40).alias("frame"), F.col("vec_id").alias("id"), F.transform("embedding", lambda x: (x > 0).cast("int")).alias("pixels"))
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",").alias(c)
    return viewer.atlases(e).select("frame", "atlas", text("ids"), text("pixels"))


@query("""WITH p AS (SELECT vec_id, i // 8 AS x, i % 8 AS y FROM embeddings, range(64) r(i) WHERE embedding[i + 1] > 0) SELECT vec_id, CAST(greatest(0, least(floor(median(x)), 60 - 40)) AS INT) AS x, CAST(greatest(22, floor(median(y))) AS INT) AS y FROM p GROUP BY vec_id""")
def label_places(t):
    runs = masks.on_runs(F.array(F.lit(8), F.lit(8)), masks.run_lengths(F.col("embedding")).cast("array<bigint>"))
    p = t("embeddings").select("vec_id", viewer.label_place(runs, F.lit(8), F.lit(60)).alias("p"))
    return p.where("p is not null").select("vec_id", "p.x", "p.y")


@query("""SELECT doc_id, doc_id * 47 % 180 AS hue, CAST(((ascii('t') * 33 + ascii(chr(CAST(48 + doc_id % 10 AS INT)))) * 33 + ascii('x')) % 7 AS INT) AS place FROM documents""")
def label_colours(t):
    name = F.concat(F.lit("t"), (F.col("doc_id") % 10).cast("string"), F.lit("x"))
    return t("documents").select("doc_id", viewer.hue(F.col("doc_id")).alias("hue"), viewer.palette_place(name, 7).alias("place"))


@query("""WITH k AS (SELECT 'v' || conv_id AS video_key, row_number() OVER (ORDER BY 'v' || conv_id) - 1 AS r, count(*) OVER () AS n FROM (SELECT DISTINCT conv_id FROM conversations)) SELECT video_key, CAST((r - (3 * greatest(1, n // 8)) % n + n) % n AS INT) AS place FROM k""")
def rotated_queue(t):
    return viewer.rotated(t("conversations").select(F.concat(F.lit("v"), F.col("conv_id").cast("string")).alias("video_key")).distinct(), "video_key", 3, 8)


@query("""SELECT doc_id AS sample_id FROM documents WHERE lang = 'en' AND doc_id % 4 > 1 AND doc_id % 3 = 0 AND (contains(lower(coalesce(text, '')), 'an') OR contains('r' || doc_id, 'an'))""")
def sample_filter(t):
    i = F.col("doc_id")
    s = t("documents").select(i.alias("sample_id"), F.col("lang").alias("dataset"), F.when(i % 3 == 0, "3–5").otherwise("0–2").alias("density_bin"), F.lit("keep").alias("decision"), F.lit("keep").alias("nlp_decision"), (i % 4).alias("original_tracks"), F.when(i % 4 > 1, 1).when(i % 4 == 1, 1).alias("nlp_tracks"), F.col("text").alias("original_text"), F.lit("").alias("refined_text"), F.array(F.lit("x")).alias("nlp_reasons"), F.lit(None).cast("array<string>").alias("reason_codes"))
    return viewer.matching(s, dataset="en", density="3–5", repair="removed", query="AN").select("sample_id")


@query("""WITH o AS (SELECT doc_id, doc_id % 4 AS n FROM documents) SELECT doc_id AS sample_id, CASE WHEN doc_id % 2 = 0 THEN 'rewrite' END AS nlp_decision, CASE WHEN doc_id % 3 = 0 THEN 'keep' ELSE 'pending' END AS decision, CAST(n AS INT) AS original_tracks, CASE WHEN doc_id % 2 = 0 THEN CAST(greatest(n - 1, 0) AS INT) END AS nlp_tracks,
CAST(CASE WHEN doc_id % 3 = 0 THEN least(n, 1) ELSE 0 END AS INT) AS retained, CASE WHEN doc_id % 2 = 0 AND n > 0 THEN 'e' || (n - 1) || ':1' ELSE '' END AS removed FROM o""")
def before_and_after(t):
    i = F.col("doc_id")
    ids = lambda n: F.transform(F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>")), lambda x: F.concat(F.lit("t"), (x - 1).cast("string")))
    n = (i % 4).cast("int")
    group = lambda x: F.struct(F.concat(F.lit("e"), F.substring(x, 2, 3)).alias("identity"), F.array(F.struct(F.lit("w").alias("text"))).alias("text_spans"), F.array(x, x).alias("tracklet_ids"))
    o = t("documents").select(i.alias("sample_id"), ids(n).alias("tracks"), F.transform(ids(n), group).alias("groups"))
    r = t("documents").where("doc_id % 2 = 0").select(i.alias("sample_id"), F.lit("rewrite").alias("decision"), ids(F.greatest(n - 1, F.lit(0))).alias("tracks"))
    v = t("documents").where("doc_id % 3 = 0").select(i.alias("sample_id"), F.lit("keep").alias("decision"), ids(F.least(n, F.lit(1))).alias("tracks"))
    b = viewer.before_after(o, r, v)
    said = F.array_join(F.transform("removed", lambda g: F.concat_ws(":", g["identity"], g["track_count"].cast("string"))), ",")
    return b.withColumn("removed", said)


@query("""SELECT o_orderkey AS submission_id, o_orderkey + 1 AS batch_id FROM orders WHERE o_orderkey % 5 = 0""")
def submission_recovery(t):
    k = F.col("o_orderkey")
    s = t("orders").where("o_orderkey % 5 = 0").select(k.alias("submission_id"), (k * 2).alias("input_file_id"))
    b = t("orders").select(k.alias("ticket"), (k + 1).alias("batch_id"), (k * 2).alias("input_file_id")).union(t("orders").select(k, k + 2, k * 3 + 1))
    return viewer.recovered(s, b)


@query("""SELECT 'f' || doc_id AS name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def unreferenced_assets(t):
    name = F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("name")
    return viewer.unreferenced(t("documents").select(name), t("labels").select(name))


@query("""WITH e AS (SELECT l_orderkey AS request_id, l_linenumber * 100 + l_partkey % 100 AS sample_id FROM lineitem WHERE l_orderkey % 6 > 0 AND l_orderkey % 10 <> 3) SELECT CAST(sample_id AS BIGINT) AS sample_id, max(request_id) AS request_id FROM e GROUP BY 1""")
def packets_by_sample(t):
    e = F.struct((F.col("l_linenumber") * 100 + F.col("l_partkey") % 100).cast("long").alias("sample_id"), F.lit("x").alias("existing_text"))
    p = t("lineitem").groupBy(F.col("l_orderkey").alias("request_id")).agg(F.collect_list(e).alias("expressions"))
    p = p.withColumn("place", F.col("request_id")).withColumn("validation_retry_of", F.when(F.col("request_id") % 6 == 0, "y")).withColumn("transport_retry_of", F.when(F.col("request_id") % 10 == 3, "z"))
    return viewer.by_sample(p).select("sample_id", "request_id")


@query("""WITH w AS (SELECT o_orderkey, o_custkey % 50 AS v, least(o_orderkey % 3, o_custkey % 3) AS a, greatest(o_orderkey % 3, o_custkey % 3) AS b, o_orderkey % 4 AS f FROM orders), h AS (SELECT v, a, b, f, min('p' || o_orderkey) AS path FROM w WHERE o_orderkey % 7 = 0 GROUP BY ALL) SELECT w.o_orderkey, h.path FROM w LEFT JOIN h ON h.v = w.v AND h.a = w.a AND h.b = w.b AND h.f = w.f""")
def image_reuse(t):
    o = t("orders").select("o_orderkey", (F.col("o_custkey") % 50).alias("video_key"), F.array(F.col("o_orderkey") % 3, F.col("o_custkey") % 3).alias("ids"), (F.col("o_orderkey") % 4).alias("frame"))
    c = o.where("o_orderkey % 7 = 0").withColumn("path", F.concat(F.lit("p"), F.col("o_orderkey").cast("string"))).drop("o_orderkey")
    return viewer.reused(o, c).select("o_orderkey", "path")


@query("""SELECT event_id, user_id || lower(event_type) AS answer FROM events""")
def prompt_cache(t):
    p = t("events").select("event_id", F.col("user_id").alias("video_key"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" "), F.upper("event_type"))).otherwise(F.col("event_type")).alias("prompt"))
    asked = viewer.asked_once(p)
    return viewer.answered(p, asked.withColumn("answer", F.concat(F.col("video_key").cast("string"), "prompt"))).select("event_id", "answer")


@query("""SELECT conv_id AS video_key, string_agg(turn || ':' || role, ',' ORDER BY turn) AS said, count(*) AS n, count(*) FILTER (WHERE role = 'user') AS rejected FROM (SELECT DISTINCT conv_id, turn, role FROM conversations) GROUP BY 1""")
def video_documents(t):
    c = t("conversations").select(F.col("conv_id").alias("video_key"), F.col("turn").alias("sample_id"), F.col("role").alias("text"), F.when(F.col("role") == "user", "rejected").otherwise("accepted").alias("status")).distinct()
    said = F.array_join(F.transform("instructions", lambda x: F.concat_ws(":", x["sample_id"].cast("string"), x["text"])), ",")
    return viewer.video_documents(c).select("video_key", said.alias("said"), "n", "rejected")


@query("""SELECT vec_id, sha256('{"frames":["' || vec_id || '","1"],"masks":[' || CASE WHEN vec_id % 3 = 0 THEN 'null' ELSE '{"size":[8,8],"counts":[' || (vec_id % 64) || ',' || (64 - vec_id % 64) || ']}' END || ']}') AS digest FROM embeddings""")
def track_signatures(t):
    i = F.col("vec_id")
    m = F.when(i % 3 != 0, F.struct(F.array(F.lit(8), F.lit(8)).alias("size"), F.array(i % 64, 64 - i % 64).alias("counts")))
    return t("embeddings").select("vec_id", viewer.canonical({"masks": F.array(m), "frames": F.array(i.cast("string"), F.lit("1"))}).alias("digest"))


@query("""SELECT sha256(coalesce(text, '')) || '.txt' AS name, count(*) > 0 AS there FROM documents GROUP BY 1""")
def content_assets(t):
    p = t("documents").select(F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("payload"))
    return sinks.named_assets(p, ".txt").select("name", F.lit(True).alias("there"))


@query("SELECT count(*) FILTER (WHERE lang <> 'en') AS foreign_rows FROM documents")
def split_purity(t):
    return release.split_faults(t("documents").withColumn("split", F.col("lang")), "en")


@query("""WITH i AS (SELECT doc_id, n_chars, coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM documents) SELECT doc_id, CAST(b // 100000 AS INT) AS shard FROM i""")
def size_shards(t):
    return release.sharded(t("documents").select("doc_id", "n_chars"), "n_chars", 100_000, ["doc_id"]).select("doc_id", "shard")


@query("""SELECT CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'reserved' ELSE 'unsubmitted' END AS state, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM orders GROUP BY 1""")
def ledger_states(t):
    state = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "reserved").otherwise("unsubmitted")
    return t("orders").groupBy(state.alias("state")).agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("amount"))


@query("""SELECT doc_id AS sample_id, 'c' || (doc_id % 3) AS annotation_category, CASE WHEN doc_id % 2 = 0 THEN 'complete_bcc' ELSE 'incomplete_context' END AS disposition, CAST(doc_id % 3 AS INT) AS object_count, CAST(1 AS INT) AS linked_phrase_count, 'f' || doc_id AS frame, 't' || (doc_id % 3) AS linked, 'keep' AS refinement_decision FROM documents WHERE doc_id % 5 > 0""")
def public_release(t):
    i = F.col("doc_id")
    said = lambda c: F.to_json(c)
    made = {
        "sample_id": i, "cohort": F.concat(F.lit("c"), (i % 3).cast("string")), "disposition": F.when(i % 2 == 0, "complete_bcc").otherwise("incomplete_context"), "negative": F.lit(False), "runtime_seconds": F.lit(0.0), "text": F.coalesce("text", F.lit("")),
        "frame_ids_json": said(F.array(F.concat(F.lit("f"), i.cast("string")))), "tracklets_json": said(F.transform(F.slice(F.array(*[F.lit(f"t{k}") for k in range(3)]), F.lit(1), (i % 3).cast("int")), lambda x: F.struct(x.alias("tracklet_id"), F.lit(1).alias("present_frames")))),
        "span_links_json": said(F.array(F.struct(F.lit(0).alias("start"), F.lit(2).alias("end"), F.lit("ab").alias("text"), F.array(F.concat(F.lit("t"), (i % 3).cast("string"))).alias("tracklet_ids")))),
    }
    rows = t("documents").select(*[made.get(c, F.lit("")).alias(c) for c in viewer.PUBLIC])
    p = viewer.public_rows(rows, t("documents").where("doc_id % 5 > 0").select(i.alias("sample_id"), F.lit("keep").alias("decision")), variant=True)
    return p.select("sample_id", "annotation_category", "disposition", "object_count", "linked_phrase_count", F.get("frame_ids", F.lit(0)).alias("frame"), F.get(F.get("caption_links", F.lit(0))["object_ids"], F.lit(0)).alias("linked"), "refinement_decision")
