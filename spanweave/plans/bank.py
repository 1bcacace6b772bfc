"""The registered queries of the annotation engine, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import language, masks
from ..functions.captions import parsed
from ..functions.text import stable_key
from ..operators import packets, refine, release, review, tracks, units
from . import media, nested, records, reviews, rounds, sources, upkeep, views, worklists  # noqa: F401  register their queries, too
from .registry import ORACLE, QUERIES  # noqa: F401  what the driver asks for
from .registry import query as _query

_SIGNS = "list_transform(embedding, lambda v: CASE WHEN v > 0 THEN 1 ELSE 0 END)"
_RUNS = f"""WITH px AS (SELECT vec_id, unnest(range(len(embedding))) AS i, unnest({_SIGNS}) AS b FROM embeddings),
isl AS (SELECT vec_id, i, b, i - row_number() OVER (PARTITION BY vec_id, b ORDER BY i) AS g FROM px),
runs AS (SELECT vec_id, b, min(i) AS first, count(*) AS length FROM isl GROUP BY vec_id, b, g)"""


@_query("""SELECT doc_id, 'corpus__' || lang || '__full__' || regexp_replace(regexp_replace(source, '[^A-Za-z0-9_.]+', '-', 'g'), '^-+|-+$', '', 'g') || '__e' || doc_id AS sample_id,
coalesce(trim(text) = '', true) AS is_blank, CAST(length(text) AS BIGINT) AS length FROM documents""")
def unit_projection(t):
    return units.units(t("documents"))


@_query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def split_anti_join(t):
    return units.without(t("documents").select("doc_id", "lang"), t("labels"), "doc_id")


@_query("SELECT d.doc_id, CASE WHEN quality = 1 THEN 'explicit' WHEN quality = 0 THEN 'implicit' ELSE 'nonexistent' END AS category FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def category_left_lookup(t):
    return review.with_category(t("documents").select("doc_id"), t("labels"))


@_query("SELECT role, count(*) AS n FROM conversations GROUP BY role")
def count_gate_by_cohort(t):
    return units.counted(t("conversations"), "role")


@_query("SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY CAST(turn AS VARCHAR), role, text) AS n FROM conversations) WHERE n = 1")
def first_expression_per_video(t):
    c = t("conversations").select("conv_id", "turn", "role", "text")
    return units.first_of(c, "conv_id", F.col("turn").cast("string"), F.col("role"), F.col("text")).drop("text")


@_query("SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY sha256('review:' || conv_id || ':' || turn), conv_id, turn) AS rank FROM (SELECT DISTINCT conv_id, turn FROM conversations)")
def stable_suggestion_rank(t):
    return units.stable_rank(t("conversations").select("conv_id", "turn").distinct(), "conv_id", "review", F.col("conv_id"), F.col("turn"))


@_query("SELECT user_id, count(DISTINCT event_id % 17) AS n, CASE WHEN count(DISTINCT event_id % 17) <= 2 THEN '0–2' WHEN count(DISTINCT event_id % 17) <= 5 THEN '3–5' WHEN count(DISTINCT event_id % 17) <= 12 THEN '6–12' ELSE '13+' END AS bin FROM events GROUP BY user_id")
def density_bins(t):
    n = F.count_distinct(F.col("event_id") % 17)
    return t("events").groupBy("user_id").agg(n.alias("n")).withColumn("bin", release.density(F.col("n")))


@_query("SELECT event_id, event_type, rank FROM (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY sha256('sample:' || event_id), event_id) AS rank FROM events) WHERE rank <= 20")
def stratified_sample(t):
    return units.stratified(t("events").select("event_id", "event_type"), "event_type", "sample", 20, "event_id")


@_query("SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS prompts, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id")
def prompt_grouping(t):
    e = t("events").select("user_id", "event_type").distinct()
    return e.groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_list("event_type")), ",").alias("prompts"), F.count("*").alias("n"))


_TRACKS = """SELECT user_id, event_type, count(*) AS present, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS confidence, max(value) AS max_confidence,
CAST(least(64, sum(CAST(floor(value) AS BIGINT))) AS BIGINT) AS pixels FROM events GROUP BY user_id, event_type"""


@_query(_TRACKS)
def track_assembly(t):
    return tracks.assembled(t("events"))


@_query(f"""WITH f AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), t AS ({_TRACKS}), m AS (SELECT *, CASE WHEN n <= 4 THEN 1 ELSE greatest(2, (n + 19) // 20) END AS least_frames FROM t JOIN f USING (user_id))
SELECT user_id, event_type, CASE WHEN present < least_frames THEN 'present_frames<' || least_frames WHEN pixels < 64 THEN 'total_pixels<64' WHEN max_confidence / 100 < 0.55 OR confidence / 100 < 0.45 THEN 'confidence_below_threshold' ELSE 'retained' END AS reason FROM m""")
def track_quality_filter(t):
    e = t("events")
    frames = e.groupBy("user_id").agg(F.count("*").alias("frames"))
    j = tracks.assembled(e).join(frames, "user_id")
    return j.select("user_id", "event_type", tracks.judged(F.col("frames"), F.col("present"), F.col("pixels"), F.col("max_confidence") / 100, F.col("confidence") / 100).alias("reason"))


@_query(f"{_RUNS} SELECT vec_id, first, length FROM runs WHERE b = 1")
def rle_encode_runs(t):
    r = tracks.runs_table(t("embeddings"))
    return r.select("vec_id", F.col("first").cast("long").alias("first"), F.col("length").cast("long").alias("length"))


@_query(f"{_RUNS}, lead AS (SELECT vec_id, -1 AS first, 0 AS length FROM runs WHERE first = 0 AND b = 1) SELECT vec_id, string_agg(CAST(length AS VARCHAR), ',' ORDER BY first) AS runs, CAST(sum(CASE WHEN b = 1 THEN length ELSE 0 END) AS BIGINT) AS area FROM (SELECT vec_id, b, first, length FROM runs UNION ALL SELECT vec_id, 0, first, length FROM lead) GROUP BY vec_id")
def rle_decode_area(t):
    return tracks.encoded(t("embeddings"))


_SUM = "list_sum(list_transform(range(len(embedding)), lambda i: CASE WHEN embedding[i + 1] > 0 THEN CAST(1 AS HUGEINT) << CAST(i AS INTEGER) ELSE 0 END))"
_BITS = f"CAST(CASE WHEN {_SUM} >= 9223372036854775808 THEN {_SUM} - 18446744073709551616 ELSE {_SUM} END AS BIGINT)"


@_query(f"SELECT vec_id, CAST({_BITS} AS VARCHAR) AS bits FROM embeddings")
def bitplane_pack(t):
    return t("embeddings").select("vec_id", F.array_join(masks.sign_words(F.col("embedding")).cast("array<string>"), ",").alias("bits"))


@_query(f"""WITH m AS (SELECT vec_id // 16 AS video, vec_id, {_BITS} AS bits FROM embeddings)
SELECT x.video, x.vec_id AS a, y.vec_id AS b, CAST(bit_count(x.bits & y.bits) AS BIGINT) AS inter, CAST(bit_count(x.bits | y.bits) AS BIGINT) AS total
FROM m x JOIN m y ON x.video = y.video AND x.vec_id < y.vec_id WHERE bit_count(x.bits | y.bits) > 0 AND bit_count(x.bits & y.bits) >= 0.4 * bit_count(x.bits | y.bits)""")
def mask_volume_iou(t):
    return tracks.overlaps(t("embeddings"), 16, 0.4)


_PHRASE = """(SELECT doc_id, pre || text AS text, CAST(length(pre) AS INT) AS start, CAST(length(pre) + 3 AS INT) AS stop, head FROM (SELECT doc_id, coalesce(text, '') AS text,
['far from the ', 'the camera view ', 'of the family ', 'he said "', '“so ', 'driven like a ', 'it is widely  used for ', 'Used As a ', 'plain '][1 + doc_id % 9] AS pre, ['camera', 'thing', 'race', 'dog', 'screen', 'ball'][1 + (doc_id // 9) % 6] AS head FROM documents))"""
_RULES = f"""SELECT doc_id, head, regexp_matches(lower(substr(text, greatest(start - 48, 0) + 1, least(stop + 24, length(text)) - greatest(start - 48, 0))), '(away|distance|far|furthest|closest|nearer|toward|from)\\s+(the\\s+)?camera|camera\\s+(view|frame|position)') AS viewpoint,
regexp_matches(lower(substr(text, greatest(start - 28, 0) + 1, stop - greatest(start - 28, 0))), '\\b(family|genus|order|species)\\b') AS taxonomic,
(length(substr(text, 1, start)) - length(replace(substr(text, 1, start), '"', ''))) % 2 = 1 OR (length(substr(text, 1, stop)) - length(replace(substr(text, 1, stop), '"', ''))) % 2 = 1
OR length(replace(substr(text, 1, start), '“', '')) < length(replace(substr(text, 1, start), '”', '')) OR length(replace(substr(text, 1, stop), '“', '')) < length(replace(substr(text, 1, stop), '”', '')) AS quoted,
regexp_matches(lower(substr(text, greatest(start - 18, 0) + 1, start - greatest(start - 18, 0))), '\\b(like|as)\\s+(an?\\s+)?$') AS compared, regexp_matches(substr(text, 1, start), '(?i)\\bwidely\\s+used\\s+for\\b|\\bused\\s+as\\b') AS defined FROM {_PHRASE}""".replace("\\\\", "\\")


def _phrases(t):
    pre = F.get(F.array(*map(F.lit, ["far from the ", "the camera view ", "of the family ", 'he said "', "“so ", "driven like a ", "it is widely  used for ", "Used As a ", "plain "])), (F.col("doc_id") % 9).cast("int"))
    head = F.get(F.array(*map(F.lit, ["camera", "thing", "race", "dog", "screen", "ball"])), (F.floor(F.col("doc_id") / 9) % 6).cast("int"))
    return t("documents").select("doc_id", F.concat(pre, F.coalesce("text", F.lit(""))).alias("text"), F.length(pre).alias("start"), (F.length(pre) + 3).alias("stop"), head.alias("head"))


@_query(_RULES)
def context_predicates(t):
    x, a, z = F.col("text"), F.col("start"), F.col("stop")
    return _phrases(t).select("doc_id", "head", language.viewpoint_camera(x, a, z).alias("viewpoint"), language.taxonomic(x, a, z).alias("taxonomic"), language.quoted(x, a, z).alias("quoted"), language.compared(x, a).alias("compared"), language.defined(x, a).alias("defined"))


@_query(f"""SELECT doc_id, CASE WHEN head IN ('object', 'something', 'stuff', 'thing') THEN 'ignore_special_unsafe_generic' WHEN head IN ('race', 'screen') THEN 'ignore_nonvisual_or_meta' WHEN head = 'camera' AND viewpoint THEN 'ignore_viewpoint_camera'
WHEN taxonomic THEN 'ignore_taxonomic_concept' WHEN quoted THEN 'ignore_quoted_title' WHEN compared THEN 'ignore_comparison_concept' WHEN defined THEN 'ignore_generic_definition' ELSE 'prompt_sam3.1' END AS decision FROM ({_RULES})""")
def decision_cascade(t):
    return _phrases(t).select("doc_id", language.decision(F.col("text"), F.col("start"), F.col("stop"), F.col("head")).alias("decision"))


@_query("SELECT lang, CASE WHEN toxic = 1 THEN 'rejected' WHEN toxic = 0 THEN 'accepted' ELSE 'pending' END AS status, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2")
def record_status_ledger(t):
    return review.ledger(t("documents"), t("labels"))


@_query("SELECT d.doc_id, CASE WHEN quality = 1 THEN upper(lang) ELSE lang END AS lang, quality IS NOT NULL AS edited FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE coalesce(toxic, 0) = 0")
def edit_overlay(t):
    return review.overlaid(t("documents"), t("labels"))


@_query("SELECT user_id, count(DISTINCT event_type) AS entities, count(DISTINCT event_type) > 3 AS over FROM events GROUP BY user_id")
def entity_ceiling(t):
    n = F.count_distinct("event_type")
    return t("events").groupBy("user_id").agg(n.alias("entities"), (n > 3).alias("over"))


@_query("""SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)
WHERE n <= 4 OR floor(ceil(i * 3 / (n - 1)) * (n - 1) / 3) = i""")
def frame_sampling(t):
    return units.evenly(t("events").select("user_id", "event_id", "ts"), "user_id", ["ts", "event_id"], 4).drop("ts")


@_query("""SELECT conv_id, chunk, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS turns FROM (SELECT conv_id, turn, CAST((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) // 3 AS INTEGER) AS chunk
FROM (SELECT DISTINCT conv_id, turn FROM conversations)) GROUP BY conv_id, chunk""")
def packet_chunking(t):
    c = units.chunked(t("conversations").select("conv_id", "turn").distinct(), "conv_id", ["turn"], 3)
    return c.groupBy("conv_id", "chunk").agg(F.array_join(F.sort_array(F.collect_list("turn")).cast("array<string>"), ",").alias("turns"))


@_query("SELECT o_orderstatus AS state, count(*) AS n, round(sum(o_totalprice), 2) AS amount FROM orders GROUP BY 1")
def ledger_by_state(t):
    return review.charges(t("orders"))


@_query("SELECT n_name, count(*) AS n, round(avg(o_totalprice), 2) AS mean_cost, round(sum(o_totalprice) * 1.1, 0) AS buffered FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def stratified_cost(t):
    return review.cost_by_stratum(t("orders").select("o_custkey", "o_totalprice"), t("customer").select("c_custkey", "c_nationkey"), t("nation"))


_PUBLISHED = """SELECT d.doc_id AS id, lang AS dataset, source AS video, CAST(length(text) AS BIGINT) AS caption_length, 'train_all' AS variant FROM documents d
UNION ALL SELECT d.doc_id, lang, source, CAST(length(text) AS BIGINT), 'train_filtered' FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 1 AND toxic = 0"""


@_query(_PUBLISHED)
def publish_rename(t):
    return review.published(t("documents"), t("labels"))


@_query(f"SELECT variant, dataset, count(*) AS n, CAST(sum(caption_length) AS BIGINT) AS length FROM ({_PUBLISHED}) GROUP BY 1, 2")
def variant_stats(t):
    return review.published(t("documents"), t("labels")).groupBy("variant", "dataset").agg(F.count("*").alias("n"), F.sum("caption_length").alias("length"))


@_query("""WITH d AS (SELECT doc_id, count(*) AS n FROM documents GROUP BY 1), l AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM labels WHERE doc_id % 7 = 0) GROUP BY 1)
SELECT CASE WHEN l.doc_id IS NULL THEN 'left_only' WHEN d.doc_id IS NULL THEN 'right_only' ELSE 'both' END AS side, count(*) AS n, count(*) FILTER (WHERE coalesce(d.n, 0) > 1 OR coalesce(l.n, 0) > 1) AS repeated FROM d FULL JOIN l ON d.doc_id = l.doc_id GROUP BY 1""")
def coverage_audit(t):
    return review.audited(t("documents"), t("labels").union(t("labels").where("doc_id % 7 = 0")), "doc_id")


@_query("SELECT doc_id // 1000 AS block, sha256(string_agg(doc_id || chr(0) || coalesce(text, ''), chr(0) ORDER BY doc_id)) AS digest, count(*) AS n FROM documents GROUP BY 1")
def dataset_fingerprint(t):
    return review.fingerprint(t("documents"))


@_query("""SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(list_transform(range(least(1 + doc_id % 40, 12)), lambda i: CASE WHEN doc_id % 40 = 0 THEN 0 ELSE i * (doc_id % 40) // (least(1 + doc_id % 40, 12) - 1) END), [(doc_id % 7) % (1 + doc_id % 40)]))), ',') AS frames FROM documents""")
def sampled_frame_numbers(t):
    n = (1 + F.col("doc_id") % 40).cast("int")
    first = F.array((F.col("doc_id") % 7 % n).cast("int"), F.lit(None).cast("int"))
    return t("documents").select("doc_id", F.array_join(refine.sampled_frames(n, first, 12).cast("array<string>"), ",").alias("frames"))


@_query("SELECT conv_id, turn FROM (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY sha256('preview:' || conv_id || ':' || turn), turn) AS n FROM (SELECT DISTINCT conv_id, turn, role FROM conversations)) WHERE n = 1")
def preview_selection(t):
    c = t("conversations").select("conv_id", "turn", "role").distinct()
    k = F.struct(stable_key("preview", F.col("conv_id"), F.col("turn")).alias("k"), F.col("turn"))
    return c.groupBy("conv_id", "role").agg(F.min(k).alias("r")).select("conv_id", "r.turn")


@_query(f"SELECT vec_id, min(vec_id) OVER (PARTITION BY vec_id // 16, bits) AS alias_of FROM (SELECT vec_id, {_BITS} AS bits FROM embeddings)")
def duplicate_tracks(t):
    return tracks.duplicates(t("embeddings"), 16)


@_query("SELECT conv_id, role, string_agg(CAST(turn AS VARCHAR), ',' ORDER BY turn) AS members FROM (SELECT DISTINCT conv_id, role, turn FROM conversations) GROUP BY 1, 2")
def span_inverse_index(t):
    return tracks.span_links(t("conversations"), "conv_id", "role", "turn")


@_query("SELECT lang, source, doc_id FROM (SELECT lang, source, d.doc_id, row_number() OVER (PARTITION BY lang, source ORDER BY sha256('accept:' || d.doc_id), d.doc_id) AS n FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 1) WHERE n = 1")
def one_accepted_per_video(t):
    good = t("documents").select("doc_id", "lang", "source").join(t("labels").where("quality = 1").select("doc_id"), "doc_id")
    first = F.min(F.struct(stable_key("accept", F.col("doc_id")).alias("k"), "doc_id")).alias("r")
    return good.groupBy("lang", "source").agg(first).select("lang", "source", "r.doc_id")


@_query("""WITH RECURSIVE it AS (SELECT l_orderkey AS k, CAST(l_quantity AS DOUBLE) AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS i FROM lineitem),
f AS (SELECT k, i, q, q AS total, 1 AS n, 0 AS batch FROM it WHERE i = 1
UNION ALL SELECT it.k, it.i, it.q, CASE WHEN f.n < 3 AND f.total + it.q <= 60 THEN f.total + it.q ELSE it.q END, CASE WHEN f.n < 3 AND f.total + it.q <= 60 THEN f.n + 1 ELSE 1 END, CASE WHEN f.n < 3 AND f.total + it.q <= 60 THEN f.batch ELSE f.batch + 1 END FROM f JOIN it ON it.k = f.k AND it.i = f.i + 1)
SELECT k AS l_orderkey, batch, CAST(count(*) AS INTEGER) AS n, sum(q) AS weight FROM f GROUP BY 1, 2""")
def batch_packing(t):
    return packets.greedy(t("lineitem"), "l_orderkey", ["l_linenumber"], "l_quantity", 60, 3)


@_query("""SELECT conv_id, turn, CASE WHEN role = 'user' THEN role || ' speaks' END AS text, CASE WHEN role = 'user' THEN CAST(length(role) AS INTEGER) END AS stop,
CASE WHEN role <> 'user' THEN 'unknown_id' END AS error FROM conversations""")
def tag_parse(t):
    c = t("conversations").select("conv_id", "turn", F.concat(F.lit("[1]"), "role", F.lit("[/1] speaks")).alias("tagged"), F.when(F.col("role") == "user", F.array(F.lit(1))).otherwise(F.array(F.lit(2))).alias("ids"))
    return c.withColumn("p", parsed("tagged", "ids")).select("conv_id", "turn", "p.text", F.get("p.mentions", F.lit(0))["stop"].alias("stop"), "p.error")
