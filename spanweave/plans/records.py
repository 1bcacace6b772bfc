"""Registered queries from detections to records, each beside flat SQL that says what it should give.

Units, official targets and detections are made from `documents` by arithmetic on the id; a video is four documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans
from ..operators import building, records
from .registry import query

SIZE, PROMPTS, OBJECTS, FRAMES = 200, 5, 3, 3
#: Documents to whose videos one task makes detections: a video has a hundred of them, and a task sorts all its own.
DEALT = 16_384


def _mask(first: Column) -> Column:
    """A mask of 10 times 20 pixels that is on from a place to its end."""
    return F.struct(F.array(F.lit(10), F.lit(20)).alias("size"), F.array(first, SIZE - first).cast("array<bigint>").alias("counts"))


def _videos(docs: DataFrame) -> DataFrame:
    v = F.floor(F.col("doc_id") / 4)
    return docs.select(v.alias("v")).distinct().select("v", F.concat(F.lit("v"), F.col("v").cast("string")).alias("video_key"), (1 + F.col("v") % FRAMES).cast("int").alias("frame_count"))


def detections(docs: DataFrame) -> DataFrame:
    """Up to two detections a frame of each prompt's objects; some lie outside the video, some frames have none.

    Videos are few bytes, which Spark would gather in few tasks; they are dealt out by their number before they grow.
    """
    p, o, f, s, v = (F.col(c) for c in "pofsv")
    d = _videos(docs).select("v", "video_key").repartition(1 + docs.count() // DEALT, "video_key")
    for name, n, first in (("p", PROMPTS, 0), ("o", OBJECTS, 0), ("f", FRAMES, -1), ("s", 1, 0)):
        d = d.withColumn(name, F.explode(F.sequence(F.lit(first), F.lit(n - 1 if name != "s" else 1))))
    d = d.where(((v + p + o + f) % 4 != 3) & ((s == 0) | ((v + f) % 3 == 0)) & ((p < 4) | (v % 2 == 0)))
    first = (v * 7 + p * 31 + o * 53 * (v % 5) + f * 11 + s * 17) % (SIZE + 1)
    prompt = F.when(p < 4, F.concat(F.lit(" p"), p.cast("string"))).otherwise("A B")
    return d.select("video_key", prompt.alias("prompt"), o.alias("object_id"), f.alias("frame_index"), s.alias("seq"), _mask(first).alias("mask"), (((v + p * 3 + o + f + s) % 10) / 10 + 0.25).alias("score"))


def units(docs: DataFrame) -> DataFrame:
    i = F.col("doc_id")
    text = F.concat(F.lit("a ball and "), F.coalesce("text", F.lit("")))
    d = docs.select(i, F.floor(i / 4).alias("v"), text.alias("text"))
    place = lambda a, z: F.struct(a.cast("int").alias("start"), z.cast("int").alias("end"))
    at = F.when(i % 7 == 0, place(F.lit(5), F.lit(2))).when(i % 7 == 1, place(F.lit(0), F.length("text") + 1)).otherwise(place(F.lit(0), F.lit(3)))
    head = F.when(i % 14 == 0, "BALL").when(i % 14 == 7, "\n?").otherwise("b")
    target = F.struct(at["start"].alias("start"), at["end"].alias("end"), spans.cut(F.col("text"), at["start"], at["end"]).alias("surface"), head.alias("head"), F.lit("ball").alias("sam_prompt"))
    candidate = lambda a, z, h: F.struct(a.cast("int").alias("start"), z.cast("int").alias("end"), spans.cut(F.col("text"), a, z).alias("surface"), h.alias("head"))
    group = lambda g: F.struct(F.concat(F.lit("P"), ((i + g) % 4).cast("string")).alias("sam_prompt"), F.array(candidate(F.lit(2), F.lit(6), F.concat(F.lit("h"), ((i + g) % 3).cast("string"))), candidate(g, g + 5, F.lit("h0"))).alias("candidates"))
    groups = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda g: F.when(g < i % 4, group(g)))
    frames = F.transform(F.sequence(F.lit(0), (F.col("v") % FRAMES).cast("int")), lambda f: F.concat(F.lit("f"), f.cast("string")))
    said = lambda x: F.lit(x)
    return d.select(
        F.concat(F.lit("s"), i.cast("string")).alias("sample_id"), said("corpus").alias("dataset"), said("train").alias("split"), said("c").alias("cohort"), said("plain").alias("annotation_protocol"), F.lit(None).cast("string").alias("provenance_warning"), said("/data").alias("dataset_root"), said("/data/frames.zip").alias("frame_source"),
        F.concat(F.lit("v"), F.col("v").cast("string")).alias("video_key"), F.concat(F.lit("v"), F.col("v").cast("string")).alias("video_id"), i.cast("string").alias("expression_id"), "text", (i % 11 == 0).alias("negative"), frames.alias("frame_ids"),
        F.when(i % 3 != 0, building.EXPECTED).otherwise(building.CONTEXT_MODEL).alias("target_source_expected"), F.array(i.cast("string")).alias("target_annotation_ids"),
        F.struct(target.alias("target"), F.when(i % 9 == 4, F.array(F.struct(F.lit(7).alias("start"), F.lit(10).alias("end"), F.lit("and").alias("text")))).alias("target_coreference_spans"), F.lit(None).cast("array<string>").alias("notes")).alias("extraction"), F.filter(groups, lambda g: g.isNotNull()).alias("prompt_groups"),
    )


def official(docs: DataFrame) -> DataFrame:
    """One or two sequences of each unit that expects official ones; those of every fifth hold no pixel."""
    i, k = F.col("doc_id"), F.col("k")
    d = docs.where("doc_id % 3 > 0").select(i, F.explode(F.sequence(F.lit(1), (i % 3).cast("int"))).alias("k"))
    first = lambda f: (i * 13 + k * 29 + f * 11) % (SIZE + 1)
    one = lambda f: F.when((i + k + f) % 4 != 0, F.when(i % 5 == 0, _mask(F.lit(SIZE))).otherwise(_mask(first(f))))
    return d.select(F.concat(F.lit("s"), i.cast("string")).alias("sample_id"), k.alias("place"), F.concat_ws("-", i.cast("string"), k.cast("string")).alias("source_annotation_id"), F.transform(F.sequence(F.lit(0), (F.floor(i / 4) % FRAMES).cast("int")), one).alias("masks"))


def built(docs: DataFrame) -> DataFrame:
    return building.build_records(units(docs), official(docs), building.assembled(detections(docs), _videos(docs)))


DETECTED = f"""vid AS (SELECT DISTINCT doc_id // 4 AS v, CAST(1 + (doc_id // 4) % 3 AS INT) AS nf FROM documents),
det AS (SELECT v, nf, p, o, f, s, (v * 7 + p * 31 + o * 53 * (v % 5) + f * 11 + s * 17) % {SIZE + 1} AS c, CAST((v + p * 3 + o + f + s) % 10 AS DOUBLE) / 10 + 0.25 AS score FROM vid, range({PROMPTS}) a(p), range({OBJECTS}) b(o), range(-1, {FRAMES}) e(f), range(2) g(s)
 WHERE (v + p + o + f) % 4 <> 3 AND (s = 0 OR (v + f) % 3 = 0) AND (p < 4 OR v % 2 = 0) AND f >= 0 AND f < nf),
seen AS (SELECT v, p, o, f, arg_max(c, s) AS c FROM det GROUP BY ALL),
trk AS (SELECT d.v, d.p, d.o, any_value(nf) AS nf, CAST(sum(CAST(score AS DECIMAL(30,20))) AS DOUBLE) / count(*) AS mean, max(score) AS most, least(64, sum({SIZE} - c)) AS pixels, (SELECT count(*) FROM seen s WHERE s.v = d.v AND s.p = d.p AND s.o = d.o AND s.c < {SIZE}) AS present FROM det d GROUP BY d.v, d.p, d.o),
jud AS (SELECT *, CASE WHEN present < CASE WHEN nf <= 4 THEN 1 ELSE 2 END THEN 'present_frames<1' WHEN pixels < 64 THEN 'total_pixels<64' WHEN most < 0.55 OR mean < 0.45 THEN 'confidence_below_threshold' ELSE 'retained' END AS reason FROM trk)"""


@query(f"""WITH {DETECTED} SELECT 'v' || v AS video_key, CASE WHEN p < 4 THEN 'p' || p ELSE 'a b' END AS prompt_key, o AS object_id, CAST(present AS INT) AS present_frames, CAST(pixels AS BIGINT) AS pixels, round(mean, 9) AS mean_score, most AS max_score, reason,
CASE WHEN reason = 'retained' THEN (SELECT string_agg(coalesce(CAST(c AS VARCHAR), '-'), ',' ORDER BY n) FROM (SELECT n, c FROM range(3) r(n) LEFT JOIN seen s ON s.v = j.v AND s.p = j.p AND s.o = j.o AND s.f = n WHERE n < j.nf)) END AS masks FROM jud j""")
def detected_tracks(t):
    d = t("documents")
    on = lambda m: F.coalesce(F.get(m["counts"], F.lit(0)).cast("string"), F.lit("-"))
    return building.assembled(detections(d), _videos(d)).withColumns({"masks": F.array_join(F.transform("masks", on), ","), "mean_score": F.round("mean_score", 9)})


BUILT = f"""RECURSIVE {DETECTED},
rec AS (SELECT doc_id AS i, doc_id // 4 AS v, CAST(1 + (doc_id // 4) % 3 AS INT) AS nf, 'a ball and ' || coalesce(text, '') AS text, doc_id % 11 = 0 AS negative, doc_id % 3 <> 0 AS expects FROM documents),
tgt AS (SELECT i, text, CASE WHEN i % 11 <> 0 AND i % 14 = 0 THEN 2 WHEN i % 11 <> 0 AND i % 14 = 7 THEN CASE WHEN instr(text, chr(10) || '?') > 0 THEN instr(text, chr(10) || '?') - 1 ELSE 0 END WHEN i % 7 = 1 THEN CASE WHEN i % 11 <> 0 THEN 2 ELSE 0 END ELSE 0 END AS a,
 CASE WHEN i % 14 = 0 THEN 6 WHEN i % 14 = 7 THEN CASE WHEN instr(text, chr(10) || '?') > 0 THEN instr(text, chr(10) || '?') + 1 ELSE length(text) END WHEN i % 7 = 1 THEN 3 ELSE 3 END AS z, CASE WHEN i % 14 = 0 THEN 'BALL' WHEN i % 14 = 7 THEN chr(10) || '?' ELSE 'b' END AS head FROM rec),
omask AS (SELECT i, k, f, CASE WHEN i % 5 = 0 THEN {SIZE} ELSE (i * 13 + k * 29 + f * 11) % {SIZE + 1} END AS c FROM rec, range(1, 3) a(k), range(3) b(f) WHERE expects AND k <= i % 3 AND f < nf AND (i + k + f) % 4 <> 0),
off AS (SELECT DISTINCT i, k FROM omask WHERE c < {SIZE} AND i % 11 <> 0),
model AS (SELECT r.i, j.v, j.p, j.o, j.reason, j.mean, row_number() OVER (PARTITION BY r.i ORDER BY j.o) AS n FROM rec r JOIN tgt g ON g.i = r.i JOIN jud j ON j.v = r.v AND j.p = CASE WHEN lower(substr(r.text, a + 1, z - a)) = 'a b' THEN 4 WHEN regexp_matches(lower(trim(substr(r.text, a + 1, z - a))), '^p[0-3]$') THEN CAST(right(trim(substr(r.text, a + 1, z - a)), 1) AS INT) ELSE 99 END WHERE NOT negative AND NOT expects),
main AS (SELECT i, k AS n, 'gt-' || lpad(CAST(k AS VARCHAR), 3, '0') AS tid, CAST(1 AS DOUBLE) AS mean FROM off UNION ALL SELECT i, n, 'sam-target-' || lpad(CAST(n AS VARCHAR), 3, '0'), mean FROM (SELECT i, o, mean, row_number() OVER (PARTITION BY i ORDER BY o) AS n FROM model WHERE reason = 'retained')),
mmask AS (SELECT o.i, o.k AS n, m.f, m.c FROM off o JOIN omask m ON m.i = o.i AND m.k = o.k UNION ALL SELECT x.i, x.n, s.f, s.c FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY o) AS n FROM model WHERE reason = 'retained') AS x(i, v, p, o, reason, mean, n_, n) JOIN seen s ON s.v = x.v AND s.p = x.p AND s.o = x.o),
grp AS (SELECT r.i, r.v, r.nf, g, (r.i + g) % 4 AS p, text FROM rec r, range(3) a(g) WHERE g < r.i % 4 AND r.i IN (SELECT i FROM main)),
raw AS (SELECT g.i, g.v, g.nf, g.g, g.p, j.o, j.reason, j.mean, row_number() OVER (PARTITION BY g.i ORDER BY g.g, j.o) AS n FROM grp g JOIN jud j ON j.v = g.v AND j.p = g.p),
tov AS (SELECT i, n, max(CASE WHEN uni > 0 THEN CAST(inter AS DOUBLE) / uni ELSE 0 END) AS iou FROM (SELECT x.i, x.n, m.n AS m, sum({SIZE} - greatest(coalesce(a.c, {SIZE}), coalesce(b.c, {SIZE}))) AS inter, sum({SIZE} - least(coalesce(a.c, {SIZE}), coalesce(b.c, {SIZE}))) AS uni
 FROM raw x JOIN main m ON m.i = x.i CROSS JOIN range(3) q(f) LEFT JOIN seen a ON a.v = x.v AND a.p = x.p AND a.o = x.o AND a.f = q.f LEFT JOIN mmask b ON b.i = x.i AND b.n = m.n AND b.f = q.f WHERE x.reason = 'retained' AND q.f < x.nf GROUP BY ALL) GROUP BY i, n),
cov AS (SELECT x.i, x.n, y.n AS m, sum({SIZE} - greatest(coalesce(a.c, {SIZE}), coalesce(b.c, {SIZE}))) AS inter, sum({SIZE} - least(coalesce(a.c, {SIZE}), coalesce(b.c, {SIZE}))) AS uni
 FROM raw x JOIN raw y ON y.i = x.i AND y.n < x.n CROSS JOIN range(3) q(f) LEFT JOIN seen a ON a.v = x.v AND a.p = x.p AND a.o = x.o AND a.f = q.f LEFT JOIN seen b ON b.v = y.v AND b.p = y.p AND b.o = y.o AND b.f = q.f WHERE x.reason = 'retained' AND y.reason = 'retained' AND q.f < x.nf GROUP BY ALL),
alike AS (SELECT i, n, list(m ORDER BY m) AS ms FROM cov WHERE uni > 0 AND CAST(inter AS DOUBLE) / uni >= 0.8 GROUP BY i, n),
todo AS (SELECT r.*, coalesce(t.iou, 0) AS iou, coalesce(a.ms, []) AS ms FROM raw r LEFT JOIN tov t ON t.i = r.i AND t.n = r.n LEFT JOIN alike a ON a.i = r.i AND a.n = r.n),
fold AS (SELECT i, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS kept, CAST('' AS VARCHAR) AS outcome, CAST(0 AS BIGINT) AS dest FROM rec UNION ALL
 SELECT t.i, t.n, CASE WHEN t.reason = 'retained' AND t.iou < 0.65 AND len(list_filter(t.ms, lambda x: list_contains(f.kept, x))) = 0 THEN list_append(f.kept, t.n) ELSE f.kept END,
 CASE WHEN t.reason <> 'retained' THEN t.reason WHEN t.iou >= 0.65 THEN 'duplicates_main_referent' WHEN len(list_filter(t.ms, lambda x: list_contains(f.kept, x))) > 0 THEN 'merged_duplicate_context_tracklet' ELSE 'retained' END,
 CASE WHEN t.reason = 'retained' AND t.iou < 0.65 THEN coalesce(list_min(list_filter(t.ms, lambda x: list_contains(f.kept, x))), t.n) ELSE 0 END FROM fold f JOIN todo t ON t.i = f.i AND t.n = f.n + 1),
res AS (SELECT f.i, f.n, f.outcome, f.dest, r.g, r.p, r.o, r.mean FROM fold f JOIN raw r ON r.i = f.i AND r.n = f.n),
ctx AS (SELECT i, dest AS n, row_number() OVER (PARTITION BY i ORDER BY dest) AS k FROM res WHERE outcome = 'retained')"""


@query(f"""WITH {BUILT},
spn AS (SELECT DISTINCT c.i, c.k, s.a, s.z, substr(g.text, s.a + 1, s.z - s.a) AS said FROM ctx c JOIN res x ON x.i = c.i AND x.dest = c.n JOIN grp g ON g.i = x.i AND g.g = x.g CROSS JOIN LATERAL (SELECT 2 AS a, 6 AS z UNION ALL SELECT g.g, g.g + 5) s),
hed AS (SELECT DISTINCT c.i, c.k, h.h FROM ctx c JOIN res x ON x.i = c.i AND x.dest = c.n CROSS JOIN LATERAL (SELECT 'h' || ((x.i + x.g) % 3) AS h UNION ALL SELECT 'h0') h),
prm AS (SELECT DISTINCT c.i, c.k, 'P' || x.p AS prompt FROM ctx c JOIN res x ON x.i = c.i AND x.dest = c.n),
cg AS (SELECT c.i, c.k, (SELECT string_agg(h, '/' ORDER BY h) FROM hed h WHERE h.i = c.i AND h.k = c.k) || '@' || (SELECT string_agg(a || '-' || z, ',' ORDER BY a, z) FROM spn s WHERE s.i = c.i AND s.k = c.k) || '=sam-context-' || lpad(CAST(c.k AS VARCHAR), 3, '0') || '(' || (SELECT string_agg(prompt, ',' ORDER BY prompt) FROM prm q WHERE q.i = c.i AND q.k = c.k) || ')' AS said FROM ctx c),
aud AS (SELECT g.i, g.g, count(x.n) AS raw, count(x.n) FILTER (WHERE x.dest > 0) AS stay, coalesce(string_agg(x.o || ' ' || x.outcome, ',' ORDER BY x.n) FILTER (WHERE x.outcome <> 'retained'), '') AS why FROM grp g LEFT JOIN res x ON x.i = g.i AND x.g = g.g GROUP BY ALL),
man AS (SELECT i, count(*) AS n, string_agg(tid, ',' ORDER BY n) AS ids FROM main GROUP BY i)
SELECT 's' || r.i AS sample_id, CAST(NULL AS VARCHAR) AS fault,
CASE WHEN negative THEN 'negative_unsegmentable' WHEN m.i IS NULL THEN 'missing_main_referent' WHEN EXISTS (SELECT 1 FROM aud a WHERE a.i = r.i AND stay = 0) THEN 'incomplete_context' ELSE 'complete_bcc' END AS disposition,
CASE WHEN m.i IS NULL THEN '' ELSE g.head || '@' || a || '-' || z || CASE WHEN r.i % 9 = 4 THEN ',7-10' ELSE '' END || '=' || m.ids END AS main,
coalesce((SELECT string_agg(said, ';' ORDER BY k) FROM cg WHERE cg.i = r.i), '') AS contexts,
CASE WHEN negative THEN NULL ELSE coalesce((SELECT string_agg('P' || ((r.i + a.g) % 4), ',' ORDER BY a.g) FROM aud a WHERE a.i = r.i AND stay = 0), '') END AS unresolved,
coalesce((SELECT string_agg('P' || ((r.i + a.g) % 4) || ':' || raw || ':' || stay || ':' || why, ';' ORDER BY a.g) FROM aud a WHERE a.i = r.i), '') AS audit,
CASE WHEN negative THEN '' WHEN expects AND m.i IS NULL THEN '0:0:official_target_tracklet_empty_or_missing' WHEN expects THEN '' ELSE (SELECT count(*) || ':' || count(*) FILTER (WHERE reason = 'retained') || ':' || coalesce(string_agg(reason, ',' ORDER BY o) FILTER (WHERE reason <> 'retained'), '') FROM model x WHERE x.i = r.i) END AS main_audit,
round(coalesce((SELECT sum(mean) FROM main x WHERE x.i = r.i), 0) + coalesce((SELECT sum(mean) FROM res x WHERE x.i = r.i AND outcome = 'retained'), 0), 6) AS confidence,
NOT negative AND r.i % 7 < 2 AS repaired
FROM rec r JOIN tgt g ON g.i = r.i LEFT JOIN man m ON m.i = r.i""")
def built_records(t):
    r = built(t("documents"))
    place = lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))
    told = lambda g: F.concat(g["identity"], F.lit("@"), F.array_join(F.transform(g["text_spans"], place), ","), F.lit("="), F.array_join(g["tracklet_ids"], ","))
    of = lambda role: F.filter("groups", lambda g: g["role"] == role)
    aliases = F.filter(F.transform("tracklets", lambda x: x["sam_prompt_aliases"]), lambda x: x.isNotNull())
    audit = F.from_json("sam_prompt_audit", f"array<{building.AUDIT}>")
    counted = lambda a, why: F.concat_ws(":", a["raw_tracklets"].cast("string"), a["retained_tracklets"].cast("string"), F.array_join(F.transform(a["rejections"], why), ","))
    r = r.withColumn("audit", audit)
    by_role = lambda role: F.filter("audit", lambda a: a["role"] == role)
    return r.select(
        "sample_id", records.fault().alias("fault"), "disposition",
        F.array_join(F.transform(of(building.MAIN), told), ";").alias("main"),
        F.array_join(F.zip_with(F.transform(of(building.CONTEXT), told), aliases, lambda g, a: F.concat(g, F.lit("("), F.array_join(a, ","), F.lit(")"))), ";").alias("contexts"),
        F.array_join("unresolved_required_prompts", ",").alias("unresolved"),
        F.array_join(F.transform(by_role(building.CONTEXT), lambda a: F.concat(a["sam_prompt"], F.lit(":"), counted(a, lambda x: F.concat(x["sam_object_id"].cast("string"), F.lit(" "), x["reason"])))), ";").alias("audit"),
        F.array_join(F.transform(by_role(building.MAIN), lambda a: counted(a, lambda x: x["reason"])), ";").alias("main_audit"),
        F.round(F.aggregate("tracklets", F.lit(0.0), lambda a, x: a + x["confidence"]), 6).alias("confidence"),
        F.contains("extraction", F.lit(building.REPAIRED)).alias("repaired"),
    )
