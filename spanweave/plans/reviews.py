"""Registered queries over a reviewer's document, each beside flat SQL that says what it should give.

Records are those of `nested`; every other video is previewed, and the document is made by arithmetic on the video.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import document
from .nested import annotated
from .registry import query


def reviewed(docs: DataFrame) -> DataFrame:
    r = annotated(docs)
    v = F.floor(F.col("id") / 4)
    kind = F.get(F.array(*map(F.lit, ("Nonexistent", "explicit", "implicit"))), (F.col("id") % 3).cast("int"))
    return r.where("id % 37 <> 0").withColumns({"dataset": F.when(v % 2 == 0, "ReVOS").otherwise("corpus"), "cohort": kind})


def _document(docs: DataFrame, faulty: bool) -> DataFrame:
    """Videos of a document over `reviewed`: of seven one is missing; some select, some list accepted ids, some previews
    carry extras or overrides; every third id has an edit. With `faulty`, lists break each rule somewhere."""
    v, i = F.col("v"), F.col("id")
    s = lambda n: F.concat(F.lit("s"), n.cast("string"))
    d = docs.where("doc_id % 37 <> 0").select(F.col("doc_id").alias("id"), F.floor(F.col("doc_id") / 4).alias("v"), F.coalesce("text", F.lit("")).alias("text"))
    edit = F.struct(F.when(i % 6 == 1, "rejected").alias("status"), F.when(i % 9 == 1, True).alias("discarded"), F.when(i % 12 == 4, F.concat(F.lit("abc "), "text")).alias("text"), F.when(i % 2 == 0, F.array(F.lit("t0"))).alias("deleted_tracklet_ids"), F.lit(None).alias("groups")).cast(document.EDIT)
    own = F.when(i % 3 == 1, F.struct(s(i).alias("k"), edit.alias("e")))
    one = d.groupBy("v").agg(F.map_from_entries(F.collect_list(own)).alias("instructions"), F.array_sort(F.collect_list(F.when(i % 3 != 1, i))).alias("free"), F.array_sort(F.collect_list(i)).alias("all"))
    first, last, no = s(F.get("free", F.lit(0))), s(F.element_at("free", -1)), F.lit(None)
    two = F.array_distinct(F.array(first, last))
    chosen = F.when((v % 6 == 1) & (F.size("free") > 0), F.array(first)).when((v % 6 == 2) & (F.size("free") > 0), two)
    taken = F.when((v % 4 == 1) & (F.size("free") > 0), F.array_distinct(F.array(last, s(F.element_at("all", -1)))))
    extra = F.when(v % 8 == 2, F.array(s(F.element_at("all", -1))))
    old = F.when(v % 8 == 0, F.array(s(F.get("all", F.lit(0))), s(F.element_at("all", -1))))
    leave = v % 6 == 2
    if faulty:
        chosen = F.when(v % 11 == 1, F.array(first, first)).when(v % 11 == 3, F.array(F.lit("s-1"))).when(v % 11 == 5, F.array().cast("array<string>")).when(v % 11 == 7, F.array(s(F.get("all", F.lit(0))), s(F.element_at("all", -1)))).otherwise(chosen)
        taken = F.when(v % 13 == 2, F.array(F.lit("s-2"))).otherwise(taken)
        extra = F.when(v % 16 == 2, F.array(F.lit("s-3"))).otherwise(extra)
        leave = v % 3 == 2
    status = F.when(v % 5 == 0, "undecided").when(v % 5 == 4, "rejected").otherwise("accepted")
    video = F.struct(status.alias("status"), leave.alias("allow_multiple"), chosen.alias("selected_sample_ids"), taken.alias("accepted_sample_ids"), F.when(v % 8 == 0, document.PREVIEW).alias("review_mode"), old.alias("preview_sample_ids"), extra.alias("preview_override_sample_ids"), no.cast("boolean").alias("video_decision_explicit"), F.when(v % 5 == 4, "s0").alias("sampled_sample_id"), F.col("instructions")).cast(document.VIDEO)
    return one.where(v % 7 != 3).select(F.concat(F.when(v % 2 == 0, "ReVOS").otherwise("corpus"), F.lit("::train::v"), v.cast("string")).alias("video_key"), video.alias("x")).select("video_key", "x.*")


def _ids(c: str | Column) -> Column:
    return F.array_join(c, ",")


REVIEWED = """r AS (SELECT doc_id AS id, doc_id // 4 AS v, 's' || doc_id AS sid, coalesce(text, '') AS text, CASE WHEN (doc_id // 4) % 2 = 0 THEN 'ReVOS' ELSE 'corpus' END || '::train::v' || (doc_id // 4) AS vk, (doc_id // 4) % 2 = 0 AS shown, doc_id % 3 AS cohort,
 doc_id % 5 > 0 AND doc_id % 6 <> 0 AS bears, CASE WHEN doc_id // 4 % 7 <> 3 AND doc_id % 3 = 1 AND doc_id % 6 = 1 THEN 'rejected' END AS status, doc_id // 4 % 7 <> 3 AND doc_id % 3 = 1 AND doc_id % 9 = 1 AS discarded, CAST(doc_id % 5 AS INT) AS k FROM documents WHERE doc_id % 37 <> 0),
rank AS (SELECT *, row_number() OVER (PARTITION BY vk ORDER BY CAST(NOT bears AS INT), sha256(vk || chr(0) || sid), sid) AS rank FROM r),
vid AS (SELECT v, any_value(vk) AS vk, any_value(shown) AS shown, list(id ORDER BY id) AS every, list(id ORDER BY id) FILTER (id % 3 <> 1) AS free, CASE WHEN v % 5 = 0 THEN 'undecided' WHEN v % 5 = 4 THEN 'rejected' ELSE 'accepted' END AS vstatus FROM r GROUP BY v),
doc AS (SELECT *, CASE WHEN v % 6 = 1 AND len(free) > 0 THEN [free[1]] WHEN v % 6 = 2 AND len(free) > 0 THEN CASE WHEN free[1] = free[-1] THEN [free[1]] ELSE [free[1], free[-1]] END END AS chosen, CASE WHEN v % 4 = 1 AND len(free) > 0 THEN CASE WHEN free[-1] = every[-1] THEN [every[-1]] ELSE [free[-1], every[-1]] END END AS taken,
 CASE WHEN v % 8 = 2 THEN [every[-1]] WHEN v % 8 = 0 THEN [every[1], every[-1]] END AS extra FROM vid WHERE v % 7 <> 3),
base AS (SELECT vk, v, id, sid, row_number() OVER (PARTITION BY vk ORDER BY CASE cohort WHEN 0 THEN 0 ELSE cohort END, rank) AS place FROM (SELECT *, min(rank) OVER (PARTITION BY vk, cohort) AS best FROM rank WHERE shown) WHERE cohort = 0 OR rank = best),
more AS (SELECT d.vk, d.v, x.id, 's' || x.id AS sid, 1000 + x.n AS place FROM doc d CROSS JOIN LATERAL (SELECT unnest(extra) AS id, unnest(range(len(extra))) AS n) x WHERE d.shown AND x.id NOT IN (SELECT id FROM base)),
prev AS (SELECT p.*, q.over, CASE WHEN r.status IS NOT NULL THEN r.status WHEN discarded THEN 'rejected' ELSE 'accepted' END AS st, r.discarded FROM (SELECT *, false AS over FROM base UNION ALL SELECT *, true FROM more) AS q JOIN r ON r.id = q.id JOIN (SELECT vk, v, id, sid, place FROM base UNION ALL SELECT vk, v, id, sid, place FROM more) p ON p.id = q.id),
std AS (SELECT k.*, CASE WHEN d.chosen IS NOT NULL THEN list_contains(d.chosen, k.id) WHEN d.taken IS NOT NULL THEN list_contains(d.taken, k.id) ELSE true END AS candidate, coalesce(list_contains(d.taken, k.id), false) OR coalesce(list_contains(d.chosen, k.id), false) OR (d.chosen IS NULL AND d.taken IS NULL) AS archived
 FROM rank k JOIN doc d ON d.v = k.v WHERE NOT k.shown AND d.vstatus = 'accepted' AND NOT k.discarded AND coalesce(k.status, '') <> 'rejected'),
agg AS (SELECT v, string_agg(sid, ',' ORDER BY rank) FILTER (archived) AS accepted, arg_min(sid, rank) FILTER (candidate) AS sampled FROM std GROUP BY v)"""


@query(f"""WITH {REVIEWED}, p AS (SELECT vk, string_agg(sid, ',' ORDER BY place) AS preview, coalesce(string_agg(sid, ',' ORDER BY place) FILTER (over), '') AS over, coalesce(string_agg(sid, ',' ORDER BY place) FILTER (st = 'accepted' AND NOT discarded), '') AS accepted, count(*) AS n FROM prev GROUP BY vk),
e AS (SELECT v, count(*) AS n FROM r WHERE id % 3 = 1 GROUP BY v), e2 AS (SELECT p.vk, count(*) AS n FROM prev p JOIN r ON r.id = p.id WHERE r.id % 3 = 1 GROUP BY 1)
SELECT w.vk AS video_key, CASE WHEN d.v IS NULL THEN 'undecided' ELSE w.vstatus END AS status, CASE WHEN w.shown THEN 'revos_preview_v1' END AS review_mode, p.preview, p.over AS overrides, CASE WHEN w.shown THEN p.accepted WHEN a.sampled IS NOT NULL THEN a.accepted ELSE array_to_string(list_transform(d.taken, lambda x: 's' || x), ',') END AS accepted,
a.sampled, CASE WHEN w.shown THEN d.v IS NOT NULL AND w.vstatus IN ('accepted', 'rejected') END AS explicit, CAST(CASE WHEN w.shown THEN p.n + CASE WHEN d.v IS NULL THEN 0 ELSE coalesce(e.n, 0) - coalesce(e2.n, 0) END ELSE coalesce(e.n, 0) END AS INT) AS instructions
FROM vid w LEFT JOIN doc d ON d.v = w.v LEFT JOIN p ON p.vk = w.vk LEFT JOIN agg a ON a.v = w.v LEFT JOIN e ON e.v = w.v LEFT JOIN e2 ON e2.vk = w.vk WHERE w.shown OR d.v IS NOT NULL""")
def completed_document(t):
    rows = document.ranked(reviewed(t("documents")).withColumn("bears", F.size("tracklets") > 0))
    c = document.completed(rows, _document(t("documents"), False))
    return c.select("video_key", "status", "review_mode", _ids("preview_sample_ids").alias("preview"), _ids("preview_override_sample_ids").alias("overrides"), _ids("accepted_sample_ids").alias("accepted"), F.col("sampled_sample_id").alias("sampled"), F.col("video_decision_explicit").alias("explicit"), F.size("instructions").alias("instructions"))


@query(f"""WITH {REVIEWED} SELECT sid AS sample_id, length(CASE WHEN r.id % 3 = 1 AND r.id % 12 = 4 THEN 'abc ' || r.text ELSE r.text END) AS len, CAST(k - CASE WHEN r.id % 3 = 1 AND r.id % 2 = 0 AND k > 0 THEN 1 ELSE 0 END AS INT) AS tracklets, 'accepted' AS verification_status, shown AND true OR r.id % 3 = 1 AS said
FROM r WHERE r.id IN (SELECT p.id FROM prev p JOIN doc d ON d.v = p.v WHERE d.vstatus = 'accepted' AND p.st = 'accepted' AND NOT p.discarded) OR sid IN (SELECT sampled FROM agg)""")
def applied_document(t):
    out = document.applied(reviewed(t("documents")), _document(t("documents"), False))
    return out.select("sample_id", F.length("text").cast("long").alias("len"), F.size("tracklets").alias("tracklets"), "verification_status", (F.col("verification_decision_json") != "{}").alias("said"))


@query(f"""WITH {REVIEWED},
x AS (SELECT v, vk, shown, vstatus, every, free, CASE WHEN v % 11 = 1 THEN [free[1], free[1]] WHEN v % 11 = 3 THEN [-1] WHEN v % 11 = 5 THEN [] WHEN v % 11 = 7 THEN [every[1], every[-1]] ELSE chosen END AS chosen, CASE WHEN v % 13 = 2 THEN [-2] ELSE taken END AS taken, v % 16 = 2 AS bad FROM doc)
SELECT vk AS video_key, CASE WHEN shown THEN 'override_duplicate_or_foreign' WHEN v % 13 = 2 THEN 'accepted_duplicate_or_foreign' WHEN chosen IS NULL THEN 'nothing_confirmed'
WHEN v % 11 IN (1, 3) OR len(list_distinct(chosen)) < len(chosen) THEN 'selected_duplicate_or_foreign' WHEN len(chosen) > 1 AND v % 3 <> 2 THEN 'several_without_leave' WHEN len(chosen) = 0 THEN 'nothing_confirmed' ELSE 'discarded_selected' END AS fault FROM x
WHERE (shown AND bad) OR (NOT shown AND (v % 13 = 2 OR (chosen IS NULL AND vstatus = 'accepted' AND coalesce(len(taken), 0) = 0) OR v % 11 IN (1, 3) OR len(list_distinct(chosen)) < len(chosen) OR (len(chosen) > 1 AND v % 3 <> 2) OR (vstatus = 'accepted' AND (len(chosen) = 0 OR len(list_filter(chosen, lambda i: i % 3 = 1 AND (i % 6 = 1 OR i % 9 = 1))) > 0))))""")
def document_faults(t):
    rows = document.ranked(reviewed(t("documents")).withColumn("bears", F.size("tracklets") > 0))
    return document.faults(rows, _document(t("documents"), True), document.SELECTION)
