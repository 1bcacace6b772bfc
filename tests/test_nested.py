"""Operators over nested records on small tables made by hand."""

import json

import pytest
from pyspark.sql import functions as F

from spanweave.functions import language, masks, spans
from spanweave.functions.captions import parsed
from spanweave.operators import campaign, decisions, records, refine, release, review, tracks
from spanweave.plans import nested
from spanweave.plans.nested import annotated

SPANS = "array<struct<start:int,end:int,text:string>>"
GROUPS = f"array<struct<id:int,role:string,identity:string,text_spans:{SPANS},tracklet_ids:array<string>>>"


def one(spark, col, **values):
    df = spark.range(1)
    for name, v in values.items():
        df = df.withColumn(name, v if not isinstance(v, str | int | float | bool) else F.lit(v))
    return df.select(col.alias("x")).first().x


def test_spans(spark):
    t = "  a ball, a ball and the hat(s) "
    text = F.col("text")
    got = one(spark, F.struct(spans.span(text, F.lit(2), F.lit(8)).alias("a"), spans.span(text, F.lit(3), F.lit(99)).alias("b"), spans.span(text, F.lit(3), F.lit(3)).alias("c"), spans.trimmed(text, F.lit(0), F.lit(9)).alias("d"), spans.nearest(text, F.lit("ball"), F.lit(9)).alias("e"), spans.nearest(text, F.lit("cat"), F.lit(0)).alias("f"), spans.repaired(text, F.lit(4), F.lit(4), F.lit("HAT")).alias("g"), spans.repaired(text, F.lit(4), F.lit(4), F.lit("dog")).alias("h")), text=t)
    assert (got.a.text, got.b, got.c, tuple(got.d), got.e, got.f) == ("a ball", None, None, (2, 9), 12, None)
    assert t[got.g.start : got.g.end] == "hat" and tuple(got.h) == (0, len(t))


def test_a_span_beyond_a_short_text_covers_it(spark, tmp_path):
    texts = ["", "a", "ab", "abc", "abcde", "abcdefgh"]
    spark.createDataFrame([(i, t) for t, i in zip(texts, (1, 2, 3, 4, 7, 8), strict=True)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in nested.caption_segments(spark, str(tmp_path)).orderBy("sample_id", "start").collect():
        got.setdefault(r.sample_id, []).append((r.start, r.stop, r.ids))
    assert got == {"s2": [(0, 1, "t0,t1")], "s3": [(0, 2, "t0,t1,t2")], "s4": [(0, 3, "t0,t1,t2,t3")], "s7": [(0, 3, "t0,t1"), (3, 5, "")], "s8": [(0, 3, "t0,t1,t2"), (3, 4, ""), (4, 7, "t1"), (7, 8, "")]}


def test_run_lengths_and_volume(spark):
    def packed(counts):  # the inverse of what is tested
        out = ""
        for i, n in enumerate(counts):
            x = n - counts[i - 2] if i > 2 else n
            while True:
                c, x = x & 31, x >> 5
                more = not (x == 0 and not c & 16 or x == -1 and c & 16)
                out += chr(48 + (c | 32 * more))
                if not more:
                    break
        return out

    for counts in ([6], [0, 6], [3, 5, 100, 2, 2000, 7, 31, 16, 15], [1000000, 1, 1, 999999]):
        assert one(spark, masks.unpacked_counts(F.col("t")), t=packed(counts)) == counts
    runs = lambda *c: masks.on_runs(F.array(F.lit(2), F.lit(3)), F.array(*[F.lit(x).cast("long") for x in c]))
    got = one(spark, F.array(runs(1, 2, 3), runs(0, 9), runs(2, 3), runs(7, -1), runs(6)))
    assert [None if x is None else [tuple(r) for r in x] for x in got] == [[(1, 3)], [(0, 6)], None, None, []]
    m = lambda *c: F.struct(F.array(F.lit(2), F.lit(3)).alias("size"), F.array(*[F.lit(x).cast("long") for x in c]).alias("counts"))
    none = F.lit(None).cast("struct<size:array<int>,counts:array<bigint>>")
    v = one(spark, masks.volume(F.array(m(1, 3, 2), none, none, m(0, 6)), F.array(m(2, 4), m(0, 2, 4), none, m(0, 1, 1, 4))))
    assert tuple(v) == (2 + 0 + 0 + 5, 5 + 2 + 0 + 6)
    assert one(spark, masks.overlap(F.array(none), F.array(none))) == 0 and one(spark, masks.overlap(F.array(m(6)), F.array(m(6), m(6)))) is None
    signs = F.array(*[F.lit(1.0 if i in (0, 63, 64, 129) else -1.0) for i in range(130)])
    assert one(spark, masks.sign_words(signs)) == [1 - 2**63, 1, 2]
    assert one(spark, masks.label_mask(F.array(*map(F.lit, (0, 2, 2))), F.lit(2))) == [0, 1, 1]


def test_masks_that_differ_in_the_last_place_only(spark):
    x = [1.0] * 63
    v = spark.createDataFrame([(0, [*x, 1.0]), (1, [*x, -1.0]), (2, [*x, 1.0])], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.alias_of for r in tracks.duplicates(v, 16).collect()} == {0: 0, 1: 1, 2: 0}
    assert {(r.a, r.b): (r.inter, r.total) for r in tracks.overlaps(v, 16, 0.4).collect()} == {(0, 1): (63, 64), (0, 2): (64, 64), (1, 2): (63, 64)}


def test_context_tracks_merge_in_order(spark):
    rows = [("s", 0, 0.1, []), ("s", 1, 0.7, []), ("s", 2, 0.0, [(0, 0.85)]), ("s", 3, 0.0, [(1, 0.9), (2, 0.9)]), ("s", 4, 0.0, [(0, 0.2), (3, 0.8)])]
    d = spark.createDataFrame(rows, "sample_id string, place int, target_overlap double, overlaps array<struct<place:int,iou:double>>")
    got = {r.place: (r.outcome, r.into) for r in tracks.settled(d).collect()}
    assert got == {0: ("retained", None), 1: ("duplicates_main_referent", None), 2: ("merged_duplicate_context_tracklet", 0), 3: ("retained", None), 4: ("merged_duplicate_context_tracklet", 3)}
    why = [one(spark, tracks.judged(*map(F.lit, x))) for x in ((4, 1, 64, 0.55, 0.45), (41, 2, 99, 1.0, 1.0), (60, 3, 63, 1.0, 1.0), (5, 2, 64, 0.54, 0.5))]
    assert why == ["retained", "present_frames<3", "total_pixels<64", "confidence_below_threshold"]


def replies(spark, rows):
    d = spark.createDataFrame(rows, f"text string, negative boolean, decision string, tagged string, entries {GROUPS}")
    return d.withColumn("parsed", parsed("tagged", F.transform("entries", lambda g: g["id"])))


def test_replies(spark):
    entry = lambda i, role, *ids: (i, role, f"e{i}", [], list(ids))
    both = [entry(1, "main_referent", "a"), entry(2, "context_entity", "b", "c")]
    rows = [
        ("the cat by a box", False, "rewrite", "[1]a cat[/1] and [2]two boxes[/2]", both),
        ("the cat by a box", False, "keep", "the cat by [2]a box[/2]", both),
        ("the cat by a box", False, "reject", "", both),
        ("the cat by a box", False, "reject", "x", both),
        ("no dog", True, "keep", "no dog", both[1:]),
        ("no dog here", True, "keep", "no dog [2]here[/2]", both[1:]),
        ("no dog here", True, "keep", "any dog [2]here[/2]", both[1:]),
        ("the cats", False, "keep", "[1]the cats[/1]", [entry(1, "main_referent", *[f"t{i}" for i in range(11)])]),
    ]
    got = refine.applied(replies(spark, rows)).collect()
    assert [r.error for r in got] == [None, "main_referent_dropped", None, "rejected_with_caption", None, None, "text_changed", "excessive_entity_link"]
    assert [r.outcome for r in got] == ["rewrite", "error", "reject", "error", "keep", "keep", "error", "reject"]
    assert got[0].new_text == "a cat and two boxes" and got[0].new_disposition == "complete_bcc"
    assert [(x.start, x.end, x.text, x.tracklet_ids) for x in got[0].new_links] == [(0, 5, "a cat", ["a"]), (10, 19, "two boxes", ["b", "c"])]
    assert [got[i].new_disposition for i in (4, 5)] == ["negative_unsegmentable", "negative_with_context"] and got[4].new_groups == []
    fix = refine.applied(replies(spark, [rows[0], ("the cat by a box", False, "keep", "[1]the cat[/1] by a box", both), rows[2]]), repair=True).collect()
    assert [r.error for r in fix] == ["text_changed", None, "not_a_repair"] and [g.id for g in fix[1].new_groups] == [1]


def test_requests_and_their_price(spark):
    ok = [one(spark, refine.permitted(F.lit(t), F.array(*map(F.lit, ids)) if ids else F.array().cast("array<int>"))) for t, ids in (("[1]a[/1] b", (1, 2)), ("[3]a[/3]", (1, 2)), ("a [x]", (1,)), ("plain", ()), ("[1]", ()))]
    assert ok == [True, False, False, True, False]
    n = lambda x: F.lit(x).cast("long")
    assert one(spark, refine.used_cost(n(1000), n(200), n(100), n(50), batch=False)) == pytest.approx((700 * 0.1 + 200 * 0.01 + 100 * 0.125 + 50 * 0.5) / 1e6)
    assert one(spark, refine.used_cost(n(300_000), n(None), n(None), n(10))) == pytest.approx(0.5 * (300_000 * 0.125 * 2 + 10 * 0.75) / 1e6)
    q = one(spark, refine.queue_limit(F.lit("x"), F.lit("Enqueued token limit: 2,000,000 reached")))
    assert (q.queued, q.limit) == (True, 2_000_000) and one(spark, refine.redacted(F.lit("key sk-abc_1-2 and hf_x9."))) == "key [redacted] and [redacted]."


def test_reservations(spark):
    have = spark.createDataFrame([("a", 0.8, "completed"), ("b", 0.0, "unsubmitted")], "id string, amount double, state string")
    ask = lambda *rows: spark.createDataFrame(list(rows), "id string, amount double")
    got = {r.id: (r.amount, r.state) for r in release.reserved(have, ask(("b", 0.1), ("c", 0.1)), 1.0).collect()}
    assert got == {"a": (0.8, "completed"), "b": (0.1, "reserved"), "c": (0.1, "reserved")}
    for rows, limit in (([("c", 0.3)], 1.0), ([("a", 0.1)], 5.0)):
        with pytest.raises(Exception, match="budget limit|conflicts"):
            release.reserved(have, ask(*rows), limit).collect()
    pilot = spark.createDataFrame([("x", 0.1), ("x", 0.3)], "s string, cost double")
    with pytest.raises(Exception, match="lacks stratum y"):
        release.estimated(pilot, spark.createDataFrame([("x",), ("y",)], "s string"), ["s"]).collect()
    e = release.estimated(pilot, spark.createDataFrame([("x",)] * 10, "s string"), ["s"]).first()
    assert (e.rows, e.pilot_rows, e.mean, e.expected) == (10, 2, 0.2, 1.0) and e.buffered == pytest.approx(10 * (0.2 + 2 * (0.02 / 2) ** 0.5) * 0.75)


def test_shards_and_draws(spark):
    rows = spark.createDataFrame([(i, (i * 7) % 5 + 1) for i in range(100)], "id long, bytes long")
    at, want = 0, {}
    for i in range(100):
        want[i] = at // 20
        at += (i * 7) % 5 + 1
    assert {r.id: r.shard for r in release.sharded(rows, "bytes", 20, ["id"]).collect()} == want
    u = spark.createDataFrame([(f"v{i % 5}", str(i), i % 2) for i in range(30)], "video_id string, expression_id string, g int")
    got = campaign.drawn(u, "g", 4, "seed", one_per_video=True).collect()
    assert len(got) == 8 and len({(r.g, r.video_id) for r in got}) == 8
    with pytest.raises(Exception, match="fewer there"):
        campaign.drawn(u, "g", 6, "seed", one_per_video=True).collect()


def test_counts_and_object_limits(spark):
    have = spark.createDataFrame([("a", "videos", 3), ("b", "videos", 1)], "key string, kind string, n long")
    want = spark.createDataFrame([("a", "videos", 3), ("c", "videos", 2)], "key string, kind string, n long")
    assert {r.key for r in campaign.count_faults(have, want).collect()} == {"b", "c"}
    u = spark.createDataFrame([("v1", "s1"), ("v1", "s2"), ("v2", "s3")], "video_key string, sample_id string")
    e = spark.createDataFrame([("s2", "OutOfMemoryError", True, 1), ("s3", "OutOfMemoryError", True, 4)], "sample_id string, error_type string, memory_safe_mode boolean, grounding_batch_size int")
    assert {r.video_key: r.most_objects for r in campaign.object_limit(u, e).collect()} == {"v1": 8, "v2": 16}


def test_language(spark):
    text = F.col("text")
    where = lambda t: one(spark, language.question_target(text), text=t)
    assert tuple(where("  Who runs")) == (2, 5) and tuple(where("Which red car is it")) == (0, 13) and where("the car") is None
    cut = lambda t, a, z: tuple(one(spark, language.candidate_span(text, F.lit(a), F.lit(z)), text=t))
    assert cut(" the dog, ", 0, 10) == (1, 8) and cut("hat(s) x", 0, 5) == (0, 6) and cut("hat(s) x", 0, 3) == (0, 3)
    assert [one(spark, language.lemma(F.lit(w))) for w in ("Hat(s)", "(es)box", "'Tis!", "...")] == ["hat", "box", "tis", ""]
    tok = "array<struct<text:string,lemma:string,pos:string,dep:string,start:int,i:int>>"
    said = [("The", "the", "DET", "det", 0, 0), ("left", "left", "ADJ", "amod", 4, 1), ("t", "t", "NOUN", "compound", 9, 2), ("v", "v", "NOUN", "ROOT", 11, 3), ("sitting", "sit", "VERB", "acl", 13, 4), ("its", "its", "PRON", "poss", 21, 5), ("hand", "hand", "NOUN", "dobj", 25, 6)]
    d = spark.createDataFrame([("The left t v sitting its hand", said)], f"text string, tokens {tok}")
    t = F.col("tokens")
    r = d.select(
        language.prompt(F.slice(t, 1, 4), F.get(t, F.lit(3))).alias("prompt"), language.head_in(t, F.lit(0), F.lit(13), F.lit("x")).alias("head"), language.head_in(t, F.lit(0), F.lit(2), F.lit("x")).alias("other"),
        language.without_actions(F.col("text"), t, F.lit(0), F.lit(20)).alias("cut"), language.coreferences(t, F.lit(0), F.lit(12)).alias("refs"),
        language.body_parts(t, F.array(F.struct(F.lit(0).alias("start"), F.lit(12).alias("end"), F.lit("v").alias("head")))).alias("parts"),
    ).first()
    assert (r.prompt, r.head, r.other, tuple(r.cut)) == ("television", "v", "x", (0, 12)) and [x.text for x in r.refs] == ["its"] and [x.text for x in r.parts] == ["hand"]
    c = spark.createDataFrame([([("a", "Red Car "), ("b", None), ("c", "dog"), ("d", "red car")],)], "c array<struct<n:string,sam_prompt:string>>")
    assert [(g.sam_prompt, [x.n for x in g.candidates]) for g in c.select(language.grouped_prompts(F.col("c")).alias("g")).first().g] == [("dog", ["c"]), ("red car", ["a", "d"])]


def test_selection_faults_of_edits(spark):
    groups = [("g", None, None, [(0, 2, "ab"), (1, 3, "xx")], ["t1", "t9"]), (None, "x", "y", [(0, 2, "ab")], ["t9"])]
    d = spark.createDataFrame([("abc", groups)], f"text string, groups array<struct<group_id:string,role:string,identity:string,text_spans:{SPANS},tracklet_ids:array<string>>>")
    (g,) = d.select(decisions.normalised(F.col("groups"), F.array(F.lit("t1")), F.col("text")).alias("g")).first().g
    assert (g.role, g.identity, g.tracklet_ids, [tuple(s) for s in g.text_spans]) == ("manual_link", "t1", ["t1"], [(0, 2, "ab")])


def test_export(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i} with some words in it") for i in range(1, 40)], "doc_id long, text string")
    r = annotated(docs)
    good = r.where(records.fault().isNull())
    errors = spark.createDataFrame([("s1", "ValueError", "no"), ("s31", "ValueError", "bad")], "sample_id string, error_type string, message string")
    units = r.select("sample_id", "dataset", "split", "cohort", "video_id", "expression_id", F.lit("none").alias("target_source_expected"), F.lit(None).cast("array<string>").alias("sam_prompt_groups"))
    out = str(tmp_path / "out")
    m = records.export_campaign(units, good, errors, out, "c1")
    assert m["worklist_units"] == 39 and m["sample_rows"] == m["verification_rows"] == good.count() and m["status_counts"]["completed"] == good.count() and m["status_counts"]["failed"] >= 1
    assert json.loads((tmp_path / "out/manifest.json").read_text()) == m and len(spark.read.parquet(f"{out}/samples.parquet").columns) == 24
    assert len(spark.read.parquet(f"{out}/verification.parquet").columns) == len(spark.read.parquet(f"{out}/tracklets.parquet").columns) == 22
    led = spark.read.option("header", True).csv(f"{out}/run_ledger.csv")
    assert len(led.columns) == 13 and led.count() == 39
    with pytest.raises(Exception, match="record s31: no_frames"):
        records.export_campaign(units, r.where("id in (1, 31)"), errors, str(tmp_path / "other"), "c1")
    assert not (tmp_path / "other").exists()


def test_whole_fingerprint(spark):
    import hashlib

    rows = [(2, "b"), (1, None), (3, "ü")]
    d = spark.createDataFrame(rows, "id long, text string").repartition(3)
    assert review.whole_fingerprint(d, ["id"], "id", "text") == hashlib.sha256("1\0\0002\0b\0003\0ü\0".encode()).hexdigest()


def test_extraction(spark):
    text = 'The red dog near the man\'s hand, like a wolf, and its paw'
    words = [("The", "the", "DET", "det", 2), ("red", "red", "ADJ", "amod", 2), ("dog", "dog", "NOUN", "nsubj", 2), ("near", "near", "ADP", "prep", 2), ("the", "the", "DET", "det", 5), ("man", "man", "NOUN", "poss", 7), ("'s", "'s", "PART", "case", 5), ("hand", "hand", "NOUN", "pobj", 3), ("like", "like", "ADP", "prep", 2), ("a", "a", "DET", "det", 10), ("wolf", "wolf", "NOUN", "pobj", 8), ("its", "its", "PRON", "poss", 12), ("paw", "paw", "NOUN", "conj", 2)]
    tokens, at = [], 0
    for i, (w, lem, pos, dep, head) in enumerate(words):
        at = text.index(w, at)
        tokens.append((w, lem, pos, dep, at, i, head))
        at += len(w)
    chunk = lambda a, z, r: (tokens[a][4], tokens[z][4] + len(tokens[z][0]), tokens[r], tokens[a : z + 1], tokens[r][3])
    tok = "struct<text:string,lemma:string,pos:string,dep:string,start:int,i:int,head:int>"
    schema = f"text string, negative boolean, tokens array<{tok}>, chunks array<struct<start:int,end:int,root:{tok},tokens:array<{tok}>,dep:string>>, category string"
    rows = [(text, False, tokens, [chunk(0, 2, 2), chunk(4, 7, 7), chunk(9, 10, 10)], "dog"), ("no dog", True, [], [], None), ("run away", False, [], [], "Bear")]
    d = spark.createDataFrame(rows, schema)
    x, none, bare = [r.x for r in d.select(language.extraction(*[F.col(c) for c in ("text", "negative", "tokens", "chunks", "category")]).alias("x")).collect()]
    assert (x.target.surface, x.target.head) == ("The red dog", "dog") and [c.text for c in x.coreferences] == ["its"]
    assert [(c.surface, c.sam_prompt) for c in x.contexts] == [("the man's hand", "hand"), ("the man", "man"), ("paw", "paw")]
    assert [(c.surface, c.decision, c.sam_prompt) for c in x.ignored] == [("a wolf", "ignore_comparison_concept", None)]
    assert none is None and (bare.target.surface, bare.target.head, bare.contexts) == ("run away", "bear", [])
