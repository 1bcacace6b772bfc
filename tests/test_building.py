"""From detections to records: assembly, merging and the outcomes of single units."""

import json

import pytest
from pyspark.sql import functions as F

from spanweave.operators import building, records
from spanweave.plans import records as plans

MASK = "struct<size:array<int>,counts:array<bigint>>"
DETECTION = f"video_key string, prompt string, object_id int, frame_index int, seq int, mask {MASK}, score double"
TARGET = "struct<start:int,end:int,surface:string,head:string,sam_prompt:string>"
CANDIDATE = "array<struct<start:int,end:int,surface:string,head:string>>"
UNIT = f"""sample_id string, text string, negative boolean, target_source_expected string, extraction struct<target:{TARGET},target_coreference_spans:array<struct<start:int,end:int,text:string>>,notes:array<string>>,
prompt_groups array<struct<sam_prompt:string,candidates:{CANDIDATE}>>"""
TEXT = "A cat beside a ball"


def mask(first, last=400):
    return ([20, 20], [first, last - first, 400 - last])


def track(prompt, obj, masks, score=0.9):
    return [("v", prompt, obj, f, 0, m, score) for f, m in enumerate(masks) if m is not None]


def built(spark, units, detections=(), targets=()):
    u = spark.createDataFrame(units, UNIT)
    said = {c: F.lit("x") for c in "dataset split cohort annotation_protocol provenance_warning dataset_root frame_source expression_id".split()}
    u = u.withColumns(said | {"video_key": F.lit("v"), "video_id": F.lit("v"), "frame_ids": F.array(F.lit("f0"), F.lit("f1")), "target_annotation_ids": F.array(F.lit("99"))})
    videos = spark.createDataFrame([("v", 2)], "video_key string, frame_count int")
    found = building.assembled(spark.createDataFrame(list(detections), DETECTION), videos)
    out = building.build_records(u, spark.createDataFrame(list(targets), f"sample_id string, place int, source_annotation_id string, masks array<{MASK}>"), found)
    return {r.sample_id: r for r in out.withColumn("fault", records.fault()).collect()}


def unit(name="s", text=TEXT, official=True, at=(0, 5), head="cat", groups=((("ball"), ((13, 19, "a ball", "ball"),)),), negative=False):
    return (name, text, negative, building.EXPECTED if official else building.CONTEXT_MODEL, ((*at, text[at[0] : at[1]], head, head), None, None), [(p, list(c)) for p, c in groups])


GIVEN = [("s", 1, "7", [mask(300), mask(300)])]
BALL = track("Ball ", 4, [mask(0, 100), mask(0, 100)])


def test_official_target_and_found_context(spark):
    r = built(spark, [unit()], BALL, GIVEN)["s"]
    assert r.fault is None and r.disposition == "complete_bcc" and [t.source for t in r.tracklets] == ["ground_truth", "sam3.1_context"]
    assert [x.tracklet_ids for x in r.span_links if x.text == "a ball"] == [["sam-context-001"]] and r.frame_files == ["v/f0.jpg", "v/f1.jpg"]
    assert r.tracklets[1].confidence == 0.9 and r.tracklets[1].sam_prompt_aliases == ["ball"] and r.tracklets[0].source_annotation_id == "7"


def test_no_proposal_is_an_outcome(spark):
    r = built(spark, [unit(official=False)])["s"]
    assert (r.fault, r.disposition, r.tracklets, r.groups) == (None, "missing_main_referent", [], [])
    assert [(a["role"], a["raw_tracklets"]) for a in json.loads(r.sam_prompt_audit)] == [("main_referent", 0)]


def test_a_target_that_only_the_model_finds(spark):
    r = built(spark, [unit(official=False, at=(0, 5))], [*track("a CAT", 2, [mask(300), None]), *track("a cat", 3, [mask(390), mask(390)]), *BALL])["s"]
    assert r.fault is None and [(t.tracklet_id, t.source, t.present_frames) for t in r.tracklets] == [("sam-target-001", "sam3.1_main_referent", 1), ("sam-context-001", "sam3.1_context", 2)]
    assert json.loads(r.pipeline)["target_source"] == "sam3.1_multiplex"
    assert json.loads(r.sam_prompt_audit)[0]["rejections"] == [{"sam_object_id": 3, "reason": "total_pixels<64"}]


@pytest.mark.parametrize("masks", [None, [None, None], [mask(400), None]])
def test_an_official_target_that_is_not_there(spark, masks):
    r = built(spark, [unit()], BALL, [("s", 1, "7", masks)] if masks else [])["s"]
    assert (r.fault, r.disposition, r.tracklets) == (None, "missing_main_referent", [])
    assert json.loads(r.sam_prompt_audit)[0]["rejections"] == [{"reason": "official_target_tracklet_empty_or_missing", "source_annotation_ids": ["99"]}]


@pytest.mark.parametrize(("at", "head", "span"), [((0, 0), "SEATING", (0, 7)), ((4, 99), "rest", (24, 28)), ((5, 3), "cat", (0, 29)), ((-1, 3), "", (0, 29))])
def test_a_target_without_a_place_gets_one(spark, at, head, span):
    text = "seating(s) designed for rest."
    r = built(spark, [unit(text=text, at=at, head=head, groups=())], (), GIVEN)["s"]
    assert r.fault is None and r.disposition == "complete_bcc"
    assert [tuple(s) for s in r.groups[0].text_spans] == [(*span, text[span[0] : span[1]])]
    assert json.loads(r.extraction)["notes"] == ["repaired invalid main-referent span deterministically"]


def test_merging_is_in_order(spark):
    """p's first track stays, its second is the target's, q's track merges into p's first and brings its span and head."""
    groups = (("p", ((13, 19, "a ball", "ball"),)), ("q", ((2, 5, "cat", "pet"), (13, 19, "a ball", "ball"))), ("r", ((6, 12, "beside", "side"),)), ("none", ((0, 1, "A", "a"),)))
    det = [*track("p", 9, [mask(0, 100)] * 2), *track("p", 10, [mask(301)] * 2), *track("q", 1, [mask(0, 95)] * 2), *track("r", 1, [mask(0, 79)] * 2), *track("r", 2, [mask(0, 100), None], 0.4)]
    r = built(spark, [unit(groups=groups), unit("n", negative=True)], det, GIVEN)
    n, r = r["n"], r["s"]
    assert r.fault is None and r.disposition == "incomplete_context" and r.unresolved_required_prompts == ["none"]
    assert [(g.group_id, g.identity, [s.text for s in g.text_spans], g.tracklet_ids) for g in r.groups[1:]] == [("context-001", "ball/pet", ["cat", "a ball"], ["sam-context-001"]), ("context-002", "side", ["beside"], ["sam-context-002"])]
    assert r.tracklets[1].sam_prompt_aliases == ["p", "q"] and r.tracklets[1].sam_prompt == "p"
    said = {a["sam_prompt"]: a for a in json.loads(r.sam_prompt_audit)}
    assert [(x["sam_object_id"], x["reason"]) for x in said["p"]["rejections"]] == [(10, "duplicates_main_referent")] and said["p"]["rejections"][0]["temporal_iou"] == 99 / 100
    assert (said["q"]["raw_tracklets"], said["q"]["retained_tracklets"]) == (1, 1) and said["r"]["rejections"] == [{"sam_object_id": 2, "reason": "confidence_below_threshold"}]
    assert (n.fault, n.disposition, n.tracklets, n.groups, n.sam_prompt_audit) == (None, "negative_unsegmentable", [], [], "[]")


def test_assembly(spark):
    det = [("v", "P", 1, 0, 0, mask(0), 0.1), ("v", "p ", 1, 0, 1, mask(399), 0.9), ("v", "p", 1, 2, 0, None, None), ("v", "p", 1, -1, 0, mask(0), 1.0), ("v", "p", 1, 9, 0, mask(0), 1.0), ("w", "p", 1, 0, 0, mask(0), 1.0)]
    videos = spark.createDataFrame([("v", 4)], "video_key string, frame_count int")
    r = building.assembled(spark.createDataFrame(det, DETECTION), videos).collect()
    assert [(x.video_key, x.prompt_key, x.present_frames, x.pixels, x.max_score, x.reason) for x in r] == [("v", "p", 1, 64, 1.0, "retained")]
    assert r[0].mean_score == pytest.approx(2 / 3, abs=1e-15) and [m and m.counts for m in r[0].masks] == [[399, 1, 0], None, None, None]


def test_detections_are_made_by_several_tasks(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"))
    made = plans.detections(docs).groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct("video_key").alias("n")).collect()
    assert len(made) == 3 and sum(r.n for r in made) == 10_000 and max(r.n for r in made) < 5_000
