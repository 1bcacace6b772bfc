"""A reviewer's document: reading, completing, refusing and applying it."""

import json

import pytest
from pyspark.sql import functions as F

from spanweave.operators import document

TRACKS = "array<struct<tracklet_id:string>>"
SCHEMA = f"sample_id string, dataset string, split string, video_id string, cohort string, negative boolean, text string, tracklets {TRACKS}, groups array<{document.GROUP}>, span_links array<struct<start:int,end:int,text:string,tracklet_ids:array<string>>>"
V1, V2, SEEN = "ref::val::v1", "ref::val::v2", "revos::val::w"


def row(name, video, dataset="ref", cohort="full_video", negative=False):
    groups = [] if negative else [("g", "main_referent", "dog", [(0, 3, "two")], ["t"])]
    return (name, dataset, "val", video, cohort, negative, "two dogs", [] if negative else [("t",)], groups, [])


PLAIN = [row("s1", "v1"), row("s2", "v1"), row("s3", "v2")]
SHOWN = [row(n, "w", "revos", {"n": "nonexistent", "e": "explicit", "i": "implicit"}[n[0]], n[0] == "n") for n in ("n1", "n2", "e1", "e2", "i1", "i2")]


class Case:
    def __init__(self, spark, tmp_path, rows, videos, **said):
        (tmp_path / "d.json").write_text(json.dumps({"videos": videos} | said, indent=1))
        self.records = spark.createDataFrame(rows, SCHEMA)
        self.document = document.normalised(document.read_document(spark, str(tmp_path / "d.json")), "f")
        self.videos, self.protocol = document.videos(self.document), said.get("selection_protocol")
        self.rows = document.ranked(self.records.withColumn("bears", F.size("tracklets") > 0))

    def completed(self):
        return {r.video_key: r for r in document.completed(self.rows, self.videos).collect()}

    def exported(self, videos=None):
        return {r.sample_id: r for r in document.applied(self.records, self.videos if videos is None else videos, self.protocol).collect()}

    def faults(self):
        return {r.video_key: r.fault for r in document.faults(self.rows, self.videos, self.protocol).collect()}


@pytest.fixture
def case(spark, tmp_path):
    return lambda rows, videos, **said: Case(spark, tmp_path, rows, videos, **said)


def test_only_what_is_confirmed_is_exported(case):
    c = case(PLAIN, {V1: {"status": "accepted", "selected_sample_ids": ["s2"], "instructions": {}}}, selection_protocol=document.SELECTION)
    assert set(c.exported()) == {"s2"} and c.faults() == {}
    both = case(PLAIN, {V1: {"status": "accepted", "allow_multiple": True, "selected_sample_ids": ["s1", "s2"]}}, selection_protocol=document.SELECTION)
    v, out = both.completed()[V1], both.exported()
    assert len(out) == 1 and set(v.accepted_sample_ids) == {"s1", "s2"} and v.sampled_sample_id in out and v.selected_sample_ids == ["s1", "s2"]
    assert case(PLAIN, {}).exported() == {}


def test_older_acceptance_keeps_the_others(case, spark):
    c = case(PLAIN, {V1: {"status": "accepted", "instructions": {"s2": {"text": "two edited dogs"}}}, V2: {"status": "rejected", "sampled_sample_id": "s3"}}, schema_version=document.VERSION)
    done = c.completed()
    v = done[V1]
    assert set(v.accepted_sample_ids) == {"s1", "s2"} and v.instructions["s2"].text == "two edited dogs" and done[V2].sampled_sample_id is None
    again = document.completed(c.rows, document.completed(c.rows, c.videos))
    assert set(c.exported()) == set(c.exported(again)) == {v.sampled_sample_id}
    gone = case(PLAIN, {V1: {"status": "accepted", "instructions": {"s1": {"discarded": True}}}})
    assert gone.completed()[V1].accepted_sample_ids == ["s2"] and set(gone.exported()) == {"s2"}
    given = case(PLAIN, {V1: {"status": "accepted", "accepted_sample_ids": ["s1", "s2"], "selected_sample_ids": ["s2"]}})
    assert set(given.completed()[V1].accepted_sample_ids) == {"s1", "s2"} and set(given.exported()) == {"s2"}


def test_edits_are_applied(case):
    edit = {"text": "2 dogs", "deleted_tracklet_ids": [], "groups": [{"text_spans": [{"start": 2, "end": 6, "text": "dogs"}], "tracklet_ids": ["t", "x"]}], "status": "rewritten"}
    r = case(PLAIN, {V1: {"status": "accepted", "selected_sample_ids": ["s2"], "instructions": {"s2": edit}}}).exported()["s2"]
    assert r.text == "2 dogs" and [(g.group_id, g.role, g.identity, g.tracklet_ids) for g in r.groups] == [("manual-001", "manual_link", "t", ["t"])] and r.verification_status == "rewritten"
    assert [tuple(x) for x in r.span_links] == [(2, 6, "dogs", ["t"])] and json.loads(r.verification_decision_json)["text"] == "2 dogs"


@pytest.mark.parametrize(("video", "fault"), [
    ({"selected_sample_ids": []}, "nothing_confirmed"), ({"selected_sample_ids": ["s1", "s2"]}, "several_without_leave"), ({"selected_sample_ids": ["s1", "s1"], "allow_multiple": True}, "selected_duplicate_or_foreign"),
    ({"selected_sample_ids": ["s3"]}, "selected_duplicate_or_foreign"), ({"selected_sample_ids": ["s1"], "instructions": {"s1": {"discarded": True}}}, "discarded_selected"), ({}, "nothing_confirmed"),
    ({"accepted_sample_ids": ["s1", "s1"]}, "accepted_duplicate_or_foreign"), ({"review_mode": document.PREVIEW, "preview_sample_ids": ["s1"]}, "preview_without_status"),
    ({"review_mode": document.PREVIEW, "preview_sample_ids": [], "preview_override_sample_ids": ["s2"]}, "override_invalid"),
])
def test_wrong_selections_are_refused(case, video, fault):
    c = case(PLAIN, {V1: {"status": "accepted"} | video}, selection_protocol=document.SELECTION)
    assert c.faults() == {V1: fault}
    if fault == "several_without_leave":
        with pytest.raises(Exception, match=fault):
            c.exported()


def test_previews(case):
    c = case(SHOWN + PLAIN[:1], {V1: {"status": "accepted", "selected_sample_ids": ["s1"]}, SEEN: {"status": "accepted", "instructions": {"n1": {"status": "rejected"}, "e1": {"text": "two more"}}}})
    v, out = c.completed()[SEEN], c.exported()
    assert set(v.preview_sample_ids[:2]) == {"n1", "n2"} and [i[0] for i in v.preview_sample_ids[2:]] == ["e", "i"]
    assert v.video_decision_explicit and set(v.accepted_sample_ids) == set(v.preview_sample_ids) - {"n1"} and set(out) == {"s1", *v.accepted_sample_ids}
    assert all(r.verification_status == "accepted" for r in out.values()) and v.instructions["e1"].text == "two more"
    fresh = case(SHOWN, {})
    v = fresh.completed()[SEEN]
    assert (v.status, v.video_decision_explicit, v.review_mode, len(v.preview_sample_ids)) == ("undecided", False, document.PREVIEW, 4) and fresh.exported() == {}


def test_overrides(case):
    base = case(SHOWN, {}).completed()[SEEN].preview_sample_ids
    extra = next(r[0] for r in SHOWN if r[0] not in base)
    for said in ({"preview_override_sample_ids": [extra]}, {"review_mode": document.PREVIEW, "preview_sample_ids": [*base, extra], "instructions": {extra: {"status": "accepted", "text": "two"}}}):
        c = case(SHOWN, {SEEN: {"status": "accepted"} | said})
        v = c.completed()[SEEN]
        assert v.preview_override_sample_ids == [extra] and v.preview_sample_ids == [*base, extra] and extra in c.exported() and v.instructions[extra].status == "accepted"
    out = case(SHOWN, {SEEN: {"status": "accepted", "preview_override_sample_ids": [extra], "instructions": {extra: {"status": "rejected"}}}}).exported()
    assert set(out) == set(base)
    for wrong in (["missing"], [extra, extra]):
        assert case(SHOWN, {SEEN: {"preview_override_sample_ids": wrong}}).faults() == {SEEN: "override_duplicate_or_foreign"}


@pytest.mark.parametrize("said", [{"schema_version": "other"}, {"source_fingerprint": "g"}, {"selection_protocol": "x"}, {"suggestion_count": "7"}])
def test_documents_of_other_kinds_are_refused(case, said):
    with pytest.raises(Exception, match="decisions|selection|suggestion_count"):
        case(PLAIN, {}, **said).document.collect()
    fine = case(PLAIN, {}, suggestion_count=5, source_fingerprint="f").document.first()
    assert (fine.schema_version, fine.source_fingerprint, fine.cursor.video_index, fine.quick_keys_enabled, fine.suggestion_count) == (document.VERSION, "f", 0, True, "5")


def test_a_session_keeps_what_was_there(case, spark, tmp_path):
    c = case(PLAIN + SHOWN, {V1: {"status": "accepted", "selected_sample_ids": ["s2"]}})
    at = str(tmp_path / "kept")
    first = document.Session(spark, at, c.rows, "f")
    assert first.load()[1].count() == 1  # the previewed video, undecided
    first.save(c.videos, selection_protocol=document.SELECTION)
    first.save(c.videos)
    head, videos = document.Session(spark, at, c.rows, "f").load()
    assert head["schema_version"] == document.VERSION and {r.video_key: r.sampled_sample_id for r in videos.collect()} == {V1: "s2", SEEN: None}
    kept = lambda: [json.loads(p.read_text()) for p in (tmp_path / "kept").glob("header.session-start.*.bak")]
    assert first.backup is None and kept() == []
    second = document.Session(spark, at, c.rows, "f")
    second.save(videos.where("video_key = 'none'"))
    second.save(videos)
    assert len(kept()) == 1 and spark.read.parquet(f"{at}/{kept()[0]['folder']}").count() == 2 and videos.count() == 2
    with pytest.raises(Exception, match="different input"):
        document.Session(spark, at, c.rows, "g").load()


def test_an_empty_export_has_its_columns(case, tmp_path):
    c = case(PLAIN, {})
    out = document.write_verified(c.records, c.videos, str(tmp_path / "v"))
    assert out.count() == 0 and out.columns == [*c.records.columns, "verification_status", "verification_decision_json"]
    with pytest.raises(ValueError, match="no records"):
        document.write_verified(c.records.where("false"), c.videos, str(tmp_path / "w"))
