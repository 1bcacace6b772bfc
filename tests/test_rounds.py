"""Rounds with a model: what a second wave asks, who commits a version, what refusals teach."""

import json

import pytest
from pyspark.sql import functions as F

from spanweave.operators import replies, sinks, submission
from spanweave.operators.ledger import Conflict, Ledger
from spanweave.plans.rounds import answered_records

MAPPING = [(1, "main_referent", "fox", [], ["t0"]), (2, "context_entity", "dog", [], ["t1"])]


def body(results, status="completed"):
    return json.dumps({"status": status, "output": [{"type": "message", "content": [{"type": "output_text", "text": json.dumps({"results": results})}]}]})


def result(sample, caption, decision="rewrite"):
    return {"sample_id": sample, "decision": decision, "tagged_caption": caption, "reason_codes": []}


class Model:
    """Answers from a list, one wave after the other, and what it was asked."""

    def __init__(self, spark, *waves):
        self.spark, self.waves, self.asked = spark, list(waves), []

    def __call__(self, packets):
        rows = packets.collect()
        self.asked.append(rows)
        said = self.waves.pop(0) if self.waves else {}
        return self.spark.createDataFrame([(r.request_id, said[m]) for r in rows for m in [r.request_id if r.request_id in said else "*"] if m in said], "request_id string, body string")


@pytest.fixture(scope="module")
def rows(spark):
    return answered_records(spark.range(4).withColumnRenamed("id", "doc_id"))


def packet(spark, samples, stage="visual", name="p", mains=(1,)):
    expressions = "array<struct<sample_id:string,existing_text:string>>"
    return spark.createDataFrame([(name, stage, [(s, list(mains), MAPPING) for s in samples], [(s, "x") for s in samples])], f"request_id string, stage string, mapping array<{replies.MAPPING}>, expressions {expressions}")


def test_a_retry_asks_for_the_invalid_alone_and_a_second_run_for_nothing(spark, rows, tmp_path):
    good = "[1]red fox[/1] and a [2]dog[/2]"
    model = Model(spark, {"p": body([result("s0", "[3]a fox[/3] runs"), result("s1", good)])}, {"*": body([result("s0", good)])})
    p = packet(spark, ["s0", "s1"])
    results, packets, responses = replies.waves(p, rows, model)
    got = {r.sample_id: r for r in results.collect()}
    assert [[len(r.mapping) for r in wave] for wave in model.asked] == [[2], [1]]
    again = model.asked[1][0]
    assert again.retry_of == "p" and [e.sample_id for e in again.expressions] == ["s0"] and again.validation_errors == {"s0": "unknown_id"}
    assert {i: (r.outcome, r.text, [t.tracklet_id for t in r.tracklets], r.disposition) for i, r in got.items()} == {i: ("rewrite", "red fox and a dog", ["t0", "t1"], "complete_bcc") for i in ("s0", "s1")}
    assert [g.group_id for g in got["s0"].groups] == ["refined-001", "refined-002"] and got["s0"].span_links[1].tracklet_ids == ["t1"]
    selected = spark.createDataFrame([("s0", "train"), ("s1", "val"), ("s2", "train"), ("s3", "test")], "sample_id string, split string")
    early = spark.createDataFrame([("s2", "reject", ["excessive_tracklets"], "heuristic")], "sample_id string, decision string, reason_codes array<string>, stage string")
    out = str(tmp_path / "out")
    summary = sinks.write_refined(selected, rows.join(selected, "sample_id"), results, early, out, 0.25)
    assert summary == {"selected": 4, "counts": {"pending": 1, "reject": 1, "rewrite": 2}, "cost_upper_usd": 0.25, "complete": False} and json.loads((tmp_path / "out/summary.json").read_text()) == summary
    assert {s: [r.text for r in spark.read.schema(rows.schema).parquet(f"{out}/split={s}").collect()] for s in ("train", "val", "test")} == {"train": ["red fox and a dog"], "val": ["red fox and a dog"], "test": []}
    assert {r.sample_id: (r.decision, r.reason_codes, r.stage) for r in spark.read.parquet(f"{out}/_audit").collect()}["s2"] == ("reject", ["excessive_tracklets"], "heuristic")
    quiet = Model(spark)
    once_more, _, _ = replies.waves(p, rows, quiet, responses)
    assert quiet.asked == [[], []] and sorted(r.sample_id for r in once_more.collect()) == ["s0", "s1"]


def test_a_grouped_reply_has_to_cover_its_packet(spark, rows):
    cases = {"short": [result("s0", "", "reject")], "twice": [result("s0", "", "reject")] * 2, "foreign": [result("s0", "", "reject"), result("s9", "", "reject")]}
    for said in cases.values():
        results, _, _ = replies.waves(packet(spark, ["s0", "s1"]), rows, Model(spark, {"p": body(said)}))
        assert {(r.sample_id, r.outcome, r.error) for r in results.collect()} == {(s, "error", replies.UNCOVERED) for s in ("s0", "s1")}


def test_a_span_of_too_many_tracks_is_a_rejection(spark, rows):
    tracks = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.struct(F.concat(F.lit("t"), i.cast("string")).alias("tracklet_id"), F.lit("p").alias("sam_prompt"), F.get("tracklets", F.lit(0))["masks"].alias("masks")))
    many = rows.where("sample_id = 's0'").withColumn("tracklets", tracks)
    mapping = [(i + 1, "x", "y", [], [f"t{i}"]) for i in range(12)]
    p = spark.createDataFrame([("p", "visual", [("s0", [1], mapping)], [("s0", "x")])], f"request_id string, stage string, mapping array<{replies.MAPPING}>, expressions array<struct<sample_id:string,existing_text:string>>")
    caption = "".join(f"[{i}]" for i in range(1, 13)) + "foxes" + "".join(f"[/{i}]" for i in range(12, 0, -1))
    results, _, _ = replies.waves(p, many, Model(spark, {"p": body([result("s0", caption)])}))
    r = results.first()
    assert (r.outcome, r.error, r.text) == ("reject", "excessive_entity_link", "red fox and dog 0")


def test_text_repair_keeps_text_candidates_and_disposition(spark, rows):
    model = Model(spark, {"p": body([result("s0", "[1]red[/1] fox and dog 0", "keep"), result("s1", "", "reject")])})
    results, _, _ = replies.waves(packet(spark, ["s0", "s1"], "nlp"), rows, model)
    got = {r.sample_id: r for r in results.collect()}
    assert (got["s0"].outcome, got["s0"].disposition, [t.tracklet_id for t in got["s0"].tracklets]) == ("keep", "as it was", ["t0"])
    assert [(g.group_id, g.identity, [s.text for s in g.text_spans]) for g in got["s0"].groups] == [("nlp-001", "fox", ["red"])]
    assert (got["s1"].outcome, got["s1"].error, len(got["s1"].tracklets)) == ("error", "not_a_repair", 2)


def test_recovery_of_what_was_never_answered(spark):
    p = packet(spark, ["s0"]).withColumn("transport_retry_of", F.lit(None).cast("string"))
    charges = spark.createDataFrame([("p", "reserved")], "id string, state string")
    none = spark.createDataFrame([], "request_id string")
    r = replies.recovered(p, charges, none)
    (one,) = r.collect()
    assert one.transport_retry_of == "p" and one.request_id != "p"
    assert replies.recovered(p.unionByName(r), charges, none).count() == 0 and replies.recovered(p, charges, spark.createDataFrame([("p",)], "request_id string")).count() == 0
    stuck = charges.union(spark.createDataFrame([(one.request_id, "reserved")], "id string, state string"))
    with pytest.raises(Exception, match="recovery has an unresolved charge"):
        replies.recovered(p.unionByName(r), stuck, none).collect()


def charges(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, amount double")


def test_one_of_two_writers_wins(spark, tmp_path):
    one, two = (Ledger(spark, str(tmp_path / "l"), 10) for _ in range(2))
    assert one.reserve(charges(spark, ("a", 1.0))) == 1
    at = one.table.latest()
    assert one.reserve(charges(spark, ("b", 2.0)), at) == 2
    with pytest.raises(Conflict):
        two.reserve(charges(spark, ("c", 3.0)), at)
    assert two.total() == 3.0 and {r.id for r in two.charges().collect()} == {"a", "b"} and {r.id for r in two.charges(1).collect()} == {"a"}
    assert len([p for p in (tmp_path / "l").iterdir() if p.name.startswith("data-")]) == 2


def test_reservations_are_all_or_none(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "l"), 1.0)
    assert ledger.total() == 0 and ledger.table.latest() == 0
    with pytest.raises(Exception, match="budget limit reached"):
        ledger.reserve(charges(spark, ("a", 0.6), ("b", 0.6)))
    assert ledger.total() == 0 and ledger.table.latest() == 0
    ledger.reserve(charges(spark, ("a", 0.6)))
    ledger.reserve(charges(spark, ("a", 0.6), ("b", 0.4)))
    with pytest.raises(Exception, match="conflicts"):
        ledger.reserve(charges(spark, ("a", 0.5)))
    ledger.release(spark.createDataFrame([("b",)], "id string"))
    ledger.settle(charges(spark, ("a", 0.1)))
    ledger.release(spark.createDataFrame([("a",)], "id string"))
    assert {(r.state, r.n, float(r.amount)) for r in ledger.by_state().collect()} == {("completed", 1, 0.1), ("unsubmitted", 1, 0.0)}
    ledger.reserve(charges(spark, ("b", 0.9)))
    assert ledger.total() == 1.0


def test_a_queue_that_takes_two_at_a_time(spark):
    """Sets are halved on refusal, sent again whole, and grow again when a set under way is over."""
    packets = spark.createDataFrame([(f"r{i}", i, 1.0, 10) for i in range(8)], "request_id string, place int, amount double, bytes int")
    none = spark.createDataFrame([], "request_id string")
    sets, sizes, capacity = [], [], submission.Capacity()
    for turn in range(6):
        held = spark.createDataFrame([(i, no) for ids, no in sets for i in ids] or [("-", True)], "request_id string, refused boolean")
        ids = [r.request_id for r in submission.next_set(submission.still_pending(packets, held, none), 99.0, capacity.ceiling).collect()]
        refused = len(ids) > 2
        sets.append((ids, refused))
        sizes.append(len(ids))
        capacity.heard({f"b{n}" for n, (_, no) in enumerate(sets) if not no}, [(f"b{turn}", len(ids), 20_000_000, False)] if refused else [], 0.0)
    assert sizes == [8, 4, 2, 2, 2, 2] and [i for ids, no in sets if not no for i in ids] == [f"r{i}" for i in range(8)]
    assert capacity.ceiling == 2 and capacity.limit_tokens == 20_000_000 and capacity.seen == {"b0", "b1"}
    capacity.active_at_refusal = {"b2"}
    assert capacity.heard({"b3"}, [], 0.0).ceiling == submission.MOST_REQUESTS
    assert capacity.heard(set(), [("x", 1, None, False)], 5.0).next_attempt == 35.0 and capacity.ceiling == 1


def test_limits_of_a_set(spark):
    packets = spark.createDataFrame([(f"r{i}", i, 1.0, 10) for i in range(5)], "request_id string, place int, amount double, bytes int")
    n = lambda *a: submission.next_set(packets, *a).count()
    assert (n(2.5), n(0.5), n(9.0, 2), n(9.0, 50_000, 29), n(9.0)) == (2, 0, 2, 2, 5)
    with pytest.raises(Exception, match="exceeds a set's bytes"):
        n(9.0, 5, 9)
