"""Captions, mask runs, packing and archives on small cases."""

import io
import json
import tarfile
import zipfile

from pyspark.sql import functions as F

from spanweave.functions.captions import parsed
from spanweave.functions.masks import well_formed
from spanweave.operators.packets import greedy
from spanweave.sources.archives import extracted, indexed, members, stale
from spanweave.sources.metadata import expressions, first_existing
from spanweave.streaming.ledger import windowed_counts


FAULTS = [
    ("[7]a[/7]", "unknown_id"), ("[1]a [1]b[/1][/1]", "self_overlap"), ("[1]a[2]b[/1]c[/2]", "crossed"), ("a[/1]", "crossed"), ("[1][/1]a", "empty_span"), ("[1]a", "malformed"), ("[x]a", "malformed"), (" a", "malformed"),
    ("", "malformed"), (None, "malformed"), ("[1]Facing[/1] us", "verb_only"), ("[1]a [/1]b", "outer_space"), ("x[1]a[/1]", "starts_in_token"), ("[1]a[/1]x", "stops_in_token"), ("[99999999999]a[/99999999999]", "unknown_id"),
]


def test_captions(spark):
    good = "[1]Der [2]große[/2] Hund[/1] sieht [1]ihn[/1] [ an"
    rows = [(i, t) for i, (t, _) in enumerate([(good, None), *FAULTS])]
    d = spark.createDataFrame(rows, "i int, t string").select("i", parsed("t", F.array(F.lit(1), F.lit(2))).alias("p"))
    got = {r.i: r.p for r in d.collect()}
    text = "Der große Hund sieht ihn [ an"
    assert (got[0].text, got[0].error) == (text, None)
    assert [(m.id, text[m.start : m.stop]) for m in got[0].mentions] == [(2, "große"), (1, "Der große Hund"), (1, "ihn")]
    assert [(got[i + 1].text, got[i + 1].mentions, got[i + 1].error) for i in range(len(FAULTS))] == [(None, [], e) for _, e in FAULTS]


def test_well_formed(spark):
    rows = [([2, 3], [6], True), ([2, 3], [0, 6], True), ([2, 2], [1, 3, 1], False), ([2, 2], [5, -1], False), ([4], [4], False), (None, None, True), ([2, 2], None, False)]
    df = spark.createDataFrame(rows, "size array<int>, counts array<long>, want boolean")
    assert all(r["got"] == r["want"] for r in df.select("want", well_formed(df["size"], df["counts"]).alias("got")).collect())


def test_greedy_limits(spark):
    df = spark.createDataFrame([("a", i, w) for i, w in enumerate([5.0, 5.0, 1.0, 99.0, 1.0, 1.0, 1.0, 1.0])] + [("b", 0, 3.0)], "g string, i int, w double")
    got = sorted((r["g"], r["batch"], r["n"], r["weight"]) for r in greedy(df, "g", ["i"], "w", 10, 3).collect())
    assert got == [("a", 0, 2, 10.0), ("a", 1, 1, 1.0), ("a", 2, 1, 99.0), ("a", 3, 3, 3.0), ("a", 4, 1, 1.0), ("b", 0, 1, 3.0)]


def test_archive_members(spark, tmp_path):
    with tarfile.open(tmp_path / "x.tar", "w") as t:
        for name, data in (("a/1.txt", b"one"), ("b", b"")):
            i = tarfile.TarInfo(name)
            i.size = len(data)
            t.addfile(i, io.BytesIO(data))
    with zipfile.ZipFile(tmp_path / "y.zip", "w") as z:
        z.writestr("c.txt", b"three")
    rows = {r["name"]: r for r in members(spark, str(tmp_path)).collect()}
    assert {k: bytes(r["payload"]) for k, r in rows.items()} == {"a/1.txt": b"one", "b": b"", "c.txt": b"three"}
    at = rows["a/1.txt"]
    assert (tmp_path / "x.tar").read_bytes()[at["offset_data"] : at["offset_data"] + at["size"]] == b"one"


def test_ranged_reads(spark, tmp_path):
    payload = {f"d/{i}.bin": bytes([i]) * (i * 1000) for i in range(20)}
    with tarfile.open(tmp_path / "x.tar", "w") as t:
        t.addfile(_folder("d"))
        for name, data in payload.items():
            i = tarfile.TarInfo(name)
            i.size = len(data)
            t.addfile(i, io.BytesIO(data))
    with zipfile.ZipFile(tmp_path / "y.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("d/3.bin", b"z" * 5000)
    index = str(tmp_path / "index")
    indexed(spark, [str(tmp_path / "x.tar"), str(tmp_path / "y.zip")], index)
    known = spark.read.parquet(index)
    assert known.count() == 21 and not stale(spark, index)
    want = spark.createDataFrame([("d/3.bin",), ("d/19.bin",), ("none",)], "name string")
    got = {(r.archive[-5:], r.name): bytes(r.payload) for r in extracted(known, want).collect()}
    assert got == {("x.tar", "d/3.bin"): payload["d/3.bin"], ("y.zip", "d/3.bin"): b"z" * 5000, ("x.tar", "d/19.bin"): payload["d/19.bin"]}
    with open(tmp_path / "x.tar", "r+b") as f:
        f.seek(600)
        f.write(b"!")
    assert [a[-5:] for a in stale(spark, index)] == ["x.tar"]


def _folder(name):
    i = tarfile.TarInfo(name)
    i.type = tarfile.DIRTYPE
    return i


def test_metadata(spark, tmp_path):
    doc = {"videos": {"v1": {"frames": ["0", ".x", "a/.b", " 1 "], "expressions": {"0": {"exp": " a cat ", "obj_id": [1, 2]}, "1": {"exp": "  ", "obj_id": 1}, "2": {"exp": "x", "obj_id": None}}}, "v2": {"frames": [".y"], "expressions": {"0": {"exp": "b", "obj_id": 3}}}}}
    (tmp_path / "meta.json").write_text(json.dumps(doc))
    at = first_existing(spark, [str(tmp_path / "none.json"), str(tmp_path / "meta.json")], "metadata")
    got = sorted((r.video_id, r.expression_id, r.exp, r.frames, r.obj_id) for r in expressions(spark, at).collect())
    assert [g[:3] for g in got] == [("v1", "0", " a cat "), ("v1", "1", "  "), ("v1", "2", "x"), ("v2", "0", "b")]
    from spanweave.operators.campaign import units

    rows = units(expressions(spark, at).withColumn("type_id", F.lit(None).cast("int")).withColumn("anno_id", F.lit(None).cast("string")), "ref_youtube_vos", "val").collect()
    assert sorted((r.sample_id, r.text, r.frame_ids, r.target_object_ids) for r in rows) == [("refytvos__val__full_video__v1__e0", "a cat", ["0", "1"], [1, 2]), ("refytvos__val__full_video__v1__e2", "x", ["0", "1"], [])]
    import pytest

    with pytest.raises(FileNotFoundError, match="none.json"):
        first_existing(spark, [str(tmp_path / "none.json")], "metadata")


def test_stream_counts(spark, tmp_path):
    rows = [(f"2024-01-01 0{h}:10:00", k) for h, k in ((0, "a"), (0, "a"), (1, "b"), (1, "a"))]
    d = spark.createDataFrame(rows, "ts string, event_type string").select(F.to_timestamp("ts").alias("ts"), "event_type")
    d.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(d.schema).parquet(str(tmp_path / "in"))
    q = windowed_counts(stream).writeStream.format("memory").queryName("counts").outputMode("complete").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    plain = lambda df: sorted((r.start.hour, r.event_type, r.n) for r in df.collect())
    assert plain(spark.table("counts")) == plain(windowed_counts(d)) == [(0, "a", 2), (1, "a", 1), (1, "b", 1)]
