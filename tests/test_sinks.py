"""Sinks and views on small tables."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from spanweave.operators import sinks, viewer
from spanweave.operators.records import write_text
from spanweave.sources.archives import first_found
from spanweave.sources.metadata import verification_rows


def test_splits_are_all_there(spark, tmp_path):
    rows = spark.createDataFrame([(1, "train"), (2, "val")], "id long, split string")
    out = str(tmp_path / "splits")
    sinks.write_splits(rows, out, ["train", "val", "test"])
    assert {s: spark.read.schema("id long").parquet(f"{out}/split={s}").count() for s in ("train", "val", "test")} == {"train": 1, "val": 1, "test": 0}
    with pytest.raises(ValueError, match="unsafe"):
        sinks.write_splits(rows, str(tmp_path / "x"), ["../up"])
    with pytest.raises(Exception, match="unknown split val"):
        sinks.write_splits(rows, str(tmp_path / "y"), ["train"])


def test_variants(spark, tmp_path):
    rows = spark.createDataFrame([(1, "train", "complete_bcc"), (2, "train", "negative_with_context")], "sample_id long, source_split string, disposition string")
    out = str(tmp_path / "variants")
    sinks.write_variants(rows, out)
    assert [spark.read.parquet(f"{out}/{v}").count() for v in ("train_all", "train_filtered")] == [2, 1]
    for bad in (rows.union(rows), rows.withColumn("source_split", F.lit("val"))):
        with pytest.raises(ValueError, match="duplicate or non-training"):
            sinks.write_variants(bad, str(tmp_path / "other"))


def test_request_files(spark):
    rows = [(0, i, "x" * n) for i, n in enumerate((9, 9, 4, 30, 4, 4, 4))] + [(1, 100, "y")]
    got = sorted((r.file, r.place, r.request_id) for r in sinks.request_lines(spark.createDataFrame(rows, "shard int, request_id long, line string"), 20, 2).collect())
    assert got == [("0-0", 1, 0), ("0-0", 2, 1), ("0-1", 1, 2), ("0-2", 1, 3), ("0-3", 1, 4), ("0-3", 2, 5), ("0-4", 1, 6), ("1-0", 1, 100)]


def test_request_files_and_their_digests(spark, tmp_path):
    rows = [(0, i, json.dumps({"custom_id": i, "said": "é" * (i % 3)}, ensure_ascii=False)) for i in range(7)]
    lines = sinks.request_lines(spark.createDataFrame(rows, "shard int, request_id long, line string"), 10_000, 3)
    listed = sinks.write_request_files(lines, str(tmp_path / "out"))
    assert [(f["name"], f["requests"]) for f in listed] == [("0-0.jsonl", 3), ("0-1.jsonl", 3), ("0-2.jsonl", 1)] and json.loads((tmp_path / "out/requests.json").read_text()) == listed
    read = [(tmp_path / "out" / f["name"]).read_bytes() for f in listed]
    assert [hashlib.sha256(b).hexdigest() for b in read] == [f["sha256"] for f in listed] and [len(b) for b in read] == [f["bytes"] for f in listed]
    assert [json.loads(x)["custom_id"] for b in read for x in b.decode().splitlines()] == list(range(7))


def test_a_small_file_is_replaced_in_one_step(spark, tmp_path):
    for text in ("one", "two ü"):
        write_text(spark, str(tmp_path / "x.json"), text)
    assert (tmp_path / "x.json").read_text() == "two ü" and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["x.json"]


def test_mask_index_joins_without_a_shuffle(spark):
    spark.sql("DROP TABLE IF EXISTS mask_sequences")
    d = spark.range(200).select(F.col("id").alias("annotation_id"), F.array(F.lit("m")).alias("masks"))
    try:
        sinks.write_mask_index(d, "mask_sequences", 4)
        plan = spark.table("mask_sequences").groupBy("annotation_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and spark.table("mask_sequences").count() == 200
    finally:
        spark.sql("DROP TABLE IF EXISTS mask_sequences")


def test_assets_and_atlases(spark):
    d = spark.createDataFrame([(bytearray(b"a"),), (bytearray(b"a"),), (bytearray(b""),)], "payload binary")
    assert {r.name for r in sinks.named_assets(d, ".bin").collect()} == {hashlib.sha256(x).hexdigest() + ".bin" for x in (b"a", b"")}
    m = spark.createDataFrame([(0, i, [int(i % 3 == 0), 1, 0]) for i in range(30)], "frame int, id int, pixels array<int>")
    a = {r.atlas: r for r in viewer.atlases(m).collect()}
    assert a[0].ids == list(range(24)) and a[0].pixels[1:] == [2**24 - 1, 0] and a[1].ids == list(range(24, 30))
    back = viewer.atlases(m).where("atlas = 0").select(viewer.in_atlas(F.col("pixels"), F.lit(3)).alias("m")).first().m
    assert back == [True, True, False]


def test_uncertain_submissions_are_refused(spark):
    s = spark.createDataFrame([(1, 7)], "submission_id long, input_file_id long")
    batches = lambda *rows: spark.createDataFrame(list(rows), "ticket long, batch_id long, input_file_id long")
    assert viewer.recovered(s, batches((1, 5, 7), (1, 6, 8))).first().batch_id == 5
    for rows in ([(1, 6, 8)], [(1, 5, 7), (1, 6, 7)]):
        with pytest.raises(Exception, match="uncertain submission 1"):
            viewer.recovered(s, batches(*rows)).collect()


def test_sources_and_prompts(spark, tmp_path):
    row = "sample_id string, dataset string, split string, video_id string, expression_id string"
    for name, rows in (("a", [("s2", "d", "t", "v", "10")]), ("b", [("s1", "d", "t", "v", "9")]), ("c", [("s1", "d", "t", "v", "8")])):
        spark.createDataFrame(rows, row).write.parquet(str(tmp_path / name))
    at = lambda *names: [str(tmp_path / n) for n in names]
    assert [r.sample_id for r in verification_rows(spark, at("a", "b"), ["sample_id"]).collect()] == ["s2", "s1"]  # "10" before "9"
    with pytest.raises(ValueError, match="s1 repeats"):
        verification_rows(spark, at("b", "c"), ["sample_id"])
    with pytest.raises(ValueError, match="lacks"):
        verification_rows(spark, at("a"), ["text"])
    assert viewer.prompt_parts("---\na: 1\n---\n\nDo it.\n") == ("a: 1", "Do it.")
    for bad in ("no", "---\na\n---\n \n", "---\na"):
        with pytest.raises(ValueError):
            viewer.prompt_parts(bad)
    known = spark.createDataFrame([("z", "x/1.png"), ("z", "1.jpg"), ("y", "1.jpg")], "archive string, name string")
    asked = spark.createDataFrame([(1, ["1.png", "1.jpg", "x/1.png"]), (2, ["2.jpg"])], "request int, candidates array<string>")
    assert [tuple(r) for r in first_found(known, asked).collect()] == [(1, "y", "1.jpg")]
    j = spark.createDataFrame([("s", '["f"]')], "sample_id string, frame_ids_json string")
    assert viewer.decoded(j, {"frame_ids_json": "array<string>"}).first().frame_ids == ["f"]


def test_label_and_palette(spark):
    runs = F.array(*[F.struct(F.lit(a).cast("long").alias("start"), F.lit(z).cast("long").alias("stop")) for a, z in ((100, 103), (150, 151))])
    p = spark.range(1).select(viewer.label_place(runs, F.lit(50), F.lit(200)).alias("p"), viewer.palette_place(F.lit("ab"), 10).alias("c")).first()
    assert (p.p.x, p.p.y) == (2, 22) and p.c == (97 * 33 + 98) % 10
