"""Packets and request bodies, label images, and where media lie."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanweave.operators import building, manifests, refine, replies
from spanweave.plans import media as plans
from spanweave.plans.media import of_one_length, png
from spanweave.sources import media, palette


def test_label_images():
    rng = np.random.default_rng(5)
    for depth in (1, 2, 4, 8):
        for shape in ((1, 1), (7, 13), (16, 8), (11, 33)):
            pixels = rng.integers(0, 2**depth, shape).astype(np.uint8)
            assert (palette.labels(png(pixels, depth)) == pixels).all()
            for label, counts in palette.runs(pixels):
                flat = np.repeat(np.arange(len(counts)) % 2 == 1, counts)
                assert (flat.reshape(shape, order="F") == (pixels == label)).all() and (counts[0] == 0) == (pixels[0, 0] == label) and all(counts[1:])
    for bad in (b"no image", png(np.zeros((2, 2), np.uint8), 8)[:40]):
        with pytest.raises(Exception):
            palette.labels(bad)


def test_targets_of_both_datasets_are_built_into_records(spark):
    pixels = np.zeros((4, 5), np.uint8)
    pixels[1:3, 2:4] = 2
    images = spark.createDataFrame([("v", "f0", png(pixels, 2)), ("v", "f1", png(np.zeros((4, 5), np.uint8), 2))], "video_id string, frame_id string, payload binary")
    found = palette.label_masks(images)
    assert [(r.video_id, r.frame_id, r.label, r.mask.size, r.mask.counts) for r in found.collect()] == [("v", "f0", 2, [4, 5], [9, 2, 2, 2, 5])]
    units = spark.createDataFrame([("a", "ref_youtube_vos", "v", [2, 3], []), ("b", "revos", "w", [], [7])], "sample_id string, dataset string, video_id string, target_object_ids array<int>, target_annotation_ids array<int>").withColumns({"frame_ids": F.array(F.lit("f0"), F.lit("f1"), F.lit("f2")), "target_source_expected": F.lit(building.EXPECTED), "negative": F.lit(False)})
    sequences = spark.createDataFrame([(7, [([1, 2], [0, 2])])], f"annotation_id int, masks {building.MASKS}")
    got = {(r.sample_id, r.place): (r.source_annotation_id, [m and m.counts for m in r.masks]) for r in palette.targets(units, found, sequences).collect()}
    assert got == {("a", 1): ("2", [[9, 2, 2, 2, 5], None, None]), ("a", 2): ("3", [None] * 3), ("b", 1): ("7", [[0, 2], None, None])}
    with pytest.raises(Exception, match="unsupported dataset: other"):
        palette.targets(units.withColumn("dataset", F.lit("other")), found, sequences).collect()


def test_places(spark, tmp_path):
    root = tmp_path / "ref"
    for at in ("meta_expressions/test/meta_expressions.json", "meta_expressions/valid/meta_expressions.json", "archives/valid.zip", "archives/test.zip", "train/JPEGImages/v/f.jpg"):
        (root / at).parent.mkdir(parents=True, exist_ok=True)
        (root / at).write_text("{}")
    test, val = (media.located(spark, str(root), "ref_youtube_vos", s) for s in ("test", "val"))
    assert test == {"metadata": f"{root}/meta_expressions/test/meta_expressions.json", "folder": str(root), "frames": f"{root}/archives/valid.zip"}
    assert val["metadata"].endswith("meta_expressions/valid/meta_expressions.json") and val["frames"].endswith("valid.zip")
    with pytest.raises(FileNotFoundError, match=r"meta_expressions_train\.json"):
        media.located(spark, str(root), "ref_youtube_vos", "train")
    (root / "meta_expressions_train.json").write_text("{}")
    assert media.located(spark, str(root), "ref_youtube_vos", "train")["frames"] == f"{root}/train/JPEGImages"
    with pytest.raises(FileNotFoundError, match="meta_expressions_valid_.json"):
        media.located(spark, str(root), "revos", "val")


@pytest.fixture(scope="module")
def records(spark):
    docs = spark.createDataFrame([(i, "a text that is long enough") for i in range(1, 25)], "doc_id long, text string")
    return refine.inspected(of_one_length(docs))


def test_bodies_and_schemas(spark, records):
    m = manifests.visual_manifests(records, "prompt").where("size(packet.tracklets) > 0")
    m = m.withColumn("images", F.transform("packet.selected_frame_indices", lambda i: F.lit("jpeg").cast("binary")))
    rows = {r.request_id: r for r in m.collect()}
    bodies = {r.request_id: json.loads(r.body) for r in manifests.request_bodies(m, "do this", "images").collect()}
    assert set(bodies) == set(rows) and rows
    for name, body in bodies.items():
        content, row = body["input"][0]["content"], rows[name]
        assert [c["type"] for c in content] == ["input_text", "input_image"] * len(row.images) + ["input_text"] and content[1]["image_url"] == "data:image/jpeg;base64,anBlZw=="
        packet = json.loads(content[-1]["text"])
        assert packet["video"] == row.video_key.split("::") and [e["sample_id"] for e in packet["expressions"]] == [e.sample_id for e in row.expressions]
        variants = body["text"]["format"]["schema"]["properties"]["results"]["items"]["anyOf"]
        for v, e in zip(variants, row.expressions, strict=True):
            assert v["properties"]["sample_id"]["enum"] == [e.sample_id] and v["additionalProperties"] is False and len(v["required"]) == 4
            caption = v["properties"]["tagged_caption"]
            if e.negative and not e.allowed_ids:
                assert caption["enum"] == ["", e.existing_text] and "pattern" not in caption
            else:
                assert caption["pattern"] == r"^(?:[^\[\]]|\[/?(?:" + "|".join(map(str, e.allowed_ids)) + r")\])*$"
    nlp = m.limit(1).withColumns({"stage": F.lit("nlp"), "retry_of": F.lit("x"), "validation_errors": F.create_map(F.lit("s"), F.lit("crossed"))})
    body = json.loads(manifests.request_bodies(nlp, "p").first().body)
    assert body["instructions"].startswith("p\nYour previous") and body["text"]["format"]["schema"]["properties"]["results"]["items"]["anyOf"][0]["properties"]["decision"]["enum"] == ["keep", "rewrite"]
    assert json.loads(body["input"][0]["content"][-1]["text"])["validation_errors"] == {"s": "crossed"}


def test_replies_to_manifests_go_back_into_records(spark, records):
    m = manifests.visual_manifests(records, "prompt")
    some = {r.request_id: r for r in m.collect() if any(e.main_ids for e in r.expressions)}
    name, row = next(iter(some.items()))
    e = next(e for e in row.expressions if e.main_ids)

    def send(asked):
        told = [{"sample_id": x.sample_id, "decision": "reject" if x.sample_id != e.sample_id else "rewrite", "tagged_caption": "" if x.sample_id != e.sample_id else " and ".join(f"[{i}]thing[/{i}]" for i in e.main_ids), "reason_codes": []} for x in row.expressions]
        body = json.dumps({"status": "completed", "output": [{"type": "message", "content": [{"type": "output_text", "text": json.dumps({"results": told})}]}]})
        return spark.createDataFrame([(name, body)], "request_id string, body string")

    results, _, _ = replies.waves(m.where(F.col("request_id") == name), records, send)
    r = {x.sample_id: x for x in results.collect()}[e.sample_id]
    back = {x.id: x.tracklet_ids[0] for x in next(x for x in row.mapping if x.sample_id == e.sample_id).entries}
    assert r.outcome == "rewrite" and r.error is None and [t.tracklet_id for t in r.tracklets] == [back[i] for i in sorted(e.main_ids)] and {g.role for g in r.groups} == {"main_referent"}


def test_frame_lists_that_differ_are_refused(spark, records):
    mixed = records.withColumn("video_id", F.lit("one"))
    with pytest.raises(Exception, match="frame lists differ in corpus::train::one"):
        manifests.visual_manifests(mixed, "prompt").collect()


def test_runs_of_a_mask_are_read_once(spark, tmp_path):
    spark.range(9).select(F.col("id").alias("doc_id")).write.parquet(f"{tmp_path}/documents.parquet")
    got = plans.palette_masks(spark, str(tmp_path))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("forall(") == 1
    assert got.count() == 81 and got.where("pixels is not null").count() > 9
