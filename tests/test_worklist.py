"""A campaign's units, counted and written."""

import json

import pytest
from pyspark.sql import functions as F

from spanweave.operators import worklist
from spanweave.plans.worklists import _said, _units


@pytest.fixture(scope="module")
def units(spark):
    said = _said(spark.createDataFrame([(i, "red ring") for i in range(12)], "p_partkey long, p_name string"))
    parts = [_units(said, "revos", "val", "i % 2 = 0"), _units(said, "ref_youtube_vos", "train", "i % 2 = 1")]
    none = spark.createDataFrame([], f"sample_id string, tokens {said.schema['tokens'].dataType.simpleString()}, chunks {said.schema['chunks'].dataType.simpleString()}")
    return worklist.campaign_units(parts, none)


def test_counts_and_files(spark, units, tmp_path):
    counts = {"ref_youtube_vos::train::full_video": 6, "revos::val::explicit": 2, "revos::val::implicit": 2, "revos::val::nonexistent": 2}
    videos = {"ref_youtube_vos::train": 2, "revos::val": 2}
    with pytest.raises(ValueError, match="instructions are not those of the release"):
        worklist.write_worklist(units, str(tmp_path / "bad"), "c", worklist.COUNTS["train"], worklist.VIDEOS["train"])
    assert not (tmp_path / "bad").exists()
    out = tmp_path / "out"
    value = worklist.write_worklist(units, str(out), "c", counts, videos, seed=3)
    assert value == json.loads((out / "worklist.json").read_text()) and (value["counts"], value["video_counts"], value["units"], value["seed"]) == (counts, videos, 12, 3)
    rows = spark.read.parquet(f"{out}/units.parquet").orderBy(*worklist.KEY).collect()
    assert [r.extraction.target and r.extraction.target.surface for r in rows] == [None if r.negative else r.text for r in rows] and all(set(worklist.PLACES) <= set(r.asDict()) for r in rows)
    text = (out / "extraction-audit.md").read_text()
    assert text.startswith("# Extraction audit: c\n") and text.count("\n## ") == 12 and text.count("intentionally absent") == 2
    many = units.withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(99)))).drop("n")
    worklist.write_worklist(many, str(tmp_path / "many"), "m")
    text = (tmp_path / "many/extraction-audit.md").read_text()
    assert "1,200 instructions" in text and "- revos::val::explicit: 200" in text and "\n## revos__" not in text
