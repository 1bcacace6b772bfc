"""Numbers over a global order at real sizes, shards as files, and what extraction trims."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from spanweave.functions import language, spans
from spanweave.operators import release, requests, sinks
from spanweave.plans.nested import annotated

TOK = "struct<text:string,lemma:string,pos:string,dep:string,start:int,i:int,head:int>"
SCHEMA = f"text string, negative boolean, tokens array<{TOK}>, chunks array<struct<start:int,end:int,root:{TOK},tokens:array<{TOK}>,dep:string>>, category string"
MILLION = 1_000_000


def test_numbers_of_a_million_rows(spark):
    rows = spark.range(MILLION).select(((F.col("id") * 7919) % MILLION).alias("k"), F.lit("x" * 50).alias("pad")).repartition(7)
    got = requests.numbered(rows, "k")
    assert got.columns == ["k", "pad", "place"]
    assert got.where("place <> k").isEmpty() and got.count() == MILLION


def test_shards_of_a_million_rows(spark, tmp_path):
    rows = spark.range(MILLION).select("id", (F.col("id") % 7).alias("size"), (F.col("id") % 3).cast("string").alias("dataset")).repartition(9)
    placed = release.sharded(rows, "size", 1_000_000, ["id"])
    got = [tuple(r) for r in placed.groupBy("shard").agg(F.sum("size"), F.min("id"), F.max("id")).orderBy("shard").collect()]
    assert len(got) == 3 and all(abs(total - 1_000_000) < 7 for _, total, _, _ in got[:-1]) and [a[3] + 1 for a in got[:-1]] == [b[2] for b in got[1:]]
    out = str(tmp_path / "out")
    m = sinks.write_shards(rows, out, "size", 1_000_000, ["id"], "dataset", model="m")
    names = sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith("."))
    assert names == ["processing.json", *[f"train-{i:05d}.parquet" for i in range(3)]] and json.loads((tmp_path / "out/processing.json").read_text()) == m
    assert [f["sha256"] for f in m["files"]] == [hashlib.sha256((tmp_path / "out" / f["name"]).read_bytes()).hexdigest() for f in m["files"]]
    assert m["retained_rows"] == MILLION and m["rows_by_dataset"] == {"0": 333334, "1": 333333, "2": 333333} and m["model"] == "m"
    back = spark.read.parquet(f"{out}/train-00001.parquet")
    assert back.columns == ["id", "size", "dataset"] and [r.id for r in back.limit(3).collect()] == [got[1][2] + i for i in range(3)]
    with pytest.raises(ValueError, match="no rows"):
        sinks.write_shards(rows.where("false"), str(tmp_path / "none"), "size", 10, ["id"])
    with pytest.raises(FileExistsError):
        sinks.write_shards(rows, out, "size", 1_000_000, ["id"])


def said(spark, text, words, chunks):
    tokens, at = [], 0
    for i, (w, lem, pos, dep) in enumerate(words):
        at = text.index(w, at)
        tokens.append((w, lem, pos, dep, at, i, i))
        at += len(w)
    made = [(a, z, tokens[r], [t for t in tokens if a <= t[4] < z], tokens[r][3]) for a, z, r in chunks]
    d = spark.createDataFrame([(text, False, tokens, made, None)], SCHEMA)
    return d.select(language.extraction(*[F.col(c) for c in ("text", "negative", "tokens", "chunks", "category")]).alias("x")).first().x


def test_targets_are_trimmed_before_their_actions(spark):
    words = [("the", "the", "DET", "det"), ("man", "man", "NOUN", "nsubj"), ("running", "run", "VERB", "acl"), ("a", "a", "DET", "det"), ("dog", "dog", "NOUN", "appos")]
    x = said(spark, "the man running, a dog", words, [(0, 16, 1), (17, 22, 4)])
    assert (x.target.surface, x.target.head) == ("the man", "man") and [c.surface for c in x.contexts] == ["a dog"]
    words = [("the", "the", "DET", "det"), ("person(s", "person(s", "NOUN", "nsubj"), (")", ")", "PUNCT", "punct"), ("runs", "run", "VERB", "ROOT")]
    x = said(spark, "the person(s) runs", words, [(0, 12, 1)])
    assert (x.target.surface, x.target.head) == ("the person(s)", "person")
    words = [("seating(s", "seating(s", "VERB", "ROOT"), (")", ")", "PUNCT", "punct")]
    x = said(spark, "seating(s) designed for rest.", words, [(0, 9, 0)])
    assert (x.target.surface, x.target.start, x.target.end) == ("seating", 0, 7)


def test_heads_and_stems(spark):
    words = [("Dog", "", "NOUN", "nsubj"), ("beats", "beat", "VERB", "ROOT"), ("hers", "hers", "PRON", "dobj"), ("it", "it", "PRON", "dobj")]
    x = said(spark, "Dog beats hers it", words, [(0, 3, 0), (10, 14, 2), (15, 17, 3)])
    assert x.target.head == "dog" and [(c.surface, c.head) for c in x.contexts] == [("hers", "hers")]


def test_nearest_places_do_not_overlap(spark):
    near = lambda t, p, at: spark.range(1).select(spans.nearest(F.lit(t), F.lit(p), F.lit(at)).alias("x")).first().x
    assert [near("aaaa", "aa", at) for at in (0, 1, 2, 9)] == [0, 0, 2, 2] and near("abc", "", 0) is None and near("abc", "d", 0) is None


def test_visual_ids_begin_with_the_mains(spark):
    """A context track that is stored before the main one still has the later id."""
    r = annotated(spark.createDataFrame([(13, "a text that is long enough")], "doc_id long, text string")).drop("id")
    two = [("c", None), ("m", None)]
    mask = "array<struct<size:array<int>,counts:array<bigint>>>"
    schema = r.schema["tracklets"].dataType.elementType.simpleString()
    t = F.array(*[F.struct(F.lit(n).alias("tracklet_id"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in r.schema["tracklets"].dataType.elementType.fields[1:-1]], F.array(F.struct(F.array(F.lit(1), F.lit(4)).alias("size"), F.array(F.lit(k), F.lit(4 - k)).cast("array<bigint>").alias("counts"))).cast(mask).alias("masks")) for k, (n, _) in enumerate(two)])
    r = r.withColumn("tracklets", t.cast(f"array<{schema}>")).withColumn("frame_ids", F.array(F.lit("f0"))).withColumn("negative", F.lit(False))
    group = lambda g, role, i: F.struct(F.lit(g).alias("group_id"), F.lit(role).alias("role"), F.lit(i).alias("identity"), F.array().cast("array<struct<start:int,end:int,text:string>>").alias("text_spans"), F.array(F.lit(i)).alias("tracklet_ids"))
    r = r.withColumn("groups", F.array(group("g0", "context_entity", "c"), group("g1", "main_referent", "m")))
    from spanweave.operators import refine

    i = refine.inspected(r)
    assert i.first().kept == ["m", "c"]
    named = requests.visual_tracks(i).collect()
    assert {x.tracklet_id: x.visual_id for x in named} == {"m": 1, "c": 2}
