"""Records and leases as they arrive in files, and rows by their place in the source."""

import pytest
from pyspark.sql import functions as F

from spanweave.sources import discovery, located
from spanweave.streaming import arrivals

ROW = "sample_id string, seq int, text string"


def test_the_same_file_twice_leaves_one_row(spark, tmp_path):
    src, table, mark = (str(tmp_path / n) for n in ("src", "table", "mark"))
    put = lambda rows: spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(src)
    put([("a", 1, "old"), ("b", 1, "b")])
    stream = spark.readStream.schema(ROW).parquet(src)
    arrivals.upsert(stream, table, mark, once=True).awaitTermination()
    put([("a", 1, "old"), ("b", 1, "b")])
    put([("a", 3, "new"), ("a", 2, "middle"), (None, 1, None)])
    arrivals.upsert(stream, table, mark, once=True).awaitTermination()
    arrivals.upsert(stream, table, mark, once=True).awaitTermination()
    got = lambda at: sorted([tuple(r) for r in arrivals.current(spark, at, ROW).collect()], key=repr)
    assert got(table) == [("a", 3, "new"), ("b", 1, "b"), (None, 1, None)]
    arrivals.compacted(spark, table, str(tmp_path / "small"), ROW)
    assert got(str(tmp_path / "small")) == got(table) and spark.read.parquet(str(tmp_path / "small")).count() == 3
    # a batch that is run again takes the place of what it wrote before
    spark.createDataFrame([("b", 2, "again")], ROW).write.mode("overwrite").parquet(f"{table}/batch=0")
    spark.createDataFrame([("b", 2, "again")], ROW).write.mode("overwrite").parquet(f"{table}/batch=0")
    assert ("b", 2, "again") in got(table)


def test_leases(spark, tmp_path):
    (tmp_path / "src").mkdir()
    src = str(tmp_path / "src")
    stream = arrivals.leases(spark.readStream.schema(arrivals.EVENT).parquet(src))
    put = lambda *rows: spark.createDataFrame([(s, o, k, t) for s, o, k, t in rows], "sample_id string, owner string, kind string, at string").select("sample_id", "owner", "kind", F.to_timestamp("at").alias("at")).coalesce(1).write.mode("append").parquet(src)
    run = lambda: arrivals.upsert(stream, str(tmp_path / "t"), str(tmp_path / "c"), once=True).awaitTermination()
    put(("x", "w1", "claim", "2024-01-01 00:00:00"), ("x", "w2", "claim", "2024-01-01 00:10:00"), ("x", "w1", "beat", "2024-01-01 00:20:00"), ("y", "w2", "release", "2024-01-01 00:00:00"))
    run()
    put(("x", "w2", "claim", "2024-01-01 00:50:00"), ("x", "w2", "claim", "2024-01-01 00:50:01"), ("x", "w1", "beat", "2024-01-01 00:51:00"), ("x", "w2", "release", "2024-01-01 00:52:00"), ("x", "w3", "claim", "2024-01-01 00:52:01"))
    run()
    got = {(r.sample_id, r.owner, r.kind, str(r.at)[11:]): (r.granted, r.attempts) for r in spark.read.schema(arrivals.GRANT).parquet(str(tmp_path / "t")).collect()}
    assert got == {
        ("x", "w1", "claim", "00:00:00"): (True, 1), ("x", "w2", "claim", "00:10:00"): (False, 1), ("x", "w1", "beat", "00:20:00"): (True, 1), ("y", "w2", "release", "00:00:00"): (False, 0),
        ("x", "w2", "claim", "00:50:00"): (False, 1), ("x", "w2", "claim", "00:50:01"): (True, 2), ("x", "w1", "beat", "00:51:00"): (False, 2), ("x", "w2", "release", "00:52:00"): (True, 2), ("x", "w3", "claim", "00:52:01"): (True, 3),
    }


def test_rows_by_place(spark, tmp_path):
    at = str(tmp_path / "t")
    spark.range(100).select(F.col("id").alias("k"), F.repeat(F.lit("wide "), 50).alias("w")).repartition(3, "k").write.parquet(at)
    narrow = located.places(spark, at, "k")
    scan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:bigint" in scan and "w:string" not in scan
    chosen = narrow.where("k % 10 = 3")
    rows = located.in_source_order(located.fetched(spark, at, chosen, "k", "w")).collect()
    whole = [r.k for r in located.in_source_order(located.places(spark, at, "k")).collect()]
    assert [r.k for r in rows] == [k for k in whole if k % 10 == 3] and all(len(r.w) == 250 for r in rows)
    located.snapshot(spark, at, chosen, "k", str(tmp_path / "s"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "s")).collect()) == list(range(3, 100, 10))
    spark.createDataFrame([(3, "w")], "k long, w string").write.mode("append").parquet(at)
    with pytest.raises(ValueError, match="k 3 lies in the source more than once"):
        located.snapshot(spark, at, chosen, "k", str(tmp_path / "n"))


def test_inputs(spark, tmp_path):
    put = lambda at, *ids: spark.createDataFrame([(i, "t") for i in ids], "sample_id string, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / at))
    put("plain/b.parquet", "b")
    put("plain/a.parquet", "a")
    put("release/train/verification.parquet", "a")
    put("release/eval/verified/verification.parquet", "a")
    put("release/x.parquet", "x")
    find = lambda at: [p.removeprefix(f"{tmp_path}/") for p in discovery.inputs(spark, str(tmp_path / at))]
    assert find("plain") == ["plain/a.parquet", "plain/b.parquet"] and find("plain/b.parquet") == ["plain/b.parquet"] and find("release") == ["release/train/verification.parquet"]
    for bad in ("none", "plain/c.parquet"):
        with pytest.raises(ValueError):
            find(bad)
    at = [str(tmp_path / p) for p in find("plain")]
    rows = discovery.indexed(spark, at, ["sample_id"], ["text"])
    assert rows.columns == ["sample_id", *located.PLACE] and [r.sample_id for r in located.in_source_order(rows).collect()] == ["a", "b"]
    with pytest.raises(ValueError, match="sample_id a repeats"):
        discovery.indexed(spark, [at[0], at[0]], ["sample_id"], ["text"])
    with pytest.raises(ValueError, match="missing columns"):
        discovery.indexed(spark, at, ["sample_id"], ["label"])
    spark.range(1).write.parquet(str(tmp_path / "odd.parquet"))
    with pytest.raises(ValueError, match="are not those of"):
        discovery.indexed(spark, [at[0], str(tmp_path / "odd.parquet")], ["sample_id"], ["text"])
