"""Records as they arrive: kept once each however often they come, and leases on work with a state for each unit."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

#: Fixed value: a lease without a sign of life for so many seconds is anyone's.
STALE_SECONDS = 30 * 60
EVENT = "sample_id string, owner string, kind string, at timestamp"
GRANT = "sample_id string, owner string, at timestamp, kind string, granted boolean, attempts int"


def upsert(stream: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Appends each batch to the table under `path`, in a folder of the batch's number, which is replaced if the batch is
    run again, so that a restart leaves nothing twice. `once` ends when what is there now has been read."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{path.rstrip('/')}/batch={number}")

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def current(spark: SparkSession, path: str, schema, key: str = "sample_id", order: str = "seq") -> DataFrame:
    """The last row of each key: that of the greatest `order`, and of equal ones the one that came last. A map-side
    greatest, so a key that comes again and again is one row a task before it is sent."""
    rows = spark.read.schema(schema).option("basePath", path).parquet(path)
    columns = [f.name for f in rows.schema if f.name != "batch"]
    rows = rows.select(*columns, F.col("batch").cast("long").alias("_batch"))
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(order, "_batch", F.xxhash64(*columns))).alias("_r")).select("_r.*")


def compacted(spark: SparkSession, path: str, to: str, schema, key: str = "sample_id", order: str = "seq") -> None:
    """The current rows as a table of one batch, to go on from."""
    current(spark, path, schema, key, order).write.mode("error").option("compression", "zstd").parquet(f"{to.rstrip('/')}/batch=-1")


class Lease:
    """Who works on a unit, since when there was a sign of life, and how often it has been begun."""

    def __init__(self, owner: str | None = None, beat: float = 0.0, attempts: int = 0):
        self.owner, self.beat, self.attempts = owner, beat, attempts

    def heard(self, owner: str, kind: str, at: float, stale: float) -> bool:
        """Whether an event is granted. A claim is if nobody holds the unit, its holder claims it again, or the holder has
        given no sign of life for longer than `stale`; a beat or a release if it comes from the holder."""
        mine = self.owner is not None and self.owner == owner
        if kind == "claim":
            if self.owner is not None and not mine and at - self.beat <= stale:
                return False
            self.owner, self.beat, self.attempts = owner, at, self.attempts + 1
            return True
        if mine:
            self.owner, self.beat = (None if kind == "release" else owner), at
        return mine


def leases(events: DataFrame, stale_seconds: int = STALE_SECONDS) -> DataFrame:
    """Each event (sample_id, owner, kind: claim, beat or release, at) with whether it is granted, over a stream.

    A unit's state is three values and outlives its batch; a batch's events of one unit are taken in the order of their
    times, of equal times claims first, then by owner. Events that come in a later batch than their time's are taken as
    they come.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        owner, beat, attempts = state.get if state.exists else ("", 0.0, 0)
        lease = Lease(owner or None, beat, attempts)
        rows = pd.concat(list(batches)).assign(turn=lambda d: (d["kind"] != "claim").astype(int)).sort_values(["at", "turn", "owner"])
        out = []
        for r in rows.itertuples(index=False):
            ok = lease.heard(r.owner, r.kind, r.at.timestamp(), stale_seconds)
            out.append((key[0], r.owner, r.at, r.kind, ok, lease.attempts))
        state.update((lease.owner or "", lease.beat, lease.attempts))
        yield pd.DataFrame(out, columns=["sample_id", "owner", "at", "kind", "granted", "attempts"])

    return events.select("sample_id", "owner", "kind", "at").groupBy("sample_id").applyInPandasWithState(run, GRANT, "owner string, beat double, attempts int", "append", "NoTimeout")
