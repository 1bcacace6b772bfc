"""A ledger of charges as a table with versions: whoever commits a version that another has committed first fails."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .records import _fs

AMOUNT = "decimal(18,6)"
CHARGES = f"id string, amount {AMOUNT}, state string"


class Conflict(RuntimeError):
    """Another writer has committed the version first."""


class Versions:
    """A table under `path`: version n is a folder of its own, and its marker file names it. A marker is created only where
    none is, which a file system does for one writer alone; folders without a marker are nobody's."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def latest(self) -> int:
        at, fs = _fs(self.spark, f"{self.path}/_versions")
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        return max((int(n[:-5]) for n in names if n[:-5].isdigit() and n.endswith(".json")), default=0)

    def said(self, version: int) -> dict:
        at, fs = _fs(self.spark, f"{self.path}/_versions/{version:012d}.json")
        stream = fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        version = self.latest() if version is None else version
        if not version:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{self.said(version)['folder']}")

    def commit(self, table: DataFrame, after: int, **said) -> int:
        """The table as the version after the one it was made from."""
        folder = f"data-{after + 1:012d}-{uuid.uuid4().hex}"
        table.write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        at, fs = _fs(self.spark, f"{self.path}/_versions/{after + 1:012d}.json")
        try:
            out = fs.create(at, False)
        except Py4JJavaError as why:
            if "Exist" not in why.java_exception.getClass().getName():
                raise
            data, _ = _fs(self.spark, f"{self.path}/{folder}")
            fs.delete(data, True)
            raise Conflict(f"version {after + 1} of {self.path} is there already") from why
        out.write(bytearray(json.dumps({"folder": folder, **said}).encode()))
        out.close()
        return after + 1


class Ledger:
    """Charges (id, amount, state) under a limit: reserved, completed or unsubmitted. Each change reads one version and
    commits the next; with `at` it is made from that version, and fails if it is no longer the last."""

    def __init__(self, spark: SparkSession, path: str, limit: float):
        self.table, self.limit = Versions(spark, path, CHARGES), limit

    def charges(self, version: int | None = None) -> DataFrame:
        return self.table.read(version)

    def by_state(self) -> DataFrame:
        return self.charges().groupBy("state").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))

    def total(self) -> float:
        return float(self.charges().agg(F.coalesce(F.sum("amount"), F.lit(0))).first()[0])

    def reserve(self, asked: DataFrame, at: int | None = None) -> int:
        """All of `asked` (id, amount) reserved, or none: a limit that would be passed, and an id with another charge than
        the same reservation, end it. What was never submitted is reserved anew."""
        from .release import reserved

        at = self.table.latest() if at is None else at
        new = reserved(self.charges(at), asked.select("id", F.col("amount").cast(AMOUNT).alias("amount")), self.limit)
        return self.table.commit(new.select("id", F.col("amount").cast(AMOUNT), "state"), at, did="reserve")

    def _changed(self, rows: DataFrame, at: int | None, state: str, amount: Column, only: Column, did: str) -> int:
        at = self.table.latest() if at is None else at
        keys = rows.groupBy("id").agg(F.max("new").alias("new")).withColumn("hit", F.lit(True))
        j = self.charges(at).join(keys, "id", "left")
        hit = F.coalesce("hit", F.lit(False)) & only
        new = j.select("id", F.when(hit, amount).otherwise(F.col("amount")).cast(AMOUNT).alias("amount"), F.when(hit, state).otherwise(F.col("state")).alias("state"))
        return self.table.commit(new, at, did=did)

    def settle(self, paid: DataFrame, at: int | None = None) -> int:
        """What was paid for (id, amount) takes the place of what was reserved."""
        return self._changed(paid.select("id", F.col("amount").cast(AMOUNT).alias("new")), at, "completed", F.col("new"), F.lit(True), "settle")

    def release(self, refused: DataFrame, at: int | None = None) -> int:
        """Reservations of requests (id) that were refused before any work cost nothing and stay on record."""
        return self._changed(refused.select("id", F.lit(0).cast(AMOUNT).alias("new")), at, "unsubmitted", F.lit(0), F.col("state") == "reserved", "release")
