"""Helpers shared by the training-data operators: word kernels, materialisation and connected components."""

from __future__ import annotations

import ctypes
import functools
import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_GAP = np.zeros(256, dtype=bool)
_GAP[[32, *range(9, 14)]] = True
_MARK = np.ones(256, dtype=bool)
_MARK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_RNG = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64, endpoint=False) | np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INV = np.uint64(pow(int(_ODD), -1, 2**64))
_STEP = _RNG.integers(0, 2**64, 64, dtype=np.uint64, endpoint=False) | np.uint64(1)
_power = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_power[0]) < n:
        for k, base in enumerate((_ODD, _ODD_INV)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _power[k] = np.multiply.accumulate(p)
    return _power[0], _power[1]


def packed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string array, without a copy; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offs


def pieces(offs: np.ndarray, size: int = 1 << 20):
    """Ranges of rows of about `size` bytes each; one longer row is a range of its own."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_spans(buf: np.ndarray, offs: np.ndarray, gap: np.ndarray = _GAP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts, ends and per-row word counts; offs starts at 0 of buf."""
    low = _LOW[buf]
    tok = np.zeros(len(buf) + 1, bool)
    np.logical_not(gap[buf], out=tok[:-1])
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    start = tok.copy()
    start[1:] &= ~tok[:-1] | edge[1:]
    starts = np.flatnonzero(start)
    stop = tok[:-1] & (~tok[1:] | edge[1:])
    ends = np.flatnonzero(stop) + 1
    return low, starts, ends, np.diff(np.searchsorted(starts, offs))


def term_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As word_spans, for runs of ASCII letters, digits and all bytes beyond ASCII."""
    return word_spans(buf, offs, _MARK)


def span_hash(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes."""
    p, inv = _powers(len(low) + 1)
    c = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(_BYTE[low] * p[: len(low)], out=c[1:])
    return mix((c[ends] - c[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def shingled(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one row, in order; with fewer words, of the whole sequence."""
    if len(h) == 0:
        return h
    k = min(k, len(h))
    s = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        s += h[i : len(h) - k + 1 + i] * _STEP[i]
    return mix(s + np.uint64(k))


def row_words(texts: pa.Array):
    """For each row: (row, word hashes), over whole texts."""
    buf, offs = packed(texts)
    for lo, hi in pieces(offs):
        own = offs[lo : hi + 1] - offs[lo]
        part = buf[offs[lo] : offs[hi]]
        low, starts, ends, counts = word_spans(part, own)
        h = span_hash(low, starts, ends)
        at = 0
        for i, n in zip(range(lo, hi), counts.tolist(), strict=True):
            yield i, h[at : at + n]
            at += n


def lowered(col: Column | str) -> Column:
    """Lower case for A-Z only."""
    return F.translate(col, UPPER, LOWER)


def checked(df: DataFrame, **need: str) -> DataFrame:
    """The needed columns under these names and nothing else, so that other columns can't clash.

    Where the session has no limit of its own, batches for Python hold 4 MB at most, so that memory follows
    the longest text and not the number of rows.
    """
    if df.sparkSession.conf.get(BATCH_BYTES, None) in (None, "-1", "67108864", "64MB", "64m"):
        df.sparkSession.conf.set(BATCH_BYTES, str(4 << 20))
    return df.select(*[df[src].alias(name) for name, src in need.items()])


def lean(run):
    """A function for mapInArrow that returns its free memory to the machine at the end of each task.

    Workers outlive their tasks; what they keep adds up over the steps of a long job.
    """

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def give_back() -> None:
    """Returns this process's free memory to the machine."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc alone
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share: spark.checkpoint.dir. Where it is unset, one machine's own folder serves
    a local session; a cluster has to name one, for its machines could not read each other's."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: tables between steps need a folder that all machines share")
        at = tempfile.gettempdir() + f"/spanweave-{os.getpid()}"
    return at.rstrip("/")


def kept(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """A written copy in the shared folder: cuts lineage and survives the loss of executors.

    Spark drops the shuffle files of finished steps when the driver collects its garbage; `release` asks
    for that at once, after steps that shuffle much.
    """
    at = f"{shared_dir(df.sparkSession)}/spanweave/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    if release:
        df.sparkSession.sparkContext._jvm.System.gc()
    out = df.sparkSession.read.schema(df.schema).parquet(at)
    out.written_at = at
    return out


def forget(*tables: DataFrame) -> None:
    """Removes tables made by kept() that nothing needs any more, not even the next step's retries."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fields(spec: str) -> T.StructType:
    """The schema that a DDL string names."""
    return T.StructType.fromDDL(spec)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): the least id that each linked id reaches, from edges (a, b) of longs.

    Alternates large and small stars on written edge tables until the edges are stars around their least
    ids. A hub's edges are reduced by a map-side minimum and joined back, never gathered, so a large
    component needs no task of its own. Self links and repeated edges are harmless; ids without links are
    not returned. No edges: no rows.
    """
    e = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for _ in range(rounds):
        both = e.union(e.select("v", "u")).toDF("u", "v")
        least = kept(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        near = kept(both.join(least, "u"), "near")
        if near.where("(v < u and m <> v) or (v > u and m <> u)").isEmpty():
            forget(near, least)
            break
        large = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = kept(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low)
        done, e = (e, least, near, low), kept(small.where("u <> v").distinct(), "edges")
        forget(*done)
    else:
        raise RuntimeError("components did not settle")
    top = e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return top.union(top.select(F.col("component").alias("id"), "component").distinct())
