"""Line deduplication: lines that many documents share go, and the rest is put together again by position."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked, kept, lean

#: Stripped at both ends of a line before it is compared.
BLANK = " \t\n\x0b\x0c\r"


def line_keys(texts: pa.Array, min_chars: int = 1) -> pa.ListArray:
    """For each text, 128-bit hashes of its lines' keys in order; null for a key of fewer code points."""
    lines = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    keys = pc.ascii_lower(pc.ascii_trim(lines.flatten(), characters=BLANK))
    keys = pc.if_else(pc.greater_equal(pc.utf8_length(keys), min_chars), keys, pa.scalar(None, pa.large_string()))
    hashed = [None if k is None else hashlib.md5(k.encode()).digest() for k in keys.to_pylist()]
    return pa.ListArray.from_arrays(pc.cast(lines.offsets, pa.int32()), pa.array(hashed, pa.binary()))


def without_lines(texts: pa.Array, dropped: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Texts without the lines at the given positions, and how many lines each had."""
    lines = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
    starts = lines.offsets.to_numpy()
    gone = np.zeros(len(lines.values), bool)
    gone[np.repeat(starts[:-1], pc.fill_null(pc.list_value_length(dropped), 0).to_numpy(zero_copy_only=False)) + dropped.flatten().to_numpy()] = True
    left = np.concatenate([[0], np.cumsum(~gone)])[starts]
    rest = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), lines.values.filter(pa.array(~gone)))
    return pc.binary_join(rest, pa.scalar("\n", pa.large_string())).cast(pa.string()), pa.array(np.diff(starts), pa.int64())


def without_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_lines, n_dropped: documents without the lines that at least `min_docs` documents have.

    Lines end at \\n alone. A line's key is the line without blanks at both ends, A-Z lower-cased; keys of fewer than
    `min_chars` code points count nowhere and stay. Keys are compared by 128-bit hashes. Rows that share an id are one
    document for the count, and so are all rows without an id. A key's documents are counted after a partial
    aggregation by key and document, so a line that a third of all rows has is dealt over all tasks; where common keys
    are met with their lines again, Spark splits what one key makes too large, and broadcasts the common keys only if
    their size is small. Texts are shuffled once, when their dropped positions come to them.

    A null or empty text is one empty line, and its text an empty one. A text all of whose lines go is an empty one,
    too. Long texts are whole texts. Repeated rows each return a row. Other columns are ignored. An empty table returns
    no rows.
    """
    d = checked(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("fp", F.unhex(F.md5("text")))

    @lean
    def keyed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["fp"], line_keys(b["text"], min_chars)], ["doc_id", "fp", "keys"])

    @lean
    def reassembled(batches):
        for b in batches:
            text, n = without_lines(b["text"], b["gone"])
            yield pa.RecordBatch.from_arrays([b["doc_id"], text, n, pc.fill_null(pc.list_value_length(b["gone"]).cast(pa.int64()), 0)], ["doc_id", "text", "n_lines", "n_dropped"])

    lines = kept(d.mapInArrow(keyed, "doc_id long, fp binary, keys array<binary>"), "line_keys")
    met = lines.select("doc_id", F.explode("keys").alias("key")).where("key is not null").distinct()
    common = kept(met.groupBy("key").count().where(F.col("count") >= min_docs).select("key"), "common_lines")
    found = lines.select("doc_id", "fp", F.posexplode("keys").alias("at", "key")).join(common, "key", "left_semi")
    found = found.groupBy("doc_id", "fp").agg(F.collect_set("at").alias("gone")).toDF("of", "as", "gone")
    both = d.join(found, d["doc_id"].eqNullSafe(F.col("of")) & (d["fp"] == F.col("as")), "left")
    return both.select("doc_id", "text", "gone").mapInArrow(reassembled, "doc_id long, text string, n_lines long, n_dropped long")
