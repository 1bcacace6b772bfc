"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked, packed, pieces, span_hash, term_spans

BUCKETS = np.uint64((1 << 26) - 1)


def terms(texts: pa.Array):
    """For each row, its distinct hashed terms: lower-cased runs of letters and digits."""
    buf, offs = packed(texts)
    for lo, hi in pieces(offs):
        low, starts, ends, counts = term_spans(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        h = span_hash(low, starts, ends) & BUCKETS
        at = 0
        for n in counts.tolist():
            yield np.unique(h[at : at + n]).astype(np.int64)
            at += n


class FactorizationMachine:
    """w0 + sum of w_i + sum over pairs of <v_i, v_j>, over the terms that a text holds, through a logistic."""

    def __init__(self, factors: int = 6, rate: float = 4.0, sparse: float = 4.0, pair_rate: float = 0.02, decay: float = 2e-5, epochs: int = 10, support: int = 4, seed: int = 5):
        self.factors, self.rate, self.sparse, self.pair_rate, self.decay = factors, rate, sparse, pair_rate, decay
        self.epochs, self.support, self.seed = epochs, support, seed
        self.known, self.w0, self.w, self.v = np.zeros(0, np.int64), 0.0, np.zeros(1), np.zeros((1, factors))

    def index(self, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known terms, and the row of each."""
        at, row = np.concatenate([*rows, np.zeros(0, np.int64)]), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        k = np.searchsorted(self.known, at)
        ok = np.append(self.known, -1)[k] == at
        return k[ok], row[ok]

    def raw(self, k: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        sums = np.stack([np.bincount(row, self.v[k, f], n) for f in range(self.factors)], axis=1)
        own = np.bincount(row, (self.v[k] ** 2).sum(axis=1), n)
        return self.w0 + np.bincount(row, self.w[k], n) + 0.5 * ((sums**2).sum(axis=1) - own), sums

    def fit(self, rows: list[np.ndarray], y: np.ndarray) -> FactorizationMachine:
        """Logistic loss over all terms that at least `support` rows hold.

        Labels have no part in the choice of terms, so those that tell classes apart only in pairs stay, too.
        Linear weights follow the regularised leader: a weight is zero until its summed gradient exceeds
        `sparse`, which keeps the many terms without a say silent. Factors take Adagrad steps; they start the
        smaller the more terms a row has, as their pairs are summed. No rows: a constant.
        """
        rng = np.random.default_rng(self.seed)
        seen, n = np.unique(np.concatenate([*rows, np.zeros(0, np.int64)]), return_counts=True)
        self.known = seen[n >= self.support]
        many = max(2.0, float(np.mean([len(r) for r in rows]))) if rows else 2.0
        self.w, self.v = np.zeros(len(self.known)), rng.normal(0, 0.3 / np.sqrt(many), (len(self.known), self.factors))
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.w0 = float(np.log(share / (1 - share)))
        lead, gw, gv, g0 = np.zeros(self.w.shape), np.ones(self.w.shape), np.full(self.v.shape, 10.0), 1e-6
        for _ in range(self.epochs):
            order = rng.permutation(len(rows))
            for lo in range(0, len(order), 64):
                batch = order[lo : lo + 64]
                k, row = self.index([rows[i] for i in batch])
                z, sums = self.raw(k, row, len(batch))
                g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]
                at, back = np.unique(k, return_inverse=True)
                dw = np.bincount(back, g[row], len(at))
                pair = g[row, None] * (sums[row] - self.v[k])
                dv = np.stack([np.bincount(back, pair[:, f], len(at)) for f in range(self.factors)], axis=1) / 8 + 10 * self.decay * self.v[at]
                before = np.sqrt(gw[at])
                gw[at] += dw**2
                after = np.sqrt(gw[at])
                lead[at] += dw - (after - before) / self.rate * self.w[at]
                self.w[at] = -np.sign(lead[at]) * np.maximum(np.abs(lead[at]) - self.sparse, 0) / (after / self.rate + 100 * self.decay)
                gv[at] += dv**2
                self.v[at] -= self.pair_rate * dv / np.sqrt(gv[at])
                g0 += (d0 := g.sum() / 8) ** 2
                self.w0 -= 0.06 * d0 / g0**0.5
        return self

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        z, _ = self.raw(*self.index(rows), len(rows))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _termer(batches):
    """Labels and terms of whole texts; a row's terms are distinct, and hashing bounds their number."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([b["y"], pa.array(list(terms(b["text"])), pa.list_(pa.int64()))], ["y", "terms"])


def toxicity_scores(docs: DataFrame, labels: DataFrame, bound: int = 16_000, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text, learned from labels outside the held-out fold.

    A text's score is that of the set of its terms, so repeats and order within it have no part.

    Held out is crc32(id as text) mod folds = 0. The machine is fitted on the driver on at most `bound`
    labelled rows, those whose hashed ids are least; scoring is one narrow pass with the fitted terms, whose
    number the bound limits. A null label is no label; where an id has several labels, the largest counts, and
    where it has several texts, the least one is learned from.
    Null and empty texts get the score of no terms. Without labels all scores are one half; a score of one
    half counts as 1. A very long text has one set of terms like any other. Repeated rows each return a row.
    An empty table returns no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    d = checked(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    y = checked(labels, doc_id=id_col, y=label_col).where("y is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("y").cast("int")).alias("y"))
    y = y.join(d.select("doc_id").distinct(), "doc_id", "left_semi").where(~held)
    some = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = d.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
    got = rows.select("y", "text").mapInArrow(_termer, "y int, terms array<long>").toArrow()
    rows = [np.asarray(r.values, np.int64) if r.values is not None else np.zeros(0, np.int64) for r in got["terms"]]
    order = sorted(range(len(rows)), key=lambda i: (rows[i].tobytes(), got["y"][i].as_py()))  # no matter how rows arrive
    machine = FactorizationMachine().fit([rows[i] for i in order], got["y"].to_numpy()[order].astype(np.float64))
    sent = spark.sparkContext.broadcast(machine)

    def run(batches):
        for b in batches:
            scores, rows = [np.zeros(0)], []
            for r in terms(b["text"]):
                rows.append(r)
                if len(rows) == 256:
                    scores.append(sent.value.score(rows))
                    rows = []
            s = np.concatenate([*scores, sent.value.score(rows)] if rows else scores)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return d.select("doc_id", held.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
