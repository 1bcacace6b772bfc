"""Whitening of vectors: scatters of partitions merged by Chan's formula, principal components, a second pass as proof."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked, kept, lean

Scatter = tuple[int, list[int | float], np.ndarray]


def exact_sums(x: np.ndarray) -> list[int | float]:
    """Column sums, exact for integers of any size."""
    if x.dtype == np.int64 and x.size and max(-int(x.min()), int(x.max())) >= 2**62 // len(x):
        return x.astype(object).sum(axis=0).tolist()
    return x.sum(axis=0).tolist()


def scatter(x: np.ndarray) -> Scatter:
    """Count, sums and scatter about the own mean."""
    sums = exact_sums(x)
    y = x - np.array([s / len(x) for s in sums])
    return len(x), sums, y.T @ y


def merged(a: Scatter, b: Scatter) -> Scatter:
    """Chan's pairwise merge: both scatters, and that of the two means."""
    n = a[0] + b[0]
    gap = np.array([t / b[0] - s / a[0] for s, t in zip(a[1], b[1], strict=True)])
    return n, [s + t for s, t in zip(a[1], b[1], strict=True)], a[2] + b[2] + np.outer(gap, gap) * (a[0] / n * b[0])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def total_scatter(rows: DataFrame, width: int, of: Callable[[np.ndarray], np.ndarray] = lambda x: x, blocks: int = 4096) -> Scatter:
    """Scatter of all rows' x, or of what `of` makes of them: one for each partition, merged in a tree."""

    @lean
    def run(batches):
        own = None
        for b in batches:
            for lo in range(0, b.num_rows, blocks):
                part = scatter(of(_matrix(b["x"].slice(lo, blocks), width)))
                own = part if own is None else merged(own, part)
        if own is not None:
            whole = [isinstance(s, int) for s in own[1]]
            sums = [str(s) if w else repr(s) for s, w in zip(own[1], whole, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([own[0]]), pa.array([sums]), pa.array([own[2].tobytes()], pa.binary())], ["n", "sums", "scatter"])

    def read(r) -> Scatter:
        return r["n"], [int(s) if s.lstrip("-").isdigit() else float(s) for s in r["sums"]], np.frombuffer(bytes(r["scatter"])).reshape(len(r["sums"]), -1)

    return rows.mapInArrow(run, "n long, sums array<string>, scatter binary").rdd.map(read).treeReduce(merged, 3)


class Whitener:
    """Leading unit eigenvectors of a covariance by falling eigenvalue; the largest entry of each is positive."""

    def __init__(self, fit: Scatter, components: int):
        self.n, self.sums = fit[0], fit[1]
        self.mean = np.array([s / self.n for s in self.sums])
        v = fit[2] / self.n
        values, vectors = np.linalg.eigh((v + v.T) / 2)
        order = np.argsort(-values, kind="stable")[:components]
        self.e, self.axes = np.maximum(values[order], 0), vectors[:, order]
        self.axes = self.axes * np.where(self.axes[np.abs(self.axes).argmax(axis=0), range(len(order))] < 0, -1, 1)
        trace = float(np.trace(v))
        self.explained = self.e / trace if trace > 0 else np.zeros(len(self.e))
        #: A spread within the rounding of the largest one is none.
        self.spread = self.e > len(v) * np.finfo(float).eps * max(float(values.max()), 0)
        self.identity_error = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections over the root of their spread; NaN along axes without any."""
        y = (x - self.mean) @ self.axes
        return np.divide(y, np.sqrt(self.e), out=np.full(y.shape, np.nan), where=self.spread[None, :])

    def deviations(self, x: np.ndarray) -> list[int]:
        """Exact sums of (n * x - S)^2."""
        if x.size and self.n * max(-int(x.min()), int(x.max())) + max(abs(s) for s in self.sums) < 2**52:
            y = self.n * x - np.array(self.sums, np.int64)
            high, low = y >> 26, y & (2**26 - 1)
            parts = ((high * high).sum(axis=1), (high * low).sum(axis=1), (low * low).sum(axis=1))
            return [(a << 52) + (b << 27) + c for a, b, c in zip(*(p.tolist() for p in parts), strict=True)]
        return ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1).tolist()


def whitened(vectors: DataFrame, components: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: each vector's leading whitened components.

    A component c of a vector counts as x = floor(scale * c); vectors that are null or hold null or non-finite entries
    return no row. Each distinct x counts once in the fit: its partitions make count, sums and a scatter about their own
    mean, which Chan's formula merges pairwise in a tree, so that the driver gets one matrix. Eigenvectors come from the
    driver, numbered from 1 by falling eigenvalue. A second pass over the fit list merges the whitened values' scatters
    the same way; `identity_error` is the largest entry of their covariance minus the identity.

    `deviation` is the sum of (n * x - S)^2, exact, a decimal of 38 digits; null if it needs more. An axis along which
    nothing spreads (one distinct vector, or fewer than axes) has a null `whitened` and adds nothing to the error.
    Vectors of each length are fitted on their own; those without entries return no row. Repeated rows and vectors each
    return theirs. An entry beyond what scales to a long counts as the largest long. Other columns are ignored. An empty
    table returns no rows.
    """
    spark = vectors.sparkSession
    v = checked(vectors, vec_id=id_col, x=vector_col).select(F.col("vec_id").cast("long"), F.col("x").cast("array<double>").alias("x"))
    fine = (F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = v.where(fine).select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("x"))
    fit = kept(rows.select("x").distinct(), "fit_vectors")
    out = spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    for r in fit.groupBy(F.size("x").alias("d")).count().orderBy("d").collect():
        width = r["d"]
        same = fit.where(F.size("x") == width)
        model = Whitener(total_scatter(same, width), components)
        known = Whitener.whitened(model, np.zeros((0, width))).shape[1]
        if model.spread.any():
            good = np.flatnonzero(model.spread)
            _, _, m = total_scatter(same, width, lambda x, model=model, good=good: model.whitened(x)[:, good])
            model.identity_error = float(np.abs(m / model.n - np.eye(len(good))).max())

        @lean
        def run(batches, model=model, width=width, known=known):
            for b in batches:
                x = _matrix(b["x"], width)
                far = pa.array([Decimal(d) if d < 10**38 else None for d in model.deviations(x)], pa.decimal128(38, 0))
                values = pa.array(model.whitened(x).ravel(), from_pandas=True)  # NaN becomes null
                yield pa.RecordBatch.from_arrays([b["vec_id"], far, pa.ListArray.from_arrays(pa.array(np.arange(0, known * len(x) + 1, known), pa.int32()), values)], ["vec_id", "deviation", "w"])

        done = rows.where(F.size("x") == width).mapInArrow(run, "vec_id long, deviation decimal(38,0), w array<double>").select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
        share = F.element_at(F.array(*[F.lit(float(e)) for e in model.explained]), F.col("at") + 1)
        out = out.union(done.select("vec_id", F.col("at") + 1, F.lit(model.n).cast("long"), "deviation", "whitened", share, F.lit(model.identity_error)))
    return out
