"""Centroid clustering in exact integers, with distances skipped by Elkan's bounds."""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked, forget, kept, lean

#: Scaled components stay within this, so that a squared distance of 64 of them fits a long.
LARGEST = 1 << 27
#: Wider than the rounding of the few operations between an exact squared distance and a bound.
SLACK = 2.0**-50
STATE = "vec_id long, x array<int>, cluster int, distance long, upper float, lower array<float>, of int, sums array<decimal(38,0)>"


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of paired rows of integers."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def above(v: np.ndarray) -> np.ndarray:
    return v * (1 + SLACK)


def below(v: np.ndarray) -> np.ndarray:
    return v * (1 - SLACK)


def floats_above(v: np.ndarray) -> np.ndarray:
    return np.nextafter(v.astype(np.float32), np.float32(np.inf))


def floats_below(v: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(v.astype(np.float32), np.float32(-np.inf)), np.float32(0))


class Move:
    """Centroids of a round, how far each has moved at most, and half of what lies between them at least."""

    def __init__(self, centroids: np.ndarray, before: np.ndarray | None):
        self.c, self.first = centroids, before is None
        self.drift = np.zeros(len(centroids)) if before is None else above(np.sqrt(squared(centroids, before).astype(np.float64)))
        self.half = np.stack([below(np.sqrt(squared(centroids, np.broadcast_to(c, centroids.shape)).astype(np.float64)) / 2) for c in centroids])
        np.fill_diagonal(self.half, np.inf)


def first_pass(x: np.ndarray, move: Move) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: smaller number), its exact distance, upper and lower bounds, distances computed."""
    d = np.stack([squared(x, np.broadcast_to(c, x.shape)) for c in move.c], axis=1)
    a = d.argmin(axis=1)
    exact = d[np.arange(len(x)), a]
    root = np.sqrt(d.astype(np.float64))
    return a, exact, floats_above(above(np.sqrt(exact.astype(np.float64)))), floats_below(below(root)), d.size


def next_pass(x: np.ndarray, a: np.ndarray, upper: np.ndarray, lower: np.ndarray, move: Move, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """As first_pass, from the bounds of the round before. A centroid is skipped only where a bound says that it is
    strictly farther, so ties are computed. Where the own distance was not needed it is -1, but never if `last`."""
    u = above(upper.astype(np.float64) + move.drift[a])
    low = below(np.maximum(lower.astype(np.float64) - move.drift, 0))
    exact = np.full(len(x), -1, np.int64)
    own = np.arange(len(move.c)) == a[:, None]
    open_ = ~own & (u[:, None] >= low) & (u[:, None] >= move.half[a])
    tight = np.arange(len(x)) if last else np.flatnonzero(open_.any(axis=1))
    exact[tight] = squared(x[tight], move.c[a[tight]])
    root = np.sqrt(exact[tight].astype(np.float64))
    u[tight], low[tight, a[tight]] = above(root), below(root)
    row, to = np.nonzero(open_ & (u[:, None] >= low) & (u[:, None] >= move.half[a]))
    a, n = a.copy(), len(tight) + len(row)
    for lo in range(0, len(row), 8192):
        i, j = row[lo : lo + 8192], to[lo : lo + 8192]
        d = squared(x[i], move.c[j])
        low[i, j] = below(np.sqrt(d.astype(np.float64)))
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        best = np.flatnonzero(np.diff(i, prepend=-1))
        i, j, d = i[best], j[best], d[best]
        better = (d < exact[i]) | ((d == exact[i]) & (j < a[i]))
        i, j, d = i[better], j[better], d[better]
        a[i], exact[i], u[i] = j, d, above(np.sqrt(d.astype(np.float64)))
    return a, exact, floats_above(u), floats_below(low), n


def _matrix(column: pa.Array, dtype: type, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(-1, width)


def _pass(move: Move, last: bool):
    """Vectors with their new state, and at the end of each task a row for each centroid: number, summed distance,
    distances computed, summed components."""
    k, width = move.c.shape

    @lean
    def run(batches):
        total = np.zeros((k, 3 + width), object)
        for b in batches:
            x = _matrix(b["x"], np.int64, width)
            if x.size and max(-int(x.min()), int(x.max())) > LARGEST:
                raise ValueError(f"a component's scaled value exceeds {LARGEST}: distances would not fit a long")
            if move.first:
                a, d, u, low, n = first_pass(x, move)
            else:
                a, d, u, low, n = next_pass(x, b["cluster"].to_numpy().astype(np.int64), b["upper"].to_numpy(), _matrix(b["lower"], np.float32, k), move, last)
            total[0, 2] += n
            for c in np.unique(a):
                of = a == c
                total[c, 0] += int(of.sum())
                total[c, 1] += sum(d[of].tolist())
                total[c, 3:] += x[of].sum(axis=0).astype(object)
            cols = [b["vec_id"], b["x"], pa.array(a, pa.int32()), pa.array(d), pa.array(u), pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(a) + 1, k), pa.int32()), pa.array(low.ravel()))]
            yield pa.RecordBatch.from_arrays([*cols, pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.list_(pa.decimal128(38, 0)))], schema=SCHEMA)
        sums = pa.array([[Decimal(int(v)) for v in row] for row in total], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays([*(pa.nulls(k, f.type) for f in list(SCHEMA)[:6]), pa.array(range(k), pa.int32()), sums], schema=SCHEMA)

    return run


SCHEMA = pa.schema([("vec_id", pa.int64()), ("x", pa.list_(pa.int32())), ("cluster", pa.int32()), ("distance", pa.int64()), ("upper", pa.float32()), ("lower", pa.list_(pa.float32())), ("of", pa.int32()), ("sums", pa.list_(pa.decimal128(38, 0)))])


def _totals(state: DataFrame, k: int) -> list[list[int]]:
    """For each centroid the tasks' sums, summed: k rows of bounded width."""
    at = state.where("of is not null").select("of", F.posexplode("sums").alias("at", "v")).groupBy("of", "at").agg(F.sum("v").alias("v"))
    out: list[dict[int, int]] = [{} for _ in range(k)]
    for r in at.collect():
        out[r["of"]][r["at"]] = int(r["v"])
    return [[row[i] for i in sorted(row)] for row in out]


def centroid_clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, width: int = 64, seed: int = 2, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, computed: vectors at their nearest centroid.

    Vectors of exactly `width` components, none null or non-finite, take part; a component x counts as floor(scale * x).
    The first centroids are the k vectors with the smallest sha256 of `<seed>:<vec_id>`, fewer if there are fewer. Each
    round assigns all vectors and moves each centroid that has some to the floor of their mean; then all are assigned
    once more. Distances are squared, exact and of integers; ties go to the smaller number.

    After the first pass each vector carries an upper bound of the distance to its own centroid and a lower bound to
    each of the k, as floats rounded away from the true value, in a written table of one round. A centroid is computed
    only where no bound (the lower one, or half of what lies between the centroids) puts it strictly farther. A round is
    one pass over the table without a shuffle of vectors; tasks return k rows of sums, whose total is the only thing
    that the driver sees. `computed` counts the exact distances of the last pass.

    Vectors without an id come after all others as first centroids. Repeated rows each return a row and count each; of
    rows that share an id the one of the smaller components is the earlier centroid. No vector: no rows. A scaled
    component over 2^27 raises a ValueError, as its distances need not fit a long; sums of distances that do not fit are
    null. Other columns are ignored.
    """
    spark = vectors.sparkSession
    v = checked(vectors, vec_id=id_col, x=vector_col).select(F.col("vec_id").cast("long"), F.col("x").cast("array<double>").alias("x"))
    fine = (F.size("x") == width) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    edge = float(2 * LARGEST)
    base = kept(v.where(fine).select("vec_id", F.transform("x", lambda c: F.greatest(F.least(F.floor(c * scale), F.lit(edge)), F.lit(-edge)).cast("int")).alias("x")), "scaled_vectors")
    first = base.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "x").limit(k).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, computed long")
    now, before = np.array([r["x"] for r in first], np.int64), None
    state = base
    for turn in range(rounds + 1):
        old = state
        columns = ["vec_id", "x"] if before is None else ["vec_id", "x", "cluster", "upper", "lower"]
        rows = old.select(*columns) if before is None else old.where("of is null").select(*columns)
        state = kept(rows.mapInArrow(_pass(Move(now, before), turn == rounds), STATE), "clusters")
        forget(old)
        totals = _totals(state, len(now))
        if turn < rounds:
            before, now = now, np.array([[s // t[0] for s in t[3:]] if t[0] else c for t, c in zip(totals, now.tolist(), strict=True)], np.int64)
    inertia, computed = sum(t[1] for t in totals), sum(t[2] for t in totals)
    table = [(c, Decimal(t[1]), hashlib.sha256(",".join(map(str, now[c].tolist())).encode()).hexdigest()) for c, t in enumerate(totals)]
    known = spark.createDataFrame(table, "of_cluster int, sum decimal(38,0), centroid_sha256 string")
    out = state.where("of is null").select("vec_id", "cluster", "distance").join(F.broadcast(known), F.col("cluster") == F.col("of_cluster"))  # k rows
    return out.select("vec_id", "cluster", "distance", F.col("sum").try_cast("long").alias("cluster_inertia"), F.lit(Decimal(inertia)).cast("decimal(38,0)").try_cast("long").alias("inertia"), "centroid_sha256", F.lit(computed).cast("long").alias("computed"))
