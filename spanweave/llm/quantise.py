"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, table look-up, exact rerank."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked, components, kept

SUBSPACES, CODES = 8, 64
#: Classes that a list holds on average; stored classes of a list that one task holds.
FILL, SHARD = 64, 4096


def k_means(x: np.ndarray, k: int, turns: int = 8, seed: int = 11) -> np.ndarray:
    """k centres (fewer if there are fewer distinct rows) by Lloyd's rounds from random rows."""
    rng = np.random.default_rng(seed)
    rows = np.unique(x, axis=0)
    c = rows[rng.permutation(len(rows))[:k]].copy()
    for _ in range(turns):
        near = nearest(x, c)
        n = np.bincount(near, minlength=len(c))
        for j in range(x.shape[1]):
            c[:, j] = np.where(n > 0, np.bincount(near, x[:, j], len(c)) / np.maximum(n, 1), c[:, j])
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances but for |x|^2."""
    return (c**2).sum(axis=1) - 2 * (x @ c.T)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.int64)
    for lo in range(0, len(x), 4096):
        out[lo : lo + 4096] = distances(x[lo : lo + 4096], c).argmin(axis=1)
    return out


def level_sizes(total: int, most: int) -> list[int]:
    """Centres of each level, `most` at most, so that the lists, their product, are one for every FILL classes."""
    need, out = max(1, total // FILL), []
    while need > 1 or not out:
        out.append(min(need, most))
        need = -(-need // out[-1]) if out[-1] > 1 else 1
    return out


class Index:
    """Coarse centres of unit vectors, then of what they leave, level by level; and a codebook of the last residuals for
    each subspace. A list is one path through the levels."""

    def __init__(self, sample: np.ndarray, sizes: list[int]):
        self.levels, rest = [], sample
        for k in sizes:
            self.levels.append(k_means(rest, k))
            rest = rest - self.levels[-1][nearest(rest, self.levels[-1])]
        self.gaps = [np.sqrt(np.maximum(distances(c, c) + (c**2).sum(axis=1)[:, None], 0)) for c in self.levels]
        self.cut = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        self.books = [k_means(rest[:, a:z], CODES) for a, z in zip(self.cut, self.cut[1:], strict=False)]

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's list and what its centres leave of it."""
        at, rest = np.zeros(len(x), np.int64), x
        for c in self.levels:
            n = nearest(rest, c)
            at, rest = at * len(c) + n, rest - c[n]
        return at, rest

    def codes(self, rest: np.ndarray) -> np.ndarray:
        return np.stack([nearest(rest[:, a:z], b) for (a, z), b in zip(zip(self.cut, self.cut[1:], strict=False), self.books, strict=True)], axis=1).astype(np.uint8)

    def probes(self, x: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, list): at each level the nearest centre, and all whose border lies within the margin; a vector moved
        so far towards any of them would lie there."""
        row, at, rest = np.arange(len(x)), np.zeros(len(x), np.int64), x
        for c, gap in zip(self.levels, self.gaps, strict=True):
            d = distances(rest, c)
            best = d.argmin(axis=1)
            i, j = np.nonzero((d - d[np.arange(len(d)), best][:, None]) <= 2 * margin * gap[best])
            row, at, rest = row[i], at[i] * len(c) + j, rest[i] - c[j]
        return row, at

    def table(self, q: np.ndarray, at: int) -> np.ndarray:
        """For each query, subspace and code, the squared distance from the query's residual to the code."""
        rest = q
        for c in reversed(self.levels):
            at, k = divmod(at, len(c))
            rest = rest - c[k]
        out = np.zeros((len(q), len(self.books), CODES))
        for s, b in enumerate(self.books):
            part = rest[:, self.cut[s] : self.cut[s + 1]]
            out[:, s, : len(b)] = distances(part, b) + (part**2).sum(axis=1)[:, None]
        return out


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same ids as the pairs do, one fewer than the ids of each joined set: its least to each other."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent, u, v = np.arange(len(ids)), ends[: len(a)], ends[len(a) :]
    while len(u):
        lo, hi = np.minimum(parent[u], parent[v]), np.maximum(parent[u], parent[v])
        np.minimum.at(parent, hi, lo)
        while (up := parent[parent]).tolist() != parent.tolist():
            parent = up
        more = parent[u] != parent[v]
        u, v = u[more], v[more]
    other = np.flatnonzero(parent != np.arange(len(ids)))
    return ids[parent[other]], ids[other]


def _unit(batch: pa.RecordBatch) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in batch["x"].to_pylist()]) if batch.num_rows else np.zeros((0, 1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _homes(index):
    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                yield pa.RecordBatch.from_arrays([part["label"], pa.array(index.value.home(_unit(part))[0])], ["label", "list"])

    return run


def _lister(index, margin: float):
    """Each class stored in its list, and asking in every list that it probes."""

    def run(batches):
        own = index.value
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                x = _unit(part)
                home, rest = own.home(x)
                codes = own.codes(rest)
                row, to = own.probes(x, margin)
                at = np.concatenate([np.arange(len(x)), row])
                asks = np.arange(len(at)) >= len(x)
                code = [c.tobytes() for c in codes]
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([part["label"].take(take), pa.array(np.concatenate([home, to])), pa.array(asks), part["rep"].take(take), part["n"].take(take), pa.array([None if q else code[i] for i, q in zip(at, asks, strict=True)], pa.binary()), part["x"].take(take)], ["label", "list", "asks", "rep", "n", "code", "x"])

    return run


def _searcher(index, cosine: float, slack: float):
    """(a, b, links): of each query a how many vectors it found in a list's shard; and pairs a, b, with no count, that
    join what the found pairs join, so that their number follows the rows and not the pairs.

    Rows come sorted by (label, list, shard), stored vectors before queries; each shard is searched when its
    queries come, block by block.
    """

    def run(batches):
        own = index.value
        key, held = None, []
        limit = 2 - 2 * cosine
        for b in batches:
            label, lists, shard, asks, rep = b["label"].to_pylist(), b["list"].to_pylist(), b["shard"].to_pylist(), b["asks"].to_pylist(), b["rep"].to_numpy()
            x, n = _unit(b), b["n"].to_numpy()
            found: list[tuple[np.ndarray, np.ndarray]] = []
            asked, links = [], []
            kinds = list(zip(label, lists, shard, asks, strict=True))
            cut = [0, *[i for i in range(1, len(kinds)) if kinds[i] != kinds[i - 1]], len(kinds)]
            for a, z in zip(cut, cut[1:], strict=False):
                if a == z:
                    continue
                if kinds[a][:3] != key:
                    key, held = kinds[a][:3], []
                if not kinds[a][3]:
                    codes = np.frombuffer(b"".join(b["code"].slice(a, z - a).to_pylist()), np.uint8).reshape(z - a, -1)
                    held.append((rep[a:z], x[a:z], n[a:z], codes))
                    continue
                if not held:
                    continue
                store, vectors, copies, codes = held[0] if len(held) == 1 else (np.concatenate(c) for c in zip(*held, strict=True))
                held = [(store, vectors, copies, codes)]
                for lo in range(a, z, 256):
                    q, ids = x[lo : min(z, lo + 256)], rep[lo : min(z, lo + 256)]
                    table, total = own.table(q, key[1]), np.zeros(len(ids), np.int64)
                    for s in range(0, len(store), 4096):
                        near = sum(table[:, k, codes[s : s + 4096, k]] for k in range(table.shape[1]))
                        i, j = np.nonzero((near <= limit + slack) & (store[None, s : s + 4096] != ids[:, None]))
                        ok = np.einsum("ij,ij->i", q[i], vectors[s + j]) >= cosine
                        i, j = i[ok], s + j[ok]
                        found.append(forest(ids[i], store[j]))
                        total += np.bincount(i, copies[j], len(ids)).astype(np.int64)
                    asked.append(ids[total > 0])
                    links.append(total[total > 0])
            one, two = forest(*(np.concatenate([x[k] for x in found] or [rep[:0]]) for k in (0, 1)))
            asked, links = (np.concatenate(x or [rep[:0]]) for x in (asked, links))
            ends = pa.concat_arrays([pa.nulls(len(asked), pa.int64()), pa.array(two)])
            counts = pa.concat_arrays([pa.array(links), pa.nulls(len(two), pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([asked, one])), ends, counts], ["a", "b", "links"])

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.98, sample: int = 20_000, branch: int = 2048, margin: float = 0.08, slack: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: vectors of one label linked from this cosine on, in double precision.

    Equal vectors of a label are one class, so copies never meet as pairs. Coarse centres, `branch` at most a
    level and as many levels as make a list for every 64 classes, and residual codebooks are fitted on a
    documented sample, the `sample` classes whose hashed ids are least; every class is indexed. A query
    searches its own list and all whose border lies within `margin`: a partner at the limit differs by
    sqrt(2 - 2 * cosine) in all, of which one direction of 64 holds an eighth on average, and margin is three
    times that. Table look-ups keep what lies within the limit plus `slack`, and what they keep is confirmed
    by exact cosine. A list of more than 4096 stored classes is dealt over several tasks, each of which gets
    all its queries; tasks return counts and a spanning set of links, never all pairs.

    A partner is counted where a query finds it in its list. A null label, a null, empty or zero vector, or one
    with a null or non-finite component links with nothing. Each length of vectors has an index of its own;
    below 64 components the margin grows, as fewer directions share the difference. Repeated rows each return a
    row and link with each other; ties go to the smaller id. An empty table returns no rows; other columns are
    ignored.
    """
    spark = vectors.sparkSession
    v = checked(vectors, vec_id=id_col, x=vector_col, label=label_col)
    kind = "float" if v.schema["x"].dataType.simpleString() == "array<float>" else "double"
    v = v.select(F.col("vec_id").cast("long"), F.col("x").cast(f"array<{kind}>").alias("x"), F.col("label").cast("string"))
    fine = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists("x", lambda c: c != 0), F.lit(False))
    good = v.where(fine).withColumn("fp", F.sha2(F.array_join(F.transform("x", lambda c: (c + 0.0).cast("string")), ","), 256))
    classes = kept(good.groupBy("label", "fp").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("x").alias("x")), "vector_classes")
    found = spark.createDataFrame([], "a long, b long, links long")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for d, total in classes.groupBy(F.size("x").alias("d")).count().where("count > 1").orderBy(F.desc("count"), "d").collect():
        same = classes.where(F.size("x") == d)
        x = np.array(same.orderBy(F.xxhash64("rep"), "rep").limit(sample).select("x").toArrow()["x"].to_pylist(), np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        index = spark.sparkContext.broadcast(Index(x, level_sizes(total, max(1, min(branch, len(x) // 4)))))
        wide = max(margin, min(margin * np.sqrt(64 / d), np.sqrt(2 - 2 * cosine)))
        cells = same.select("label", "rep", "n", "x").mapInArrow(_lister(index, wide), f"label string, list long, asks boolean, rep long, n long, code binary, x array<{kind}>")
        large = same.select("label", "x").mapInArrow(_homes(index), "label string, list long").groupBy("label", "list").agg(F.ceil(F.count("*") / SHARD).alias("shards")).where("shards > 1")
        cells = cells.join(kept(large, "large_lists"), ["label", "list"], "left").withColumn("shards", F.coalesce("shards", F.lit(1)))
        to = F.when(F.col("asks"), F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).otherwise(F.array(F.pmod(F.xxhash64("rep"), F.col("shards"))))
        cells = cells.select("label", "list", F.explode(to).alias("shard"), "asks", "rep", "n", "code", "x")
        near = cells.repartition(max(least, total // 50_000), "label", "list", "shard").sortWithinPartitions("label", "list", "shard", "asks").mapInArrow(_searcher(index, cosine, slack), "a long, b long, links long")
        found = found.union(kept(near, "vector_links"))
    more = found.where("links is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("more"))
    comp = components(found.where("links is null").select("a", "b")).select(F.col("id").alias("rep"), "component")
    known = kept(classes.select("label", "fp", "rep", "n").join(more, "rep", "left").join(comp, "rep", "left"), "vector_known")
    out = good.select("vec_id", "label", "fp").join(known, ["label", "fp"])
    out = out.select("vec_id", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).cast("long").alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = out.union(v.where(~fine).select("vec_id", F.lit(0).cast("long"), "vec_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
