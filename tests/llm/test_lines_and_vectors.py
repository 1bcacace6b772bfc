"""Line dedup, centroid clusters and whitening against plain versions of their definitions, odd rows included."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanweave.llm import elkan, whitening
from spanweave.llm.elkan import centroid_clusters
from spanweave.llm.lines import line_keys, without_common_lines, without_lines
from spanweave.llm.whitening import whitened

RNG = np.random.default_rng(77)
CLASH = "key at gone fp keys of as count x cluster distance upper lower sums sum component w d n label".split()


def clashing(df):
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)])


def plain_lines(rows, min_docs, min_chars):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    docs = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            docs.setdefault(key(line), set()).add(i)
    common = {k for k, d in docs.items() if len(k) >= min_chars and len(d) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if key(x) not in common]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return out


LINES = ["Terms of use", "  terms of USE\t", "\x0bTERMS OF USE\r", " terms of use", "Ärger", "ärger", "", " ", "x", "\x1cx", "a b", "日本", "~" * 9]


@pytest.mark.parametrize(("min_docs", "min_chars"), [(1, 0), (2, 1), (3, 1), (10, 1), (3, 3)])
def test_lines_match_the_definition(spark, min_docs, min_chars):
    rows = [(i, "\n".join(RNG.choice(LINES, RNG.integers(1, 9)).tolist() + [f"only {i}"] * (i % 3))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "\n"), (54, "x\n" * 30_000 + "z" * 200_000), (None, "terms of use\nx"), (None, "x"), *rows[:3], (0, "x\nagain"), (None, None)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in without_common_lines(df, min_docs, min_chars).collect()]
    assert sorted(got, key=repr) == sorted(plain_lines(rows, min_docs, min_chars), key=repr)


def test_lines_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert without_common_lines(empty).collect() == []


def test_line_kernels():
    texts = pa.array(["a\nB \n\n b", None, "", "c"])[0:4]
    keys = line_keys(texts.slice(1, 3)).to_pylist()
    assert keys[0] == keys[1] == [None] and keys[2] == [hashlib.md5(b"c").digest()]
    text, n = without_lines(texts, pa.array([[3, 1], None, [0], []], pa.list_(pa.int32())))
    assert text.to_pylist() == ["a\n", "", "", "c"] and n.to_pylist() == [4, 1, 1, 1]


def plain_clusters(rows, k, rounds):
    kept = [(i, [math.floor(256 * c) for c in x]) for i, x in rows]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))[:k]
    c = [x for _, x in first]
    assigned = lambda: [min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), j) for j, y in enumerate(c)) for _, x in kept]
    for _ in range(rounds):
        a = assigned()
        for j in range(len(c)):
            own = [x for (_, x), (_, n) in zip(kept, a, strict=True) if n == j]
            c[j] = [sum(v) // len(own) for v in zip(*own, strict=True)] if own else c[j]
    a = assigned()
    sha = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c]
    return sorted([(i, j, d, sum(e for e, n in a if n == j), sum(e for e, _ in a), sha[j]) for (i, _), (d, j) in zip(kept, a, strict=True)], key=repr)


GRIDS = {"ties": lambda: (RNG.integers(-2, 3, 4) / 256).tolist(), "spread": lambda: (RNG.normal(size=4) * RNG.choice([0.1, 40])).tolist(), "large": lambda: (RNG.integers(-(2**19), 2**19, 4)).astype(float).tolist()}


@pytest.mark.parametrize("kind", sorted(GRIDS))
@pytest.mark.parametrize("k", [1, 7])
def test_clusters_match_the_definition(spark, kind, k):
    rows = [(i, GRIDS[kind]()) for i in range(150)]
    rows += [rows[0], rows[1], (2, rows[9][1]), (None, rows[3][1]), (None, rows[4][1]), (200, [0.0, -0.0, 0.5, -0.001])]
    odd = [(300, None), (301, [0.0] * 3), (302, [0.0] * 5), (303, [0.0, None, 0.0, 0.0]), (304, [float("nan")] * 4), (305, [float("inf")] * 4), (306, [])]
    df = clashing(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(3))
    got = centroid_clusters(df, k=k, width=4).drop("computed").collect()
    assert sorted(map(tuple, got), key=repr) == plain_clusters(rows, k, 5)


def test_clusters_of_few_and_none(spark):
    few = spark.createDataFrame([(1, [0.5] * 64), (1, [0.5] * 64), (2, None)], "vec_id long, embedding array<float>")
    assert [(r.cluster, r.distance, r.inertia) for r in centroid_clusters(few).collect()] == [(0, 0, 0)] * 2
    assert centroid_clusters(few.where("vec_id = 2")).collect() == [] and centroid_clusters(few.where("false")).collect() == []
    with pytest.raises(Exception, match="would not fit a long"):
        centroid_clusters(spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")).collect()


def test_bounds_skip_distances_and_hold():
    """On grouped rows most distances are skipped; bounds hold after each round, in exact terms."""
    x = (RNG.integers(0, 12, (600, 1)) * 400 + RNG.integers(-40, 40, (600, 8))).astype(np.int64)
    c, before, state, done = x[:12].copy(), None, None, []
    for _ in range(6):
        move = elkan.Move(c, before)
        a, d, u, low, n = elkan.first_pass(x, move) if before is None else elkan.next_pass(x, *state, move, False)
        every = ((x[:, None] - c) ** 2).sum(axis=2)
        assert (a == every.argmin(axis=1)).all() and (u.astype(float) >= np.sqrt(every[np.arange(600), a])).all() and (low.astype(float) <= np.sqrt(every)).all()
        assert all(e in (-1, w) for e, w in zip(d.tolist(), every[np.arange(600), a].tolist(), strict=True))
        done.append(n)
        state, before = (a, u, low), c
        c = np.array([x[a == j].sum(axis=0) // (a == j).sum() if (a == j).any() else c[j] for j in range(12)])
    assert done[0] == 7200 and done[-1] < 720


def plain_whitened(rows, components):
    kept = [(i, [math.floor(256 * c) + 0 for c in x]) for i, x in rows]
    fit = sorted({tuple(x) for _, x in kept})
    n, s = len(fit), [sum(v) for v in zip(*fit, strict=True)]
    m = np.array([[n * c - t for c, t in zip(x, s, strict=True)] for x in fit], float) / n
    v = m.T @ m / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    return n, {tuple(x): (sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True)), (np.array([n * c - t for c, t in zip(x, s, strict=True)], float) / n) @ axes / np.sqrt(e)) for _, x in kept}, e / np.trace(v)


def test_whitening_matches_the_definition(spark):
    mix = RNG.normal(size=(6, 6)) * np.array([9, 5, 3, 2, 1, 0.5])
    rows = [(i, (RNG.normal(size=6) @ mix).tolist()) for i in range(300)]
    rows += [(400 + i, rows[7][1]) for i in range(90)] + [rows[0], (None, rows[5][1]), (500, [0.0, -0.0, -0.001, 1.0, 2.0, 3.0])]
    odd = [(600, None), (601, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (602, [float("nan")] * 6), (603, [float("-inf")] * 6), (604, [])]
    df = clashing(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(4))
    got = whitened(df).collect()
    n, want, explained = plain_whitened(rows, 4)
    assert len(got) == 4 * len(rows) and {r.n for r in got} == {n} and {r.component for r in got} == {1, 2, 3, 4}
    of = {}
    for i, x in rows:
        of.setdefault(i, tuple(math.floor(256 * c) for c in x))
    signs = {}
    for r in got:
        far, w = want[of[r.vec_id]]
        assert int(r.deviation) == far and abs(r.explained - explained[r.component - 1]) < 1e-12 and r.identity_error < 1e-10
        assert abs(abs(r.whitened) - abs(w[r.component - 1])) < 1e-9
        if abs(r.whitened) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(r.whitened) == np.sign(w[r.component - 1]))
    assert all(len(x) == 1 for x in signs.values())


def test_whitening_of_few_flat_and_none(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitened(spark.createDataFrame([], schema)).collect() == []
    one = whitened(spark.createDataFrame([(1, [1.0] * 3), (2, [1.0] * 3)], schema)).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(c, 1, 0, None, 0.0, 0.0) for c in (1, 2, 3)] * 2
    flat = whitened(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)] + [(9, [7.0])], schema)).collect()
    assert [r.component for r in flat if r.vec_id == 9] == [1] and all(r.whitened is None for r in flat if r.component == 2 and r.vec_id != 9)
    assert abs(sum(r.whitened**2 for r in flat if r.component == 1 and r.vec_id != 9) / 5 - 1) < 1e-12
    wide = whitened(spark.createDataFrame([(0, [1e15]), (1, [-1e15]), (2, [0.5])], schema)).collect()
    assert {r.vec_id: int(r.deviation) for r in wide}[0] == (3 * 256 * 10**15 - 128) ** 2


def test_merging_scatters():
    x = RNG.integers(-300, 300, (1000, 5))
    parts = [whitening.scatter(p) for p in np.split(x, [1, 3, 400, 999])]
    n, s, m = parts[0]
    for p in parts[1:]:
        n, s, m = whitening.merged((n, s, m), p)
    assert n == 1000 and s == x.sum(axis=0).tolist() and np.allclose(m, (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)), rtol=1e-13)
    assert whitening.exact_sums(np.full((9, 1), 2**62, np.int64)) == [9 * 2**62]
