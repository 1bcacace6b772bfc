"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked, components, kept, lean, mix, row_words, shingled

SPACE = 1 << 20
_RNG = np.random.Generator(np.random.PCG64(77))
FIRST = _RNG.permutation(SPACE).astype(np.int64)
SECOND = _RNG.permutation(SPACE).astype(np.uint32)


def rows_of(coords: int) -> np.ndarray:
    """For each place of SECOND, the `coords` values from there on, circularly, as a view."""
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([SECOND, SECOND[:coords]]), coords)


def circulant(shingles: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Signature of a set of 64-bit shingle hashes: coordinate k is the least SECOND[(FIRST[x] + k) mod SPACE].

    Two permutations give all coordinates: FIRST breaks up the layout, and SECOND is shifted circularly,
    once for each coordinate, so that the coordinates of one element lie side by side in memory.
    """
    at = FIRST[(shingles & np.uint64(SPACE - 1)).astype(np.int64)]
    out = np.full(rows.shape[1], 0xFFFFFFFF, np.uint32)
    for i in range(0, len(at), 256):
        np.minimum(out, rows[at[i : i + 256]].min(axis=0), out=out)
    return out


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    return np.unique(shingled(words, width))


def set_prints(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit prints of a set, equal for equal sets."""
    if not len(s):
        return 0, 0
    return int(np.uint64(s.sum()).view(np.int64)), int(np.bitwise_xor.reduce(mix(s + np.uint64(len(s)))).view(np.int64))


def _signer(width: int, bands: int, rows: int):
    @lean
    def run(batches):
        view = rows_of(bands * rows)
        weight = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        seen: dict[tuple, np.ndarray] = {}
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for _, words in row_words(b["text"]):
                s = shingle_set(words, width)
                x = (len(s), *set_prints(s))
                if len(s) and x not in seen:
                    sig = circulant(s, view)
                    band = mix((sig.reshape(bands, rows).astype(np.uint64) * weight).sum(axis=1) + np.arange(bands, dtype=np.uint64) * weight[0])
                    if len(seen) > 4_000:
                        seen.clear()
                    seen[x] = band.view(np.int64)
                for col, v in zip(out, (*x, seen[x] if len(s) else []), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([b["doc_id"], *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.list_(pa.int64()))], ["doc_id", "n_shingles", "fp1", "fp2", "bands"])

    return run


def _setter(width: int):
    """The set of each text, if it is the one that the row's prints name."""

    @lean
    def run(batches):
        for b in batches:
            want = zip(*(b[c].to_pylist() for c in ("n_shingles", "fp1", "fp2")), strict=True)
            out: tuple[list, ...] = ([], [], [])
            for (_, words), x, node, rep in zip(row_words(b["text"]), want, b["node"].to_pylist(), b["rep"].to_pylist(), strict=True):
                s = shingle_set(words, width)
                if (len(s), *set_prints(s)) == x:
                    for col, v in zip(out, (node, rep, s.tobytes()), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["doc_id", "rep", "items"])

    return run


@lean
def _lister(batches):
    for b in batches:
        ids = b["doc_id"].to_pylist()
        for lo in range(0, len(ids), 64):
            sets = [np.frombuffer(x, np.int64) for x in b["items"][lo : lo + 64].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(ids[lo : lo + 64], np.int64), [len(s) for s in sets])), pa.array(np.concatenate(sets))], ["doc_id", "item"])


def _verifier(percent: int):
    @lean
    def run(batches):
        for b in batches:
            last, left, out = None, None, []
            for x, y in zip(b["x"], b["y"], strict=True):
                if (x := x.as_py()) != last:
                    last, left = x, np.frombuffer(x, np.uint64)
                right = np.frombuffer(y.as_py(), np.uint64)
                both = np.concatenate([left, right])
                both.sort(kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                out.append(100 * same >= percent * (len(left) + len(right) - same))
            yield b.select(["a", "b"]).filter(pa.array(out, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, bands: int = 48, rows: int = 8, rare: int = 32) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: documents linked where 100 * shared >= percent * union of shingles.

    Equal shingle sets first become one class each. Class representatives get a circulant signature of
    bands * rows coordinates; at 0.85 and 48 bands of 8 a linked pair shares no band with chance 2e-7, at
    0.8 with chance 1e-4. Every bucket elects its most central member (fewest shingles that no other
    candidate has), and all members are compared with it, on full sets. Where a bucket then still holds
    several components, its members are compared across components, too, but for those that cannot link:
    a document of n shingles, u of them its own alone, shares n - u at most. That goes by rounds: in each, some
    members of a bucket are compared with all of its other components and leave it, until one component is
    left. So no link between bucket mates is lost that would join components, and no bucket is expanded
    into its pairs.

    Null or empty texts, or texts without words: n_shingles 0, linked with nothing. A very long text has one
    signature and one set like any other. Repeated rows each return a row; rows that share an id but not their
    text are one document, linked by each of its texts. Ties go to the smaller id. Null ids return with
    component_id null. Other columns are ignored. An empty table returns no rows.
    """
    d = checked(docs, doc_id=id_col, text=text_col)
    d = d.select(F.col("doc_id").cast("long"), "text")
    sig = kept(d.mapInArrow(_signer(width, bands, rows), "doc_id long, n_shingles long, fp1 long, fp2 long, bands array<long>"), "signatures")
    print_of = ["n_shingles", "fp1", "fp2"]
    classes = sig.where("n_shingles > 0 and doc_id is not null").groupBy(*print_of).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    # a class goes by its least id; where classes share that, as ids repeat, by a hash of their sets
    shared = classes.groupBy("rep").agg(F.count("*").alias("c")).where("c > 1").select("rep", F.lit(True).alias("again"))
    classes = kept(classes, "class_sets")
    classes = kept(classes.join(shared, "rep", "left").withColumn("node", F.when(F.col("again"), F.xxhash64(*print_of)).otherwise(F.col("rep"))).drop("again"), "classes")
    member = classes.select(F.col("node").alias("b"), "rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    full = kept(member.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "buckets")
    member = kept(member.join(full, "key"), "members")
    nodes = classes.join(member.select(F.col("b").alias("node")).distinct(), "node", "left_semi").select("node", "rep", *print_of)
    made = d.join(nodes.withColumn("doc_id", F.col("rep")), "doc_id").select("node", "rep", *print_of, "text").mapInArrow(_setter(width), "doc_id long, rep long, items binary")
    sets = kept(made.dropDuplicates(["doc_id"]), "sets")
    alone = sets.select("doc_id", "items").mapInArrow(_lister, "doc_id long, item long").groupBy("item").agg(F.count("*").alias("c"), F.min("doc_id").alias("b")).where("c = 1")
    own = kept(alone.groupBy("b").agg(F.count("*").alias("u")), "own")
    # what a document shares with another is n - u at most, and at least percent of the larger set
    member = member.join(own, "b", "left").select("key", "b", "rep", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("most"))
    member = kept(member.where(f"100 * most >= {percent} * n"), "able")
    head = kept(member.groupBy("key").agg(F.max(F.struct((F.col("most") / F.col("n")).alias("r"), (-F.col("b")).alias("i"))).alias("h"), F.count("*").alias("c")).where("c > 1").select("key", (-F.col("h.i")).alias("a")), "heads")
    star = member.join(head, "key").where("a <> b").select("a", "b").distinct()
    one = kept(sig.drop("bands").join(classes.select(*print_of, "rep"), print_of, "left").select("doc_id", "n_shingles", "rep"), "ids")
    many = one.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").select("doc_id")
    same = one.where("rep is not null").join(many, "doc_id", "left_semi").select("doc_id", "rep").distinct()
    links = kept(_verify(star, sets, percent).union(same), "links")
    comp = kept(components(links), "components")
    rest = _unsettled(kept(_placed(member, comp), "at"), percent)
    turn = 0
    while not rest.isEmpty():
        if turn == 1:  # by now few are left: what they share is known more closely by their rare shingles
            by_rare, rest = _narrowed(rest, sets, percent, rare)
        heads = rest.groupBy("key", F.pmod(F.xxhash64("b"), F.lit(min(MOST, 4**turn * CENTRES) if turn else 1)).alias("s")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("a"), F.col("g").alias("ga"))).alias("h"))
        heads = kept(heads.select("key", "h.a", "h.ga"), "heads")
        pairs = rest.join(heads, "key").where("g <> ga").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if turn == 1:
            pairs = pairs.union(by_rare).distinct()
        more = kept(_verify(pairs, sets, percent), "links")
        if not more.isEmpty():
            comp = kept(components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more)), "components")
        rest = rest.join(heads.select("key", F.col("a").alias("b")), ["key", "b"], "left_anti")  # they have met all others
        rest = _unsettled(kept(_placed(rest, comp), "at"), percent)
        turn += 1
    one = one.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    cid = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return one.select("doc_id", "n_shingles", cid.alias("component_id"), (F.col("doc_id") == cid).alias("kept"))


#: Members of a bucket that are compared with the rest of it: four times these in the second round, four times as many in
#: each after it, and no more than MOST in one.
CENTRES, MOST = 16, 1024


def _placed(member: DataFrame, comp: DataFrame) -> DataFrame:
    """Bucket members with the component of each now."""
    own = member.select("key", "b", "rep", "n", "most").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    return own.select("key", "b", "rep", "n", "most", F.coalesce("component", "rep").alias("g"))


def _unsettled(at: DataFrame, percent: int) -> DataFrame:
    """Members of buckets that hold several components, but for those too far from all bucket mates.

    |y| <= most * (1 + 100 / percent) - |x| holds for any partner y of x.
    """
    mixed = kept(at.groupBy("key").agg(F.min("g").alias("g1"), F.max("g").alias("g2"), F.min("n").alias("least")).where("g1 < g2").select("key", "least"), "mixed")
    rest = kept(at.join(mixed, "key").where(f"least * {percent} <= most * {100 + percent} - n * {percent}").drop("least"), "rest")
    still = kept(rest.groupBy("key").agg(F.min("g").alias("g1"), F.max("g").alias("g2")).where("g1 < g2").select("key"), "still")
    return kept(rest.join(still, "key"), "rest")


def _narrowed(rest: DataFrame, sets: DataFrame, percent: int, rare: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): members of different components that can still link must do one of two things.

    They share a shingle that at most `rare` of these documents have: found by that shingle, at most
    rare^2 / 2 pairs for each. Or all they share are common shingles, so that their numbers of common
    shingles bound the overlap: members whose bound reaches the percentage stay.
    """
    ids = rest.select(F.col("b").alias("doc_id"), "g").distinct()
    items = kept(sets.select("doc_id", "items").join(ids.select("doc_id").distinct(), "doc_id", "left_semi").mapInArrow(_lister, "doc_id long, item long"), "items")
    counts = kept(items.groupBy("item").agg(F.count("*").alias("c")).where("c > 1"), "counts")
    found = kept(items.join(counts, "item").join(ids, "doc_id"), "found")
    common = found.where(F.col("c") > rare).groupBy(F.col("doc_id").alias("b")).agg(F.count("*").alias("most"))
    few = found.where(F.col("c") <= rare).select("item", "doc_id", "g")
    other = few.select("item", F.col("doc_id").alias("a"), F.col("g").alias("ga"))
    by_rare = few.join(other, "item").where("ga < g").select(F.least("a", "doc_id").alias("a"), F.greatest("a", "doc_id").alias("b"))
    left = _unsettled(kept(rest.drop("most").join(common, "b").select("key", "b", "rep", "n", "most", "g"), "at"), percent)
    return by_rare, left


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets reach the percentage, by their least ids; a hub's pairs are split by
    the skewed join."""
    pairs = kept(pairs, "pairs")
    y = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("rep").alias("rb"), F.col("items").alias("y")), "b")
    both = y.join(sets.select(F.col("doc_id").alias("a"), F.col("rep").alias("ra"), F.col("items").alias("x")), "a")
    return both.select(F.col("ra").alias("a"), F.col("rb").alias("b"), "x", "y").mapInArrow(_verifier(percent), "a long, b long")
