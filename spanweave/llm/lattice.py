"""Subword lattice likelihood: unigram piece scores weight all segmentations of every word."""

from __future__ import annotations

from math import exp, inf, log1p

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _BYTE, _powers, checked, forget, kept, mix, packed, pieces, span_hash, word_spans

#: Bytes of a block of texts; of a word from which on it is scored by itself; shuffle partitions take so many blocks.
BLOCK_BYTES, LONG, SHARE = 12 << 20, 64, 1


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray, float]:
    """Pieces as bytes (a word's start is a blank) and log weights from the vocabulary's own scores.

    Scores of this kind fall by one from piece to piece, so a score s weighs as 1 / (3 - s). Pieces that no
    lower-cased word can hold are left out; all single bytes are in, so that every word has a segmentation.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    best: dict[bytes, float] = {bytes([b]): 1e-6 for b in range(256)} | {b" ": 1e-3}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            continue
        p, w = sp.id_to_piece(i).replace("▁", " ").encode(), 1 / (3 - min(0.0, sp.get_score(i)))
        if b" " not in p[1:] and not any(65 <= c <= 90 for c in p):
            best[p] = max(best.get(p, 0), w)
    names = sorted(best)
    return names, *normal(names, np.array([best[p] for p in names]), sum(best.values()) / 4)


def normal(names: list[bytes], w: np.ndarray, stops: float) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces that begin a word, among themselves, and of the others and a word's stop."""
    head = np.array([p.startswith(b" ") for p in names])
    rest = w[~head].sum() + stops
    return np.log(w / np.where(head, w[head].sum(), rest)), float(np.log(stops / rest))


class Lattice:
    """Log-space forward and backward recursions over all segmentations of many words at once.

    Several sets of weights may be given, which share the search for pieces.
    """

    def __init__(self, names: list[bytes], *logps: np.ndarray):
        raw = np.frombuffer(b"".join(names), np.uint8)
        ends = np.cumsum([len(p) for p in names])
        self.keys = span_hash(raw, ends - [len(p) for p in names], ends)
        self.logps, self.sizes = [np.append(p, -np.inf) for p in logps], sorted({len(p) for p in names})
        self.logp = self.logps[0]
        self.tables, todo, shift = [], np.arange(len(names)), 0
        while len(todo):  # each table holds one piece a slot; the few that meet go to the next
            t = np.full(1 << 19, len(names), np.int32)
            at = ((self.keys[todo] >> np.uint64(shift)) & np.uint64(len(t) - 1)).astype(np.int64)
            t[at] = todo
            self.tables.append((shift, t))
            todo, shift = todo[t[at] != todo], shift + 19
        self.keys = np.append(self.keys, np.uint64(0))

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(h.shape, len(self.keys) - 1, np.int32)
        for shift, t in self.tables:
            at = t[((h >> np.uint64(shift)) & np.uint64(len(t) - 1)).astype(np.int64)]
            np.copyto(out, at, where=self.keys[at] == h)
        return out

    def _groups(self, words: list[bytes]):
        """Words of equal length together, as columns of bytes."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        for n in np.unique(size).tolist():
            at = order[np.searchsorted(size[order], n) : np.searchsorted(size[order], n, "right")]
            step = max(1, 4_000_000 // (n + 1) // 8)
            for lo in range(0, len(at), step):
                own = at[lo : lo + step]
                raw = np.frombuffer(b"".join(words[i] for i in own), np.uint8).reshape(len(own), n)
                full = np.concatenate([np.full((len(own), 1), 32, np.uint8), raw], axis=1)
                yield own, np.ascontiguousarray(full.T)

    def _edges(self, b: np.ndarray):
        """The bytes' prefix sums, for span ids by place: b has a row for each place and a column for each word."""
        n = len(b)
        p, inv = _powers(n + 1)
        c = np.zeros((n + 1, b.shape[1]), np.uint64)
        np.cumsum(_BYTE[b] * p[:n, None], axis=0, out=c[1:])
        return lambda s, e: self.find(mix((c[e] - c[s]) * inv[s] + np.uint64(e - s)))

    def forward(self, b: np.ndarray, span, keep: bool = False) -> tuple[list[np.ndarray], dict]:
        n = len(b)
        alphas, found = [np.full((n + 1, b.shape[1]), -np.inf) for _ in self.logps], {}
        for alpha in alphas:
            alpha[0] = 0
        for e in range(1, n + 1):
            for k in self.sizes:
                if k > e:
                    break
                ids = span(e - k, e)
                if (ids != len(self.keys) - 1).any():
                    if keep:
                        found[e - k, e] = ids
                    for alpha, logp in zip(alphas, self.logps, strict=True):
                        alpha[e] = np.logaddexp(alpha[e], alpha[e - k] + logp[ids])
        return alphas, found

    def edges(self, word: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every piece in one word, by end: about as many as the word has bytes, however long."""
        b = np.frombuffer(b" " + word, np.uint8)
        p, inv = _powers(len(b) + 1)
        c = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_BYTE[b] * p[: len(b)], out=c[1:])
        out = []
        for lo in range(1, len(b) + 1, 1 << 14):
            e = np.arange(lo, min(lo + (1 << 14), len(b) + 1))
            own = []
            for k in self.sizes:
                to = e[e >= k]
                ids = self.find(mix((c[to] - c[to - k]) * inv[to - k] + np.uint64(k)))
                hit = ids != len(self.keys) - 1
                own.append((to[hit] - k, to[hit], ids[hit]))
            s, e, ids = (np.concatenate(x) for x in zip(*own, strict=True))
            order = np.argsort(e, kind="stable")
            out.append((s[order], e[order], ids[order]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    @staticmethod
    def summed(n: int, froms: list[int], tos: list[int], w: list[float], begin: int) -> list[float]:
        """The recursion over the edges of one long word, in their order."""
        total = [-inf] * (n + 1)
        total[begin] = 0.0
        for s, e, x in zip(froms, tos, w, strict=True):
            x += total[s]
            if x == -inf:
                continue
            if (y := total[e]) < x:
                x, y = y, x
            total[e] = y + log1p(exp(x - y))
        return total

    def _long(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter((len(w) >= LONG for w in words), bool, len(words))

    def scores(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability, over all segmentations; a row for each set of weights."""
        out, long = np.empty((len(self.logps), len(words))), self._long(words)
        short = np.flatnonzero(~long)
        for own, b in self._groups([words[i] for i in short]):
            out[:, short[own]] = [alpha[-1] for alpha in self.forward(b, self._edges(b))[0]]
        for i in np.flatnonzero(long):
            s, e, ids = self.edges(words[i])
            for row, logp in zip(out, self.logps, strict=True):
                row[i] = self.summed(len(words[i]) + 1, s.tolist(), e.tolist(), logp[ids].tolist(), 0)[-1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected counts of all pieces in the words, each word counted so many times."""
        total, long = np.zeros(len(self.keys)), self._long(words)
        short = np.flatnonzero(~long)
        for own, b in self._groups([words[i] for i in short]):
            (alpha, *_), found = self.forward(b, self._edges(b), keep=True)
            beta = np.full(alpha.shape, -np.inf)
            beta[-1] = 0
            for (s, e), ids in reversed(found.items()):
                beta[s] = np.logaddexp(beta[s], beta[e] + self.logp[ids])
            for (s, e), ids in found.items():
                w = np.exp(alpha[s] + self.logp[ids] + beta[e] - alpha[-1]) * counts[short[own]]
                total += np.bincount(ids, w, len(total))
        for i in np.flatnonzero(long):
            s, e, ids = self.edges(words[i])
            n, w = len(words[i]) + 1, self.logp[ids]
            alpha = np.array(self.summed(n, s.tolist(), e.tolist(), w.tolist(), 0))
            back = np.lexsort((-e, -s))  # by start, the last first
            beta = np.array(self.summed(n, e[back].tolist(), s[back].tolist(), w[back].tolist(), n))
            total += np.bincount(ids, np.exp(alpha[s] + w + beta[e] - alpha[-1]) * counts[i], len(total))
        return total[:-1]


def _groups_of(names: list[str]):
    """Each row's place in names, or the place after them."""
    return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in names]), F.col("group")).cast("int"), F.lit(0)) if names else F.lit(0)


def _blocks(batches):
    part, size = TaskContext.get().partitionId(), 0
    for b in batches:
        _, offs = packed(b["text"])
        block = (np.int64(part) << 32) + (size + offs[:-1] - offs[0]) // BLOCK_BYTES
        size += int(offs[-1] - offs[0])
        yield pa.RecordBatch.from_arrays([pa.array(block), b["doc_id"], b["held_out"], b["group"], b["text"].fill_null("")], ["block", "doc_id", "held_out", "group", "text"])


def _block_words(groups: int):
    """Distinct words of each block, a row each, with their training counts in each group, a block at a time."""

    def run(batches):
        seen: dict[bytes, int] = {}
        parts: list[tuple[np.ndarray, int, np.ndarray]] = []
        now = None

        def said():
            by = np.zeros((groups, len(seen)), np.int32)
            for at, g, n in parts:
                by[g][at] += n
            cols = [pa.array([now] * len(seen), pa.int64()), pa.array(list(seen), pa.binary()), *map(pa.array, by)]
            return pa.RecordBatch.from_arrays(cols, ["block", "word", *[f"c{g}" for g in range(groups)]])

        for b in batches:
            buf, offs = packed(b["text"])
            blocks, group = b["block"].to_numpy(), np.where(b["held_out"].to_numpy(zero_copy_only=False), -1, b["group"].to_numpy())
            for lo, hi in pieces(offs, 4 << 20):
                for a, z in _runs(blocks, lo, hi):
                    if now != int(blocks[a]):
                        yield said()
                        seen, parts, now = {}, [], int(blocks[a])
                    part, own = buf[offs[a] : offs[z]], offs[a : z + 1] - offs[a]
                    low, starts, ends, counts = word_spans(part, own)
                    h = span_hash(low, starts, ends)
                    own_group, raw = np.repeat(group[a:z], counts), low.tobytes()
                    for g in np.unique(own_group).tolist():
                        at = np.flatnonzero(own_group == g)
                        _, first, n = np.unique(h[at], return_index=True, return_counts=True)
                        spans = zip(starts[at[first]].tolist(), ends[at[first]].tolist(), strict=True)
                        row = np.fromiter((seen.setdefault(raw[s:e], len(seen)) for s, e in spans), np.int64, len(first))
                        if g >= 0:
                            parts.append((row, g, n))
        yield said()

    return run


def _runs(blocks: np.ndarray, lo: int, hi: int):
    cut = [lo, *(np.flatnonzero(np.diff(blocks[lo:hi])) + 1 + lo).tolist(), hi]
    return zip(cut, cut[1:], strict=False)


def _gathered(batches, rows: int):
    """Batches joined to about so many rows, so that words of equal length are many."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _expecter(names: list[bytes], logp: np.ndarray):
    def run(batches):
        model = Lattice(names, logp)
        total = np.zeros(len(names))
        for b in _gathered(batches, 60_000):
            total += model.expected(b["word"].to_pylist(), np.ones(b.num_rows))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], ["piece", "n"])

    return run


def _word_scorer(names: list[bytes], logp: np.ndarray, given: np.ndarray):
    """Each word's log probability over all segmentations, by learned weights and by the vocabulary's own; equal
    words come one after another and are scored once."""

    def run(batches):
        model = Lattice(names, logp, given)
        for b in _gathered(batches, 120_000):
            words = b["word"].chunk(0)
            new = np.ones(len(words), bool)
            new[1:] = pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)
            some, of = words.filter(pa.array(new)).to_pylist(), np.cumsum(new) - 1
            size = np.fromiter(map(len, some), np.int64, len(some))
            ends = np.cumsum(size)
            h = span_hash(np.frombuffer(b"".join(some), np.uint8), ends - size, ends).view(np.int64)
            learned, own = model.scores(some)
            rest = [n for n in b.column_names if n.startswith("c")]
            cols = [b["block"].chunk(0), pa.array(h[of]), pa.array(learned.astype(np.float32)[of]), pa.array(own.astype(np.float32)[of]), *(b[n].chunk(0) for n in rest)]
            yield from _parts(pa.RecordBatch.from_arrays(cols, ["block", "h", "pieces", "vocab", *rest]))

    return run


def _parts(batch: pa.RecordBatch, rows: int = 50_000):
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def _scorer(stops: tuple[float, float], off: float, docs: np.ndarray, sizes: np.ndarray, kinds: np.ndarray, v: int, whole_words: bool):
    """stops: log probability that a word stops, learned and by the vocabulary; sizes, kinds, docs: tokens, distinct
    words and texts in training, by group."""
    n, ends, smooth = int(sizes.sum()), int(docs.sum()), 0.1
    total, groups = n + smooth * (v + 1), len(docs)
    prior = np.log((docs + 1) / (ends + groups))
    last = np.log((ends - off * (ends > 0) + 1) / (n + 2)) if whole_words else np.log((ends + 1) / (n + 2))
    sub = np.log((off * v + 1) / (n + 2)) if whole_words else np.log1p(-np.exp(last))

    def by_group(whole: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Log10 of each token's probability in each group, from its log probability overall and its counts."""
        if not whole_words:
            return np.repeat(whole[:, None] / np.log(10), groups, axis=1)
        with np.errstate(divide="ignore"):
            own = np.log(np.maximum(c - off, 0) / (sizes + 1))
        rest = np.log((off * (kinds + (docs > 0)) + 1) / (sizes + 1))
        return np.logaddexp(own, rest + whole[:, None]) / np.log(10)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        by = np.stack([right[f"c{g}"].to_numpy() for g in range(groups)], axis=1).astype(np.int64)
        c = by.sum(axis=1)
        with np.errstate(divide="ignore"):
            met = np.log(np.maximum(c - off, 0) / (n + 2)) if whole_words else np.full(len(c), -np.inf)
        whole = np.logaddexp(met, sub + stops[0] + right["pieces"].to_numpy().astype(np.float64))
        vocab = (np.log1p(-np.exp(last)) + stops[1] + right["vocab"].to_numpy().astype(np.float64)) / np.log(10)
        own = np.column_stack([by_group(whole, by), vocab, np.log10((c + smooth) / total), c > 0])
        h = right["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        h, own = h[order], own[order]
        buf, offs = packed(left["text"])
        sums, met = np.zeros((left.num_rows, groups + 3)), np.zeros(left.num_rows, np.int64)
        for lo, hi in pieces(offs):
            low, first, stop, counts = word_spans(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
            at, row = np.searchsorted(h, span_hash(low, first, stop)), np.repeat(np.arange(lo, hi), counts)
            met[lo:hi] = counts
            for k in range(groups + 3):
                sums[lo:hi, k] = np.bincount(row - lo, own[at, k], hi - lo)
        end = by_group(np.array([last]), docs[None, :])[0]
        sums += np.concatenate([end, [last / np.log(10), np.log10((ends + smooth) / total), ends > 0]])
        score = np.logaddexp.reduce(prior + sums[:, :groups] * np.log(10), axis=1) / np.log(10)
        return pa.table({"doc_id": left["doc_id"], "held_out": left["held_out"], "n_tokens": pa.array(met + 1), "n_known": pa.array(np.rint(sums[:, -1]).astype(np.int64)), "train_tokens": pa.array(np.full(len(met), n, np.int64)), "base_score": pa.array(sums[:, -2]), "score": pa.array(score), "vocab_score": pa.array(sums[:, -3])})

    return run


def lattice_scores(docs: DataFrame, path: str, folds: int = 10, turns: int = 2, prior: float = 1_000.0, whole_words: bool = True, groups: int = 16, group_col: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, vocab_score (log10) of every whole text.

    Words are lower-cased (A-Z) runs without blanks, and each text ends with an end token. A word's
    probability is the sum over all its segmentations, by forward recursion in log space. The lattice's
    edges are the vocabulary's pieces. vocab_score weighs them by the vocabulary's own scores alone. For score
    these are the prior of `prior` pseudo-counts to `turns` rounds of expectation and maximisation over all
    distinct training words; and, with whole_words, one more edge leads from a word's start to its end if
    training met it: whole words weigh as their counts less an absolute discount, and the discounts are the
    pieces' share, so the words' and the end's probabilities sum to one. With group_col, the most frequent
    `groups` values of it in training and the rest as one each add such counts of their own, discounted in
    favour of the above, and a text's probability is the mixture over the groups, its own value unused.
    base_score is a smoothed unigram over whole words.

    Held out is crc32(id as text) mod folds = 0; all else trains. Texts are cut into blocks of 12 MB. The
    distinct words of each block travel once to their word's partition, where they are counted over the
    corpus and scored, each once; back to the blocks go hashes and numbers, log probabilities in single precision. Only piece totals (as many as the
    vocabulary has) reach the driver. A text longer than a block is one by itself, and a word of any length is
    scored in time and memory that follow its length. Null and empty texts hold only the end token. Repeated
    rows each count and return a row. Groups of equal frequency are taken in order of their values. An empty
    table returns no rows. Other columns are ignored.
    """
    d = checked(docs, doc_id=id_col, text=text_col, **({"group": group_col} if group_col else {}))
    d = d.select(F.col("doc_id").cast("long"), F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"), (F.col("group").cast("string") if group_col else F.lit(None).cast("string")).alias("group"))
    often = [r["group"] for r in d.where("not held_out and `group` is not null").groupBy("group").count().orderBy(F.desc("count"), "group").limit(groups).collect()] if group_col else []
    d = d.withColumn("group", _groups_of(often))
    texts = kept(d.mapInArrow(_blocks, "block long, doc_id long, held_out boolean, `group` int, text string"), "texts")
    each = [f"c{g}" for g in range(len(often) + 1)]
    own = texts.mapInArrow(_block_words(len(each)), f"block long, word binary, {', '.join(c + ' int' for c in each)}")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-texts.select("block").distinct().count() // SHARE))
    all_of, first = Window.partitionBy("word"), F.row_number().over(Window.partitionBy("word").orderBy("block")) == 1
    counts = own.repartition(parts, "word").select("block", "word", *[F.sum(c).over(all_of).alias(c) for c in each], first.alias("first"))
    counts = kept(counts, "counts", release=True)
    types = counts.where("first").withColumn("n", sum(map(F.col, each)))
    held = {r["group"]: r["count"] for r in texts.where("not held_out").groupBy("group").count().collect()}
    docs_in = np.array([held.get(g, 0) for g in range(len(each))], np.int64)
    got = types.agg(*[F.sum(c).alias(c) for c in each], *[F.count_if(F.col(c) > 0).alias("v" + c) for c in [*each, "n"]], F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2")).first()
    sizes, kinds = np.array([got[c] or 0 for c in each], np.int64) + docs_in, np.array([got["v" + c] for c in each])
    v = got["vn"] + bool(docs_in.sum())
    off = (got["n1"] + 1) / (got["n1"] + 2 * got["n2"] + 2)
    names, given, own_stop = vocabulary(path)
    logp, stop = given, own_stop
    for _ in range(turns if got["vn"] else 0):
        rows = types.where("n > 0").select("word").mapInArrow(_expecter(names, logp), "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        total = prior * np.exp(given)
        for r in rows:
            total[r["piece"]] += r["n"]
        logp, stop = normal(names, total, got["vn"])
    scored = counts.drop("first").mapInArrow(_word_scorer(names, logp, given), f"block long, h long, pieces float, vocab float, {', '.join(c + ' long' for c in each)}")
    run = _scorer((float(stop), float(own_stop)), off, docs_in, sizes, kinds, v, whole_words)
    ready = kept(texts.repartition(parts, "block").groupBy("block").cogroup(scored.repartition(parts, "block").groupBy("block")).applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, vocab_score double"), "scores", release=True)
    forget(texts, counts)
    return ready
