"""Language of each word, and of whole texts, by a linear-chain conditional random field."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BYTE, WORD, checked, give_back, lean, mix, packed, pieces, span_hash, word_spans

SPACE = 1 << 18
BLOCK_BYTES = 3 << 19


def word_features(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each word and the first place of each word's own: n-grams, affixes and lexicon entries.

    N-grams of 1 to 4 bytes lie in the word and its two borders; the one to four first and last bytes are
    features of their own kind, and so is the whole word if the lexicon has it (else, that it has it not).
    """
    size = ends - starts
    total = int(size.sum()) + 2 * len(size)
    first = np.cumsum(size + 2) - size - 2
    b = np.full(total, 32, np.uint8)
    inner = np.ones(total, bool)
    inner[first] = inner[first + size + 1] = False
    at = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    b[inner] = raw[at]
    word = np.repeat(np.arange(len(size)), size + 2)
    left = np.repeat(first + size + 2, size + 2) - np.arange(total)  # bytes from here to the word's end
    out, of = [], []
    h = np.zeros(total, np.uint64)
    for n in range(1, 5):
        h = h[: total - n + 1] * np.uint64(0x100000001B3) + _BYTE[b[n - 1 :]]
        ok = left[: len(h)] >= n
        if n == 1:
            ok = ok & inner
        out.append(mix(h[ok] + np.uint64(n)))
        of.append(word[: len(h)][ok])
        whole = np.flatnonzero(size + 1 >= n)
        for kind, place in ((11, first[whole]), (23, first[whole] + size[whole] + 2 - n)):
            out.append(mix(h[place] + np.uint64(n * 64 + kind)))
            of.append(whole)
    own = span_hash(raw, starts, ends)
    has = lexicon[np.minimum(np.searchsorted(lexicon, own), len(lexicon) - 1)] == own if len(lexicon) else np.zeros(len(own), bool)
    out.append(np.where(has, mix(own + np.uint64(7)), np.uint64(99)))
    of.append(np.arange(len(size)))
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    f = (np.concatenate(out)[order] & np.uint64(SPACE - 1)).astype(np.int64)
    return f, np.searchsorted(of[order], np.arange(len(size)))


class ChainCRF:
    """Hashed word features and transitions between labels; labels are marginals by forward-backward."""

    def __init__(self, labels: list[str], lexicon: np.ndarray):
        self.labels, self.lexicon = labels, lexicon
        self.w = np.zeros((SPACE, len(labels)), np.float32)
        self.trans = np.zeros((len(labels), len(labels)))

    def emissions(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty((len(starts), len(self.labels)), np.float32)
        for lo in range(0, len(starts), 20_000):
            f, at = word_features(raw, starts[lo : lo + 20_000], ends[lo : lo + 20_000], self.lexicon)
            out[lo : lo + 20_000] = np.add.reduceat(self.w[f], at, axis=0)
        return out

    def chain(self, e: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward messages of many sequences at once, emission and transition potentials.

        e holds time step after time step, and in each the active[t] longest sequences, in one order; each
        message is scaled to sum to one.
        """
        begin = np.concatenate([[0], np.cumsum(active)])
        psi = np.exp(e - e.max(axis=1, keepdims=True)).astype(np.float64)
        step = np.exp(self.trans - self.trans.max())
        fwd, back = np.empty(psi.shape), np.ones(psi.shape)
        for t in range(len(active)):
            a, z = begin[t], begin[t + 1]
            f = psi[a:z] if t == 0 else (fwd[begin[t - 1] : begin[t - 1] + z - a] @ step) * psi[a:z]
            fwd[a:z] = f / f.sum(axis=1, keepdims=True)
        for t in range(len(active) - 2, -1, -1):
            a, n, nxt = begin[t], active[t + 1], begin[t + 1]
            b = (back[nxt : nxt + n] * psi[nxt : nxt + n]) @ step.T
            back[a : a + n] = b / b.sum(axis=1, keepdims=True)
        return fwd, back, psi, step

    def marginals(self, e: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Label marginals of many sequences at once, laid out as in chain()."""
        fwd, back, _, _ = self.chain(e, active)
        fwd *= back
        return fwd / fwd.sum(axis=1, keepdims=True)

    @staticmethod
    def pair_posteriors(fwd: np.ndarray, back: np.ndarray, psi: np.ndarray, step: np.ndarray, length: int) -> np.ndarray:
        """P(label here, label next) for each place but the last, of sequences of one length: forward message,
        transition, next emission, next backward message, scaled to sum to one."""
        rows = len(fwd) // length
        shape = (length, rows, fwd.shape[1])
        ahead = (psi * back).reshape(shape)[1:]
        pair = fwd.reshape(shape)[:-1, :, :, None] * step * ahead[:, :, None, :]
        return pair / pair.sum(axis=(2, 3), keepdims=True)

    def transition_gradient(self, chain: tuple, gold: np.ndarray) -> np.ndarray:
        """Expected less seen transitions, by label here and next; gold has a row for each time step."""
        out = self.pair_posteriors(*chain, len(gold)).sum(axis=(0, 1))
        np.subtract.at(out, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        return out

    def fit(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, sequences: np.ndarray, y: np.ndarray, epochs: int = 4, rate: float = 0.3) -> ChainCRF:
        """Adagrad on the negative log-likelihood of sequences (rows of word numbers) with labels y, all of one length."""
        _, uniq, back = np.unique(word_hashes(raw, starts, ends), return_index=True, return_inverse=True)
        fs, sizes = [], []
        for u in np.array_split(uniq, len(uniq) // 2_000 + 1):  # few at once, for the driver's memory
            n = ends[u] - starts[u]
            z = np.cumsum(n)
            own = raw[np.repeat(starts[u] - z + n, n) + np.arange(int(n.sum()))]  # these words' bytes alone
            p, a = word_features(own, z - n, z, self.lexicon)
            fs.append(p.astype(np.int32))
            sizes.append(np.diff(np.append(a, len(p))))
        f, size = np.concatenate(fs), np.concatenate(sizes)
        del fs, sizes
        at = np.cumsum(size) - size
        rng, n = np.random.default_rng(9), len(self.labels)
        gw, gt = np.full(self.w.shape, 1e-4, np.float32), np.full(self.trans.shape, 1e-4)
        length = sequences.shape[1]
        for _ in range(epochs):
            order = rng.permutation(len(sequences))
            for lo in range(0, len(order), 64):
                rows = order[lo : lo + 64]
                words, inv = np.unique(back[sequences[rows]], return_inverse=True)
                inv = inv.reshape(len(rows), length)
                own = np.concatenate([f[at[w] : at[w] + size[w]] for w in words])
                first = np.cumsum(size[words]) - size[words]
                e = np.add.reduceat(self.w[own], first, axis=0)
                steps = np.ascontiguousarray(inv.T)
                psi = e[steps.ravel()]
                chain = self.chain(psi, np.full(length, len(rows)))
                gold = np.ascontiguousarray(y[rows].T)
                d = chain[0] * chain[1]
                d /= d.sum(axis=1, keepdims=True)
                d[np.arange(d.shape[0]), gold.ravel()] -= 1
                dword = np.stack([np.bincount(steps.ravel(), d[:, k], len(words)) for k in range(n)], axis=1) / 16
                feats, place = np.unique(own, return_inverse=True)
                of = np.repeat(np.arange(len(words)), size[words])
                dw = np.stack([np.bincount(place, dword[of, k], len(feats)) for k in range(n)], axis=1) + 1e-4 * self.w[feats]
                gw[feats] += dw**2
                self.w[feats] -= rate * dw / np.sqrt(gw[feats])
                dt = self.transition_gradient(chain, gold) / 64 + 1e-3 * self.trans
                gt += dt**2
                self.trans -= rate * dt / np.sqrt(gt)
        return self


def label_words(model: ChainCRF, texts: pa.Array):
    """For each range of rows (lo, hi): the word's bytes and spans, the row of each word, and its marginals."""
    buf, offs = packed(texts)
    for lo, hi in pieces(offs, BLOCK_BYTES):
        low, starts, ends, counts = word_spans(buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo])
        if not len(starts):
            yield lo, hi, low, starts, ends, counts, np.zeros((0, len(model.labels)))
            continue
        h = word_hashes(low, starts, ends)
        _, uniq, back = np.unique(h, return_index=True, return_inverse=True)
        e = model.emissions(low, starts[uniq], ends[uniq])
        order = np.argsort(-counts, kind="stable")
        first = np.cumsum(counts) - counts
        active = np.searchsorted(-counts[order], -np.arange(counts.max()), "left")
        at = np.repeat(np.arange(len(active)), active)
        rank = np.arange(len(at)) - np.repeat(np.cumsum(active) - active, active)
        word = first[order[rank]] + at
        m = np.empty((len(h), len(model.labels)))
        m[word] = model.marginals(e[back[word]], active)
        yield lo, hi, low, starts, ends, counts, m


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """span_hash of each word, by cuts of about a MB."""
    return np.concatenate([np.zeros(0, np.uint64), *(span_hash(low[a:z], starts[i:j] - a, ends[i:j] - a) for a, z, i, j in _parts(low, starts, ends))])


def _parts(low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Cuts between words about every MB, so that hashing keeps to the cache."""
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + (1 << 20), "right")))
        yield int(starts[i]), int(ends[j - 1]), i, j
        i = j


@lean
def _segments(batches):
    """Every text in consecutive segments of SEGMENT words between blanks; a shorter last one is filled by repeating it.
    A word of more than PIECE letters, as in a script without blanks, counts as several of that many, so that a segment's
    size is bounded."""
    for b in batches:
        langs, segs = [], []
        for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist(), strict=True):
            words = [w[at : at + PIECE] for w in WORD.findall((text or "").translate(_LOWER)) for at in range(0, len(w), PIECE)]
            for at in range(0, len(words), SEGMENT):
                langs.append(lang)
                segs.append(" ".join((words[at : at + SEGMENT] * SEGMENT)[:SEGMENT]))
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(segs, pa.string())], ["lang", "segment"])


#: Words of a segment, and of the stretches that mixed ones are made of.
SEGMENT, STRETCH = 24, 3
#: Letters of a word that a training segment holds as one.
PIECE = 256
_LOWER = {c: c + 32 for c in range(65, 91)}


def trained(train: DataFrame, bound: int = 4_000, segments: int = 24_000, lexicon_size: int = 6_000) -> ChainCRF:
    """The field learned from (doc_id, lang, text) rows: those of at most `bound` ids, whose hashes are least.

    Their whole texts are cut into segments of 24 words, labelled with their language; at most `segments` of
    these, again of least hash, are learned from, which bounds the driver's memory however long texts are or
    often an id repeats. Half as many more are mixed from stretches of three words of two, so that transitions
    learn of switches. The lexicon holds the segments' most frequent words. No rows: one label und.
    """
    some = train.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    cut = train.join(F.broadcast(some), "doc_id").select("lang", "text").mapInArrow(_segments, "lang string, segment string")
    got = cut.orderBy(F.xxhash64("segment"), "lang", "segment").limit(segments).toArrow().sort_by([("lang", "ascending"), ("segment", "ascending")])
    if not got.num_rows:
        return ChainCRF(["und"], np.zeros(0, np.uint64))
    langs = got["lang"].to_pylist()
    labels = sorted(set(langs))
    buf, offs = packed(got["segment"])
    low, starts, ends, _ = word_spans(buf[offs[0] : offs[-1]], offs - offs[0])
    seqs = np.arange(len(starts)).reshape(-1, SEGMENT)
    y = np.repeat(np.array([labels.index(x) for x in langs])[:, None], SEGMENT, axis=1)
    rng = np.random.default_rng(3)
    i, j = rng.integers(0, len(seqs), (2, len(seqs) // 2))
    other = np.repeat(rng.random((len(i), SEGMENT // STRETCH)) < 0.5, STRETCH, axis=1)
    seqs, y = (np.concatenate([x, np.where(other, x[j], x[i])]) for x in (seqs, y))
    h, n = np.unique(word_hashes(low, starts, ends), return_counts=True)
    lexicon = np.sort(h[np.argsort(-n, kind="stable")[:lexicon_size]])
    return ChainCRF(labels, lexicon).fit(low, starts, ends, seqs, y)


def languages(docs: DataFrame, folds: int = 3, held: int = 1, bound: int = 4_000, segments: int = 24_000, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text, and chance, the score of a text that tells nothing.

    Held out is crc32(id as text) mod folds = held; the field learns from a bounded sample of the other rows
    with a language (see trained) on the driver. Every text is then labelled in one narrow pass: forward-backward
    over all its words, its language the one whose marginals sum highest, its score their mean. Ties go to
    the first label in order. Null texts and those without a letter get `und` and score 0. A null language
    is not learned from. A very long text is one sequence, labelled whole, in memory that follows its number
    of words. Repeated rows each return a row; an empty table returns no rows; other columns are ignored.
    """
    d = checked(docs, doc_id=id_col, text=text_col, lang=lang_col)
    d = d.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"), F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False)).alias("held_out"))
    model = docs.sparkSession.sparkContext.broadcast(trained(d.where("not held_out and lang is not null and text is not null"), bound, segments))
    give_back()  # what the fit took, for a driver that goes on to other steps

    @lean
    def run(batches):
        crf = model.value
        for b in batches:
            some = b["letters"].to_numpy(zero_copy_only=False)
            pred, score = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for lo, hi, _, _, _, counts, m in label_words(crf, b["text"]):
                row = np.repeat(np.arange(hi - lo), counts)
                sums = np.stack([np.bincount(row, m[:, k], hi - lo) for k in range(len(crf.labels))], axis=1)
                pred[lo:hi] = sums.argmax(axis=1)
                score[lo:hi] = np.where(counts > 0, sums.max(axis=1) / np.maximum(counts, 1), 0)
            names = [crf.labels[k] if ok else "und" for k, ok in zip(pred.tolist(), some.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(names, pa.string()), pa.array(np.where(some, np.clip(score, 0, 1), 0.0)), pa.array(np.full(b.num_rows, 1 / len(crf.labels)))], ["doc_id", "held_out", "lang_pred", "score", "chance"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    return d.select("doc_id", "held_out", "text", letters).mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, chance double")


def word_languages(docs: DataFrame, model: ChainCRF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, place, word, lang, score: every word of code-switched texts with its most likely label."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        crf = sent.value
        for b in batches:
            for lo, hi, low, starts, ends, counts, m in label_words(crf, b["text"]):
                best, raw = m.argmax(axis=1) if len(m) else np.zeros(0, np.int64), low.tobytes()
                place = np.arange(len(starts)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays([b["doc_id"].slice(lo, hi - lo).take(pa.array(np.repeat(np.arange(hi - lo), counts))), pa.array(place.astype(np.int32)), pa.array([raw[s:e].decode("utf-8", "replace") for s, e in zip(starts, ends, strict=True)], pa.string()), pa.array([crf.labels[k] for k in best], pa.string()), pa.array(m[np.arange(len(m)), best])], ["doc_id", "place", "word", "lang", "score"])

    d = checked(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return d.mapInArrow(run, "doc_id long, place int, word string, lang string, score double")
