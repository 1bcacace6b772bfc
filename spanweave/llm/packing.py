"""Packing of token sequences by minimum bin slack over the histogram of lengths."""

from __future__ import annotations

import gc
import os
import re
import zlib
from array import array
from functools import lru_cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import visible_bytes
from .common import checked, kept

_ODD_SPACE = re.compile(r"[\x1c-\x1f\x85]")
_SIMPLE = re.compile(r"([!-&(-/:;=-@\[-`{-~]*)([^\W\d_]+)([!-&(-/:;=-@\[-`{-~]*)")


class WordEncoder:
    """Ids as little-endian 32-bit bytes; the tokenizers library encodes each new word once.

    The vocabulary drops white space and never joins across it, so a text's ids are those of its
    blank-separated chunks; and a chunk of letters between marks is three words to it. A new word goes to
    the library's model in lower case, by the characters that stand for its bytes. Chunks of any other form
    go through the whole library, and so do texts with rare separators, which str.split() and the library
    see differently.
    """

    RUN = 60_000

    def __init__(self, path: str, cache: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task has one core, and threads keep memory of their own
        from tokenizers import Tokenizer

        self.lib, self.known, self.older, self.cache = Tokenizer.from_file(path), {}, {}, cache
        self.shown = {b: c for c, b in visible_bytes().items()}
        self.lib.no_truncation()
        self.lib.no_padding()

    def whole(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, chunks: list[str]) -> None:
        known, mixed, other, new = self.known, [], [], []
        for c in chunks:
            if not c.isascii() and (not is_normalized("NFC", c) or "Σ" in c or "İ" in c):
                other.append(c)  # composes, or its lower case hangs on its place or is more than letters
            elif c.isalpha():
                new.append(c)
            elif (m := _SIMPLE.fullmatch(c)) and m[2].isalpha():
                mixed.append((c, m[1], m[2], m[3]))
            else:
                other.append(c)
        split, shown = self.lib.model.tokenize, self.shown
        for w in {*new, *(w for _, *own in mixed for w in own)}.difference(known, [""]):
            x = w.lower()
            if not x.isascii():
                x = x.encode().decode("latin-1").translate(shown)
            known[w] = array("I", [t.id for t in split(x)]).tobytes()
        known[""] = b""
        known.update([(c, known[x] + known[y] + known[z]) for c, x, y, z in mixed])
        for c, e in zip(other, self.lib.encode_batch(other, add_special_tokens=False), strict=True):
            known[c] = np.array(e.ids, "<u4").tobytes()

    def meet(self, words: set[str]) -> None:
        """Makes the words known. A full table first becomes the older one, of which a word that is met again is
        taken over: 2 * cache words and those of two calls are known at most."""
        if len(self.known) > self.cache:
            self.older, self.known = self.known, {}
        new = words.difference(self.known)
        again = {w for w in new if w in self.older}
        self.known.update((w, self.older[w]) for w in again)
        if new := new.difference(again):
            gc.disable()  # it would walk the new tuples again and again
            self.learn(list(new))
            gc.enable()

    def looked_up(self, words: list[str]) -> bytes:
        """Ids of words in order, RUN words at a time, so that no text however long outgrows the table."""
        out = []
        for lo in range(0, len(words), self.RUN):
            part = words[lo : lo + self.RUN]
            self.meet(set(part))
            out.append(b"".join(map(self.known.__getitem__, part)))
        return b"".join(out)

    def encode(self, texts: list[str | None]):
        """Each text's ids; short texts are looked up together, about RUN words at a time."""
        ready: list[tuple[list[str] | None, str]] = []
        size = 0
        for t in texts:
            t = t or ""
            words = None if _ODD_SPACE.search(t) else t.split()
            ready.append((words, t))
            size += len(words or ())
            if size >= self.RUN or len(ready) == 1024:
                yield from self._encoded(ready)
                ready, size = [], 0
        yield from self._encoded(ready)

    def _encoded(self, ready: list[tuple[list[str] | None, str]]):
        short = [w for w, _ in ready if w is not None and len(w) < self.RUN]
        self.meet(set().union(*short))
        known = self.known.__getitem__
        done = [b"".join(map(known, w)) if w is not None and len(w) < self.RUN else None for w, _ in ready]
        for ids, (w, t) in zip(done, ready, strict=True):
            yield ids if ids is not None else self.whole(t) if w is None else self.looked_up(w)


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _cutter(path: str, most: int, end: int):
    def run(batches):
        enc, part, tail = encoder(path), TaskContext.get().partitionId(), np.array([end], "<u4").tobytes()
        met = np.zeros(most + 1, np.int64)
        for b in batches:
            rows = []
            for i, ids in zip(b["doc_id"].to_pylist(), enc.encode(b["text"].to_pylist()), strict=True):
                ids += tail
                for k, at in enumerate(range(0, len(ids), 4 * most)):
                    own = ids[at : at + 4 * most]
                    n = len(own) // 4
                    rows.append((i, k, at // 4, n, zlib.crc32(own), part, met[n]))
                    met[n] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            cols = list(zip(*rows, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "part", "seq"])

    return run


def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """(length, how many) whose sum is the most that fits into `room`, by subset sums in the bits of an integer.

    Lengths are taken up from the longest on until the room can be filled exactly; the steps are kept, so
    that the combination can be read back.
    """
    sums, steps, full, mask = 1, [], 1 << room, (1 << (room + 1)) - 1
    for size in (np.flatnonzero(counts[: room + 1])[::-1]).tolist():
        left, take = min(int(counts[size]), room // size), 1
        while left > 0 and not sums & full:
            take = min(take, left)
            steps.append((sums, size, take))
            sums |= (sums << size * take) & mask
            left -= take
            take *= 2
        if sums & full:
            break
    at, found = sums.bit_length() - 1, {}
    for before, size, take in reversed(steps):
        if not before >> at & 1:
            at -= size * take
            found[size] = found.get(size, 0) + take
    return list(found.items())


def bins(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(how often, [(length, how many)]) for all items: each bin takes the longest item left and the fullest rest.

    A combination is removed as often as the counts allow before the next is sought, so the number of
    searches follows the number of lengths, not of items.
    """
    counts, out = counts.astype(np.int64).copy(), []
    while len(have := np.flatnonzero(counts)):
        longest = int(have[-1])
        counts[longest] -= 1
        rest = dict(fullest(counts, capacity - longest)) if longest < capacity else {}
        counts[longest] += 1
        rest[longest] = rest.get(longest, 0) + 1
        times = min(int(counts[n]) // k for n, k in rest.items())
        for n, k in rest.items():
            counts[n] -= times * k
        out.append((times, sorted(rest.items(), reverse=True)))
    return out


def _placer(plan: dict[int, tuple[np.ndarray, ...]]):
    def run(batches):
        for b in batches:
            length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                at = np.flatnonzero(length == n)
                first, base, each, place = plan[n]
                k = np.searchsorted(first, rank[at], "right") - 1
                r = rank[at] - first[k]
                seq[at], off[at] = base[k] + r // each[k], place[k] + r % each[k] * n
            yield pa.RecordBatch.from_arrays([*(b[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(seq), pa.array(off)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def packed_sequences(docs: DataFrame, path: str, capacity: int = 2048, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    A document's ids end with `end`; longer ones are cut every `capacity` ids. Only the histogram of
    lengths (capacity entries at most) goes to the driver, where minimum bin slack turns it into bin
    patterns; every piece then finds its place from its rank among pieces of its length. Ranks come from
    counts for each task and length, so no task sees all pieces of a length. The patterns sent to the tasks
    are bounded by `capacity`, too, not by the number of rows.

    Null and empty texts are one piece of the end id. A very long text is encoded a bounded number of words at
    a time and cut into pieces. Repeated rows are packed each by itself. Pieces of equal length take their
    places by task and order within it; of combinations that fill a bin alike the one with the longest lengths
    is taken. An empty table returns no rows. Other columns are ignored.
    """
    d = checked(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    made = kept(d.mapInArrow(_cutter(path, capacity, end), "doc_id long, piece int, start long, length long, ids_crc32 long, part int, seq long"), "pieces")
    shares = made.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = kept(shares.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")), "bases")
    counts = np.zeros(capacity + 1, np.int64)
    for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used, base = np.zeros(capacity + 1, np.int64), 0
    for times, combo in bins(counts, capacity):
        at = 0
        for n, k in combo:
            rows.setdefault(n, []).append((int(used[n]), base, k, at))
            used[n] += times * k
            at += n * k
        base += times
    plan = {n: tuple(np.array(c, np.int64) for c in zip(*x, strict=True)) for n, x in rows.items()}
    ranked = made.join(before.drop("n"), ["part", "length"]).withColumn("rank", F.col("base") + F.col("seq"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_placer(plan), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
