"""Byte-level BPE by a contiguous rank array: encoding and decoding of whole texts."""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked

# Fixed value: the split pattern of byte-level BPE vocabularies of this kind.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NEVER = 1 << 60


def visible_bytes() -> dict[str, int]:
    """The character that stands for each byte in such vocabularies: itself if printable, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for b in sorted(set(range(256)) - set(plain)):
        out[chr(256 + len(out) - len(plain))] = b
    return out


class Recent(dict):
    """Results of `make` for keys of up to `longest` characters, at most 2 * `size` of them.

    A full table becomes the older one, of which a key that is met again is taken over; so what a text
    repeats stays, and what is rare goes.
    """

    def __init__(self, make, size: int, longest: int = 40):
        super().__init__()
        self.make, self.size, self.longest, self.older = make, size, longest, {}

    def __missing__(self, key: str):
        if (out := self.older.get(key)) is None:
            out = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.size:
                self.older = dict(self)
                self.clear()
            self[key] = out
        return out


class RankArrayBPE:
    """Encodes with merge ranks; parts and the ranks of adjacent parts lie in two short lists.

    A word up to `short` bytes is merged by scanning the rank list for its least value, deleting one
    boundary and looking up the ranks on both sides anew. A longer one takes a heap over the same ranks,
    for the scans would be quadratic; both choose the least rank, leftmost first.
    """

    def __init__(self, path: str, short: int = 96, cache: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = visible_bytes()
        vocab, self.short = spec["model"]["vocab"], short
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = {i: bytes(chars[c] for c in t) for t, i in vocab.items() if t not in self.special}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.decimal = {i: str(i) for i in self.bytes}
        self.first = {chars[t]: i for t, i in vocab.items() if len(t) == 1}
        # a pair of ids as one number, and its rank and the id it makes as another: numbers order by rank
        self.bits = max(self.bytes).bit_length()
        self.merges: dict[int, int] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges.setdefault(vocab[a] << self.bits | vocab[b], rank << self.bits | vocab[a + b])
        self.words = Recent(self.word, cache // 4)
        self.chunks = Recent(lambda part: self.chunk(" " + part), cache)
        self.split = regex.compile(PATTERN)
        self.special_at = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.gaps = regex.compile(r"\s\s")

    def word(self, word: str) -> tuple[int, ...]:
        ids = [self.first[b] for b in word.encode()]
        if len(ids) > self.short:
            return self.long_word(ids)
        bits, get, mask = self.bits, self.merges.get, (1 << self.bits) - 1
        ranks = [get(a << bits | b, NEVER) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (least := min(ranks)) != NEVER:
            i = ranks.index(least)
            ids[i] = made = least & mask
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] << bits | made, NEVER)
            if i < len(ranks):
                ranks[i] = get(made << bits | ids[i + 1], NEVER)
        return tuple(ids)

    def long_word(self, ids: list[int]) -> tuple[int, ...]:
        after, before, bits = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)], self.bits
        heap = []

        def offer(left: int, right: int) -> None:
            if (m := self.merges.get(ids[left] << bits | ids[right])) is not None:
                heapq.heappush(heap, (m, left, ids[left], ids[right]))

        for i in range(len(ids) - 1):
            offer(i, i + 1)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = m & ((1 << bits) - 1), -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return tuple(i for i in ids if i >= 0)

    def chunk(self, text: str) -> tuple[int, ...]:
        """Ids of a text by the split pattern; a chunk of one word is remembered as a chunk alone."""
        words = self.split.findall(text)
        return self.word(words[0]) if len(words) == 1 else tuple(chain.from_iterable(map(self.words.__getitem__, words)))

    def plain(self, text: str) -> list[int]:
        """Text without special tokens. Between single blanks a split depends on nothing else, so such chunks are remembered."""
        if not text:
            return []
        if self.gaps.search(text):
            return list(self.chunk(text))
        start, *parts = text.split(" ")
        return list(chain(self.chunk(start) if start else (), chain.from_iterable(map(self.chunks.__getitem__, parts))))

    def encode(self, text: str | None) -> list[int]:
        """Ids of the whole text; null is empty. A special token's own string becomes its id."""
        text = text or ""
        out, at = [], 0
        for m in self.special_at.finditer(text):
            out += self.plain(text[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self.plain(text[at:])

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(path: str) -> RankArrayBPE:
    return RankArrayBPE(path)


def _map(path: str, digest: bool):
    def run(batches):
        bpe = tokenizer(path)
        for b in batches:
            n, ids_out, text_out = [], [], []
            for text in b["text"]:
                ids = bpe.encode(text.as_py())
                back = bpe.decode(ids)
                n.append(len(ids))
                ids_out.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest() if digest else ids)
                text_out.append(hashlib.sha256(back.encode()).hexdigest() if digest else back)
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "n_tokens", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n, pa.int64()), pa.array(ids_out, pa.string() if digest else pa.list_(pa.int32())), pa.array(text_out, pa.string())], names)

    return run


def bpe_encoded(docs: DataFrame, path: str, digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids and decoded text (or, with digest, their SHA-256) of every whole text.

    One narrow pass; each Python worker keeps a bounded cache of words. `path` names the vocabulary on
    every machine. Null and empty texts have no tokens and decode to the empty text. A very long text is
    encoded whole, a very long word by a heap. Of pairs of equal rank the leftmost is merged first. Repeated
    rows each return a row; an empty table returns no rows; other columns are ignored.
    """
    d = checked(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    return d.mapInArrow(_map(path, digest), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, n_tokens long, ids array<int>, decoded string")
