"""The methods of the operators against plain versions of what they compute."""

import math
import re
import zlib
from itertools import product

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from spanweave.llm import langid, media, windows
from spanweave.llm.common import mix
from spanweave.llm.langid import ChainCRF
from spanweave.llm.lattice import Lattice, lattice_scores, vocabulary
from spanweave.llm.minhash import FIRST, SECOND, SPACE, circulant, rows_of
from spanweave.llm.pii import pseudonymised
from spanweave.llm.toxicity import FactorizationMachine
from spanweave.llm.windows import _rarest, rarest_windows, unsettled_starts


def test_log_mel_is_that_of_a_plain_transform():
    x = np.random.default_rng(1).normal(size=1000)
    rows, db = media.log_mel(x, 10_000)
    n, hop = media.WINDOW, media.HOP
    k = np.arange(n // 2 + 1)
    wave = np.exp(-2j * np.pi * np.outer(np.arange(n), k) / n)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / (n - 1))
    mel, back = (lambda f: 2595 * math.log10(1 + f / 700)), (lambda m: 700 * (10 ** (m / 2595) - 1))
    edges = [back(mel(5000) * i / (media.MELS + 1)) for i in range(media.MELS + 2)]
    assert len(rows) == 1 + math.ceil((1000 - n) / hop)
    for t in (0, 3, len(rows) - 1):
        part = np.zeros(n)
        own = x[t * hop : t * hop + n]
        part[: len(own)] = own
        power = np.abs((part * window) @ wave) ** 2
        for b in range(media.MELS):
            f = k * 10_000 / n
            tri = np.clip(np.minimum((f - edges[b]) / (edges[b + 1] - edges[b]), (edges[b + 2] - f) / (edges[b + 2] - edges[b + 1])), 0, None)
            assert math.isclose(rows[t, b], math.log(max(tri @ power, 1e-10)), rel_tol=1e-4, abs_tol=1e-4)
        assert math.isclose(db[t], 10 * math.log10(np.mean(part**2) + 1e-10), abs_tol=1e-6)


def test_resampling_is_a_polyphase_filter():
    """Each output is the low-pass of the input with zeros between, at every 8th place of 5 times the rate."""
    x = np.random.default_rng(2).normal(size=200)
    taps = media.lowpass(5, 8, media.TAPS)
    proto = np.empty(5 * media.TAPS)
    for p in range(5):
        proto[p::5] = taps[p][::-1]
    full = np.zeros(len(x) * 5 + len(proto) * 2)
    full[len(proto) : len(proto) + len(x) * 5 : 5] = x
    y = media.resampled(x)
    for i in range(0, len(y), 7):
        at = len(proto) + i * 8 + 5 * (media.TAPS - media.TAPS // 2 - 1)
        want = sum(proto[j] * full[at - j] for j in range(len(proto)))
        assert abs(want - y[i]) < 1e-9


def test_transition_gradient_is_the_slope_of_the_likelihood():
    rng = np.random.default_rng(3)
    model = ChainCRF(["a", "b", "c"], np.zeros(0, np.uint64))
    model.trans = rng.normal(size=(3, 3))
    length, rows = 5, 4
    e, gold = rng.normal(size=(length * rows, 3)), rng.integers(0, 3, (length, rows))

    def loss(trans):
        out = 0.0
        for s in range(rows):
            own = e.reshape(length, rows, 3)[:, s]
            score = lambda y: sum(own[t, k] for t, k in enumerate(y)) + sum(trans[a, b] for a, b in zip(y, y[1:], strict=False))  # noqa: E731, B023
            out += math.log(sum(math.exp(score(y)) for y in product(range(3), repeat=length))) - score(gold[:, s])
        return out

    got = model.transition_gradient(model.chain(e, np.full(length, rows)), gold)
    for a, b in product(range(3), repeat=2):
        step = np.zeros((3, 3))
        step[a, b] = 1e-5
        assert abs((loss(model.trans + step) - loss(model.trans - step)) / 2e-5 - got[a, b]) < 1e-5


def test_machine_is_the_plain_sum_over_pairs():
    rng = np.random.default_rng(4)
    m = FactorizationMachine()
    m.known, m.w0 = np.arange(20) * 3, 0.3
    m.w, m.v = rng.normal(size=20), rng.normal(size=(20, m.factors))
    rows = [np.sort(rng.choice(60, n, replace=False)) for n in (0, 1, 5, 30)]
    for r, got in zip(rows, m.score(rows), strict=True):
        k = [int(x) // 3 for x in r if x % 3 == 0]
        z = 0.3 + sum(m.w[i] for i in k) + sum(float(m.v[i] @ m.v[j]) for n, i in enumerate(k) for j in k[n + 1 :])
        assert math.isclose(got, 1 / (1 + math.exp(-z)), rel_tol=1e-9)


def test_signatures_are_shifts_of_one_permutation():
    s = mix(np.arange(700, dtype=np.uint64))
    got = circulant(s, rows_of(40))
    for k in range(40):
        assert got[k] == min(int(SECOND[(int(FIRST[int(x) % SPACE]) + k) % SPACE]) for x in s)


def test_text_scores_are_sums_over_all_segmentations(spark):
    """The whole score of whole texts, with the vocabulary's own weights, by plain recursion over strings."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = ["the cat sat", "the Dog sat on the mat", "", None, "unheardof words here", "cat cat cat", "naïve ünïts"] * 3
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in lattice_scores(d, path, turns=0).collect()}
    plain = {r.doc_id: r for r in lattice_scores(d, path, turns=0, whole_words=False).collect()}
    names, logp, stop = vocabulary(path)
    weight = dict(zip(names, np.exp(logp), strict=True))
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))

    def pieces(word):
        total = [1.0] + [0.0] * len(word)
        for e in range(1, len(word) + 1):
            total[e] = sum(total[s] * weight.get(word[s:e], 0.0) for s in range(e))
        return total[-1] * math.exp(stop)

    count, ends = {}, 0
    for i, t in enumerate(texts):
        if zlib.crc32(str(i).encode()) % 10:
            ends += 1
            for w in tokens(t):
                count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()) + ends, len(count) + 1
    ones, twos = (sum(c == k for c in count.values()) for k in (1, 2))
    off = (ones + 1) / (ones + 2 * twos + 2)
    for i, t in enumerate(texts):
        group = lambda c, whole: max(c - off, 0) / (n + 1) + (off * (len(count) + 1) + 1) / (n + 1) * whole
        score = math.log10(group(ends, (ends - off + 1) / (n + 2)))
        bare = alone = math.log10((ends + 1) / (n + 2))
        end = math.log10((ends - off + 1) / (n + 2))
        vocab = end
        for w in tokens(t):
            p = pieces((" " + w).encode())
            whole = max(count.get(w, 0) - off, 0) / (n + 2) + (off * v + 1) / (n + 2) * p
            score += math.log10(group(count.get(w, 0), whole))
            vocab += math.log10(1 - 10**end) + math.log10(p)
            alone += math.log10(1 - 10**bare) + math.log10(p)
        assert math.isclose(got[i].score, score, rel_tol=1e-5), i
        assert math.isclose(got[i].vocab_score, vocab, rel_tol=1e-5) and math.isclose(plain[i].score, alone, rel_tol=1e-5)


def test_long_words_score_as_short_ones_do(monkeypatch):
    from spanweave.llm import lattice

    names, logp, _ = vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    words = [b"internationalisation" * 4, "überraschung".encode() * 9, b"x" * 70, b"ab"]
    model = Lattice(names, logp, logp - 1)
    one, many = model.scores(words), model.expected(words, np.array([1.0, 2.0, 1.0, 3.0]))
    monkeypatch.setattr(lattice, "LONG", 10_000)
    assert np.allclose(one, model.scores(words)) and np.allclose(many, model.expected(words, np.array([1.0, 2.0, 1.0, 3.0])))


def test_stretches_met_for_every_hash():
    rng = np.random.default_rng(5)
    t, hashes = 6, 3
    for _ in range(40):
        n = 12
        keys = (rng.integers(0, 1000, n) * hashes + rng.integers(0, hashes, n)).astype(np.int64)
        c = rng.integers(5, 25, n)
        left, right = np.maximum(c - rng.integers(0, 9, n), 0), c + rng.integers(0, 9, n)
        want = []
        for a in range(0, 40):
            run = range(a, a + t)
            held = {int(k) % hashes for k, x, lo, hi in zip(keys, c, left, right, strict=True) if x in run and lo <= a and a + t - 1 <= hi}
            if len(held) == hashes:
                want.append(a)
        assert unsettled_starts(keys, c, left, right, t, hashes).tolist() == want


def test_rarest_shingle_is_the_centre():
    places, keys, holders = np.array([10, 11, 12, 13, 14, 15, 40]), np.arange(7) + 500, np.array([9, 9, 2, 9, 9, 9, 2])
    key, c, left, right = rarest_windows(places, keys, holders, 5, 4)
    assert set(zip(key.tolist(), c.tolist(), strict=True)) == {(502, 12), *((k, p) for k, p in zip(key.tolist(), c.tolist(), strict=True) if p > 12)}
    assert left[c.tolist().index(12)] <= 8 and right[c.tolist().index(12)] >= 16 and 40 not in c


def test_a_common_line_beside_one_word_over_and_over_is_no_centre():
    # shingles of the line, four of its end and the word's start, then the word's alone
    keys = np.concatenate([np.arange(13), np.full(48, 99)])
    holders = np.concatenate([np.full(9, 4000), np.full(4, 2), np.full(48, 50)])
    times = np.concatenate([np.ones(13, np.int64), np.full(48, 48)])
    for held in (np.zeros(61, bool), np.arange(61) >= 9):  # also where a passage holds the rest
        own, centre, *_ = next(_rarest(np.arange(61), keys, holders, 46, 31, 80, times, held))
        assert len(own) == 61 and not centre[:9].any() and centre[9:13].any()


def test_most_lacking_shingles_of_runs():
    from spanweave.llm.windows import most_lacking

    rng = np.random.default_rng(1)
    for _ in range(50):
        t, n = int(rng.integers(3, 9)), int(rng.integers(9, 40))
        doc = rng.integers(0, rng.integers(2, 30), n)
        times = {k: int((doc == k).sum() + (rng.random() < 0.3)) for k in doc.tolist()}  # some stand elsewhere in the text, too
        each = np.array([times[k] for k in doc.tolist()])
        given, copied = (each > 1) | (rng.random(n) < 0.5), rng.random(n) < 0.8
        v = np.where(given, doc + 1000, np.arange(n)).astype(np.uint64)
        at = np.flatnonzero(given)
        for x, got in enumerate(most_lacking(v, copied, at, each[at], t, 80).tolist()):
            near = range(max(0, x - t + 1), min(n, x + 2 * t - 1))
            before = {k for k in doc[x : x + t][given[x : x + t]].tolist() if k in doc[:x] or times[k] > (doc == k).sum()}
            assert got == min(20 * len({int(v[i]) for i in near if copied[i]}) // 100 + len(before), 40 * t // 120)


def test_the_driver_returns_what_the_fit_took(spark, monkeypatch):
    called = []
    monkeypatch.setattr(langid, "give_back", lambda: called.append(1))
    assert langid.languages(spark.createDataFrame([(1, "a b", "en")], "doc_id long, text string, lang string")).count() == 1 and called


def test_names_follow_their_full_form(spark):
    rows = [(1, "Mr John Smith came. Mr Smith left. Mrs Smith stayed."), (2, "Mr Smith"), (3, "Mr John Smith and Mr Adam Smith, then Mr Smith"), (4, "Dear Mr John Smith")]
    got = {r.doc_id: r.text for r in pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    m = re.fullmatch(r"Mr (\w+) (\w+) came\. Mr (\w+) left\. Mrs (\w+) stayed\.", got[1])
    assert m and m[2] == m[3] != m[4] and "Smith" not in got[1]
    assert got[4] == f"Dear Mr {m[1]} {m[2]}" and got[2] not in (f"Mr {m[2]}", "Mr Smith")
    x = re.fullmatch(r"Mr (\w+) (\w+) and Mr (\w+) (\w+), then (Mr \w+)", got[3])
    assert x and x[2] == m[2] != x[4] and x[5] == got[2]  # two fit, so it is an entity of its own


def test_full_spaces_of_surrogates_grow(spark):
    from spanweave.llm.pii import entity_surrogates

    e = spark.range(1000).select(F.lit("ssn").alias("kind"), F.format_string("%03d", F.col("id")).alias("canon"))
    made = [r.made for r in entity_surrogates(e, "k").collect()]
    assert len(set(made)) == 1000 and not set(made) & {f"{i:03d}" for i in range(1000)} and all(len(m) > 3 for m in made)


def test_sets_of_parts_too_unlike_are_not_made(monkeypatch):
    made = []
    monkeypatch.setattr(windows, "_alike", lambda *a, f=windows._alike: made.append(a) or f(*a))
    rng = np.random.default_rng(7)
    other = rng.integers(0, 2**60, 3000).astype(np.uint64)
    part = other.copy()
    part[np.arange(3000) % 8 > 3] = rng.integers(0, 2**60, 1500).astype(np.uint64)  # half of each stretch is there
    assert windows.passages(part, 0, 2999, other, 5, 50, 80) == [] and not made
    part[1000:1100] = other[1000:1100]
    [(first, last)] = windows.passages(part, 0, 2999, other, 5, 50, 80)
    assert first <= 1000 and last >= 1099 and last - first < 140 and not made
    again = np.concatenate([other[:60], other[:60], other[60:200]])  # repeats count once in a set, on either side
    assert windows.passages(again, 0, 259, other[:200], 5, 50, 80) == [(0, 259)] and not made


def test_training_words_are_hashed_by_parts(monkeypatch):
    """Hashes are the same by parts, and what one takes of the driver's memory is that of a MB."""
    raw = np.frombuffer(b"one word of many " * 200_000, np.uint8)
    low, starts, ends, _ = langid.word_spans(raw, np.array([0, len(raw)]))
    want, sizes = langid.span_hash(low, starts, ends), []
    whole = langid.span_hash
    monkeypatch.setattr(langid, "span_hash", lambda low, *spans: (sizes.append(len(low)), whole(low, *spans))[1])
    ChainCRF(["a", "b"], np.zeros(0, np.uint64)).fit(low, starts, ends, np.arange(48).reshape(2, 24), np.zeros((2, 24), np.int64), epochs=1)
    assert np.array_equal(langid.word_hashes(low, starts, ends), want) and max(sizes) <= (1 << 20) + 8
