"""Every operator on repeated rows, very long texts and words, ties and columns whose names are its own inside."""

import pytest
import public_tokenizers
from pyspark.sql import functions as F

from spanweave.llm.bpe import bpe_encoded
from spanweave.llm.langid import languages
from spanweave.llm.lattice import lattice_scores
from spanweave.llm.media import audio_digest
from spanweave.llm.minhash import near_duplicates
from spanweave.llm.packing import packed_sequences
from spanweave.llm.pii import pseudonymised
from spanweave.llm.quantise import near_vectors
from spanweave.llm.toxicity import toxicity_scores
from spanweave.llm.windows import without_repeats

CLASH = "block group word held_out part seq key c l r run side items rep node bands n most g row found between uid pos kind canon text_2 score y terms length rank label list shard asks code x component_id kept".split()
LONG = {
    "word": "z" * 300_000,
    "labels": "mail x@" + "a." * 100_000 + "com",
    "digits": "7" * 1_000_000,
    "words": " ".join(f"w{i % 4000}" for i in range(120_000)),
    "marks": "=" * 200_000 + " ....@@@@" * 20_000,
}
PLAIN = ["one two three", "one two three", "ONE two three", "", None, " \t\n", "ein Haus und ein Baum", "a b", "b a", "x"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3]) for i, t in enumerate([*PLAIN, *LONG.values()])]
    d = spark.createDataFrame(rows + rows[:4] + rows[-2:-1] * 2, "doc_id long, text string, lang string")
    return d.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASH)]).repartition(4).persist()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2 if i % 5 else None) for i in range(15)]
    return spark.createDataFrame(rows + rows[:3] + [(3, 0), (None, 1)], "doc_id long, toxic int").withColumn("terms", F.lit(1))


def vocab(name):
    return public_tokenizers.path(name)


BY_ROW = {
    "media": lambda d, y: audio_digest(d),
    "lattice": lambda d, y: lattice_scores(d, vocab("piece_bpe_32k.model"), group_col="lang"),
    "pii": lambda d, y: pseudonymised(d, "k").drop(*CLASH, "lang"),
    "minhash": lambda d, y: near_duplicates(d),
    "langid": lambda d, y: languages(d),
    "bpe": lambda d, y: bpe_encoded(d, vocab("byte_bpe_50k.json"), digest=True),
    "toxicity": lambda d, y: toxicity_scores(d, y),
    "windows": lambda d, y: without_repeats(d, carry=["block", "found", "lang"]),
}


@pytest.mark.parametrize("name", sorted(BY_ROW))
def test_a_row_for_each_row(docs, labels, name):
    got = BY_ROW[name](docs, labels).collect()
    n = {}
    for r in docs.select("doc_id").collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(tuple(r))
    assert {i: len(x) for i, x in by.items()} == n
    assert all(len({repr(r) for r in x}) == 1 for x in by.values()), "equal rows give equal results"


def test_packing_of_odd_rows(docs):
    rows = packed_sequences(docs, vocab("word_bpe_49k.json")).collect()
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in x) <= 2048 for x in places.values())
    once = {r.doc_id: r for r in docs.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    heads = {}
    for r in rows:
        heads[r.doc_id] = heads.get(r.doc_id, 0) + (r.piece == 0)
    assert heads == {i: r.n for i, r in once.items()}


def test_personal_data_of_long_texts(docs):
    got = {r.doc_id: r for r in pseudonymised(docs, "k").collect()}
    at = len(PLAIN)
    assert got[at].text == LONG["word"] and got[at + 3].text == LONG["words"] and got[at].pii_count == 0 and len(got[at + 2].text) == 1_000_000


def test_rows_of_vectors(spark):
    one = [1.0] * 64
    rows = [(1, one, 1), (1, one, 1), (2, one, 1), (2, [2.0] * 64, 1), (3, [-1.0] * 64, 1), (4, one, 2), (None, one, 1), (5, [float("inf")] * 64, 1)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select("*", *[F.lit(1).alias(c) for c in CLASH if c not in ("label",)])
    got = sorted((r.vec_id or 0, r.n_links, r.component_id) for r in near_vectors(d).collect())
    assert got == [(0, 0, None), (1, 3, 1), (1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5)]
