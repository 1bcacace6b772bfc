"""The registered queries of the training-data operators: SQL where it can say them, and the pipeline stage by stage."""

import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from spanweave.llm import queries
from spanweave.llm.langid import languages

SF = "/root/testdata/sf0.01"
RNG = np.random.default_rng(31)
VOCABS = {k: ["".join(RNG.choice(list(letters), RNG.integers(2, 8))) for _ in range(500)] for k, letters in (("en", "abcdefghij"), ("de", "klmnopqäöü"), ("ru", "абвгдежзик"))}


def prose(lang, n, seed):
    return " ".join(np.random.default_rng(seed).choice(VOCABS[lang], n))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE[name]})").fetchall()
    got = df.select(*cols).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert name != "op4_minhash" or any(not r.kept for r in got)  # the vectors of this table have no links


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents of three languages with copies, a shared passage, personal data and texts that belong nowhere."""
    shared = prose("en", 60, 900)
    texts = [(k, prose(k, 80, 10 * i + j)) for i, k in enumerate(VOCABS) for j in range(12)]
    texts += [("en", texts[0][1]), ("en", texts[1][1] + " x"), ("en", prose("en", 30, 901) + " " + shared), ("en", shared + " " + prose("en", 30, 902)), ("en", prose("en", 20, 903) + " mail a.b@site.org now, card 4041894974608795"), (None, None), ("en", ""), ("de", "12 34 !!"), ("en", shared)]
    rows = [(i, t, k, "s", len(t or ""), i % 3) for i, (k, t) in enumerate(texts)]
    at = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, word int").repartition(3).write.parquet(f"{at}/documents.parquet")
    return at


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0d]+", (t or "").lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_pipeline_stage_by_stage(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    said = {n: f for n, f in corpus_pipeline.STAGES}
    before = {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "substring_dedup", "pii", "packing"]

    one = said["language_id"](spark, docs, corpus).persist()
    score = {r.doc_id: r for r in languages(docs).collect()}
    gone = {i for i, r in score.items() if r.lang_pred == "und" or r.score < r.chance + 0.1 * (1 - r.chance)}
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == set(before) - gone
    assert gone == {i for i, r in before.items() if not re.search(r"[^\W\d_]", r.text or "")}

    two = said["near_dedup"](spark, one, corpus).persist()
    left = {r.doc_id: r.text for r in one.collect()}
    comp = {i: i for i in left}
    for a in left:
        for b in left:
            x, y = shingles(left[a]), shingles(left[b])
            if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((comp[a], comp[b]))
                comp = {i: lo if c == hi else c for i, c in comp.items()}
    assert {r.doc_id for r in two.collect()} == {i for i, c in comp.items() if i == c} and len(left) - two.count() == 2

    three = said["substring_dedup"](spark, two, corpus).persist()
    passage, first = prose("en", 60, 900), 38
    out = {r.doc_id: r for r in three.collect()}
    assert three.columns == docs.columns and set(out) == {r.doc_id for r in two.collect()} - {44}  # the passage alone is emptied and goes
    assert passage in out[first].text and out[39].text.strip() == prose("en", 30, 902)
    assert all(r.text == before[i].text and r.n_chars == before[i].n_chars for i, r in out.items() if i != 39) and out[39].n_chars == len(out[39].text)

    four = said["pii"](spark, three, corpus).persist()
    safe = {r.doc_id: r for r in four.collect()}
    assert four.columns == docs.columns and set(safe) == set(out)
    assert all(safe[i].text == r.text for i, r in out.items() if i != 40)
    assert re.fullmatch(re.escape(prose("en", 20, 903)) + r" mail \S+@\S+\.example now, card \d{16}", safe[40].text) and "4041894974608795" not in safe[40].text

    five = said["packing"](spark, four, corpus).collect()
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*lib.encode(r.text, add_special_tokens=False).ids, 0] for i, r in safe.items()}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in five} == {(i, k, s, min(2048, len(x) - s), zlib.crc32(np.array(x[s : s + 2048], "<u4").tobytes())) for i, x in ids.items() for k, s in enumerate(range(0, len(x), 2048))}
    places = {}
    for r in five:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in x) <= 2048 and [a for a, _ in sorted(x)] == [sum(n for _, n in sorted(x)[:k]) for k in range(len(x))] for x in places.values())
    assert len(places) == -(-sum(map(len, ids.values())) // 2048)

    whole = {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, corpus).collect()}
    assert whole == {(r.doc_id, r.piece, r.length, r.ids_crc32) for r in five}


def test_columns_of_any_name_pass_through(spark, corpus, tmp_path):
    names = ["gone_id", "_cut", "pii_count", "rest", "dup_words", "n_words", "kept", "score", "a.b"]
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    wide = docs.select("*", *[(docs["doc_id"] * 10 + i).alias(n) for i, n in enumerate(names)])
    for name, stage in corpus_pipeline.STAGES[1:4]:
        wide.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        wide = stage(spark, spark.read.parquet(f"{tmp_path}/{name}"), corpus)
        rows = wide.collect()
        assert wide.columns == docs.columns + names and rows and all(r[len(docs.columns) + i] == r.doc_id * 10 + i for r in rows for i in range(len(names)))
        wide = spark.createDataFrame(rows, wide.schema)


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
