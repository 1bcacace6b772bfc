"""The registered queries of this subpackage: thin digests of its operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_encoded
from .elkan import centroid_clusters
from .langid import languages
from .lattice import lattice_scores
from .lines import without_common_lines
from .media import audio_digest
from .minhash import near_duplicates
from .packing import packed_sequences
from .pii import pseudonymised
from .quantise import near_vectors
from .toxicity import toxicity_scores
from .whitening import whitened
from .windows import without_repeats


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio_digest(_table(spark, sf_dir, "documents"))


def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(_table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"), group_col="lang")


#: Of these queries only; real runs pass a secret of their own.
KEY = "example-key"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(_table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op5_quantise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encoded(_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), digest=True)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_sequences(_table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op11_elkan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters(_table(spark, sf_dir, "embeddings")).drop("computed")


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_common_lines(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_media": op1_media,
    "op2_lattice": op2_lattice,
    "op3_pii": op3_pii,
    "op4_minhash": op4_minhash,
    "op5_quantise": op5_quantise,
    "op6_langid": op6_langid,
    "op7_bpe": op7_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_windows": op9_windows,
    "op10_packing": op10_packing,
    "op11_elkan": op11_elkan,
    "op12_lines": op12_lines,
    "op13_whitening": op13_whitening,
}
_COMPONENTS = """reach AS (SELECT id, id AS got FROM nodes UNION SELECT r.id, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = r.got),
firsts AS (SELECT id, min(got) AS component_id FROM reach GROUP BY id)"""
_NEAREST = "SELECT v.vec_id, v.x, min({{'d': list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'c': c.c}}) AS m FROM v CROSS JOIN c{0} c GROUP BY v.vec_id, v.x"
_MOVED = """parts{0} AS (SELECT m.c AS c, unnest(x) AS x, unnest(range(64)) AS i FROM a{0}),
sums{0} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM parts{0} GROUP BY c, i),
c{1} AS MATERIALIZED (SELECT c.c, coalesce(list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) FILTER (i IS NOT NULL), any_value(c.x)) AS x FROM c{0} c LEFT JOIN sums{0} t ON t.c = c.c GROUP BY c.c)"""
#: Assignments and moves of five rounds, one after the other; ids are distinct.
_ROUNDS = ", ".join([f"a{r} AS MATERIALIZED ({_NEAREST.format(r)}), {_MOVED.format(r, r + 1)}" for r in range(5)])
#: Queries whose whole result SQL can say, too, by comparison of all documents, or vectors, with each other.
ORACLE: dict[str, str] = {
    "op4_minhash": f"""WITH RECURSIVE w AS (SELECT doc_id AS id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
nodes AS (SELECT id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
items AS (SELECT id, unnest(s) AS x FROM nodes), pairs AS (SELECT p.id AS a, q.id AS b, count(*) AS c FROM items p JOIN items q ON p.x = q.x AND p.id < q.id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN nodes p ON p.id = a JOIN nodes q ON q.id = b WHERE 100 * c >= 85 * (len(p.s) + len(q.s) - c)), {_COMPONENTS}
SELECT n.id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, n.id = component_id AS kept FROM nodes n JOIN firsts l ON l.id = n.id""",
    "op5_quantise": f"""WITH RECURSIVE nodes AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
good AS (SELECT id, label, x, sqrt(list_sum(list_transform(x, lambda v: v * v))) AS size FROM nodes WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0),
links AS (SELECT p.id AS a, q.id AS b FROM good p JOIN good q ON p.label = q.label AND p.id < q.id AND len(p.x) = len(q.x) WHERE p.size > 0 AND q.size > 0 AND list_dot_product(p.x, q.x) / (p.size * q.size) >= 0.98), {_COMPONENTS},
n AS (SELECT id, count(*) AS n FROM (SELECT a AS id FROM links UNION ALL SELECT b FROM links) GROUP BY 1)
SELECT x.id AS vec_id, coalesce(n.n, 0) AS n_links, component_id, x.id = component_id AS kept FROM nodes x JOIN firsts l ON l.id = x.id LEFT JOIN n ON n.id = x.id""",
    "op11_elkan": f"""WITH v AS MATERIALIZED (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, x FROM v QUALIFY c < 40), {_ROUNDS}, a AS MATERIALIZED ({_NEAREST.format(5)}),
t AS (SELECT m.c AS c, sum(m.d) AS s FROM a GROUP BY m.c)
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance, CAST(t.s AS BIGINT) AS cluster_inertia, (SELECT CAST(sum(s) AS BIGINT) FROM t) AS inertia, sha256(array_to_string(c5.x, ',')) AS centroid_sha256 FROM a JOIN t ON t.c = m.c JOIN c5 ON c5.c = m.c""",
    "op12_lines": """WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
c AS (SELECT k FROM k WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(c.k) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (c.k IS NULL), '')) AS kept_sha256 FROM k LEFT JOIN c ON c.k = k.k GROUP BY doc_id""",
}
