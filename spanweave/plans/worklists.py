"""A registered query from metadata and parsed tokens to the units of a campaign, beside its SQL.

Instructions are made from `part`: its name as a target, and after it one of four ways to name one of five other things.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import campaign, worklist
from .registry import query

TOK = "struct<text:string,lemma:string,pos:string,dep:string,start:int,i:int,head:int>"
CHUNKS = f"array<struct<start:int,end:int,root:{TOK},tokens:array<{TOK}>,dep:string>>"
OTHER = ("camera", "person(s", "family", "thing", "ball")
#: Words between the target and the other thing: (text, lemma, part of speech, relation), and blanks before each.
BETWEEN = (
    (("running", "run", "VERB", "acl"), ("near", "near", "ADP", "prep"), ("a", "a", "DET", "det")),
    (("like", "like", "ADP", "prep"), ("a", "a", "DET", "det")),
    (("near", "near", "ADP", "prep"), ("the", "the", "DET", "det"), ("man", "man", "NOUN", "poss"), ("'s", "'s", "PART", "case")),
    (("moving", "move", "VERB", "acl"), ('"toward', "toward", "ADP", "prep"), ("the", "the", "DET", "det")),
)


def _said(parts: DataFrame) -> DataFrame:
    """i, text, tokens and chunks of every instruction."""
    i = F.col("p_partkey")
    word = lambda n: F.get(F.split("p_name", " "), F.lit(n))
    other = F.get(F.array(*map(F.lit, OTHER)), (i % 5).cast("int"))
    row = lambda text, lemma, pos, dep: F.struct(text.alias("text"), lemma.alias("lemma"), F.lit(pos).alias("pos"), F.lit(dep).alias("dep"))
    plain = lambda m: [row(F.lit(a), F.lit(b), c, d) for a, b, c, d in BETWEEN[m]]
    first = [row(F.lit("the"), F.lit("the"), "DET", "det"), row(word(0), word(0), "ADJ", "amod"), row(word(1), word(1), "NOUN", "nsubj")]
    words = lambda m: F.array(*first, *plain(m), row(other, F.lit(""), "NOUN", "pobj"), *[row(F.lit(")"), F.lit(")"), "PUNCT", "punct")])
    kind = (i % 4).cast("int")
    every = F.when(kind == 0, words(0)).when(kind == 1, words(1)).when(kind == 2, words(2)).otherwise(words(3))
    d = parts.select(i.alias("i"), kind.alias("m"), (other == OTHER[1]).alias("plural"), F.slice(every, 1, F.size(every) - F.when(other == OTHER[1], 0).otherwise(1)).alias("w"))
    glued = lambda w: w["text"].isin("'s", ")")
    start = F.struct(F.lit("").alias("text"), F.array().cast(f"array<{TOK}>").alias("tokens"))

    def step(a: Column, w: Column) -> Column:
        before = F.when(F.length(a["text"]) == 0, "").when(glued(w), a["text"]).otherwise(F.concat(a["text"], F.lit(" ")))
        n = F.size(a["tokens"])
        token = F.struct(w["text"].alias("text"), w["lemma"].alias("lemma"), w["pos"].alias("pos"), w["dep"].alias("dep"), F.length(before).alias("start"), n.alias("i"), (n + 1).alias("head"))
        return F.struct(F.concat(before, w["text"]).alias("text"), F.array_append(a["tokens"], token).alias("tokens"))

    d = d.select("i", "m", "plural", F.aggregate("w", start, step).alias("x")).select("i", "m", "plural", "x.text", "x.tokens")
    at = lambda n: F.get("tokens", n)
    end = lambda n: at(n)["start"] + F.length(at(n)["text"])
    last = F.size("tokens") - F.when(F.col("plural"), 2).otherwise(1)
    begin = last - F.when(F.col("m") == 2, 3).otherwise(1)
    chunk = lambda a, z, root: F.struct(at(a)["start"].alias("start"), end(z).alias("end"), at(root).alias("root"), F.filter("tokens", lambda t: (t["i"] >= a) & (t["i"] <= z)).alias("tokens"), at(root)["dep"].alias("dep"))
    stop = F.when(F.col("m").isin(0, 3), F.lit(3)).otherwise(F.lit(2))
    return d.select("i", "text", "tokens", F.array(chunk(F.lit(0), stop, F.lit(2)), chunk(begin, last, last)).cast(CHUNKS).alias("chunks"))


def _units(said: DataFrame, dataset: str, split: str, which: str) -> DataFrame:
    i = F.col("i")
    e = said.where(which).select(F.concat(F.lit("v"), F.floor(i / 10).cast("string")).alias("video_id"), i.cast("string").alias("expression_id"), F.concat(F.lit(" "), "text").alias("exp"), F.array(F.lit("f0"), F.lit(".hidden")).alias("frames"), F.lit("[1]").alias("obj_id"), F.lit("[2]").alias("anno_id"), (i % 3).cast("int").alias("type_id"))
    return worklist.placed(campaign.units(e, dataset, split), dataset_root="/data")


@query("""WITH p AS (SELECT p_partkey AS i, p_name AS name, string_split(p_name, ' ')[2] AS noun, p_partkey % 4 AS m, p_partkey % 2 = 0 AS revos, p_partkey % 2 = 0 AND p_partkey % 3 = 2 AS negative,
 CASE p_partkey % 5 WHEN 0 THEN 'camera' WHEN 1 THEN 'person(s)' WHEN 2 THEN 'family' WHEN 3 THEN 'thing' ELSE 'ball' END AS said, CASE p_partkey % 5 WHEN 0 THEN 'camera' WHEN 1 THEN 'person' WHEN 2 THEN 'family' WHEN 3 THEN 'thing' ELSE 'ball' END AS head FROM part),
t AS (SELECT *, 'the ' || name || CASE m WHEN 0 THEN ' running near a ' WHEN 1 THEN ' like a ' WHEN 2 THEN ' near the man''s ' ELSE ' moving "toward the ' END || said AS text, CASE m WHEN 0 THEN 'a ' WHEN 1 THEN 'a ' WHEN 2 THEN 'the man''s ' ELSE 'the ' END || said AS surface,
 CASE WHEN head = 'thing' THEN 'ignore_special_unsafe_generic' WHEN head = 'family' THEN 'ignore_nonvisual_or_meta' WHEN head = 'camera' AND m = 3 THEN 'ignore_viewpoint_camera' WHEN m = 3 THEN 'ignore_quoted_title' WHEN m = 1 THEN 'ignore_comparison_concept' ELSE 'prompt_sam3.1' END AS decision FROM p)
SELECT CASE WHEN revos THEN 'revos__val__' || CASE i % 3 WHEN 0 THEN 'explicit' WHEN 1 THEN 'implicit' ELSE 'nonexistent' END ELSE 'refytvos__train__full_video' END || '__v' || (i // 10) || '__e' || i AS sample_id, text,
CASE WHEN negative THEN NULL ELSE CASE WHEN revos THEN 'target_gt' ELSE 'target_sam' END || ':the ' || name || ':0:' || (length(name) + 4) || ':' || noun END AS target,
CASE WHEN negative THEN '' ELSE concat_ws(';', CASE WHEN decision = 'prompt_sam3.1' THEN surface || '=' || head END, CASE WHEN m = 2 THEN 'the man=man' END) END AS contexts,
CASE WHEN negative OR decision = 'prompt_sam3.1' THEN '' ELSE surface || ':' || decision END AS ignored,
CASE WHEN negative THEN '' ELSE array_to_string(list_sort(list_filter([CASE WHEN decision = 'prompt_sam3.1' THEN head END, CASE WHEN m = 2 THEN 'man' END], lambda x: x IS NOT NULL)), ',') END AS prompts, '/data' AS dataset_root FROM t""")
def campaign_worklist(t):
    said = _said(t("part"))
    parts = [_units(said, "revos", "val", "i % 2 = 0"), _units(said, "ref_youtube_vos", "train", "i % 2 = 1")]
    ids = parts[0].select("sample_id", "expression_id").union(parts[1].select("sample_id", "expression_id"))
    parsed = ids.join(said.select(F.col("i").cast("string").alias("expression_id"), "tokens", "chunks"), "expression_id").select("sample_id", "tokens", "chunks")
    w = worklist.campaign_units(parts, parsed)
    x = F.col("extraction.target")
    return w.select(
        "sample_id", "text", F.when(x.isNotNull(), F.concat_ws(":", x["role"], x["surface"], x["start"].cast("string"), x["end"].cast("string"), x["head"])).alias("target"),
        F.array_join(F.transform("extraction.contexts", lambda c: F.concat_ws("=", c["surface"], c["sam_prompt"])), ";").alias("contexts"),
        F.array_join(F.transform("extraction.ignored", lambda c: F.concat_ws(":", c["surface"], c["decision"])), ";").alias("ignored"),
        F.array_join(F.transform("prompt_groups", lambda g: g["sam_prompt"]), ",").alias("prompts"), "dataset_root",
    )
