"""Rules over texts and parsed tokens: which noun phrases of an instruction are entities to look for.

Tokens are structs (text, lemma, pos, dep, start, i); a parser outside this library makes them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import spans
from .binding import let

# Word lists and patterns that decisions depend on.
ABSTRACT = "background beginning exercise family foreground front frame genus image left matter motion order place position race right screen side strike subject thing view video".split()
GENERIC = "object something stuff thing".split()
EVENTS = "beginning exercise game motion race strike speed".split()
BODY_PARTS = "arm face foot hand head leg mouth paw tail trunk wing".split()
TAXONOMY = "family genus order species".split()
ACTIONS = "hang hanging leaning running seating sitting standing talking wearing".split()
PRONOUNS = "he her hers him his its she that their them they who whose".split()
NO_HEADS = "he her him his it its she that their them they which who whose".split()
REFERENCES = "nsubj nsubjpass poss relcl attr dobj pobj".split()
SUBJECTS = "nsubj nsubjpass ROOT attr dobj".split()
MODIFIERS = "amod compound nmod".split()
PLACES = "first last left right".split()
CAMERA = r"(?:away|distance|far|furthest|closest|nearer|toward|from)\s+(?:the\s+)?camera|camera\s+(?:view|frame|position)"
COMPARED = r"\b(?:like|as)\s+(?:an?\s+)?$"
DEFINED = r"(?i)\bwidely\s+used\s+for\b|\bused\s+as\b"
QUESTION = r"(?i)^\s*(which\b.+?)(?=\s+(?:is|are|was|were|could|would|has|have|does|do)\b)"


def before(text: Column, at: Column, most: int | None = None) -> Column:
    """The text up to a place, of it at most the last characters."""
    first = F.greatest(at - most, F.lit(0)) if most else F.lit(0)
    return spans.cut(text, first, at)


def viewpoint_camera(text: Column, start: Column, end: Column) -> Column:
    return F.lower(spans.cut(text, F.greatest(start - 48, F.lit(0)), F.least(end + 24, F.length(text)))).rlike(CAMERA)


def taxonomic(text: Column, start: Column, end: Column) -> Column:
    return F.lower(spans.cut(text, F.greatest(start - 28, F.lit(0)), end)).rlike(r"\b(?:" + "|".join(TAXONOMY) + r")\b")


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def quoted(text: Column, start: Column, end: Column) -> Column:
    """Whether a quotation is open before the span or at its end."""
    opened = lambda part: (_count(part, '"') % 2 == 1) | (_count(part, "“") > _count(part, "”"))
    return opened(before(text, start)) | opened(before(text, end))


def compared(text: Column, start: Column) -> Column:
    return F.lower(before(text, start, 18)).rlike(COMPARED)


def defined(text: Column, start: Column) -> Column:
    return before(text, start).rlike(DEFINED)


def decision(text: Column, start: Column, end: Column, head: Column) -> Column:
    """What becomes of a noun phrase: the first rule that holds decides."""
    return (
        F.when(head.isin(GENERIC), "ignore_special_unsafe_generic")
        .when(head.isin(EVENTS) | head.isin(ABSTRACT), "ignore_nonvisual_or_meta")
        .when((head == "camera") & viewpoint_camera(text, start, end), "ignore_viewpoint_camera")
        .when(taxonomic(text, start, end), "ignore_taxonomic_concept")
        .when(quoted(text, start, end), "ignore_quoted_title")
        .when(compared(text, start), "ignore_comparison_concept")
        .when(defined(text, start), "ignore_generic_definition")
        .otherwise("prompt_sam3.1")
    )


def candidate(index: Column, text: Column, start: Column, end: Column, head: Column, prompt: Column) -> Column:
    """A context candidate with its decision; only those to look for keep their prompt."""
    what = decision(text, start, end, head)
    wanted = what == "prompt_sam3.1"
    return F.struct(
        F.concat(F.lit("entity-"), F.lpad(index.cast("string"), 2, "0")).alias("candidate_id"),
        F.when(wanted, "context_sam").otherwise("special_handling").alias("role"),
        spans.cut(text, start, end).alias("surface"), start.alias("start"), end.alias("end"), head.alias("head"),
        F.when(wanted, F.coalesce(prompt, head)).alias("sam_prompt"), what.alias("decision"), wanted.alias("required_by_bcc"),
    )


def lemma(word: Column) -> Column:
    """Lower case, without a plural in brackets and without what is no letter or digit at both ends."""
    plain = F.regexp_replace(F.replace(F.lower(F.trim(word)), F.lit("ß"), F.lit("ss")), r"\((?:e?s)\)?", "")
    return F.regexp_replace(plain, r"^[^a-z0-9]+|[^a-z0-9]+$", "")


def stem(token: Column) -> Column:
    """A token's lemma, or that of its text where the parser gave none."""
    return lemma(F.coalesce(F.nullif(token["lemma"], F.lit("")), token["text"]))


def candidate_span(text: Column, start: Column, end: Column) -> Column:
    """Offsets without outer blanks and marks at the end; a bracket that closes a plural "(s" is taken in."""
    t = spans.trimmed(text, start, end)
    part = spans.cut(text, t["start"], t["end"])
    stop = t["start"] + F.length(F.regexp_replace(part, r'[,.;:!?"]+$', ""))
    plural = (F.substring(text, stop + 1, F.lit(1)) == ")") & F.lower(spans.cut(text, t["start"], stop)).rlike(r"\((?:e?s)$")
    return F.struct(t["start"].alias("start"), F.when(plural, stop + 1).otherwise(stop).cast("int").alias("end"))


def question_target(text: Column) -> Column:
    """Where a question says what it asks for: its "who", or "which ..." up to the verb; null if it does neither."""
    who, which = F.regexp_extract(text, r"(?i)^\s*(who)\b", 1), F.regexp_extract(text, QUESTION, 1)
    left = F.length(text) - F.length(F.regexp_replace(text, r"^\s+", ""))
    place = lambda said: F.struct(left.alias("start"), (left + F.length(F.regexp_replace(said, r"\s+$", ""))).alias("end"))
    return F.when(who != "", place(who)).when(which != "", place(which))


def prompt(tokens: Column, root: Column) -> Column:
    """A noun phrase's words to look for: its modifiers and its head as lemmas, each once; "t v" is television."""
    some = F.filter(tokens, lambda t: (t["i"] < root["i"]) & t["dep"].isin(MODIFIERS) & t["text"].rlike(r"^\p{L}+$") & ~stem(t).isin(PLACES))
    words = F.filter(F.array_distinct(F.concat(F.transform(some, lambda t: stem(t)), F.array(stem(root)))), lambda w: w != "")
    return F.regexp_replace(F.regexp_replace(F.array_join(words, " "), r"\bflatscreen\s+t\s+v\b", "television"), r"\bt\s+v\b", "television")


def head_in(tokens: Column, start: Column, end: Column, fallback: Column) -> Column:
    """The last noun that begins in the span."""
    nouns = F.filter(tokens, lambda t: (t["start"] >= start) & (t["start"] < end) & t["pos"].isin("NOUN", "PROPN") & (stem(t) != ""))
    return F.coalesce(stem(F.try_element_at(nouns, F.lit(-1))), fallback)


def without_actions(text: Column, tokens: Column, start: Column, end: Column) -> Column:
    """The span without outer blanks, marks at its end, and then verbs and words of action at its end."""
    at = candidate_span(text, start, end)
    return let(at, lambda a: _before_actions(text, tokens, a["start"], a["end"]))


def _before_actions(text: Column, tokens: Column, start: Column, end: Column) -> Column:
    own = F.reverse(F.filter(tokens, lambda t: (t["start"] >= start) & (t["start"] < end)))
    acts = lambda t: stem(t).isin(ACTIONS) | t["pos"].isin("VERB", "AUX")
    first = F.struct(end.cast("int").alias("end"), F.lit(True).alias("on"))
    step = lambda a, t: F.struct(F.when(a["on"] & acts(t), t["start"].cast("int")).otherwise(a["end"]).alias("end"), (a["on"] & acts(t)).alias("on"))
    return spans.trimmed(text, start, F.aggregate(own, first, step)["end"])


def target_chunk(chunks: Column) -> Column:
    """The first noun phrase in a subject's or object's place, else the first; chunks have dep, the root's part."""
    return F.coalesce(F.get(F.filter(chunks, lambda c: c["dep"].isin(SUBJECTS)), F.lit(0)), F.get(chunks, F.lit(0)))


def coreferences(tokens: Column, start: Column, end: Column) -> Column:
    """Spans of pronouns outside the target that refer to something, not those that stand before a noun."""
    refers = lambda t: F.lower(t["text"]).isin(PRONOUNS) & (t["dep"].isin(REFERENCES) | F.lower(t["text"]).isin("who", "whose", "that"))
    out = F.filter(tokens, lambda t: refers(t) & ~((t["start"] >= start) & (t["start"] < end)))
    return F.transform(out, lambda t: F.struct(t["start"].alias("start"), (t["start"] + F.length(t["text"])).alias("end"), t["text"].alias("text")))


def body_parts(tokens: Column, covered: Column) -> Column:
    """Tokens that name a part of a body and lie in no candidate (start, end, head) of that head."""
    there = lambda t: F.exists(covered, lambda c: (c["start"] <= t["start"]) & (t["start"] < c["end"]) & (c["head"] == stem(t)))
    return F.filter(tokens, lambda t: stem(t).isin(BODY_PARTS) & ~there(t))


def grouped_prompts(contexts: Column) -> Column:
    """Candidates by prompt, whatever its case or blanks; prompts in order, candidates as they come."""
    key = lambda c: F.lower(F.trim(F.coalesce(c["sam_prompt"], F.lit(""))))
    keys = F.array_sort(F.array_distinct(F.filter(F.transform(contexts, key), lambda k: k != "")))
    return F.transform(keys, lambda k: F.struct(k.alias("sam_prompt"), F.filter(contexts, lambda c: key(c) == k).alias("candidates")))


def _raw(start: Column, end: Column, head: Column, words: Column, sure: bool) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), head.alias("head"), words.alias("prompt"), F.lit(sure).alias("sure"))


RAW = "array<struct<start:int,end:int,head:string,prompt:string,sure:boolean>>"


def phrases(text: Column, tokens: Column, chunks: Column, place: Column) -> Column:
    """What may be an entity beside the target, each place and head once: noun phrases, each with its possessors after
    it, then body parts that lie in none of them. chunks: start, end, root (a token), tokens; tokens also say their head's
    number; place: the target's start, end and head. A phrase within the target, or that covers its start, is none, nor
    is one whose head is a pronoun."""
    none, start, end = F.array().cast(RAW), place["start"], place["end"]

    def owned(c: Column) -> Column:
        owners = F.filter(c["tokens"], lambda t: (t["dep"] == "poss") & t["pos"].isin("NOUN", "PROPN"))
        first = lambda t: F.array_min(F.concat(F.array(t["start"]), F.transform(F.filter(tokens, lambda d: (d["head"] == t["i"]) & (d["i"] < t["i"]) & (d["dep"] == "det")), lambda d: d["start"])))
        each = F.transform(owners, lambda t: _raw(first(t), t["start"] + F.length(t["text"]), stem(t), stem(t), True))
        return F.filter(each, lambda r: ~((r["start"] >= start) & (r["end"] <= end)))

    def of_chunk(c: Column) -> Column:
        read = F.struct(candidate_span(text, c["start"], c["end"]).alias("at"), stem(c["root"]).alias("word"), prompt(c["tokens"], c["root"]).alias("said"))

        def made(x: Column) -> Column:
            inside = ((x["at"]["start"] >= start) & (x["at"]["end"] <= end)) | ((x["at"]["start"] <= start) & (start < x["at"]["end"]))
            some = (x["word"] != "") & ~inside & ~x["word"].isin(*NO_HEADS)
            return F.when(some, F.concat(F.array(_raw(x["at"]["start"], x["at"]["end"], x["word"], F.nullif(x["said"], F.lit("")), False)), owned(c))).otherwise(none)

        return let(read, made)

    key = lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), r["head"].alias("head"))

    def once(named: Column) -> Column:
        keys = F.concat(F.array(key(place)), F.transform(named, key))
        return F.filter(named, lambda r, i: F.array_position(keys, key(r)) == i + 2)

    def with_parts(named: Column) -> Column:
        parts = F.transform(body_parts(tokens, F.concat(F.array(key(place)), F.transform(named, key))), lambda t: _raw(t["start"], t["start"] + F.length(t["text"]), stem(t), stem(t), True))
        return F.concat(named, parts)

    return let(let(F.flatten(F.transform(chunks, of_chunk)), once), with_parts)


def extraction(text: Column, negative: Column, tokens: Column, chunks: Column, category: Column) -> Column:
    """(target, coreferences, contexts, ignored) of an instruction; negative ones have none.

    The target is what a question asks for, else the first subject-like noun phrase, else the whole text under its
    category's name; an empty span becomes that of its head.
    """
    is_who = text.rlike(r"(?i)^\s*who\b")

    def first(x: Column) -> Column:
        own = F.when(x["chunk"].isNotNull(), without_actions(text, x["chunk"]["tokens"], x["chunk"]["start"], x["chunk"]["end"]))
        at = F.coalesce(x["asked"], own, F.struct(F.lit(0).alias("start"), F.length(text).alias("end")))
        return F.struct(at.alias("at"), x["asked"].isNotNull().alias("asked"), x["chunk"].isNotNull().alias("named"), stem(x["chunk"]["root"]).alias("root"))

    def headed(x: Column) -> Column:
        noun = head_in(tokens, x["at"]["start"], x["at"]["end"], F.when(x["asked"], "entity").otherwise(x["root"]))
        head = F.when(is_who, F.lit("person")).when(x["asked"] | x["named"], noun).otherwise(F.lower(F.coalesce(category, F.lit("entity"))))
        return F.struct(x["at"].alias("at"), head.alias("head"))

    def placed(x: Column) -> Column:
        return let(repaired_at(x), lambda p: F.struct(p["start"].cast("int").alias("start"), p["end"].cast("int").alias("end"), x["head"].alias("head")))

    def repaired_at(x: Column) -> Column:
        return spans.repaired(text, x["at"]["start"], x["at"]["end"], x["head"])

    def numbered(r: Column, i: Column) -> Column:
        what = F.when(r["sure"], F.lit("prompt_sam3.1")).otherwise(decision(text, r["start"], r["end"], r["head"]))

        def told(x: Column) -> Column:
            wanted = x == "prompt_sam3.1"
            return F.struct(F.concat(F.lit("entity-"), F.lpad((i + 1).cast("string"), 2, "0")).alias("candidate_id"), F.when(wanted, "context_sam").otherwise("special_handling").alias("role"), spans.cut(text, r["start"], r["end"]).alias("surface"), r["start"].alias("start"), r["end"].alias("end"), r["head"].alias("head"), F.when(wanted, F.coalesce(r["prompt"], r["head"])).alias("sam_prompt"), x.alias("decision"), wanted.alias("required_by_bcc"))

        return let(what, told)

    def whole(place: Column) -> Column:
        target = F.struct(F.lit("entity-00").alias("candidate_id"), F.lit("target_gt").alias("role"), spans.cut(text, place["start"], place["end"]).alias("surface"), place["start"].alias("start"), place["end"].alias("end"), place["head"].alias("head"), place["head"].alias("sam_prompt"))
        split = lambda every: F.struct(target.alias("target"), coreferences(tokens, place["start"], place["end"]).alias("coreferences"), F.filter(every, lambda c: c["required_by_bcc"]).alias("contexts"), F.filter(every, lambda c: ~c["required_by_bcc"]).alias("ignored"))
        return let(F.transform(phrases(text, tokens, chunks, place), numbered), split)

    begun = F.struct(question_target(text).alias("asked"), target_chunk(chunks).alias("chunk"))
    return F.when(~negative, let(let(let(let(begun, first), headed), placed), whole))
