"""Spans of texts as structs (start, end, text), half open, in characters; and what groups of them say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,end:int,text:string>"


def cut(text: Column, start: Column, end: Column) -> Column:
    """text[start:end]."""
    return F.substring(text, start + 1, F.greatest(end - start, F.lit(0)))


def span(text: Column, start: Column, end: Column) -> Column:
    """The span from start to end, or null where the text has no such place."""
    ok = (start >= 0) & (start < end) & (end <= F.length(text))
    return F.when(ok, F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), cut(text, start, end).alias("text")))


def literal(text: Column, s: Column) -> Column:
    """Whether a span lies in the text and says what stands there."""
    return F.coalesce((s["start"] >= 0) & (s["start"] < s["end"]) & (s["end"] <= F.length(text)) & (cut(text, s["start"], s["end"]) == s["text"]), F.lit(False))


def trimmed(text: Column, start: Column, end: Column) -> Column:
    """Offsets without the white space at both ends; an all-blank stretch shrinks to its end."""
    part = cut(text, start, end)
    left = F.length(part) - F.length(F.regexp_replace(part, r"^\s+", ""))
    size = F.length(F.regexp_replace(part, r"^\s+|\s+$", ""))
    return F.struct((start + left).cast("int").alias("start"), (start + left + size).cast("int").alias("end"))


def unique(spans: Column) -> Column:
    """Spans by place, each once, in order."""
    return F.array_sort(F.array_distinct(spans))


def all_spans(groups: Column) -> Column:
    plain = lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), s["text"].alias("text"))
    return unique(F.flatten(F.transform(groups, lambda g: F.transform(F.coalesce(g["text_spans"], F.array().cast(f"array<{SPAN}>")), plain))))


def ids_on(groups: Column, s: Column) -> Column:
    """Sorted ids of all groups that have this span."""
    has = lambda g: F.exists(g["text_spans"], lambda o: (o["start"] == s["start"]) & (o["end"] == s["end"]) & (o["text"] == s["text"]))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(groups, has), lambda g: g["tracklet_ids"]))))


def links(groups: Column) -> Column:
    """The inverse of groups: every span once, in order, with the sorted ids of all groups on it."""
    return F.transform(all_spans(groups), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), ids_on(groups, s).alias("tracklet_ids")))


def owner(groups: Column, tracklet: Column) -> Column:
    """What the groups of one tracklet say: the first one's role, all identities, all spans."""
    own = F.filter(groups, lambda g: F.array_contains(g["tracklet_ids"], tracklet))
    names = F.array_join(F.array_sort(F.array_distinct(F.transform(own, lambda g: g["identity"]))), "/")
    return F.struct(F.get(own, F.lit(0))["role"].alias("role"), names.alias("identity"), all_spans(own).alias("text_spans"))


def ids_of(groups: Column, role: str | None = None) -> Column:
    """All distinct ids that groups (of one role) name."""
    some = groups if role is None else F.filter(groups, lambda g: g["role"] == role)
    return F.array_distinct(F.flatten(F.transform(some, lambda g: F.coalesce(g["tracklet_ids"], F.array().cast("array<string>")))))


def segments(text: Column, marks: Column, covers: Column | None = None) -> Column:
    """The text in stretches between the borders of marks (start, end, tracklet_ids), each with the ids that cover it:
    those of marks, or of `covers`, which may reach beyond the text."""
    covers = marks if covers is None else covers
    ends = F.flatten(F.transform(marks, lambda m: F.array(m["start"], m["end"])))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0), F.length(text)), ends)))
    pairs = F.zip_with(F.slice(cuts, 1, F.greatest(F.size(cuts) - 1, F.lit(0))), F.slice(cuts, 2, F.greatest(F.size(cuts) - 1, F.lit(0))), lambda a, z: F.struct(a.alias("start"), z.alias("end")))
    over = lambda p: F.filter(covers, lambda m: (m["start"] <= p["start"]) & (p["end"] <= m["end"]))
    ids = lambda p: F.array_sort(F.array_distinct(F.flatten(F.transform(over(p), lambda m: m["tracklet_ids"]))))
    return F.transform(pairs, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), cut(text, p["start"], p["end"]).alias("text"), ids(p).alias("tracklet_ids")))


def nearest(text: Column, phrase: Column, at: Column) -> Column:
    """Where the phrase stands in the text nearest to an offset (the leftmost of two), or null. Places are looked for
    from the left, each after the end of the one before."""
    size, last = F.length(phrase), F.length(text) - F.length(phrase)
    every = F.when((last >= 0) & (size > 0), F.filter(F.sequence(F.lit(0), last), lambda i: F.substring(text, i + 1, size) == phrase))
    first = F.struct(F.array().cast("array<int>").alias("out"), F.lit(0).alias("free"))
    step = lambda a, i: F.when(i >= a["free"], F.struct(F.concat(a["out"], F.array(i)).alias("out"), (i + size).alias("free"))).otherwise(a)
    places = F.aggregate(every, first, step)["out"]
    return F.array_min(F.transform(places, lambda i: F.struct(F.abs(i - at).alias("far"), i.alias("start"))))["start"]


def repaired(text: Column, start: Column, end: Column, head: Column) -> Column:
    """An empty span becomes that of its head word, whatever its case, or else of the whole text."""
    at = F.locate(F.lower(head), F.lower(text)) if isinstance(head, str) else F.instr(F.lower(text), F.lower(head))
    found = F.when((at > 0) & (F.length(head) > 0), F.struct((at - 1).alias("start"), (at - 1 + F.length(head)).alias("end")))
    whole = F.struct(F.lit(0).alias("start"), F.length(text).alias("end"))
    return F.when(start < end, F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))).otherwise(F.coalesce(found, whole))
