"""Structural refinement of records before and after a model reads them, and what its requests may cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import masks, spans
from ..functions.binding import bound

#: Tracks a record and an entity may have; packets' expressions, tracks and reply tokens; prices.
MOST_TRACKS, MOST_PER_ENTITY = 64, 10
PACKET, UNION = 12, 24
REPLY_BASE, REPLY_EACH, REPLY_MOST = 4096, 768, 16384
LONG_INPUT = 272_000


def inspected(records: DataFrame, most: int = MOST_TRACKS, per_entity: int = MOST_PER_ENTITY) -> DataFrame:
    """The records with reason (null if sound), kept (track ids) and aliases (id, of).

    Tracks are taken with those of the main referent first. A track without a pixel goes, and one with the
    same masks in all frames as an earlier one becomes its alias. A negative record's tracks are those of its
    context groups alone. The reason is the first that applies, track by track.
    """
    frames, groups = F.col("frame_ids"), F.col("groups")
    none = F.array().cast("array<string>")
    mains = F.when(F.col("negative"), none).otherwise(spans.ids_of(groups, "main_referent"))
    context = F.array_except(spans.ids_of(groups, "context_entity"), spans.ids_of(groups, "main_referent"))
    tracks = F.when(F.col("negative"), F.filter("tracklets", lambda t: F.array_contains(F.col("_context"), t["tracklet_id"]))).otherwise(F.col("tracklets"))
    d = bound(bound(records, _mains=mains, _context=context), _tracks=tracks)
    is_main = lambda t: F.array_contains(F.col("_mains"), t["tracklet_id"])
    d = bound(d, _tracks=F.concat(F.filter("_tracks", is_main), F.filter("_tracks", lambda t: ~is_main(t))))
    d = bound(d, _ids=F.transform("_tracks", lambda t: t["tracklet_id"]))

    def state(t: Column, i: Column) -> Column:
        again = F.array_contains(F.slice(F.col("_ids"), F.lit(1), i), t["tracklet_id"])
        runs_ok = F.forall(t["masks"], lambda m: m.isNull() | masks.well_formed(m["size"], m["counts"]))
        seen = F.size(masks.visible(t["masks"])) > 0
        why = F.when(again | (F.coalesce(F.size(t["masks"]), F.lit(0)) != F.size(frames)), "invalid_tracklet_alignment").when(~F.coalesce(runs_ok, F.lit(False)), "invalid_mask_rle").when(~seen & F.array_contains(F.col("_mains"), t["tracklet_id"]), "empty_main_referent")
        return F.struct(t["tracklet_id"].alias("id"), why.alias("why"), seen.alias("seen"), F.sha2(F.to_json(F.struct(frames.alias("f"), t["masks"].alias("m")), {"ignoreNullFields": "false"}), 256).alias("sign"))

    d = bound(d, _states=F.transform("_tracks", state))
    d = bound(d, _shown=F.filter("_states", lambda s: s["seen"]))
    first_of = lambda s: F.get(F.filter(F.col("_shown"), lambda o: o["sign"] == s["sign"]), F.lit(0))["id"]
    d = bound(d, _alias=F.transform("_shown", lambda s: F.struct(s["id"].alias("id"), first_of(s).alias("of"))))
    d = bound(d, kept=F.transform(F.filter("_alias", lambda a: a["id"] == a["of"]), lambda a: a["id"]), aliases=F.filter("_alias", lambda a: a["id"] != a["of"]))
    track_fault = F.get(F.array_compact(F.transform("_states", lambda s: s["why"])), F.lit(0))
    reason = (
        F.when((F.size(frames) == 0) | (F.size(F.array_distinct(frames)) < F.size(frames)), "invalid_frame_sequence")
        .when(~F.col("negative") & (F.size("_mains") == 0), "missing_main_referent")
        .when(track_fault.isNotNull(), track_fault)
        .when(F.size(F.array_except("_mains", "_ids")) > 0, "missing_main_referent")
        .when(F.size("kept") > most, "excessive_tracklets")
        .when(crowded(groups, F.col("kept"), F.col("aliases"), per_entity), "excessive_entity_link")
    )
    return bound(d, reason=reason).select(*records.columns, "reason", "kept", "aliases")


def renamed(ids: Column, aliases: Column, kept: Column) -> Column:
    """Ids with aliases put in place, without those that are not kept."""
    of = lambda x: F.coalesce(F.get(F.filter(aliases, lambda a: a["id"] == x), F.lit(0))["of"], x)
    return F.array_intersect(F.array_distinct(F.transform(ids, of)), kept)


def crowded(groups: Column, kept: Column, aliases: Column, most: int) -> Column:
    """Whether a group, or all groups on one span together, have more than `most` distinct tracks."""
    own = F.transform(groups, lambda g: F.struct(renamed(g["tracklet_ids"], aliases, kept).alias("tracklet_ids"), g["text_spans"].alias("text_spans")))
    many = F.exists(own, lambda g: F.size(g["tracklet_ids"]) > most)
    return F.coalesce(many | F.exists(spans.links(own), lambda x: F.size(x["tracklet_ids"]) > most), F.lit(False))


def merged_groups(sound: DataFrame) -> DataFrame:
    """Inspected records with entries: groups alike in role, identity and spans as one, in order, numbered from 1,
    with the sorted union of their kept tracks. Groups without a kept track go; a negative record keeps context."""
    some = F.filter("groups", lambda g: ~F.col("negative") | (g["role"] == "context_entity"))
    own = F.transform(some, lambda g: F.struct(F.struct(g["role"].alias("role"), g["identity"].alias("identity"), g["text_spans"].alias("text_spans")).alias("key"), renamed(g["tracklet_ids"], F.col("aliases"), F.col("kept")).alias("ids")))
    d = bound(bound(sound, _g=own), _g=F.filter("_g", lambda g: F.size(g["ids"]) > 0))
    d = bound(d, _keys=F.array_distinct(F.transform("_g", lambda g: g["key"])))
    ids = lambda k: F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter(F.col("_g"), lambda g: g["key"] == k), lambda g: g["ids"]))))
    d = bound(d, _each=F.transform("_keys", ids))
    entry = lambda k, i: F.struct((i + 1).alias("id"), k["role"].alias("role"), k["identity"].alias("identity"), k["text_spans"].alias("text_spans"), F.get("_each", i).alias("tracklet_ids"), F.size(F.get("_each", i)).alias("candidates"))
    return bound(d, entries=F.transform("_keys", entry)).drop("_g", "_keys", "_each")


def visual_ids(tracks: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(video_key, sign, visual_id): ids of distinct track signs of a video by first appearance, after those known.

    tracks: video_key, sample_id, place, sign. The first appearance is a map-side least; only distinct signs are
    ranked, and those of one video alone meet in a task.
    """
    first = tracks.groupBy("video_key", "sign").agg(F.min(F.struct("sample_id", "place")).alias("at"))
    rank = F.row_number().over(Window.partitionBy("video_key").orderBy("at", "sign"))
    if known is None:
        return first.select("video_key", "sign", rank.alias("visual_id"))
    base = known.groupBy("video_key").agg(F.max("visual_id").alias("base"))
    fresh = first.join(known.select("video_key", "sign"), ["video_key", "sign"], "left_anti").join(base, "video_key", "left")
    return known.select("video_key", "sign", "visual_id").union(fresh.select("video_key", "sign", (rank + F.coalesce("base", F.lit(0))).alias("visual_id")))


def chunks(items: DataFrame, group: str, order: str, ids: str, most: int = PACKET, union: int = UNION) -> DataFrame:
    """The items with chunk: in order, a chunk is closed before an item that would be its `most` + first or take its
    distinct ids over `union`. A group's items meet as ids alone and are few: one video's expressions."""
    item = F.struct(F.col(order).alias("o"), F.col(ids).alias("ids"))
    all_of = items.groupBy(group).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    start = F.struct(F.array().cast("array<int>").alias("of"), F.lit(-1).alias("chunk"), F.lit(0).alias("n"), F.array().cast(items.schema[ids].dataType).alias("met"))

    def step(a: Column, x: Column) -> Column:
        full = (a["chunk"] < 0) | (a["n"] >= most) | (F.size(F.array_union(a["met"], x["ids"])) > union)
        at = F.when(full, a["chunk"] + 1).otherwise(a["chunk"])
        met = F.when(full, F.array_distinct(x["ids"])).otherwise(F.array_union(a["met"], x["ids"]))
        return F.struct(F.concat(a["of"], F.array(at)).alias("of"), at.alias("chunk"), F.when(full, 1).otherwise(a["n"] + 1).alias("n"), met.alias("met"))

    numbered = all_of.select(group, F.explode(F.zip_with("_items", F.aggregate("_items", start, step)["of"], lambda x, c: F.struct(x["o"].alias(order), c.alias("chunk")))).alias("r"))
    return items.join(numbered.select(group, F.col(f"r.{order}").alias(order), F.col("r.chunk").alias("chunk")), [group, order])


def relinked(groups: Column, mentions: Column, text: Column) -> Column:
    """Groups by id with the spans that a reply's mentions (id, start, stop) give them; groups not mentioned go."""
    mine = lambda g: F.filter(mentions, lambda m: m["id"] == g["id"])
    places = lambda g: F.array_sort(F.transform(mine(g), lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("end"), spans.cut(text, m["start"], m["stop"]).alias("text"))))
    new = F.transform(groups, lambda g: F.struct(g["id"].alias("id"), g["role"].alias("role"), g["identity"].alias("identity"), places(g).alias("text_spans"), g["tracklet_ids"].alias("tracklet_ids")))
    return F.filter(new, lambda g: F.size(g["text_spans"]) > 0)


def applied(replies: DataFrame, repair: bool = False, per_entity: int = MOST_PER_ENTITY) -> DataFrame:
    """Replies put into their records: new_text, new_groups, new_links, new_disposition, and error where one can't be.

    replies: text, negative, decision, tagged, parsed (text, mentions, error), entries (id, role, ..., tracklet_ids).
    With `repair` only links may change: the text stays, and nothing is rejected. Otherwise a reply may reword a
    positive record, and has to keep its main referent; a span with too many tracks makes it a rejection.
    """
    mains = F.transform(F.filter("entries", lambda g: g["role"] == "main_referent"), lambda g: g["id"])
    said = F.array_distinct(F.transform("parsed.mentions", lambda m: m["id"]))
    silent = F.col("negative") & (F.col("tagged") == F.col("text"))
    dropped = ~F.col("negative") & (F.size(F.array_except(mains, said)) > 0)
    changed = F.col("parsed.text") != F.col("text")
    fixed = F.lit(True) if repair else F.col("negative")
    rejects = F.col("decision") == "reject"
    error = (
        F.when(F.lit(repair) & ~F.col("decision").isin("keep", "rewrite"), "not_a_repair")
        .when(rejects & (F.col("tagged") != ""), "rejected_with_caption")
        .when(~rejects & ~silent, F.coalesce(F.col("parsed.error"), F.when(fixed & changed, "text_changed"), F.when(dropped, "main_referent_dropped")))
    )
    d = replies.withColumn("_error", error)
    empty = F.slice(F.col("entries"), 1, 0)
    groups = F.when(d["_error"].isNull() & ~rejects & ~silent, relinked(F.col("entries"), F.col("parsed.mentions"), F.col("parsed.text"))).otherwise(relinked(empty, F.col("parsed.mentions"), F.col("text")))
    d = d.withColumn("new_groups", groups).withColumn("new_links", spans.links(F.col("new_groups")))
    over = F.exists("new_links", lambda x: F.size(x["tracklet_ids"]) > per_entity) & ~F.lit(repair)
    outcome = F.when(F.col("negative"), F.when(F.size("new_groups") > 0, "negative_with_context").otherwise("negative_unsegmentable")).otherwise("complete_bcc")
    final = F.when(d["_error"].isNull() & over, "reject").when(d["_error"].isNull(), F.col("decision")).otherwise("error")
    return d.select(
        "*",
        F.coalesce("_error", F.when(over, "excessive_entity_link")).alias("error"),
        final.alias("outcome"),
        F.when(final.isin("keep", "rewrite"), F.when(silent | fixed, F.col("text")).otherwise(F.col("parsed.text"))).alias("new_text"),
        F.when(final.isin("keep", "rewrite"), outcome).alias("new_disposition"),
    ).drop("_error")


def sampled_frames(n: Column, first_seen: Column, most: int) -> Column:
    """Numbers of `most` frames evenly from the first to the last, and the first one in which each track is seen."""
    k = F.least(n, F.lit(most))
    even = F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.when(k > 1, F.floor(i * (n - 1) / F.greatest(k - 1, F.lit(1))).cast("int")).otherwise(F.lit(0)))
    return F.array_sort(F.array_distinct(F.concat(even, F.array_compact(first_seen))))


def reply_tokens(expressions: Column) -> Column:
    return F.least(F.lit(REPLY_MOST), F.lit(REPLY_BASE) + REPLY_EACH * expressions)


def input_bound(text_bytes: Column, images: Column) -> Column:
    """Tokens that a request can't exceed: a byte each and 4096 for the frame, eight for each patch of 32 by 32."""
    patches = F.aggregate(images, F.lit(0).cast("long"), lambda a, x: a + F.floor((x["width"] + 31) / 32) * F.floor((x["height"] + 31) / 32) * 8)
    return text_bytes + 4096 + patches


def most_cost(inputs: Column, reply: Column, batch: bool = True) -> Column:
    """Upper bound of a request's price in dollars; beyond LONG_INPUT the dearer rates hold."""
    long = inputs > LONG_INPUT
    return F.lit(0.5 if batch else 1.0) * (inputs * F.when(long, 0.25).otherwise(0.125) + reply * F.when(long, 0.75).otherwise(0.5)) / 1e6


def used_cost(inputs: Column, cached: Column, written: Column, reply: Column, batch: bool = True) -> Column:
    """The price of what a reply reports; where it does not report cache writes (null), uncached input counts as such."""
    rest = F.greatest(inputs - F.coalesce(cached, F.lit(0)) - F.coalesce(written, F.lit(0)), F.lit(0))
    paid = rest * F.when(written.isNotNull(), 0.1).otherwise(0.125) + F.coalesce(cached, F.lit(0)) * 0.01 + F.coalesce(written, F.lit(0)) * 0.125
    long = inputs > LONG_INPUT
    return F.lit(0.5 if batch else 1.0) * (paid * F.when(long, 2).otherwise(1) + reply * F.when(long, 0.75).otherwise(0.5)) / 1e6


def permitted(tagged: Column, ids: Column) -> Column:
    """Whether a caption's brackets are all tags of these ids."""
    some = F.concat(F.lit(r"^(?:[^\[\]]|\[/?(?:"), F.array_join(ids.cast("array<string>"), "|"), F.lit(r")\])*+$"))
    return F.when(F.size(ids) > 0, F.regexp_like(tagged, some)).otherwise(~F.contains(tagged, F.lit("[")) & ~F.contains(tagged, F.lit("]")))


def queue_limit(code: Column, message: Column) -> Column:
    """(queued, limit): whether an error speaks of queued tokens, and the limit it names."""
    low = F.lower(message)
    queued = code.isin("token_limit_exceeded", "batch_token_limit_exceeded", "enqueued_token_limit_exceeded") | (low.contains("token") & (low.contains("enqueued") | low.contains("queue limit") | low.contains("queued token")))
    limit = F.regexp_replace(F.regexp_extract(message, r"(?i)\blimit\s*:\s*([\d,]+)", 1), ",", "")
    return F.struct(queued.alias("queued"), F.when(queued & (limit != ""), limit.cast("long")).alias("limit"))


def redacted(text: Column) -> Column:
    """Keys of two well-known forms become a mark."""
    return F.regexp_replace(text, r"\b(?:sk-|hf_)[A-Za-z0-9_-]+", "[redacted]")


def retries(packets: DataFrame, responses: DataFrame, decisions: DataFrame) -> DataFrame:
    """(request_id, invalid): for packets that are no retries and have a stored response, the samples whose decision
    is an error that no retry has followed; packets: request_id, retry_of, samples."""
    bad = decisions.where((F.col("decision") == "error") & F.col("retry_of").isNull()).select("sample_id")
    asked = packets.where(F.col("retry_of").isNull()).join(responses.select("request_id").distinct(), "request_id", "left_semi")
    each = asked.select("request_id", F.explode("samples").alias("sample_id")).join(bad.distinct(), "sample_id", "left_semi")
    return each.groupBy("request_id").agg(F.array_sort(F.collect_set("sample_id")).alias("invalid"))


def pending(packets: DataFrame, submitted: DataFrame, responses: DataFrame) -> DataFrame:
    """Packets neither submitted nor answered."""
    return packets.join(submitted.select("request_id").distinct(), "request_id", "left_anti").join(responses.select("request_id").distinct(), "request_id", "left_anti")
