"""Replies of a model: read, checked for cover, put into their records one by one, and asked for again once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import captions, spans
from ..functions.binding import bound
from . import records
from .refine import MOST_PER_ENTITY
from .requests import request_id
from .steps import written

# Form of a reply, and what a decision says of one that can't be used.
BODY = "struct<status:string,output:array<struct<type:string,content:array<struct<type:string,text:string>>>>>"
RESULT = "struct<sample_id:string,decision:string,tagged_caption:string,reason_codes:array<string>>"
INCOMPLETE, UNREADABLE, UNCOVERED = "model response incomplete or failed", "unreadable response", "missing, duplicate or unexpected sample_id in grouped response"
CROWDED = "excessive_entity_link"

ENTRY = f"struct<id:int,role:string,identity:string,text_spans:array<{spans.SPAN}>,tracklet_ids:array<string>>"
#: What a packet keeps of each of its samples: groups by id (text), or the track of each visual id; and the main ids.
MAPPING = f"struct<sample_id:string,main_ids:array<int>,entries:array<{ENTRY}>>"


def read(responses: DataFrame, packets: DataFrame) -> DataFrame:
    """(request_id, stage, retry_of, sample_id, mapping, result) of every sample of a packet that has a response.

    responses: request_id, body (JSON). packets: request_id, stage, retry_of, mapping. A response that failed, can't be
    read, or does not say each sample of its packet exactly once gives an error for all of them.
    """
    j = packets.join(responses.select("request_id", F.from_json("body", BODY).alias("b")), "request_id")
    said = F.filter("b.output", lambda o: o["type"] == "message")
    text = F.array_join(F.flatten(F.transform(said, lambda o: F.transform(F.filter(o["content"], lambda c: c["type"] == "output_text"), lambda c: c["text"]))), "")
    j = bound(j, results=F.from_json(text, f"results array<{RESULT}>")["results"])
    ids, wanted = F.transform("results", lambda r: r["sample_id"]), F.transform("mapping", lambda m: m["sample_id"])
    fault = (
        F.when(~F.coalesce(F.col("b.status") == "completed", F.lit(False)), INCOMPLETE)
        .when(F.col("results").isNull(), UNREADABLE)
        .when(~F.coalesce(F.array_sort(ids) == F.array_sort(wanted), F.lit(False)), UNCOVERED)
    )
    one = bound(j, fault=fault).select("request_id", "stage", "retry_of", "results", "fault", F.explode("mapping").alias("mapping"))
    own = F.get(F.filter("results", lambda r: r["sample_id"] == F.col("mapping")["sample_id"]), F.lit(0))
    lost = F.struct(F.col("mapping")["sample_id"].alias("sample_id"), F.lit("error").alias("decision"), F.lit("").alias("tagged_caption"), F.array("fault").alias("reason_codes")).cast(RESULT)
    return one.select("request_id", "stage", "retry_of", F.col("mapping")["sample_id"].alias("sample_id"), "mapping", F.when(F.col("fault").isNull(), own).otherwise(lost).alias("result"))


def rebuilt(asked: DataFrame, rows: DataFrame, version: str | None = records.VERSION) -> DataFrame:
    """The results put into their records: `rows` columns as they become, outcome (keep, rewrite, reject or error) and
    error.

    asked: those of `read`. In stage "nlp" only links may change: the text stays, nothing is rejected, an entity keeps all
    its tracks, and the disposition is left to the next stage. In the other stage each visual id is one track; a caption
    may be reworded but for a negative record, its main referents have to stay, and a span with too many tracks makes the
    result a rejection. The new record has to pass validation. A negative record whose text comes back as it is loses
    its tracks and groups. Tracks that no mention names go.
    """
    keep = [c for c in rows.columns if c != "sample_id"]
    d = asked.join(rows, "sample_id")
    nlp = F.col("stage") == "nlp"
    ids = F.transform("mapping.entries", lambda e: e["id"])
    d = bound(d, tagged=F.coalesce("result.tagged_caption", F.lit("")), decision=F.coalesce("result.decision", F.lit("error")))
    d = bound(d, parsed=captions.parsed(F.col("tagged"), ids))
    silent = F.col("negative") & (F.col("tagged") == F.col("text"))
    said = F.array_distinct(F.transform("parsed.mentions", lambda m: m["id"]))
    dropped = ~F.col("negative") & (F.size(F.array_except(F.col("mapping.main_ids"), said)) > 0)
    first = F.coalesce(F.array_join("result.reason_codes", ", "), F.lit("error"))
    why = (
        F.when(F.col("decision") == "error", first)
        .when(nlp & ~F.col("decision").isin("keep", "rewrite"), "not_a_repair")
        .when(~F.col("decision").isin("keep", "rewrite", "reject"), "unknown_decision")
        .when((F.col("decision") == "reject") & (F.col("tagged") != ""), "rejected_with_caption")
        .when((F.col("decision") != "reject") & ~silent, F.coalesce(F.col("parsed.error"), F.when((nlp | F.col("negative")) & (F.col("parsed.text") != F.col("text")), "text_changed"), F.when(dropped, "main_referent_dropped")))
    )
    d = bound(d, error=why)
    live = F.col("error").isNull() & (F.col("decision") != "reject")
    mine = lambda e: F.array_sort(F.transform(F.filter("parsed.mentions", lambda m: m["id"] == e["id"]), lambda m: F.struct(m["start"].alias("start"), m["stop"].alias("end"), spans.cut(F.col("parsed.text"), m["start"], m["stop"]).alias("text"))))
    old = lambda t: F.get(F.filter("groups", lambda g: F.array_contains(g["tracklet_ids"], t)), F.lit(0))["identity"]
    prompt = lambda t: F.get(F.filter("tracklets", lambda x: x["tracklet_id"] == t), F.lit(0))["sam_prompt"]
    track = lambda e: F.get(e["tracklet_ids"], F.lit(0))
    role = lambda e: F.when(F.array_contains("mapping.main_ids", e["id"]), "main_referent").otherwise("context_entity")
    entries = F.array_sort("mapping.entries")
    group = lambda e: F.struct(F.when(nlp, F.format_string("nlp-%03d", e["id"])).otherwise(F.format_string("refined-%03d", e["id"])).alias("group_id"), F.when(nlp, e["role"]).otherwise(role(e)).alias("role"), F.when(nlp, e["identity"]).otherwise(F.coalesce(old(track(e)), prompt(track(e)), F.lit(""))).alias("identity"), mine(e).alias("text_spans"), e["tracklet_ids"].alias("tracklet_ids"))
    new = F.filter(F.transform(entries, group), lambda g: F.size(g["text_spans"]) > 0).cast(rows.schema["groups"].dataType.simpleString())
    d = bound(d, new_groups=F.when(live & ~silent, new).otherwise(F.array().cast(rows.schema["groups"].dataType.simpleString())))
    d = bound(d, new_links=spans.links(F.col("new_groups")).cast(rows.schema["span_links"].dataType.simpleString()))
    named = F.flatten(F.transform("new_groups", lambda g: g["tracklet_ids"]))
    by_id = F.transform(named, lambda t: F.get(F.filter("tracklets", lambda x: x["tracklet_id"] == t), F.lit(0)))
    stored = F.filter("tracklets", lambda x: F.array_contains(named, x["tracklet_id"]))
    d = bound(d, new_tracks=F.when(live & ~silent, F.when(nlp, stored).otherwise(by_id)).otherwise(F.slice("tracklets", 1, 0)))
    over = live & ~nlp & F.exists("new_links", lambda x: F.size(x["tracklet_ids"]) > MOST_PER_ENTITY)
    became = F.when(F.col("negative"), F.when(F.size("new_tracks") > 0, "negative_with_context").otherwise("negative_unsegmentable")).otherwise("complete_bcc")
    d = bound(d, outcome=F.when(F.col("error").isNotNull(), "error").when(over, "reject").otherwise(F.col("decision")), over=over)
    changed = F.col("outcome").isin("keep", "rewrite")
    values = {"text": F.when(silent | nlp, F.col("text")).otherwise(F.col("parsed.text")), "tracklets": F.col("new_tracks"), "groups": F.col("new_groups"), "span_links": F.col("new_links"), "disposition": F.when(nlp, F.col("disposition")).otherwise(became)}
    out = d.select("request_id", "stage", "retry_of", "sample_id", *[F.when(changed, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in keep], "outcome", F.coalesce("error", F.when(F.col("over"), CROWDED)).alias("error"))
    broken = F.when(F.col("outcome").isin("keep", "rewrite") & (F.col("stage") != "nlp") & ~(F.col("negative") & (F.size("groups") == 0)), records.fault(version))
    out = bound(out, broken=broken)
    return out.withColumn("error", F.coalesce("error", "broken")).withColumn("outcome", F.when(F.col("broken").isNotNull(), "error").otherwise(F.col("outcome"))).drop("broken")


def asked_again(packets: DataFrame, results: DataFrame) -> DataFrame:
    """One more packet for each that is no retry itself, of those samples alone whose result is an error, with the errors.

    packets: request_id, stage, retry_of, mapping, expressions. The new id follows from the old one and the samples, so
    that a run that is resumed asks for the same."""
    bad = results.where("outcome = 'error'").groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("sample_id", "error"))).alias("bad"))
    p = packets.where("retry_of is null").drop("validation_errors").join(bad, "request_id")
    ids = F.transform("bad", lambda b: b["sample_id"])
    some = lambda c: F.filter(c, lambda x: F.array_contains(ids, x["sample_id"]))
    return p.select(request_id(F.col("request_id"), F.lit("validation-retry"), ids).alias("request_id"), "stage", F.col("request_id").alias("retry_of"), some("mapping").alias("mapping"), some("expressions").alias("expressions"), F.map_from_entries("bad").alias("validation_errors"))


def recovered(packets: DataFrame, charges: DataFrame, responses: DataFrame) -> DataFrame:
    """Packets to send in place of those that were reserved and never answered: each under a second id, once, as the first
    one's reservation may yet be charged. packets also: transport_retry_of. A recovery that is open itself ends the job."""
    stuck = packets.join(responses.select("request_id"), "request_id", "left_anti").join(charges.where("state = 'reserved'").select(F.col("id").alias("request_id")), "request_id", "left_semi")
    first = F.when(F.col("transport_retry_of").isNull(), F.col("request_id")).otherwise(F.raise_error(F.concat(F.lit("recovery has an unresolved charge: "), "request_id")))
    again = stuck.withColumn("transport_retry_of", first).withColumn("request_id", request_id(F.col("request_id"), F.lit("transport-recovery-v1")))
    return again.join(packets.select("request_id"), "request_id", "left_anti").select(*packets.columns)


def waves(packets: DataFrame, rows: DataFrame, send: Callable[[DataFrame], DataFrame], answered: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results, packets, responses) once all packets have been sent and those with errors once more.

    send: takes packets without a response and returns (request_id, body) of those that were answered. `answered` are
    responses from before, which are not asked for again. Tables between waves are written. Each sample's result is the
    one of the retry, where that was answered.
    """
    todo = packets.withColumns({"retry_of": F.lit(None).cast("string"), "validation_errors": F.lit(None).cast("map<string,string>")}).select("request_id", "stage", "retry_of", "mapping", "expressions", "validation_errors")
    got = answered.select("request_id", "body") if answered is not None else packets.sparkSession.createDataFrame([], "request_id string, body string")
    sent, results = None, None
    for _ in range(2):
        todo = written(todo, "packets")
        fresh = send(todo.join(got.select("request_id"), "request_id", "left_anti"))
        got = written(got.union(fresh.select("request_id", "body")), "responses")
        now = written(rebuilt(read(got, todo), rows), "results")
        sent = todo if sent is None else sent.unionByName(todo)
        todo, results = asked_again(todo, now), now if results is None else results.join(now.select("sample_id"), "sample_id", "left_anti").unionByName(now)
    return results, sent, got
