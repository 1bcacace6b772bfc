"""What a model is sent of records with tracks: packets by video, their frames and inventory, and request bodies whose
schema says, for each expression, which tags its caption may have."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import spans
from . import refine, replies, requests
from .steps import written

#: The model and the form of its reply.
MODEL, EFFORT, NAME = "gpt-6-luna", "medium", "concor_video_refinement"
DECISIONS = ("keep", "rewrite", "reject")
AGAIN = "\nYour previous output failed local validation. Correct the listed validation_errors while following every original task constraint."
REF = "array<struct<tracklet_id:string,visual_id:int>>"
SHOWN = f"array<struct<role:string,identity:string,ids:array<int>,text_spans:array<{spans.SPAN}>>>"


def _ids(groups_ids: Column, refs: Column) -> Column:
    """Visual ids of local ones, sorted, each once; ids without one go."""
    of = lambda t: F.get(F.filter(refs, lambda r: r["tracklet_id"] == t), F.lit(0))["visual_id"]
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(F.coalesce(groups_ids, F.array().cast("array<string>")), of))))


def entries(inspected: DataFrame, named: DataFrame) -> DataFrame:
    """(video_key, sample_id, frame_ids, ids, expression, mapping, refs) of sound records: what a model may see of each, what
    its reply is put back with, and the visual id of every local one, aliases as that of the track they repeat.

    Sound records of a video whose frame lists differ end the job. named: `requests.visual_tracks`.
    """
    sound = inspected.where("reason is null").withColumn("video_key", F.concat_ws("::", "dataset", "split", "video_id"))
    lists = sound.groupBy("video_key").agg(F.min("frame_ids").alias("_least"), F.max("frame_ids").alias("_most"))
    own = named.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("tracklet_id", "visual_id"))).alias("_own"))
    d = sound.join(lists, "video_key").join(own, "sample_id", "left")
    same = F.when(F.col("_least") == F.col("_most"), F.col("video_key")).otherwise(F.raise_error(F.concat(F.lit("frame lists differ in "), "video_key")))
    d = d.select(same.alias("video_key"), "sample_id", "frame_ids", "text", "negative", "target_source", "groups", "aliases", F.coalesce("_own", F.array().cast(REF)).alias("_own"))
    extra = F.transform("aliases", lambda a: F.struct(a["id"].alias("tracklet_id"), F.get(F.filter("_own", lambda o: o["tracklet_id"] == a["of"]), F.lit(0))["visual_id"].alias("visual_id")))
    d = d.withColumn("refs", F.concat("_own", F.filter(extra, lambda r: r["visual_id"].isNotNull()).cast(REF)))
    allowed = F.array_sort(F.transform("_own", lambda o: o["visual_id"]))
    mains = F.when(F.col("negative"), F.array().cast("array<int>")).otherwise(_ids(spans.ids_of(F.col("groups"), "main_referent"), F.col("refs")))
    shown = F.transform("groups", lambda g: F.struct(g["role"].alias("role"), g["identity"].alias("identity"), _ids(g["tracklet_ids"], F.col("refs")).alias("ids"), g["text_spans"].alias("text_spans"))).cast(SHOWN)
    back = F.transform("_own", lambda o: F.struct(o["visual_id"].alias("id"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("identity"), F.array().cast(f"array<{spans.SPAN}>").alias("text_spans"), F.array(o["tracklet_id"]).alias("tracklet_ids")))
    expression = F.struct("sample_id", F.col("text").alias("existing_text"), "negative", allowed.alias("allowed_ids"), mains.alias("main_ids"), "target_source", shown.alias("existing_groups"))
    mapping = F.struct("sample_id", mains.alias("main_ids"), F.array_sort(back).alias("entries")).cast(replies.MAPPING)
    return d.select("video_key", "sample_id", "frame_ids", allowed.alias("ids"), expression.alias("expression"), mapping.alias("mapping"), "refs")


def visual_manifests(inspected: DataFrame, prompt: str, frames: int = 12, known: DataFrame | None = None, size: int = refine.PACKET, union: int = refine.UNION) -> DataFrame:
    """(request_id, stage, video_key, packet, mapping, expressions, max_output_tokens) of all sound records.

    A video's records go in order of their ids into packets of at most `size` expressions and `union` tracks. A packet
    names its frames, those chosen (`frames` of them evenly, and the first one that shows each track), an inventory of its
    tracks, and its expressions. A track's source and proposal are those of the video's last record that has it. The
    request's id follows from the prompt, the packet and the tracks' masks. A video's expressions are few and meet as
    such; tracks meet as ids, never with their masks.
    """
    named = written(requests.visual_tracks(inspected, known), "visual_tracks")
    each = written(entries(inspected, named), "visual_entries")
    packed = refine.chunks(each.select("video_key", "sample_id", "ids"), "video_key", "sample_id", "ids", size, union)
    p = each.join(packed.select("video_key", "sample_id", "chunk"), ["video_key", "sample_id"]).groupBy("video_key", "chunk")
    by_id = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("sample_id", c))), lambda x: x[c])
    p = p.agg(by_id("expression").alias("expressions"), by_id("mapping").alias("mapping"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"), F.max("frame_ids").alias("frame_ids"))
    track = named.groupBy("video_key", "visual_id").agg(F.max_by(F.struct("source", "sam_prompt"), F.struct("sample_id", "place")).alias("said"), F.max("visible").alias("visible"), F.max("sign").alias("sign"))
    item = F.struct(F.col("visual_id").alias("id"), F.col("said.source").alias("source"), F.col("said.sam_prompt").alias("proposal"), F.col("visible").alias("visible_frame_indices"), "sign")
    used = p.select("video_key", "chunk", F.explode("ids").alias("visual_id")).join(track, ["video_key", "visual_id"]).groupBy("video_key", "chunk").agg(F.array_sort(F.collect_list(item)).alias("tracks"))
    p = p.join(used, ["video_key", "chunk"], "left")
    kinds = "array<struct<id:int,source:string,proposal:string,visible_frame_indices:array<int>,sign:string>>"
    p = p.withColumn("tracks", F.coalesce("tracks", F.array().cast(kinds)))
    first = F.transform("tracks", lambda t: F.get(t["visible_frame_indices"], F.lit(0)))
    inventory = F.transform("tracks", lambda t: t.dropFields("sign"))
    packet = F.struct(F.split("video_key", "::").alias("video"), "frame_ids", refine.sampled_frames(F.size("frame_ids"), first, frames).alias("selected_frame_indices"), inventory.alias("tracklets"), "expressions")
    p = p.withColumn("packet", packet)
    name = requests.request_id(F.lit(prompt), F.to_json("packet", {"ignoreNullFields": "false"}), F.transform("tracks", lambda t: t["sign"]))
    return p.select(name.alias("request_id"), F.lit("visual").alias("stage"), "video_key", "packet", "mapping", "expressions", refine.reply_tokens(F.size("expressions")).alias("max_output_tokens"))


def caption_pattern(ids: Column) -> Column:
    """The pattern of captions whose brackets are all tags of these ids."""
    return F.concat(F.lit(r"^(?:[^\[\]]|\[/?(?:"), F.array_join(ids.cast("array<string>"), "|"), F.lit(r")\])*$"))


def response_schema(expressions: Column, text_only: Column) -> Column:
    """The schema of a reply as JSON text: one variant for each expression, with its own id, its decisions and its tags; a
    negative one without tracks may only come back as it is, or empty. Text-only stages reject nothing."""
    string, texts = F.struct(F.lit("string").alias("type")), lambda values: F.struct(F.lit("string").alias("type"), values.alias("enum"))
    every = F.array(*map(F.lit, DECISIONS))
    bare = lambda e: e["negative"] & (F.size(e["allowed_ids"]) == 0)
    caption = lambda e: F.struct(F.lit("string").alias("type"), F.when(bare(e), F.array(F.lit(""), e["existing_text"])).alias("enum"), F.when(~bare(e), caption_pattern(e["allowed_ids"])).alias("pattern"))
    codes = F.struct(F.lit("array").alias("type"), string.alias("items"))
    properties = lambda e: F.struct(texts(F.array(e["sample_id"])).alias("sample_id"), texts(F.when(text_only, F.slice(every, 1, 2)).otherwise(every)).alias("decision"), caption(e).alias("tagged_caption"), codes.alias("reason_codes"))
    item = lambda e: F.struct(F.lit("object").alias("type"), F.lit(False).alias("additionalProperties"), F.array(*map(F.lit, ("sample_id", "decision", "tagged_caption", "reason_codes"))).alias("required"), properties(e).alias("properties"))
    results = F.struct(F.lit("array").alias("type"), F.struct(F.transform(expressions, item).alias("anyOf")).alias("items"))
    whole = F.struct(F.lit("object").alias("type"), F.lit(False).alias("additionalProperties"), F.array(F.lit("results")).alias("required"), F.struct(results.alias("results")).alias("properties"))
    return whole


def request_bodies(manifests: DataFrame, prompt: str, images: str | None = None) -> DataFrame:
    """(request_id, body): each manifest as the JSON text of a request. `images` names a column of JPEG bytes, one for each
    chosen frame, which follow their captions; without it a request holds text alone. A retry's prompt says so, and its
    packet carries what was wrong."""
    packet = F.col("packet")
    text = lambda said: F.struct(F.lit("input_text").alias("type"), said.alias("text"), F.lit(None).cast("string").alias("detail"), F.lit(None).cast("string").alias("image_url"))
    about = lambda i: F.concat(F.lit("Source frame "), F.get(packet["frame_ids"], i), F.lit(": left=original; right=candidate tracklet overlay."))
    picture = lambda data: F.struct(F.lit("input_image").alias("type"), F.lit(None).cast("string").alias("text"), F.lit("high").alias("detail"), F.concat(F.lit("data:image/jpeg;base64,"), F.regexp_replace(F.base64(data), r"\s", "")).alias("image_url"))
    retry = "validation_errors" in manifests.columns
    said = F.to_json(F.struct(packet.alias("packet"), F.col("validation_errors")) if retry else packet)
    shown = F.flatten(F.zip_with(packet["selected_frame_indices"], F.col(images), lambda i, data: F.array(text(about(i)), picture(data)))) if images else F.array().cast("array<struct<type:string,text:string,detail:string,image_url:string>>")
    content = F.concat(shown, F.array(text(said)))
    asked = F.concat(F.lit(prompt), F.when(F.col("retry_of").isNotNull(), AGAIN).otherwise("")) if "retry_of" in manifests.columns else F.lit(prompt)
    form = F.struct(F.lit("json_schema").alias("type"), F.lit(NAME).alias("name"), F.lit(True).alias("strict"), response_schema(F.col("expressions"), F.col("stage") == "nlp").alias("schema"))
    body = F.struct(F.lit(MODEL).alias("model"), F.struct(F.lit(EFFORT).alias("effort")).alias("reasoning"), F.lit(False).alias("store"), asked.alias("instructions"), F.array(F.struct(F.lit("user").alias("role"), content.alias("content"))).alias("input"), F.struct(form.alias("format")).alias("text"), "max_output_tokens")
    return manifests.select("request_id", F.to_json(body).alias("body"))
