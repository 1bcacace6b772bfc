"""Correspondence records from detections: tracks assembled, told apart by overlap, merged and linked to their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import masks, spans
from ..functions.binding import bound, let
from . import tracks
from .records import VERSION

MASKS = "array<struct<size:array<int>,counts:array<bigint>>>"
TRACK = f"struct<tracklet_id:string,source:string,source_annotation_id:string,sam_prompt:string,confidence:double,max_confidence:double,present_frames:int,masks:{MASKS},sam_prompt_aliases:array<string>>"
GROUP = f"struct<group_id:string,role:string,identity:string,text_spans:array<{spans.SPAN}>,tracklet_ids:array<string>>"
REJECTION = "struct<sam_object_id:bigint,reason:string,temporal_iou:double,source_annotation_ids:array<string>>"
AUDIT = f"struct<role:string,sam_prompt:string,surface_spans:array<string>,raw_tracklets:int,retained_tracklets:int,rejections:array<{REJECTION}>>"

# What records say of sources, roles, outcomes and repairs.
OFFICIAL, MODEL_TARGET, MODEL_CONTEXT, CONTEXT_MODEL = "ground_truth", "sam3.1_main_referent", "sam3.1_context", "sam3.1_multiplex"
EXPECTED = "official_dataset_ground_truth"
MAIN, CONTEXT = "main_referent", "context_entity"
NO_OFFICIAL = "official_target_tracklet_empty_or_missing"
LIKE_TARGET, MERGED, STAYS = "duplicates_main_referent", "merged_duplicate_context_tracklet", "retained"
REPAIRED = "repaired invalid main-referent span deterministically"


def prompt_key(prompt: Column) -> Column:
    """Prompts are the same whatever their case and outer blanks."""
    return F.lower(F.regexp_replace(prompt, r"^\s+|\s+$", ""))


def _array(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def filled(seen: Column, n: Column) -> Column:
    """Masks of n frames from (frame_index, mask) sorted by frame, with null where a frame has none."""
    nulls = lambda k: F.array_repeat(F.lit(None).cast(MASKS[6:-1]), k.cast("int"))
    before = lambda i: F.coalesce(F.get(seen, i - 1)["frame_index"], F.lit(-1))
    parts = F.transform(seen, lambda s, i: F.concat(nulls(s["frame_index"] - before(i) - 1), F.array(s["mask"])))
    return F.concat(F.flatten(parts), nulls(n - 1 - F.coalesce(F.try_element_at(seen, F.lit(-1))["frame_index"], F.lit(-1))))


def assembled(detections: DataFrame, videos: DataFrame) -> DataFrame:
    """One track for each video, prompt and object: its mask in every frame (the last one that came), how many show it,
    pixels up to 64, mean and greatest score, and why it goes or "retained".

    detections: video_key, prompt, object_id, frame_index, seq (order of arrival), mask (null: none), score (null: 1).
    videos: video_key, frame_count. Frames outside a video count for nothing. A track that goes carries no masks.
    """
    d = detections.select("video_key", prompt_key(F.col("prompt")).alias("prompt_key"), F.col("object_id").cast("long").alias("object_id"), F.col("frame_index").cast("int").alias("frame_index"), "seq", "mask", F.coalesce("score", F.lit(1.0)).alias("score"))
    d = d.join(videos.select("video_key", F.col("frame_count").cast("int").alias("frame_count")), "video_key").where("frame_index >= 0 and frame_index < frame_count")
    key = ["video_key", "prompt_key", "object_id", "frame_count"]
    on = F.coalesce(masks.area(F.col("mask")["counts"]), F.lit(0).cast("long"))
    frame = d.groupBy(*key, "frame_index").agg(F.max_by("mask", "seq").alias("mask"), F.sum(F.col("score").cast("decimal(30,20)")).alias("sum"), F.count("*").alias("n"), F.max("score").alias("most"), F.sum(on).alias("on"))
    one = frame.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("frame_index", "mask"))).alias("seen"), F.sum("sum").alias("sum"), F.sum("n").alias("n"), F.max("most").alias("max_score"), F.least(F.lit(64), F.sum("on")).alias("pixels"))
    one = one.select(*key, "seen", "max_score", "pixels", (F.col("sum").cast("double") / F.col("n")).alias("mean_score"))
    one = bound(one, masks=filled(F.col("seen"), F.col("frame_count")))
    one = one.withColumn("present_frames", F.size(masks.visible(F.col("masks"))))
    why = tracks.judged(F.col("frame_count"), F.col("present_frames"), F.col("pixels"), F.col("max_score"), F.col("mean_score"))
    return one.select("video_key", "prompt_key", "object_id", "present_frames", "pixels", "mean_score", "max_score", why.alias("reason"), F.when(why == STAYS, F.col("masks")).alias("masks"))


def targeted(units: DataFrame) -> DataFrame:
    """Units whose target has a place in the text: one that has none gets that of its head, or of its prompt, whatever
    its case, or else the whole text, and a note that says so."""
    t, text = F.col("extraction")["target"], F.col("text")
    fine = F.coalesce((t["start"] >= 0) & (t["start"] < t["end"]) & (t["end"] <= F.length(text)), F.lit(False))
    word = F.trim(F.coalesce(F.nullif(t["head"], F.lit("")), t["sam_prompt"], F.lit("")))
    at = F.when(fine, F.struct(t["start"].cast("int").alias("start"), t["end"].cast("int").alias("end"))).otherwise(spans.repaired(text, F.lit(0), F.lit(0), word))
    u = bound(units, _fine=fine, _at=at)
    a = F.col("_at")
    moved = t.withField("start", a["start"]).withField("end", a["end"]).withField("surface", spans.cut(text, a["start"], a["end"]))
    e = F.col("extraction")
    notes = F.concat(F.coalesce(e["notes"], _array("string")), F.array(F.lit(REPAIRED)))
    mended = F.when(F.col("negative") | F.col("_fine"), e).otherwise(e.withField("target", moved).withField("notes", notes))
    return u.withColumn("extraction", mended).drop("_fine", "_at")


def _official(targets: DataFrame) -> DataFrame:
    seen = targets.where(F.size(masks.visible(F.col("masks"))) > 0)
    return seen.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct(F.col("place").cast("int").alias("place"), F.col("source_annotation_id").cast("string").alias("source_annotation_id"), "masks"))).alias("official"))


def _asked(u: DataFrame) -> DataFrame:
    """(sample_id, video_key, place, prompt_key): the target's prompt at -1 where the model has to find it, then the
    contexts' by their place. Without a chance of a target there is none."""
    target = F.when(F.col("by_model"), F.array(F.struct(F.lit(-1).alias("place"), F.col("target_prompt").alias("prompt"))))
    contexts = F.transform("prompt_groups", lambda g, i: F.struct(i.alias("place"), g["sam_prompt"].alias("prompt")))
    all_of = F.concat(F.coalesce(target, _array("struct<place:int,prompt:string>")), contexts)
    some = u.where(~F.col("negative") & (F.col("by_model") | (F.size("official") > 0)))
    return some.select("sample_id", "video_key", F.explode(all_of).alias("p")).select("sample_id", "video_key", "p.place", prompt_key(F.col("p.prompt")).alias("prompt_key"))


def _mains(threshold: Column) -> Column:
    """Target tracks: official ones by their place in the list, or those that the model retained."""
    name = lambda form, i: F.format_string(form, i)
    of = lambda i, source, annotation, prompt, mean, most, m: F.struct(i.alias("tracklet_id"), F.lit(source).alias("source"), annotation.alias("source_annotation_id"), prompt.alias("sam_prompt"), mean.alias("confidence"), most.alias("max_confidence"), F.size(masks.visible(m)).alias("present_frames"), m.alias("masks"), F.lit(None).cast("array<string>").alias("sam_prompt_aliases"))
    nothing, number = F.lit(None).cast("string"), F.lit(None).cast("double")
    given = F.transform("official", lambda t: of(name("gt-%03d", t["place"]), OFFICIAL, t["source_annotation_id"], nothing, F.lit(1.0), number, t["masks"]))
    found = F.filter("items", lambda x: (x["place"] == -1) & (x["reason"] == STAYS))
    made = F.transform(found, lambda x, i: of(name("sam-target-%03d", i + 1), MODEL_TARGET, nothing, F.col("target_prompt"), x["mean_score"], x["max_score"], x["masks"]))
    return F.when(threshold, given).otherwise(made)


def outcomes(contexts: Column, same: float, alike: float) -> Column:
    """(reason, iou, into) of each context track in order, given its overlap with the targets and with each track before
    it: one too like a target goes; one like an earlier track that stayed merges into the first such one (its number
    from 0); all others stay."""
    kind = "struct<reason:string,iou:double,into:int>"

    def step(done: Column, x: Column) -> Column:
        first = F.array_position(F.zip_with(done, x["overlaps"], lambda d, o: (d["reason"] == STAYS) & (o >= alike)), F.lit(True))

        def judged(at: Column) -> Column:
            near = x["target_overlap"] >= same
            reason = F.when(x["reason"] != STAYS, x["reason"]).when(near, LIKE_TARGET).when(at > 0, MERGED).otherwise(STAYS)
            return F.struct(reason.alias("reason"), F.when((x["reason"] == STAYS) & near, x["target_overlap"]).alias("iou"), F.when((x["reason"] == STAYS) & ~near & (at > 0), (at - 1).cast("int")).alias("into"))

        return F.concat(done, F.array(let(first, judged)).cast(f"array<{kind}>"))

    return F.aggregate(contexts, _array(kind), step)


def build_records(units: DataFrame, targets: DataFrame, found: DataFrame, threshold: float = 0.5, same_as_target: float = 0.65, same_as_context: float = 0.80, version: str = VERSION) -> DataFrame:
    """Records of units, each with its target's tracks, the context tracks that are none of these, and their spans.

    units: sample_id, dataset, split, cohort, annotation_protocol, provenance_warning, dataset_root, frame_source,
    video_key, video_id, expression_id, text, negative, frame_ids, target_source_expected, target_annotation_ids
    (strings), extraction (with target (start, end, surface, head, sam_prompt), target_coreference_spans, notes) and
    prompt_groups (sam_prompt, candidates (start, end, surface, head)). targets: sample_id, place (from 1),
    source_annotation_id, masks. found: the tracks of `assembled`.

    An official target is one with a pixel in some frame. Where none is official the model's tracks under the target's
    surface are the target, after their quality. Context prompts count only with a target. Each unit's tracks are one
    array, bounded by the objects that a model may follow and by its prompts. A target that should be official and isn't
    there is said in the audit, and so is each track that does not stay. A negative unit has neither tracks nor groups.
    """
    u = targeted(units).join(_official(targets), "sample_id", "left")
    target = F.col("extraction")["target"]
    prompt = F.trim(F.coalesce(F.nullif(target["surface"], F.lit("")), target["sam_prompt"], F.lit("")))
    groups = F.coalesce("prompt_groups", F.array().cast(units.schema["prompt_groups"].dataType))
    u = u.withColumns({"prompt_groups": groups, "target_prompt": prompt, "official": F.when(F.col("negative"), F.lit(None)).otherwise(F.col("official"))})
    u = u.withColumn("by_model", ~F.col("negative") & (F.col("target_source_expected") != EXPECTED) & F.col("official").isNull())
    u = u.withColumn("official", F.coalesce("official", _array(f"struct<place:int,source_annotation_id:string,masks:{MASKS}>")))
    item = f"struct<place:int,object_id:bigint,reason:string,mean_score:double,max_score:double,masks:{MASKS}>"
    got = _asked(u).join(found, ["video_key", "prompt_key"]).groupBy("sample_id")
    got = got.agg(F.array_sort(F.collect_list(F.struct("place", "object_id", "reason", "mean_score", "max_score", "masks"))).cast(f"array<{item}>").alias("items"))
    u = u.join(got, "sample_id", "left").withColumn("items", F.coalesce("items", _array(item)))

    u = bound(u, mains=_mains(F.size("official") > 0).cast(f"array<{TRACK}>"))
    has = F.size("mains") > 0
    u = bound(u, raw=F.when(has, F.filter("items", lambda x: x["place"] >= 0)).otherwise(_array(item)))
    near = lambda x: F.coalesce(F.array_max(F.transform("mains", lambda m: masks.overlap(x["masks"], m["masks"]))), F.lit(0.0))
    earlier = lambda x, i: F.transform(F.slice("raw", F.lit(1), i), lambda y: F.when((x["reason"] == STAYS) & (y["reason"] == STAYS), masks.overlap(x["masks"], y["masks"])).otherwise(0.0))
    told = F.transform("raw", lambda x, i: F.struct(x["reason"].alias("reason"), F.when(x["reason"] == STAYS, near(x)).otherwise(0.0).alias("target_overlap"), earlier(x, i).alias("overlaps")))
    u = bound(u, told=told)
    u = bound(u, done=outcomes(F.col("told"), same_as_target, same_as_context))
    numbers = F.filter(F.transform("done", lambda d, i: F.when(d["reason"] == STAYS, i)), lambda i: i.isNotNull())
    u = bound(u, stays=numbers)

    members = lambda k: F.filter(F.transform("raw", lambda x, i: F.when((i == k) | F.coalesce(F.get("done", i)["into"] == k, F.lit(False)), x["place"])), lambda p: p.isNotNull())
    candidates = lambda k: F.flatten(F.transform(members(k), lambda p: F.get("prompt_groups", p)["candidates"]))
    of = F.transform("stays", lambda k: F.struct(F.get("raw", k).alias("track"), F.array_sort(F.array_distinct(F.transform(members(k), lambda p: F.get("prompt_groups", p)["sam_prompt"]))).alias("prompts"), candidates(k).alias("candidates")))
    u = bound(u, contexts=of)
    text = F.col("text")
    context_id = lambda i: F.format_string("sam-context-%03d", i + 1)
    made = F.transform("contexts", lambda c, i: F.struct(context_id(i).alias("tracklet_id"), F.lit(MODEL_CONTEXT).alias("source"), F.lit(None).cast("string").alias("source_annotation_id"), F.get(c["prompts"], F.lit(0)).alias("sam_prompt"), c["track"]["mean_score"].alias("confidence"), c["track"]["max_score"].alias("max_confidence"), F.size(masks.visible(c["track"]["masks"])).alias("present_frames"), c["track"]["masks"].alias("masks"), c["prompts"].alias("sam_prompt_aliases")))
    place = lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), spans.cut(text, s["start"], s["end"]).alias("text"))
    ids = F.transform("mains", lambda m: m["tracklet_id"])
    main = F.struct(F.lit("main-referent").alias("group_id"), F.lit(MAIN).alias("role"), target["head"].alias("identity"), F.concat(F.array(place(target)), F.transform(F.coalesce(F.col("extraction")["target_coreference_spans"], _array(spans.SPAN)), lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), s["text"].alias("text")))).alias("text_spans"), ids.alias("tracklet_ids"))
    beside = F.transform("contexts", lambda c, i: F.struct(F.format_string("context-%03d", i + 1).alias("group_id"), F.lit(CONTEXT).alias("role"), F.array_join(F.array_sort(F.array_distinct(F.transform(c["candidates"], lambda x: x["head"]))), "/").alias("identity"), spans.unique(F.transform(c["candidates"], place)).alias("text_spans"), F.array(context_id(i)).alias("tracklet_ids")))
    groups = F.when(has, F.concat(F.array(main).cast(f"array<{GROUP}>"), beside.cast(f"array<{GROUP}>"))).otherwise(_array(GROUP))

    no_rows, no_ids = _array(REJECTION), F.lit(None).cast("array<string>")
    rejected = lambda x, d: F.struct(x["object_id"].alias("sam_object_id"), d["reason"].alias("reason"), d["iou"].alias("temporal_iou"), no_ids.alias("source_annotation_ids"))
    lost = F.struct(F.lit(MAIN).alias("role"), F.lit(None).cast("string").alias("sam_prompt"), F.array(target["surface"]).alias("surface_spans"), F.lit(0).alias("raw_tracklets"), F.lit(0).alias("retained_tracklets"), F.array(F.struct(F.lit(None).cast("bigint").alias("sam_object_id"), F.lit(NO_OFFICIAL).alias("reason"), F.lit(None).cast("double").alias("temporal_iou"), F.col("target_annotation_ids").alias("source_annotation_ids"))).alias("rejections"))
    own = F.filter("items", lambda x: x["place"] == -1)
    asked = F.struct(F.lit(MAIN).alias("role"), F.col("target_prompt").alias("sam_prompt"), F.array(target["surface"]).alias("surface_spans"), F.size(own).alias("raw_tracklets"), F.size("mains").alias("retained_tracklets"), F.transform(F.filter(own, lambda x: x["reason"] != STAYS), lambda x: F.struct(x["object_id"].alias("sam_object_id"), x["reason"].alias("reason"), F.lit(None).cast("double").alias("temporal_iou"), no_ids.alias("source_annotation_ids"))).alias("rejections"))

    def context_audit(g: Column, at: Column) -> Column:
        both = F.filter(F.zip_with("raw", "done", lambda x, d: F.struct(x["place"].alias("place"), d["reason"].alias("reason"), rejected(x, d).alias("row"))), lambda r: r["place"] == at)
        return let(both, lambda r: F.struct(F.lit(CONTEXT).alias("role"), g["sam_prompt"].alias("sam_prompt"), F.transform(g["candidates"], lambda c: c["surface"]).alias("surface_spans"), F.size(r).alias("raw_tracklets"), F.size(F.filter(r, lambda x: x["reason"].isin(STAYS, MERGED))).alias("retained_tracklets"), F.transform(F.filter(r, lambda x: x["reason"] != STAYS), lambda x: x["row"]).alias("rejections")))

    first = F.when(F.col("negative"), _array(AUDIT)).when((F.col("target_source_expected") == EXPECTED) & ~has, F.array(lost).cast(f"array<{AUDIT}>")).when(F.col("by_model"), F.array(asked).cast(f"array<{AUDIT}>")).otherwise(_array(AUDIT))
    second = F.when(has, F.transform("prompt_groups", context_audit).cast(f"array<{AUDIT}>")).otherwise(_array(AUDIT))
    u = bound(u, tracklets=F.concat("mains", made.cast(f"array<{TRACK}>")), groups=groups, audit=F.concat(first, second))
    u = bound(u, unresolved_required_prompts=F.transform(F.filter("audit", lambda a: (a["role"] == CONTEXT) & (a["retained_tracklets"] == 0)), lambda a: a["sam_prompt"]))
    what = F.when(F.col("negative"), "negative_unsegmentable").when(~has, "missing_main_referent").when(F.size("unresolved_required_prompts") > 0, "incomplete_context").otherwise("complete_bcc")
    made_by = F.struct(F.col("target_source_expected").alias("target_source"), F.lit(CONTEXT_MODEL).alias("context_source"), F.lit(threshold).alias("sam_output_prob_threshold"), F.lit(same_as_target).alias("duplicate_target_temporal_iou"), F.lit(same_as_context).alias("duplicate_context_temporal_iou"))
    keep = ["sample_id", "dataset", "split", "cohort", "annotation_protocol", "provenance_warning", "dataset_root", "frame_source", "video_id", "expression_id", "text", "negative"]
    return u.select(
        F.lit(version).alias("schema_version"), *keep, F.col("target_source_expected").alias("target_source"), what.alias("disposition"), "frame_ids",
        F.transform("frame_ids", lambda f: F.concat("video_id", F.lit("/"), f, F.lit(".jpg"))).alias("frame_files"),
        F.when(~F.col("negative"), F.col("unresolved_required_prompts")).alias("unresolved_required_prompts"),
        F.to_json("extraction").alias("extraction"), F.to_json("audit").alias("sam_prompt_audit"), F.to_json(made_by).alias("pipeline"), F.lit(None).cast("double").alias("runtime_seconds"),
        "tracklets", "groups", spans.links(F.col("groups")).alias("span_links"),
    )
