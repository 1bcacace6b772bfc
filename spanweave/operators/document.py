"""A reviewer's document: read under its version, completed for the rows it belongs to, checked, and applied to records."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decisions
from .records import _fs, rename, write_text
from .steps import written

# Names of versions and protocols, and what a document may say.
VERSION, SELECTION, PREVIEW = "concor-video-decisions-v1", "selected_instructions_v1", "revos_preview_v1"
COHORTS = ("explicit", "implicit", "nonexistent")
SUGGESTIONS = ("1", "3", "5", "10", "all")

GROUP = "struct<group_id:string,role:string,identity:string,text_spans:array<struct<start:int,end:int,text:string>>,tracklet_ids:array<string>>"
EDIT = f"struct<status:string,discarded:boolean,text:string,deleted_tracklet_ids:array<string>,groups:array<{GROUP}>>"
VIDEO = f"""struct<status:string,allow_multiple:boolean,selected_sample_ids:array<string>,accepted_sample_ids:array<string>,review_mode:string,preview_sample_ids:array<string>,
preview_override_sample_ids:array<string>,video_decision_explicit:boolean,sampled_sample_id:string,instructions:map<string,{EDIT}>>"""
DOCUMENT = f"""schema_version string, source_fingerprint string, updated_at string, cursor struct<video_index:int>, quick_keys_enabled boolean, selection_protocol string, suggestion_count string,
videos map<string,{VIDEO}>"""
LISTS = {"selected": "selected_sample_ids", "accepted": "accepted_sample_ids", "preview": "preview_sample_ids", "override": "preview_override_sample_ids"}


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """The document in a JSON file, one row; fields that it doesn't have are null."""
    return spark.read.schema(DOCUMENT).option("multiLine", True).option("mode", "FAILFAST").json(path)


def normalised(document: DataFrame, fingerprint: str) -> DataFrame:
    """The document with its defaults. Another version, other rows' fingerprint, an unknown selection or a number of
    suggestions that can't be asked for end the job."""
    say = lambda why, c: F.raise_error(F.concat(F.lit(why + ": "), F.coalesce(c, F.lit("null"))))
    version, source, protocol, count = (F.col(c) for c in ("schema_version", "source_fingerprint", "selection_protocol", "suggestion_count"))
    ok = (
        F.when(version.isNotNull() & (version != VERSION), say("unsupported decisions schema", version))
        .when((F.coalesce(source, F.lit("")) != "") & (source != fingerprint), say("decisions belong to a different input", source))
        .when(protocol.isNotNull() & (protocol != SELECTION), say("unsupported instruction selection", protocol))
        .when(count.isNotNull() & ~count.isin(*SUGGESTIONS), say("suggestion_count must be 1, 3, 5, 10 or all", count))
        .otherwise(True)
    )
    return document.where(ok).select(
        F.lit(VERSION).alias("schema_version"), F.lit(fingerprint).alias("source_fingerprint"), "updated_at",
        F.coalesce("cursor", F.struct(F.lit(0).alias("video_index"))).alias("cursor"), F.coalesce("quick_keys_enabled", F.lit(True)).alias("quick_keys_enabled"),
        protocol, count, F.coalesce("videos", F.create_map().cast(f"map<string,{VIDEO}>")).alias("videos"),
    )


def videos(document: DataFrame) -> DataFrame:
    """One row for each video of the document: video_key and its fields."""
    return document.select(F.explode("videos").alias("video_key", "v")).select("video_key", "v.*")


def edits(of: DataFrame) -> DataFrame:
    """(video_key, sample_id, edit): what the document says of single instructions."""
    return of.select("video_key", F.explode("instructions").alias("sample_id", "edit"))


def ranked(rows: DataFrame) -> DataFrame:
    """video_key, sample_id, cohort, rank and previews (whether the video is reviewed by its preview) of rows with
    dataset, split, video_id, sample_id, cohort, negative and bears (whether they have tracks)."""
    key = F.concat_ws("::", "dataset", "split", "video_id")
    r = rows.select(key.alias("video_key"), F.col("sample_id").cast("string").alias("sample_id"), F.lower("cohort").alias("cohort"), (F.lower("dataset") == "revos").alias("_d"), (F.col("bears") & ~F.coalesce("negative", F.lit(False))).alias("bears"))
    kind = r.groupBy("video_key").agg(F.coalesce(F.max(F.col("_d") & F.col("cohort").isin(*COHORTS)), F.lit(False)).alias("previews"))
    return decisions.ranked(r, "video_key", "sample_id", F.col("bears")).drop("_d", "bears").join(kind, "video_key")


def _listed(of: DataFrame) -> DataFrame:
    """(video_key, kind, sample_id, at): every entry of every list."""
    each = [of.select("video_key", F.lit(kind).alias("kind"), F.posexplode(c).alias("at", "sample_id")) for kind, c in LISTS.items()]
    return each[0].union(each[1]).union(each[2]).union(each[3]).select("video_key", "kind", "sample_id", "at")


def _status(edit: Column) -> Column:
    """A preview's instruction is accepted unless it was rejected or discarded."""
    return F.when(edit["status"].isin("accepted", "rejected"), edit["status"]).when(F.coalesce(edit["discarded"], F.lit(False)), "rejected").otherwise("accepted")


def previews(rows: DataFrame, of: DataFrame) -> DataFrame:
    """(video_key, sample_id, place, override, edit): what each previewed video shows, in order, each with its status.

    All its nonexistent instructions, its first explicit and first implicit one by rank, then what a reviewer added: the
    document's overrides, or, in a document that has none yet, whatever an older preview showed beyond the rule.
    """
    base = decisions.preview(rows.where("previews"), "video_key", "cohort").select("video_key", "sample_id", F.col("place").cast("long").alias("place"))
    added = F.coalesce("preview_override_sample_ids", F.when(F.col("review_mode") == PREVIEW, F.col("preview_sample_ids")))
    own = of.select("video_key", F.posexplode(added).alias("at", "sample_id")).join(rows.where("previews").select("video_key", "sample_id"), ["video_key", "sample_id"], "left_semi")
    more = own.join(base, ["video_key", "sample_id"], "left_anti").select("video_key", "sample_id", (F.col("at") + (1 << 40)).alias("place"))
    both = base.withColumn("override", F.lit(False)).unionByName(more.withColumn("override", F.lit(True)))
    e = both.join(edits(of), ["video_key", "sample_id"], "left")
    edit = F.coalesce("edit", F.lit(None).cast(EDIT))
    fields = [_status(edit).alias("status"), *[edit[c].alias(c) for c in ("discarded", "text", "deleted_tracklet_ids", "groups")]]
    return e.withColumn("edit", F.struct(*fields).cast(EDIT))


def _standard(rows: DataFrame, of: DataFrame) -> DataFrame:
    """Rows of accepted videos that are not previewed: whether each may be exported, and whether it is kept as accepted."""
    v = of.where(F.coalesce(F.col("review_mode") != PREVIEW, F.lit(True)) & (F.col("status") == "accepted"))
    v = v.select("video_key", F.col("selected_sample_ids").isNotNull().alias("_s"), F.col("accepted_sample_ids").isNotNull().alias("_a"))
    named = _listed(of).groupBy("video_key", "sample_id").agg(F.max(F.col("kind") == "selected").alias("_in_s"), F.max(F.col("kind") == "accepted").alias("_in_a"))
    r = rows.where("not previews").join(v, "video_key").join(named, ["video_key", "sample_id"], "left").join(edits(of), ["video_key", "sample_id"], "left")
    r = r.where(decisions.eligible(F.col("edit")["status"], F.col("edit")["discarded"]))
    in_s, in_a = F.coalesce("_in_s", F.lit(False)), F.coalesce("_in_a", F.lit(False))
    candidate = F.when(F.col("_s"), in_s).when(F.col("_a"), in_a).otherwise(True)
    return r.select("video_key", "sample_id", "rank", candidate.alias("candidate"), (in_a | in_s | (~F.col("_s") & ~F.col("_a"))).alias("archived"))


def completed(rows: DataFrame, of: DataFrame) -> DataFrame:
    """The document's videos with all that follows from the rows, old decisions kept; of previewed videos also those that
    it doesn't have yet, undecided.

    A previewed video gets its preview, its overrides, a status for each instruction shown and the list of those
    accepted. Another accepted video gets the ids that stay accepted, by rank, and the one that stands for it; without
    one, or not accepted, it has none. rows: those of `ranked`.
    """
    by_place = lambda test, c="place": F.transform(F.array_sort(F.collect_list(F.when(test, F.struct(c, "sample_id")))), lambda x: x["sample_id"])
    taken = (F.col("edit")["status"] == "accepted") & ~F.coalesce(F.col("edit")["discarded"], F.lit(False))
    shown = previews(rows, of).groupBy("video_key").agg(by_place(F.lit(True)).alias("p_preview"), by_place(F.col("override")).alias("p_override"), by_place(taken).alias("p_accepted"), F.map_from_entries(F.collect_list(F.struct("sample_id", "edit"))).alias("p_edits"))
    plain = _standard(rows, of).groupBy("video_key").agg(by_place(F.col("archived"), "rank").alias("s_accepted"), F.min_by(F.when(F.col("candidate"), F.col("sample_id")), F.when(F.col("candidate"), F.col("rank"))).alias("s_sampled"))
    j = of.withColumn("had", F.lit(True)).join(shown, "video_key", "full").join(plain, "video_key", "left")
    is_shown, none = F.col("p_preview").isNotNull(), F.create_map().cast(f"map<string,{EDIT}>")
    old = F.coalesce("instructions", none)
    kept = F.when(is_shown, F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key("p_edits", k)), F.col("p_edits"))).otherwise(old)
    adapter = is_shown | F.coalesce(F.col("review_mode") == PREVIEW, F.lit(False))
    explicit = F.coalesce("video_decision_explicit", F.when(is_shown, F.coalesce("had", F.lit(False)) & F.coalesce(F.col("status").isin("accepted", "rejected"), F.lit(False))))
    accepted = F.when(is_shown, F.col("p_accepted")).when(F.col("s_sampled").isNotNull(), F.col("s_accepted")).otherwise(F.col("accepted_sample_ids"))
    return j.select(
        "video_key", F.coalesce("status", F.when(is_shown, "undecided")).alias("status"), "allow_multiple", "selected_sample_ids", accepted.alias("accepted_sample_ids"),
        F.when(is_shown, PREVIEW).otherwise(F.col("review_mode")).alias("review_mode"), F.coalesce("p_preview", "preview_sample_ids").alias("preview_sample_ids"), F.coalesce("p_override", "preview_override_sample_ids").alias("preview_override_sample_ids"),
        explicit.alias("video_decision_explicit"), F.when(~adapter, F.col("s_sampled")).otherwise(F.when(~is_shown, F.col("sampled_sample_id"))).alias("sampled_sample_id"), kept.alias("instructions"),
    )


def faults(rows: DataFrame, of: DataFrame, protocol: str | None = None) -> DataFrame:
    """(video_key, fault): the first rule that a video of the document breaks. Ids are met with rows by joins, so no video's
    rows are gathered. rows: those of `ranked`."""
    foreign = _listed(of).join(rows.select("video_key", "sample_id"), ["video_key", "sample_id"], "left_anti").groupBy("video_key").agg(F.collect_set("kind").alias("_foreign"))
    kinds = rows.groupBy("video_key").agg(F.max("previews").alias("_shown"))
    v = of.join(foreign, "video_key", "left").join(kinds, "video_key", "left")
    none = F.array().cast("array<string>")
    wrong = lambda kind: F.coalesce(F.size(F.array_distinct(LISTS[kind])) < F.size(LISTS[kind]), F.lit(False)) | F.array_contains(F.coalesce("_foreign", none), kind)
    edit = lambda i: F.try_element_at("instructions", i)
    shown, adapter = F.coalesce("_shown", F.lit(False)), F.coalesce(F.col("review_mode") == PREVIEW, F.lit(False))
    taken, chosen = F.coalesce(F.col("status") == "accepted", F.lit(False)), F.col("selected_sample_ids")
    plain = ~shown & ~adapter
    beyond = F.size(F.array_except(F.coalesce("preview_override_sample_ids", none), F.coalesce("preview_sample_ids", none))) > 0
    undecided = F.exists(F.coalesce("preview_sample_ids", none), lambda i: ~F.coalesce(edit(i)["status"].isin("accepted", "rejected"), F.lit(False)))
    out = F.exists(F.coalesce(chosen, none), lambda i: F.coalesce(edit(i)["discarded"], F.lit(False)) | F.coalesce(edit(i)["status"] == "rejected", F.lit(False)))
    rule = (
        F.when(shown & wrong("override"), "override_duplicate_or_foreign")
        .when(~shown & wrong("accepted"), "accepted_duplicate_or_foreign")
        .when(~shown & adapter & wrong("preview"), "preview_duplicate_or_foreign")
        .when(~shown & adapter & (wrong("override") | beyond), "override_invalid")
        .when(~shown & adapter & undecided, "preview_without_status")
        .when(plain & chosen.isNull() & F.lit(protocol == SELECTION) & taken & (F.coalesce(F.size("accepted_sample_ids"), F.lit(0)) <= 0), "nothing_confirmed")
        .when(plain & wrong("selected"), "selected_duplicate_or_foreign")
        .when(plain & (F.size(chosen) > 1) & ~F.coalesce("allow_multiple", F.lit(False)), "several_without_leave")
        .when(plain & taken & chosen.isNotNull() & (F.size(chosen) == 0), "nothing_confirmed")
        .when(plain & taken & out, "discarded_selected")
    )
    return v.select("video_key", rule.alias("fault")).where("fault is not null")


def checked(rows: DataFrame, of: DataFrame, protocol: str | None = None) -> DataFrame:
    """The document's videos; one that breaks a rule ends the job with its key and the rule."""
    f = faults(rows, of, protocol)
    said = F.raise_error(F.concat_ws(": ", F.lit("decisions"), "video_key", "fault"))
    return of.join(f, "video_key", "left").where(F.when(F.col("fault").isNull(), True).otherwise(said)).drop("fault")


def exports(rows: DataFrame, of: DataFrame) -> DataFrame:
    """(video_key, sample_id, edit, status): what each accepted video exports. A previewed one gives all accepted of its
    preview, another one its first candidate by rank."""
    named = previews(rows, of).select("video_key", "sample_id", "edit")
    kept = of.where(F.col("review_mode") == PREVIEW).join(rows.where("previews").select("video_key").distinct(), "video_key", "left_anti")
    other = kept.select("video_key", F.explode("preview_sample_ids").alias("sample_id")).join(edits(of), ["video_key", "sample_id"], "left")
    shown = named.unionByName(other).where((F.col("edit")["status"] == "accepted") & ~F.coalesce(F.col("edit")["discarded"], F.lit(False)))
    shown = shown.join(of.where("status = 'accepted'").select("video_key"), "video_key", "left_semi")
    first = _standard(rows, of).where("candidate").groupBy("video_key").agg(F.min_by("sample_id", "rank").alias("sample_id"))
    first = first.join(edits(of), ["video_key", "sample_id"], "left").select("video_key", "sample_id", "edit")
    return shown.select("video_key", "sample_id", "edit").unionByName(first).withColumn("status", F.lit("accepted"))


def applied(records: DataFrame, of: DataFrame, protocol: str | None = None) -> DataFrame:
    """Records that the document exports, with their edits, verification_status and verification_decision_json.

    records: those with tracklets, groups and span_links, and dataset, split, video_id, sample_id, cohort, negative. A
    document that breaks a rule ends the job. An instruction's own status stands before its video's. Ranks, document and
    exports, none of which holds a mask, are written once, as each is read several times.
    """
    r = written(ranked(records.withColumn("bears", F.coalesce(F.size("tracklets") > 0, F.lit(False)))), "ranked")
    of = written(of, "decisions")
    e = written(exports(r, checked(r, of, protocol)), "exports")
    edit = F.col("edit")
    some = e.select("sample_id", edit["text"].alias("new_text"), edit["deleted_tracklet_ids"].alias("deleted"), edit["groups"].alias("new_groups"), F.coalesce(edit["status"], "status").alias("edit_status"), F.coalesce(F.to_json(edit), F.lit("{}")).alias("verification_decision_json"))
    there = records.withColumn("sample_id", F.col("sample_id").cast("string")).withColumn("video_key", F.concat_ws("::", "dataset", "split", "video_id"))
    mine = there.join(some.select("sample_id"), "sample_id", "left_semi")
    none = there.sparkSession.createDataFrame([], "video_key string, status string")
    out = decisions.overlaid(mine, some.drop("verification_decision_json"), none).drop("video_key")
    return out.join(some.select("sample_id", "verification_decision_json"), "sample_id").select(*records.columns, "verification_status", "verification_decision_json")


class Session:
    """A reviewer's document kept under a path: header.json, which names the folder of its videos, a table. A save writes a
    folder of its own and then replaces the header in one step, so it is there whole or not at all, and frames read
    before stay good. The first save of a session leaves the header that was there under a name of its own.
    """

    def __init__(self, spark: SparkSession, path: str, rows: DataFrame, fingerprint: str):
        self.spark, self.path, self.rows, self.fingerprint = spark, path.rstrip("/"), rows, fingerprint
        self.before, self.backup = self._header(), None

    def _header(self) -> dict | None:
        at, fs = _fs(self.spark, f"{self.path}/header.json")
        if not fs.exists(at):
            return None
        return json.loads("\n".join(r[0] for r in self.spark.read.text(f"{self.path}/header.json").collect()))

    def load(self) -> tuple[dict, DataFrame]:
        """The header and the videos, completed for the rows; without a document, one that nobody has decided on."""
        head = self._header() or {}
        none = self.spark.createDataFrame([], f"video_key string, v {VIDEO}").select("video_key", "v.*")
        kept = self.spark.read.schema(none.schema).parquet(f"{self.path}/{head['folder']}") if head else none
        one = self.spark.createDataFrame([(json.dumps(head),)], "j string").select(F.from_json("j", DOCUMENT).alias("d")).select("d.*")
        first = normalised(one, self.fingerprint).drop("videos").first()
        return first.asDict(recursive=True), completed(self.rows, kept)

    def save(self, of: DataFrame, **head) -> None:
        """The videos, completed and checked, under the header."""
        folder = f"videos-{uuid.uuid4().hex}.parquet"
        done = completed(self.rows, of)
        checked(self.rows, done, head.get("selection_protocol")).write.option("compression", "zstd").parquet(f"{self.path}/{folder}")
        now = datetime.now(UTC)
        if self.before and not self.backup:
            self.backup = f"{self.path}/header.session-start.{now.strftime('%Y%m%dT%H%M%S.%fZ')}.bak"
            write_text(self.spark, self.backup, json.dumps(self.before, sort_keys=True))
        value = {k: v for k, v in head.items() if v is not None} | {"schema_version": VERSION, "source_fingerprint": self.fingerprint, "updated_at": now.isoformat(), "folder": folder}
        write_text(self.spark, f"{self.path}/header.json", json.dumps(value, sort_keys=True))


def write_verified(records: DataFrame, of: DataFrame, path: str, protocol: str | None = None) -> DataFrame:
    """What the document exports, written under `path`, with all columns also where it exports nothing; no records at all end
    it."""
    if records.isEmpty():
        raise ValueError("no records to verify")
    stage = f"{path.rstrip('/')}.{uuid.uuid4().hex}.part"
    applied(records, of, protocol).write.option("compression", "zstd").parquet(stage)
    rename(records.sparkSession, stage, path)
    return records.sparkSession.read.parquet(path)
