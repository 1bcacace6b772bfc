"""Where metadata, frames and masks of a dataset may lie, and which units' media are there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .metadata import first_existing

# How released datasets name their files and folders.
REF_SPLITS = {"train": ["train"], "val": ["valid", "val"], "test": ["test", "valid", "val"]}
REF_ARCHIVES = {"train": ["train.zip"], "val": ["valid.zip", "val.zip"], "test": ["valid.zip", "val.zip", "test_ytvos.zip", "test.zip"]}
PREFIXES = ("", "JPEGImages/", "train/JPEGImages/", "valid/JPEGImages/", "val/JPEGImages/", "test/JPEGImages/", "ReVOS/JPEGImages/")
SUFFIXES = (".jpg", ".jpeg", ".png")
FOLDERS = PREFIXES[:-1]
LABELS = ("", "Annotations/", "train/Annotations/")
ARCHIVES = (".zip", ".tar")


def ref_expressions(root: str, split: str) -> list[str]:
    """Candidates for a split's expressions; "val" is also called "valid"."""
    names = [split, "valid"] if split == "val" else [split]
    return [f"{root}/{at}" for n in names for at in (f"meta_expressions/{n}/meta_expressions.json", f"{n}/meta_expressions.json", f"meta_expressions_{n}.json")]


def ref_folder(root: str, split: str) -> list[str]:
    """Candidates for a split's folder, the root last; test expressions share the pool of the other."""
    return [*(f"{root}/{n}" for n in REF_SPLITS[split]), root]


def ref_frames(root: str, split: str, folder: str) -> list[str]:
    """Candidates for a split's frames: folders before archives."""
    return [f"{folder}/JPEGImages", f"{root}/JPEGImages", *(f"{root}/archives/{n}" for n in REF_ARCHIVES[split]), *(f"{root}/{n}" for n in REF_ARCHIVES[split])]


def revos_metadata(root: str, split: str) -> list[str]:
    names = ["valid", "val"] if split == "val" else ["train"]
    return [f"{root}/{at}" for n in names for at in (f"meta_expressions_{n}_.json", f"meta_expressions_{n}.json", f"{n}/meta_expressions.json")]


def located(spark: SparkSession, root: str, dataset: str, split: str) -> dict[str, str]:
    """Paths of a split's metadata and frames; what can't be found ends it with all places that were looked at."""
    root = root.rstrip("/")
    if dataset == "revos":
        return {"metadata": first_existing(spark, revos_metadata(root, split), f"{dataset} {split} metadata")}
    folder = first_existing(spark, ref_folder(root, split), f"{dataset} {split} folder")
    return {"metadata": first_existing(spark, ref_expressions(root, split), f"{dataset} {split} metadata"), "folder": folder, "frames": first_existing(spark, ref_frames(root, split, folder), f"{dataset} {split} frames")}


def frame_names(video: Column, frame: Column) -> Column:
    """Names that a frame may have in an archive or below a folder, in order of preference."""
    return F.array(*[F.concat(F.lit(p), video, F.lit("/"), frame, F.lit(s)) for p in PREFIXES for s in SUFFIXES])


def label_names(video: Column, frame: Column) -> Column:
    return F.array(*[F.concat(F.lit(p), video, F.lit("/"), frame, F.lit(".png")) for p in LABELS])


def frames_found(frames: DataFrame, listing: DataFrame) -> DataFrame:
    """(video_id, frame_id, source, name) of each frame that some source has: the first source by rank, in it the first
    name by preference. Frames that none has return no row.

    frames: video_id, frame_id, sources (paths in order of preference). listing: source, name, for folders as for archives.
    All candidates meet the listing in one equi-join, and the least place wins.
    """
    each = frames.select("video_id", "frame_id", F.posexplode("sources").alias("rank", "source"), frame_names(F.col("video_id"), F.col("frame_id")).alias("names"))
    each = each.select("video_id", "frame_id", "rank", "source", F.posexplode("names").alias("turn", "name"))
    there = each.join(listing.select("source", "name").distinct(), ["source", "name"])
    return there.groupBy("video_id", "frame_id").agg(F.min_by(F.struct("source", "name"), F.struct("rank", "turn")).alias("m")).select("video_id", "frame_id", "m.source", "m.name")


def available(rows: DataFrame, paths: DataFrame) -> DataFrame:
    """The rows whose media are there: some candidate is an archive, or a folder that has the video's own below it.

    rows: candidates (paths), video_id and whatever else. paths: path, is_folder. Distinct candidates and videos meet the
    paths, not the rows.
    """
    asked = rows.select("candidates", "video_id").distinct()
    one = asked.select("candidates", "video_id", F.explode("candidates").alias("candidate"))
    archive = one.join(paths.where(~F.col("is_folder") & F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin(*ARCHIVES)).select(F.col("path").alias("candidate")), "candidate", "left_semi")
    below = F.explode(F.array(*[F.concat("candidate", F.lit("/" + p), "video_id") for p in FOLDERS]))
    folder = one.join(paths.where("is_folder").select(F.col("path").alias("candidate")), "candidate", "left_semi").select("candidates", "video_id", below.alias("path"))
    folder = folder.join(paths.where("is_folder").select("path"), "path", "left_semi")
    return rows.join(archive.select("candidates", "video_id").union(folder.select("candidates", "video_id")).distinct(), ["candidates", "video_id"], "left_semi").select(*rows.columns)
