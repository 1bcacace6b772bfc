"""Label images: indexed PNG files as label pixels, and all their objects as run lengths in one pass."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGNATURE = b"\x89PNG\r\n\x1a\n"
INDEXED, GRAY = 3, 0
MASK = "struct<size:array<int>,counts:array<bigint>>"


def _unfiltered(data: bytes, rows: int, width: int) -> np.ndarray:
    """Scanlines of `width` bytes, one byte a step, without their filters."""
    lines = np.frombuffer(data, np.uint8).reshape(rows, width + 1)
    out, up = np.zeros((rows, width), np.uint8), np.zeros(width, np.uint8)
    for y in range(rows):
        kind, line = lines[y, 0], lines[y, 1:]
        if kind == 0:
            up = line
        elif kind == 1:
            up = np.cumsum(line, dtype=np.uint64).astype(np.uint8)
        elif kind == 2:
            up = line + up
        elif kind in (3, 4):
            now, left, corner = np.empty(width, np.uint8), 0, 0
            for x, (v, b) in enumerate(zip(line.tolist(), up.tolist(), strict=True)):
                if kind == 3:
                    guess = (left + b) // 2
                else:
                    p = left + b - corner
                    da, db, dc = abs(p - left), abs(p - b), abs(p - corner)
                    guess = left if da <= db and da <= dc else b if db <= dc else corner
                left, corner = (v + guess) & 255, b
                now[x] = left
            up = now
        else:
            raise ValueError(f"scanline filter {kind}")
        out[y] = up
    return out


def labels(payload: bytes) -> np.ndarray:
    """Label pixels of an indexed PNG of 1, 2, 4 or 8 bits, or a gray one of 8, without interlace."""
    if payload[:8] != SIGNATURE:
        raise ValueError("no PNG file")
    at, head, body = 8, None, []
    while at + 8 <= len(payload):
        size, kind = int.from_bytes(payload[at : at + 4], "big"), payload[at + 4 : at + 8]
        chunk = payload[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = chunk
        elif kind == b"IDAT":
            body.append(chunk)
        elif kind == b"IEND":
            break
        at += 12 + size
    if head is None:
        raise ValueError("PNG file without a header")
    width, height = int.from_bytes(head[:4], "big"), int.from_bytes(head[4:8], "big")
    depth, color, interlace = head[8], head[9], head[12]
    if interlace or (color, depth) not in {(GRAY, 8), *((INDEXED, d) for d in (1, 2, 4, 8))}:
        raise ValueError(f"PNG of color type {color}, {depth} bits, interlace {interlace}")
    line = -(-width * depth // 8)
    packed = _unfiltered(zlib.decompress(b"".join(body)), height, line)
    if depth == 8:
        return packed
    bits = np.unpackbits(packed, axis=1).reshape(height, -1, depth)
    return (bits * (1 << np.arange(depth - 1, -1, -1))).sum(axis=2, dtype=np.uint8)[:, :width]


def runs(image: np.ndarray) -> list[tuple[int, list[int]]]:
    """For each label that the image has, 0 too, its mask's run lengths by column, those of other labels first."""
    flat = image.reshape(-1, order="F")
    if not len(flat):
        return []
    cuts = np.concatenate([[0], np.flatnonzero(flat[1:] != flat[:-1]) + 1, [len(flat)]])
    order = np.argsort(flat[cuts[:-1]], kind="stable")
    kinds, begin, end = flat[cuts[order]], cuts[order], cuts[order + 1]
    first = np.append(0, np.flatnonzero(kinds[1:] != kinds[:-1]) + 1)
    before = np.append(0, end[:-1])
    before[first] = 0
    pairs, rest, at = np.stack([begin - before, end - begin], axis=1).ravel().tolist(), (len(flat) - end).tolist(), [*first.tolist(), len(kinds)]
    return [(label, pairs[2 * i : 2 * j] + ([rest[j - 1]] if rest[j - 1] else [])) for label, i, j in zip(kinds[first].tolist(), at[:-1], at[1:], strict=True)]


def label_masks(images: DataFrame, payload: str = "payload") -> DataFrame:
    """The other columns of each image, label and mask (size, counts): one row for each label but 0 that it has. An image is
    decoded once, whatever the number of its objects; one that can't be ends the job."""
    kept = [c for c in images.columns if c != payload]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in images.schema if f.name != payload), "label int", f"mask {MASK}"])

    def run(batches):
        for b in batches:
            at, found, size, counted, ends = [], [], [], [], [0]
            for i, data in enumerate(b[payload].to_pylist()):
                image = labels(data)
                for label, counts in runs(image):
                    if label:
                        at.append(i)
                        found.append(label)
                        size += image.shape
                        counted += counts
                        ends.append(len(counted))
            take = pa.array(at, pa.int64())
            sizes = pa.ListArray.from_arrays(pa.array(range(0, len(size) + 1, 2), pa.int32()), pa.array(size, pa.int32()))
            made = pa.StructArray.from_arrays([sizes, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(counted, pa.int64()))], ["size", "counts"])
            yield pa.RecordBatch.from_arrays([*[b[c].take(take) for c in kept], pa.array(found, pa.int32()), made], [*kept, "label", "mask"])

    return images.mapInArrow(run, schema)


def palette_targets(units: DataFrame, masks: DataFrame) -> DataFrame:
    """(sample_id, place, source_annotation_id, masks): each target object's mask in every frame of its unit, null where it
    has no pixel or the frame has no labels.

    units: sample_id, video_id, frame_ids, target_object_ids, target_source_expected. masks: video_id, frame_id, label, mask.
    A label meets its units by equal video, frame and label, so no image is copied for each object.
    """
    u = units.where("target_source_expected = 'official_dataset_ground_truth'").select("sample_id", "video_id", "frame_ids", F.posexplode("target_object_ids").alias("at", "label"))
    u = u.select("sample_id", "video_id", "at", F.col("label").cast("int").alias("label"), F.posexplode("frame_ids").alias("frame", "frame_id"))
    got = u.join(masks.select("video_id", "frame_id", "label", "mask"), ["video_id", "frame_id", "label"], "left")
    frames = F.transform(F.array_sort(F.collect_list(F.struct("frame", "mask"))), lambda f: f["mask"])
    return got.groupBy("sample_id", (F.col("at") + 1).alias("place"), F.col("label").cast("string").alias("source_annotation_id")).agg(frames.alias("masks"))


def targets(units: DataFrame, label_masks_: DataFrame, sequences: DataFrame) -> DataFrame:
    """Official targets of units of both datasets, by the dataset that each unit names; another one ends the job."""
    from ..operators.campaign import sequence_targets

    other = units.where(~F.coalesce(F.col("dataset").isin("ref_youtube_vos", "revos"), F.lit(False))).select("dataset").first()
    if other:
        raise ValueError(f"unsupported dataset: {other[0]}")
    of = lambda name: units.where(F.col("dataset") == name)
    order = of("revos").select("sample_id", F.posexplode("target_annotation_ids").alias("at", "annotation_id"))
    stored = sequence_targets(of("revos"), sequences).join(order, ["sample_id", "annotation_id"])
    stored = stored.select("sample_id", (F.col("at") + 1).alias("place"), F.col("annotation_id").cast("string").alias("source_annotation_id"), "masks")
    return palette_targets(of("ref_youtube_vos"), label_masks_).unionByName(stored)
