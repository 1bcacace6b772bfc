"""Registered queries over packets with tracks, label images and media, each beside its SQL."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import masks
from ..functions.binding import bound
from ..operators import manifests, refine
from ..sources import media, palette
from .nested import FLAT, annotated
from .registry import ORACLE, query


def of_one_length(docs: DataFrame) -> DataFrame:
    """Records whose videos have frames of one number: a video is the documents of a dozen with that number."""
    r = annotated(docs)
    name = F.concat(F.lit("v"), F.floor(F.col("id") / 12).cast("string"), F.lit("-"), (F.col("id") % 3).cast("string"))
    return r.where("id % 37 <> 0").withColumns({"video_id": name, "target_source": F.lit("official")})


_SOUND = f"""insp AS ({ORACLE["structural_inspection"]}), {FLAT},
ok AS (SELECT r.id, r.sample_id, r.nf, 'v' || (r.id // 12) || '-' || (r.id % 3) AS v, i.kept, r.negative FROM insp i JOIN rec r ON r.sample_id = i.sample_id WHERE i.reason IS NULL),
kept AS (SELECT id, sample_id, v, nf, unnest(string_split(kept, ',')) AS tid, unnest(range(len(string_split(kept, ',')))) AS place FROM ok WHERE kept <> ''),
sgn AS (SELECT id, tid, string_agg(coalesce(CAST(c AS VARCHAR), '-'), ',' ORDER BY j) AS sign, string_agg(CASE WHEN c < total THEN CAST(j AS VARCHAR) END, ' ' ORDER BY j) AS seen, min(j) FILTER (WHERE c < total) AS first FROM msk GROUP BY id, tid),
k AS (SELECT kept.*, sign, seen, first FROM kept JOIN sgn ON sgn.id = kept.id AND sgn.tid = kept.tid),
reg AS (SELECT v, sign, any_value(seen) AS seen, any_value(first) AS first, row_number() OVER (PARTITION BY v ORDER BY min((sample_id, place))) AS vid, arg_max(tid, (sample_id, place)) AS last FROM k GROUP BY v, sign),
own AS (SELECT s.id, s.tid, g.vid FROM sgn s JOIN ok ON ok.id = s.id JOIN reg g ON g.v = ok.v AND g.sign = s.sign),
pos AS (SELECT ok.*, (row_number() OVER (PARTITION BY v ORDER BY sample_id) - 1) // 2 AS chunk FROM ok),
mine AS (SELECT p.v, p.chunk, p.id, p.sample_id, k.tid, g.vid FROM pos p JOIN k ON k.id = p.id JOIN reg g ON g.v = k.v AND g.sign = k.sign),
exp AS (SELECT p.v, p.chunk, p.sample_id, p.sample_id || '[' || coalesce((SELECT string_agg(vid, ' ' ORDER BY vid) FROM mine m WHERE m.id = p.id), '') || '|' || coalesce((SELECT string_agg(DISTINCT o.vid, ' ' ORDER BY o.vid) FROM gid i JOIN own o ON o.id = i.id AND o.tid = i.tid WHERE i.id = p.id AND i.role = 'main_referent' AND NOT p.negative), '') || '|' || coalesce((SELECT string_agg(coalesce(x.ids, ''), ';' ORDER BY g.g) FROM grp g LEFT JOIN (SELECT i.g, string_agg(DISTINCT o.vid, ' ' ORDER BY o.vid) AS ids FROM gid i JOIN own o ON o.id = i.id AND o.tid = i.tid WHERE i.id = p.id AND (NOT p.negative OR EXISTS (SELECT 1 FROM k WHERE k.id = p.id AND k.sign = (SELECT sign FROM sgn WHERE sgn.id = i.id AND sgn.tid = i.tid))) GROUP BY i.g) x ON x.g = g.g WHERE g.id = p.id), '') || ']' AS said FROM pos p),
used AS (SELECT DISTINCT m.v, m.chunk, g.vid, g.seen, g.first, 'p' || (CAST(substr(g.last, 2) AS INT) % 2) AS proposal FROM mine m JOIN reg g ON g.v = m.v AND g.vid = m.vid)"""


@query(f"""WITH {_SOUND} SELECT 'corpus::train::' || p.v AS video_key, string_agg(p.sample_id, ',' ORDER BY p.sample_id) AS samples, (SELECT string_agg(said, ' ' ORDER BY sample_id) FROM exp e WHERE e.v = p.v AND e.chunk = p.chunk) AS expressions,
coalesce((SELECT string_agg(vid || ':' || proposal || ':' || coalesce(seen, ''), ',' ORDER BY vid) FROM used u WHERE u.v = p.v AND u.chunk = p.chunk), '') AS inventory,
(SELECT string_agg(DISTINCT f, ' ' ORDER BY f) FROM (SELECT first AS f FROM used u WHERE u.v = p.v AND u.chunk = p.chunk UNION ALL SELECT 0 UNION ALL SELECT any_value(p.nf) - 1)) AS frames, CAST(least(16384, 4096 + 768 * count(*)) AS INT) AS max_output_tokens FROM pos p GROUP BY p.v, p.chunk""")
def visual_manifests(t):
    m = manifests.visual_manifests(refine.inspected(of_one_length(t("documents"))), "prompt", 2, None, 2)
    text = lambda ids, by=" ": F.array_join(ids.cast("array<string>"), by)
    said = lambda e: F.concat(e["sample_id"], F.lit("["), text(e["allowed_ids"]), F.lit("|"), text(e["main_ids"]), F.lit("|"), F.array_join(F.transform(e["existing_groups"], lambda g: text(g["ids"])), ";"), F.lit("]"))
    item = lambda x: F.concat_ws(":", x["id"].cast("string"), x["proposal"], text(x["visible_frame_indices"]))
    return m.select("video_key", F.array_join(F.transform("expressions", lambda e: e["sample_id"]), ",").alias("samples"), F.array_join(F.transform("expressions", said), " ").alias("expressions"), F.array_join(F.transform("packet.tracklets", item), ",").alias("inventory"), text(F.col("packet.selected_frame_indices")).alias("frames"), "max_output_tokens")


WIDTH, HEIGHT = 13, 7


def png(pixels: np.ndarray, depth: int) -> bytes:
    """An indexed PNG of these labels, its scanlines filtered by all five kinds in turn."""
    bits = np.unpackbits(pixels[:, :, None], axis=2)[:, :, 8 - depth :].reshape(len(pixels), -1)
    lines = np.packbits(bits, axis=1).astype(int)
    up, left, corner = np.zeros((3, *lines.shape), int)
    up[1:], left[:, 1:], corner[1:, 1:] = lines[:-1], lines[:, :-1], lines[:-1, :-1]
    near, across, both = abs(up - corner), abs(left - corner), abs(left + up - 2 * corner)
    paeth = np.where((near <= across) & (near <= both), left, np.where(across <= both, up, corner))
    kind = np.arange(len(lines))[:, None] % 5
    guess = np.choose(kind, [np.zeros_like(lines), left, up, (left + up) // 2, paeth])
    body = np.hstack([kind, (lines - guess) % 256]).astype(np.uint8).tobytes()
    chunk = lambda kind, data: len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")
    packed, half = zlib.compress(body), 9
    head = pixels.shape[1].to_bytes(4, "big") + pixels.shape[0].to_bytes(4, "big") + bytes([depth, palette.INDEXED, 0, 0, 0])
    return palette.SIGNATURE + chunk(b"IHDR", head) + chunk(b"PLTE", bytes(3 * 2**depth)) + chunk(b"IDAT", packed[:half]) + chunk(b"IDAT", packed[half:]) + chunk(b"IEND", b"")


def label_images(docs: DataFrame) -> DataFrame:
    """Two frames of labels for each document, of 1, 2, 4 or 8 bits by its id."""

    def run(batches):
        y, x = np.mgrid[:HEIGHT, :WIDTH]
        for b in batches:
            out = []
            for i, f in zip(b["doc_id"].to_pylist(), b["f"].to_pylist(), strict=True):
                depth = 1 << (i % 4)
                out.append(png((((x // 2) * 3 + y * (1 + i % 5) + i + f * 7) % 2**depth % 11).astype(np.uint8), depth))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["f"], pa.array(out, pa.binary())], ["doc_id", "f", "payload"])

    return docs.select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("f")).mapInArrow(run, "doc_id long, f int, payload binary")


@query(f"""WITH d AS (SELECT doc_id AS i, CAST(pow(2, pow(2, doc_id % 4)) AS BIGINT) AS many FROM documents),
p AS (SELECT i, f, x * {HEIGHT} + y AS px, ((x // 2) * 3 + y * (1 + i % 5) + i + f * 7) % many % 11 AS label FROM d, range(2) a(f), range({WIDTH}) b(x), range({HEIGHT}) c(y)),
e AS (SELECT *, lag(label) OVER w AS before, lead(label) OVER w AS after FROM p WINDOW w AS (PARTITION BY i, f ORDER BY px)),
r AS (SELECT i, f, label, count(*) AS pixels, count(*) FILTER (before IS DISTINCT FROM label) AS runs, CAST(sum(px) FILTER (before IS DISTINCT FROM label) AS BIGINT) AS starts, CAST(sum(px + 1) FILTER (after IS DISTINCT FROM label) AS BIGINT) AS stops FROM e WHERE label > 0 GROUP BY ALL),
w AS (SELECT i, place, label, f FROM d, (VALUES (1, 3), (2, 1), (3, 8)) v(place, label), range(3) a(f))
SELECT 's' || w.i AS sample_id, CAST(w.place AS INT) AS place, CAST(w.label AS VARCHAR) AS source_annotation_id, CAST(w.f AS INT) AS frame, r.pixels, CAST(r.runs AS INT) AS runs, r.starts, r.stops FROM w LEFT JOIN r ON r.i = w.i AND r.f = w.f AND r.label = w.label""")
def palette_masks(t):
    d = t("documents")
    name = F.col("doc_id").cast("string")
    found = palette.label_masks(label_images(d).select(name.alias("video_id"), F.col("f").cast("string").alias("frame_id"), "payload"))
    units = d.select(F.concat(F.lit("s"), name).alias("sample_id"), name.alias("video_id"), F.array(F.lit("0"), F.lit("1"), F.lit("2")).alias("frame_ids"), F.array(F.lit(3), F.lit(1), F.lit(8)).alias("target_object_ids"), F.lit("official_dataset_ground_truth").alias("target_source_expected"))
    each = palette.palette_targets(units, found).select("sample_id", "place", "source_annotation_id", F.posexplode("masks").alias("frame", "m"))
    each = bound(each, on=F.when(F.col("m").isNotNull(), masks.on_runs(F.col("m")["size"], F.col("m")["counts"])))
    on = F.col("on")
    total = lambda c: F.when(on.isNotNull(), F.aggregate(on, F.lit(0).cast("long"), lambda a, r: a + r[c]))
    return each.select("sample_id", "place", "source_annotation_id", "frame", masks.pixels(on).alias("pixels"), F.when(on.isNotNull(), F.size(on)).alias("runs"), total("start").alias("starts"), total("stop").alias("stops"))


@query("""WITH d AS (SELECT doc_id AS i FROM documents), n AS (SELECT i, CASE WHEN i % 4 = 1 THEN '/b.zip' WHEN i % 4 = 2 THEN '/a' WHEN i % 4 = 3 THEN '/b.zip' END AS source, CASE WHEN i % 4 = 1 THEN 'JPEGImages/v' || i || '/f.jpg' WHEN i % 4 = 2 THEN 'v' || i || '/f.png' ELSE 'train/JPEGImages/v' || i || '/f.jpeg' END AS name FROM d)
SELECT 'v' || i AS video_id, 'f' AS frame_id, source, name FROM n WHERE i % 4 > 0""")
def media_found(t):
    v = F.concat(F.lit("v"), F.col("doc_id").cast("string"))
    d = t("documents").select(v.alias("video_id"), "doc_id")
    frames = d.select("video_id", F.lit("f").alias("frame_id"), F.array(F.lit("/a"), F.lit("/b.zip"), F.lit("/c.tar")).alias("sources"))
    listed = lambda when, source, *names: d.where(when).select(F.lit(source).alias("source"), F.explode(F.array(*[F.concat(F.lit(a), "video_id", F.lit(z)) for a, z in names])).alias("name"))
    listing = listed("doc_id % 4 = 1", "/b.zip", ("JPEGImages/", "/f.jpg"), ("test/JPEGImages/", "/f.jpg"), ("JPEGImages/", "/f.png")).union(listed("doc_id % 4 = 1", "/c.tar", ("", "/f.jpg")))
    listing = listing.union(listed("doc_id % 4 = 2", "/a", ("", "/f.png"), ("JPEGImages/", "/f.jpg"))).union(listed("doc_id % 4 = 2", "/b.zip", ("", "/f.jpg")))
    listing = listing.union(listed("doc_id % 4 = 3", "/b.zip", ("train/JPEGImages/", "/f.jpeg"), ("other/", "/f.jpg"))).union(listed("doc_id % 4 = 0", "/d", ("", "/f.jpg")))
    return media.frames_found(frames, listing)


@query("""SELECT doc_id FROM documents WHERE doc_id % 6 IN (0, 2) OR (doc_id % 6 = 1 AND doc_id % 5 < 2)""")
def media_available(t):
    i = F.col("doc_id")
    kind = i % 6
    rows = t("documents").select(i, F.when(kind == 0, F.array(F.lit("/no"), F.lit("/x/train.zip"))).when(kind == 1, F.array(F.lit("/pool"))).when(kind == 2, F.array(F.lit("/pool"), F.lit("/x/test.TAR"))).when(kind == 3, F.array(F.lit("/x/readme.txt"))).when(kind == 4, F.array(F.lit("/zip.zip"))).otherwise(F.array().cast("array<string>")).alias("candidates"), F.concat(F.lit("v"), i.cast("string")).alias("video_id"))
    fixed = [("/x/train.zip", False), ("/x/test.TAR", False), ("/x/readme.txt", False), ("/zip.zip", True), ("/pool", True), ("/x", True)]
    paths = t.spark.createDataFrame(fixed, "path string, is_folder boolean")
    below = t("documents").where("doc_id % 5 < 2").select(F.concat(F.lit("/pool/"), F.when(i % 5 == 0, "").otherwise("valid/JPEGImages/"), F.lit("v"), i.cast("string")).alias("path"), F.lit(True).alias("is_folder"))
    return media.available(rows, paths.union(below)).select("doc_id")
