"""Members of tar and zip archives as rows: all at once, or by a stored index and ranged reads."""

from __future__ import annotations

import hashlib
import io
import tarfile
import zipfile
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "archive string, name string, offset_data long, size long, payload binary"
INDEX = "archive string, archive_size long, signature string, name string, offset_data long, size long, stored long, packed boolean"
#: Bytes at an archive's beginning, middle and end that its signature covers; of a zip member's local header.
SAMPLE, HEADER = 1 << 20, 30


def _members(batches):
    for b in batches:
        for at, raw in zip(b["path"].to_pylist(), b["content"], strict=True):
            data = io.BytesIO(raw.as_buffer())
            if zipfile.is_zipfile(data):
                box = zipfile.ZipFile(data)
                each = ((i.filename, None, i.file_size, box.read(i)) for i in box.infolist() if not i.is_dir())
            else:
                data.seek(0)
                box = tarfile.open(fileobj=data, mode="r:")
                each = ((i.name, i.offset_data, i.size, box.extractfile(i).read()) for i in box if i.isreg())
            for name, offset, size, payload in each:
                yield pa.RecordBatch.from_pylist([{"archive": at, "name": name, "offset_data": offset, "size": size, "payload": payload}], schema=pa.schema([("archive", pa.string()), ("name", pa.string()), ("offset_data", pa.int64()), ("size", pa.int64()), ("payload", pa.binary())]))


def members(spark: SparkSession, path: str) -> DataFrame:
    """Regular members of uncompressed tar and of zip archives, each archive whole in one task: for those of up to 2 GB.
    Larger ones are read by indexed() and extracted()."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_members, SCHEMA)


def _opened(path: str):
    """A seekable file on any file system that pyarrow knows, by URI or plain path."""
    fs, at = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs.open_input_file(at)


def signature(path: str) -> tuple[int, str]:
    """Size and a SHA-256 over it and a sample of the bytes: from the beginning, the middle and the end."""
    with _opened(path) as f:
        size, digest = f.size(), hashlib.sha256()
        digest.update(str(size).encode())
        for at in sorted({0, max(0, size // 2 - SAMPLE // 2), max(0, size - SAMPLE)}):
            f.seek(at)
            digest.update(f.read(SAMPLE))
    return size, digest.hexdigest()


def _walk(batches):
    """The headers of each archive alone: a tar is walked by seeking over its payloads, a zip by its directory."""
    names = [c.split()[0] for c in INDEX.split(", ")]
    for b in batches:
        for path in b["archive"].to_pylist():
            size, sign = signature(path)
            with _opened(path) as f:
                rows: list[dict] = []
                if zipfile.is_zipfile(f):
                    for i in zipfile.ZipFile(f).infolist():
                        if not i.is_dir():
                            rows.append(dict(zip(names, (path, size, sign, i.filename, i.header_offset, i.file_size, i.compress_size, True), strict=True)))
                else:
                    f.seek(0)
                    for i in tarfile.open(fileobj=f, mode="r:"):
                        if i.isreg():
                            rows.append(dict(zip(names, (path, size, sign, i.name, i.offset_data, i.size, i.size, False), strict=True)))
                for lo in range(0, len(rows), 4096):
                    yield pa.RecordBatch.from_pylist(rows[lo : lo + 4096], schema=pa.schema([(n, pa.string() if n in ("archive", "signature", "name") else pa.bool_() if n == "packed" else pa.int64()) for n in names]))


def indexed(spark: SparkSession, archives: list[str], out: str) -> None:
    """Writes the index of all members under `out`, an archive a task; payloads are not read."""
    spark.createDataFrame([(a,) for a in archives], "archive string").repartition(max(1, len(archives))).mapInArrow(_walk, INDEX).write.parquet(out)


def stale(spark: SparkSession, index: str) -> list[str]:
    """Archives of an index whose size or sampled bytes have changed since."""
    known = spark.read.parquet(index).select("archive", "archive_size", "signature").distinct()

    def check(batches):
        for b in batches:
            now = [signature(a) for a in b["archive"].to_pylist()]
            same = [n == (s, x) for n, s, x in zip(now, b["archive_size"].to_pylist(), b["signature"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b["archive"], pa.array(same)], ["archive", "same"])

    return sorted(r.archive for r in known.mapInArrow(check, "archive string, same boolean").where("not same").collect())


def _ranged(batches):
    for b in batches:
        last, f = None, None
        for r in b.to_pylist():
            if r["archive"] != last:
                last, f = r["archive"], _opened(r["archive"])
            at = r["offset_data"]
            if r["packed"]:
                f.seek(at)
                head = f.read(HEADER)
                at += HEADER + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little")
                method = int.from_bytes(head[8:10], "little")
            f.seek(at)
            data = f.read(r["stored"])
            if r["packed"] and method == zipfile.ZIP_DEFLATED:
                data = zlib.decompress(data, -15)
            elif r["packed"] and method != zipfile.ZIP_STORED:
                raise ValueError(f"{r['archive']}: {r['name']} has compression {method}")
            if len(data) != r["size"]:
                raise ValueError(f"{r['archive']}: {r['name']} is cut short")
            yield pa.RecordBatch.from_arrays([pa.array([r["archive"]]), pa.array([r["name"]]), pa.array([r["offset_data"]], pa.int64()), pa.array([r["size"]], pa.int64()), pa.array([data], pa.binary())], ["archive", "name", "offset_data", "size", "payload"])


def extracted(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The payloads of the wanted names (or archives and names), each by one ranged read.

    Members are dealt by archive and place, so that many tasks read from one large archive, each forward.
    """
    on = [c for c in ("archive", "name") if c in wanted.columns]
    hit = index.join(wanted.select(*on).distinct(), on, "left_semi")
    return hit.repartitionByRange("archive", "offset_data").sortWithinPartitions("archive", "offset_data").mapInArrow(_ranged, SCHEMA)


def first_found(index: DataFrame, requests: DataFrame) -> DataFrame:
    """Of each request's candidate names (an array, in order of preference) the first that the index has: an equi-join of
    all candidates and the least place, not a search by request."""
    each = requests.select("request", F.posexplode("candidates").alias("place", "name"))
    return each.join(index, "name").groupBy("request").agg(F.min_by(F.struct("archive", "name"), F.struct("place", "archive")).alias("m")).select("request", "m.archive", "m.name")
