"""Binary masks as packed bits and as runs; no raster is made."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sign_words(vector: Column) -> Column:
    """The signs of all values (one for a positive value) in longs of 64, the first value lowest."""
    words = F.sequence(F.lit(0), F.floor((F.greatest(F.size(vector), F.lit(1)) - 1) / 64).cast("int"))
    bit = lambda v, i: F.when(v > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    one = lambda w: F.aggregate(F.transform(F.slice(vector, w * 64 + 1, F.lit(64)), bit), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))
    return F.transform(words, one)


def bits_in(words: Column) -> Column:
    return F.aggregate(words, F.lit(0).cast("long"), lambda a, x: a + F.bit_count(x))


def run_lengths(vector: Column) -> Column:
    """Lengths of the runs of equal sign, those of zeros first (0 if the first value is positive)."""
    start = F.struct(F.array().cast("array<int>").alias("runs"), F.lit(0).alias("n"), F.lit(False).alias("on"))

    def step(acc: Column, v: Column) -> Column:
        on = v > 0
        same = on == acc["on"]
        return F.struct(F.when(same, acc["runs"]).otherwise(F.concat(acc["runs"], F.array(acc["n"]))).alias("runs"), F.when(same, acc["n"] + 1).otherwise(1).alias("n"), on.alias("on"))

    return F.aggregate(vector, start, step, lambda a: F.concat(a["runs"], F.array(a["n"])))


def area(runs: Column) -> Column:
    """Pixels that are on: the sum of every second run."""
    return F.aggregate(F.filter(runs, lambda _, i: i % 2 == 1), F.lit(0).cast("long"), lambda a, x: a + x)


def well_formed(size: Column, counts: Column) -> Column:
    """Whether run lengths fill a mask of this size; null (an absent mask) counts as well formed."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    area_of = F.aggregate(size, F.lit(1).cast("long"), lambda a, x: a * x)
    ok = (F.size(size) == 2) & F.forall(size, lambda x: x > 0) & F.forall(counts, lambda c: c >= 0) & (total == area_of)
    return F.when(size.isNull() & counts.isNull(), True).otherwise(F.coalesce(ok, F.lit(False)))


def unpacked_counts(text: Column) -> Column:
    """Run lengths from their ASCII form: five bits a character from code 48 on, low first, bit 5 for "more follows",
    bit 4 of the last one for a negative number; from the fourth on, differences to the number two before."""
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: (F.ascii(c) - 48).cast("long"))
    start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("long").alias("x"), F.lit(0).alias("shift"))
    left = lambda x, n: F.call_function("shiftleft", x, n)

    def step(a: Column, c: Column) -> Column:
        x = a["x"].bitwiseOR(left(c.bitwiseAND(F.lit(31).cast("long")), a["shift"]))
        more = c.bitwiseAND(F.lit(32).cast("long")) != 0
        signed = F.when(c.bitwiseAND(F.lit(16).cast("long")) != 0, x.bitwiseOR(left(F.lit(-1).cast("long"), a["shift"] + 5))).otherwise(x)
        value = F.when(F.size(a["out"]) > 2, signed + F.element_at(a["out"], -2)).otherwise(signed)
        done = F.struct(F.concat(a["out"], F.array(value)).alias("out"), F.lit(0).cast("long").alias("x"), F.lit(0).alias("shift"))
        return F.when(more, F.struct(a["out"].alias("out"), x.alias("x"), (a["shift"] + 5).alias("shift"))).otherwise(done)

    return F.aggregate(codes, start, step)["out"]


def on_runs(size: Column, counts: Column) -> Column:
    """Places (start, stop) of the runs that are on, cut at the mask's end; null if a run is negative or the runs
    don't reach the end."""
    whole = F.aggregate(size, F.lit(1).cast("long"), lambda a, x: a * x)
    start = F.struct(F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("out"), F.lit(0).cast("long").alias("at"), F.lit(False).alias("on"))

    def step(a: Column, n: Column) -> Column:
        stop = F.least(a["at"] + n, whole)
        run = F.array(F.struct(a["at"].alias("start"), stop.alias("stop")))
        return F.struct(F.when(a["on"] & (stop > a["at"]), F.concat(a["out"], run)).otherwise(a["out"]).alias("out"), stop.alias("at"), (~a["on"]).alias("on"))

    return F.when(F.forall(counts, lambda n: n >= 0), F.aggregate(counts, start, step, lambda a: F.when(a["at"] == whole, a["out"])))


def pixels(runs: Column) -> Column:
    return F.aggregate(runs, F.lit(0).cast("long"), lambda a, r: a + r["stop"] - r["start"])


def common_pixels(a: Column, b: Column) -> Column:
    """Pixels that two lists of disjoint runs share: a sweep over their borders in order."""
    edges = lambda runs: F.flatten(F.transform(runs, lambda r: F.array(F.struct(r["start"].alias("at"), F.lit(1).alias("d")), F.struct(r["stop"].alias("at"), F.lit(-1).alias("d")))))
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("at"), F.lit(0).alias("depth"))
    step = lambda s, e: F.struct((s["sum"] + F.when(s["depth"] == 2, e["at"] - s["at"]).otherwise(F.lit(0).cast("long"))).alias("sum"), e["at"].alias("at"), (s["depth"] + e["d"]).alias("depth"))
    return F.aggregate(F.array_sort(F.concat(edges(a), edges(b))), start, step)["sum"]


def volume(masks: Column, others: Column) -> Column:
    """(inter, total) over aligned frames of two mask sequences, an absent mask holding no pixel; null if their
    lengths differ."""
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    runs = lambda m: F.when(m.isNull(), none).otherwise(on_runs(m["size"], m["counts"]))
    frame = F.zip_with(F.transform(masks, runs), F.transform(others, runs), lambda x, y: F.struct(common_pixels(x, y).alias("inter"), (pixels(x) + pixels(y)).alias("both")))
    zero = F.struct(F.lit(0).cast("long").alias("inter"), F.lit(0).cast("long").alias("total"))
    both = F.aggregate(frame, zero, lambda a, f: F.struct((a["inter"] + f["inter"]).alias("inter"), (a["total"] + f["both"] - f["inter"]).alias("total")))
    return F.when(F.size(masks) == F.size(others), both)


def overlap(masks: Column, others: Column) -> Column:
    """Volume overlap: shared pixels of all frames over all covered ones, 0 where none is covered."""
    v = volume(masks, others)
    return F.when(v["total"] > 0, v["inter"] / v["total"]).when(v["total"] == 0, F.lit(0.0))


def visible(masks: Column) -> Column:
    """Numbers of the frames in which a track has a pixel, from 0."""
    seen = F.transform(masks, lambda m, i: F.when(m.isNotNull() & (area(m["counts"]) > 0), i))
    return F.array_compact(seen)


def label_mask(labels: Column, wanted: Column) -> Column:
    """One object of a label image as bits, or null where it has no pixel."""
    bits = F.transform(labels, lambda x: (x == wanted).cast("int"))
    return F.when(F.exists(bits, lambda b: b == 1), bits)
