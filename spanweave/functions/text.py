"""Column functions over names, texts and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Fixed value: the characters that identifiers may have.
OTHER = "[^A-Za-z0-9_.]+"


def safe(col: Column | str) -> Column:
    """Runs of characters outside [A-Za-z0-9_.] become one dash; outer dashes go."""
    return F.regexp_replace(F.regexp_replace(col, OTHER, "-"), "^-+|-+$", "")


def stable_key(seed: str, *parts: Column) -> Column:
    """A pseudo-random order that only the seed and the parts decide."""
    return F.sha2(F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts]), 256)


def blank(col: Column) -> Column:
    return F.coalesce(F.trim(col) == "", F.lit(True))
