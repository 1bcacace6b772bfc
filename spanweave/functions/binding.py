"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(df: DataFrame, **columns: Column) -> DataFrame:
    """The frame with these columns, each row's computed once.

    The optimizer merges projections, and a column that is named within a lambda would then be computed anew for each
    element, level upon level. A generator over one struct stands between and costs next to nothing.
    """
    cols = [c for c in df.columns if c not in columns]
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*cols, F.explode(F.array(made)).alias("_bound")).select(*cols, *[F.col("_bound").getField(n).alias(n) for n in columns])


def let(value: Column, use) -> Column:
    """use(value) within an expression, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
