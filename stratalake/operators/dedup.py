"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str, order: list[str | Column], nulls_last: tuple[str, ...] = ()) -> DataFrame:
    """The first row per key; a null key counts as a key of its own. Nulls come first, but last in the columns
    of `nulls_last`. The order is made total by the columns it does not name (nulls first), so neither file
    order nor a task that runs again changes the result.

    Spark cuts each task's rows down to one per key before the shuffle (window group limit), so even a key that
    holds a third of all rows sends at most one row per map task."""
    named = {c for c in order if isinstance(c, str)}
    last = lambda c: F.col(c).asc_nulls_last() if c in nulls_last else F.col(c).asc_nulls_first()
    ranked = [last(c) if isinstance(c, str) else c for c in order]
    ranked += [F.col(c).asc_nulls_first() for c in df.columns if c not in named and c != key]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*ranked))
    return df.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def keep_any(df: DataFrame, key: str) -> DataFrame:
    """Some row per key; which one may change between runs."""
    return df.dropDuplicates([key])
