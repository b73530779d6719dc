"""Sorting and top-n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_year_and_releases(metrics: DataFrame) -> DataFrame:
    """Latest year first, most releases first, ties by country."""
    return metrics.orderBy(F.desc("release_year"), F.desc("total_releases"), F.asc("country_code"))


def preview_head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.col(key).asc_nulls_last()).limit(n)


def newest_top1(listing: DataFrame) -> DataFrame:
    """The last changed file of a listing (ties by path)."""
    return listing.orderBy(F.desc("modificationTime"), F.desc("path")).limit(1)


def top_n_per_key(
    df: DataFrame, key: str, order: list[Column], n: int, spread_by: str, parts: int = 64
) -> DataFrame:
    """The first n rows per key, in two rounds: each key is first ranked in `parts` hash parts, then the
    survivors (at most n x parts per key) are ranked together. A hot key is so never ranked by one task."""
    part = F.pmod(F.xxhash64(spread_by), F.lit(parts))

    def cut(rows: DataFrame, *keys: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        return rows.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")

    return cut(cut(df.withColumn("_part", part), key, "_part"), key).drop("_part")
