"""Profiles as DataFrames: null counts, shape and types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """(table, column, null_count): one pass over the table, whatever its width."""
    counts = df.agg(*(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns))
    return (
        counts.unpivot([], [f"`{c}`" for c in df.columns], "column", "null_count")
        .select(F.lit(table).alias("table"), "column", "null_count")
    )


def shape_dtypes(df: DataFrame, table: str) -> DataFrame:
    """(table, column, dtype, row_count, column_count)"""
    types = F.array(
        *(F.struct(F.lit(n).alias("column"), F.lit(t).alias("dtype")) for n, t in df.dtypes)
    )
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.explode(types).alias("c"), "row_count")
        .select(
            F.lit(table).alias("table"),
            "c.column",
            "c.dtype",
            "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
        )
    )


def stack_profiles(profiles: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, profiles)
