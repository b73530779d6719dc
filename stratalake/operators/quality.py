"""Data-quality rules. Each returns (table, rule, column, violations)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.dates import normalize_partial_date


def _report(df: DataFrame, table: str, rule: str, violations: dict[str, Column]) -> DataFrame:
    """Global aggregates, one per column, turned into one row per column."""
    counted = df.agg(*(v.cast("bigint").alias(c) for c, v in violations.items()))
    return counted.unpivot([], [f"`{c}`" for c in violations], "column", "violations").select(
        F.lit(table).alias("table"), F.lit(rule).alias("rule"), "column", "violations"
    )


def dq_null_check(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return _report(df, table, "not_null", {c: F.count_if(F.col(c).isNull()) for c in columns})


def dq_unique_check(df: DataFrame, table: str, key: str) -> DataFrame:
    """Surplus rows: for each non-null key, all but one. Counted per key on the map side first."""
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return _report(per_key, table, "unique", {key: surplus})


def dq_date_check(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Source texts that are there but give no date."""
    bad = {
        c: F.count_if(F.col(c).isNotNull() & normalize_partial_date(F.col(c)).isNull()) for c in columns
    }
    return _report(df, table, "valid_date", bad)


def dq_schema_check(df: DataFrame, table: str, expected: T.StructType) -> DataFrame:
    """Rows that lack an expected column or hold it in another type: all of the table's or none."""
    actual = {f.name: f.dataType for f in df.schema}
    rows = F.count(F.lit(1))
    return _report(
        df,
        table,
        "schema",
        {f.name: F.lit(0) if actual.get(f.name) == f.dataType else rows for f in expected},
    )
