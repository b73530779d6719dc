"""Distinct counts from sketches that can be kept and united.

An exact distinct count has to see all values again whenever rows come. A sketch (HyperLogLog, 2^14 registers, 12 KB)
is kept per group and batch; uniting the batches' sketches gives one of all rows, and an estimate with a relative
standard error of 0.8 %. Groups of few values have small sketches and nearly exact estimates. In what parts rows were
counted changes an estimate within that error."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REGISTER_BITS = 14
# Three standard errors; an estimate is off by more with a chance of 0.3 %.
ERROR_BOUND = 0.025


def distinct_sketches(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The keys and, for each column, a sketch of its values under the column's name. Nulls don't count. Combined on
    the map side, so a group with a third of all rows sends one sketch per task."""
    return rows.groupBy(*keys).agg(*(F.hll_sketch_agg(F.col(c), F.lit(REGISTER_BITS)).alias(c) for c in columns))


def unite_sketches(sketches: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key from the rows of several batches: sketches of all their rows."""
    return sketches.groupBy(*keys).agg(*(F.hll_union_agg(F.col(c), F.lit(True)).alias(c) for c in columns))


def estimate_distinct(sketches: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return sketches.select(*keys, *(F.hll_sketch_estimate(c).alias(c) for c in columns))


# A quantile's rank is off by at most this share of the rows (99 % confidence for KLL with k = 800: 0.4 %).
QUANTILE_K, RANK_ERROR = 800, 0.005
# Values that a column's counter tracks: counts are exact for columns with no more of them, and else too high by at
# most the rows divided by three quarters of this.
TRACKED = 4096
PROFILE_KEYS = ["table", "column"]


def profile_states(df: DataFrame, table: str) -> DataFrame:
    """(table, column, row_count, null_count, quantiles, frequent): the state of each column's profile, in one pass.
    Numbers, dates and times have quantiles (dates as days, times as seconds); all columns' most frequent values are
    tracked as text. States are a few 10 KB each."""

    def number(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind == "date":
            return F.unix_date(column).cast("double")
        if kind.startswith("timestamp"):
            return column.cast("timestamp").cast("double")
        return column.cast("double") if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal") else None

    aggregates, states = [F.count(F.lit(1)).alias("rows")], []
    for i, (name, kind) in enumerate(df.dtypes):
        aggregates.append(F.count_if(F.col(f"`{name}`").isNull()).alias(f"nulls{i}"))
        aggregates.append(F.expr(f"approx_top_k_accumulate(CAST(`{name}` AS STRING), {TRACKED})").alias(f"frequent{i}"))
        quantiles = F.lit(None).cast("binary")
        if (value := number(name, kind)) is not None:
            aggregates.append(F.kll_sketch_agg_double(value, F.lit(QUANTILE_K)).alias(f"quantiles{i}"))
            quantiles = F.col(f"quantiles{i}")
        row = {"column": F.lit(name), "null_count": F.col(f"nulls{i}"), "quantiles": quantiles, "frequent": F.col(f"frequent{i}")}
        states.append(F.struct(*(v.alias(k) for k, v in row.items())))
    wide = df.agg(*aggregates).select("rows", F.inline(F.array(*states)))
    return wide.select(F.lit(table).alias("table"), "column", F.col("rows").alias("row_count"), "null_count", "quantiles", "frequent")


def unite_profiles(states: DataFrame) -> DataFrame:
    """One state per table and column from those of several batches."""
    return states.groupBy(*PROFILE_KEYS).agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_K)).alias("quantiles"),
        F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent"),
    )


def profile(states: DataFrame, ranks: tuple[float, ...] = (0.25, 0.5, 0.75), top: int = 3) -> DataFrame:
    """(table, column, row_count, null_count, quantiles, frequent): quantiles at the given ranks, null where a column
    has none or only nulls, and the most frequent values with their counts, nulls among them."""
    known = F.col("quantiles").isNotNull() & (F.kll_sketch_get_n_double("quantiles") > 0)
    found = F.when(known, F.array(*(F.kll_sketch_get_quantile_double("quantiles", F.lit(r)) for r in ranks)))
    frequent = F.expr(f"approx_top_k_estimate(frequent, {top})")
    return states.select(*PROFILE_KEYS, "row_count", "null_count", found.alias("quantiles"), frequent.alias("frequent"))
