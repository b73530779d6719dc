from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_not_null(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def target_searches(df: DataFrame, targets: list[str] | DataFrame) -> DataFrame:
    """Keep the rows of the wanted searches. A list from the caller's own code becomes an IN filter, which
    the Parquet scan takes; a table of any size becomes a semi join, whose strategy Spark picks from the
    table's measured size."""
    if isinstance(targets, DataFrame):
        return df.join(targets, "artist_search", "left_semi")
    return df.filter(F.col("artist_search").isin(targets))
