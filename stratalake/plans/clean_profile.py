"""Interactive cleaning: remove duplicates, fix types, fill flags, and profile before and after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import normalize_partial_date
from stratalake.functions.values import flag_or_false
from stratalake.operators.profile import null_profile, stack_profiles
from stratalake.plans.flat_export import RAW_DATES, Bronze, first_rows


def _cleaned(column: str) -> Column:
    if column in RAW_DATES.values():
        return normalize_partial_date(F.col(column))
    return flag_or_false(F.col(column)) if column == "video" else F.col(column)


def clean_tables(bronze: Bronze) -> dict[str, DataFrame]:
    return {
        name: df.select(*(_cleaned(c).alias(c.removesuffix("_raw")) for c in df.columns))
        for name, df in first_rows(bronze).items()
    }


def clean_and_profile(bronze: Bronze) -> DataFrame:
    """(stage, table, column, null_count) of the de-duplicated tables before and after cleaning. Both
    stages are counted side by side, so each table is de-duplicated once."""
    profiles = []
    for name, df in first_rows(bronze).items():
        before = [F.col(c).alias(f"before:{c.removesuffix('_raw')}") for c in df.columns]
        after = [_cleaned(c).alias(f"after:{c.removesuffix('_raw')}") for c in df.columns]
        profiles.append(null_profile(df.select(*before, *after), name))
    stage_and_column = F.split("column", ":")
    return stack_profiles(profiles).select(
        stage_and_column[0].alias("stage"), "table", stage_and_column[1].alias("column"), "null_count"
    )
