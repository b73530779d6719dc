"""The two batch jobs: bronze to silver, silver to gold."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession

from stratalake.plans.gold import build_artist_summary, build_yearly_release_metrics
from stratalake.plans.silver import TRANSFORMS
from stratalake.schemas import BRONZE, BRONZE_FOR, SILVER_KEYS
from stratalake.session import drop_work_dir, short_lived_shuffles, work_dir
from stratalake.sources.readers import scan_bronze_json, scan_silver_parquet, unreadable
from stratalake.sources.writers import INNER_CODEC, STAGED_ENVELOPES, publish_with_count, write_parquet_overwrite

T = TypeVar("T")


def run_together(spark: SparkSession, tasks: dict[str, Callable[[], T]]) -> dict[str, T]:
    """Run independent jobs at the same time: one's last tasks then do not leave the cluster idle."""
    with ThreadPoolExecutor(max(1, len(tasks))) as pool:
        runs = {name: pool.submit(inheritable_thread_target(spark)(task)) for name, task in tasks.items()}
        return {name: run.result() for name, run in runs.items()}


def write_tables(
    spark: SparkSession, tables: dict[str, DataFrame], base: str, keys: dict[str, str] | None = None
) -> dict[str, int]:
    """Write all tables below `base` and return their row counts. Each old table stays until its successor is
    complete. Tables that have one of the `keys` are made for look-ups by it."""
    keys = keys or {}
    with short_lived_shuffles(spark):
        return run_together(
            spark, {name: partial(publish_with_count, df, f"{base}/{name}", keys.get(name)) for name, df in tables.items()}
        )


def stage_bronze(envelopes: DataFrame, path: str) -> None:
    """Bronze as nested Parquet: raw JSON is parsed once, whatever is built from it. The copy lies in the
    shared folder, so lost executors cost no re-parse."""
    write_parquet_overwrite(envelopes, path, codec=INNER_CODEC, file_rows=STAGED_ENVELOPES)


def read_staged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path)


def staged_parts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """For each silver table the staged envelopes with only what that table needs of them."""
    return {table: spark.read.schema(schema).parquet(path) for table, schema in BRONZE_FOR.items()}


def silver_from_staged(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {table: TRANSFORMS[table](part) for table, part in staged_parts(spark, path).items()}


def run_bronze_to_silver(
    spark: SparkSession,
    bronze_path: str | list[str],
    silver_base: str,
    multi_line: bool = False,
    stage_path: str | None = None,
) -> dict[str, int]:
    """Rebuild artists, albums and songs from all raw files; returns the row count per table, and under
    `unreadable` how many texts were no envelopes. `<silver_base>/unreadable` holds those texts of this run, and
    is empty if there are none. The staged copy is kept where `stage_path` says; without one it is removed at the
    end, also of a failed run."""
    staged = stage_path or work_dir(spark, "bronze")
    try:
        stage_bronze(scan_bronze_json(spark, bronze_path, multi_line=multi_line, keep_corrupt=True), staged)
        # The window that picks first rows leaves each task's rows sorted by key.
        counts = write_tables(spark, silver_from_staged(spark, staged), silver_base, SILVER_KEYS)
        counts["unreadable"] = publish_with_count(unreadable(spark, staged), f"{silver_base}/unreadable")
    finally:
        if stage_path is None:
            drop_work_dir(spark, staged)
    return counts


def run_silver_to_gold(
    spark: SparkSession, silver_base: str, gold_base: str, run_ts: datetime | Column | None = None
) -> dict[str, int]:
    """Rebuild the summary and the yearly metrics; returns the row count per table."""
    artists, albums, songs = (
        scan_silver_parquet(spark, silver_base, t) for t in ("artists", "albums", "songs")
    )
    tables = {
        "artist_summary": build_artist_summary(artists, songs, albums, run_ts),
        "yearly_release_metrics": build_yearly_release_metrics(albums, run_ts),
    }
    return write_tables(spark, tables, gold_base)
