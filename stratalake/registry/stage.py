"""The derived layers each session works on, written once per table folder to the shared folder: bronze as
JSON Lines (as landed), bronze as nested Parquet, and the silver tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.plans.jobs import (
    read_staged,
    silver_from_staged,
    stage_bronze,
    staged_parts,
    write_tables,
)
from stratalake.registry.bronze_from_tables import envelopes
from stratalake.schemas import SILVER
from stratalake.session import short_lived_shuffles, work_dir
from stratalake.sources.readers import scan_bronze_json, scan_silver_parquet
from stratalake.sources.writers import write_json_lines


@dataclass
class Layers:
    spark: SparkSession
    sf_dir: str
    json_path: str | None = None
    parquet_path: str | None = None
    silver_path: str | None = None
    silver_tables: set[str] = field(default_factory=set)

    def bronze_json(self) -> str:
        if self.json_path is None:
            path = work_dir(self.spark, "landed")
            with short_lived_shuffles(self.spark):
                write_json_lines(envelopes(self.spark, self.sf_dir), path)
            self.json_path = path
        return self.json_path

    def bronze(self, table: str | None = None) -> DataFrame:
        """Whole envelopes, or the part of them that a silver table needs."""
        path = self.bronze_parquet()
        return staged_parts(self.spark, path)[table] if table else read_staged(self.spark, path)

    def bronze_parts(self) -> dict[str, DataFrame]:
        return staged_parts(self.spark, self.bronze_parquet())

    def bronze_parquet(self) -> str:
        if self.parquet_path is None:
            path = work_dir(self.spark, "bronze")
            stage_bronze(scan_bronze_json(self.spark, self.bronze_json()), path)
            self.parquet_path = path
        return self.parquet_path

    def silver(self, table: str) -> DataFrame:
        return scan_silver_parquet(self.spark, self.silver_base(table), table)

    def silver_base(self, *tables: str) -> str:
        """The folder of the silver tables, in which the named ones, or all, are written by now."""
        if self.silver_path is None:
            self.silver_path = work_dir(self.spark, "silver")
        missing = [t for t in tables or SILVER if t not in self.silver_tables]
        if missing:
            made = silver_from_staged(self.spark, self.bronze_parquet())
            write_tables(self.spark, {t: made[t] for t in missing}, self.silver_path)
            self.silver_tables.update(missing)
        return self.silver_path


_layers: dict[tuple[str, str], Layers] = {}


def layers(spark: SparkSession, sf_dir: str) -> Layers:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _layers:
        _layers[key] = Layers(spark, sf_dir.rstrip("/"))
    return _layers[key]


def comparable(df: DataFrame) -> DataFrame:
    """Dates as ISO text and instants as whole epoch seconds: types that every engine holds alike."""

    def plain(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.unix_seconds(column)
        return column.alias(field.name)

    return df.select(*(plain(f) for f in df.schema))
