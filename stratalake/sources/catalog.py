"""Tables for SQL users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_tables(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Temporary views `<prefix><table>`; returns their names."""
    names = []
    for table, df in tables.items():
        names.append(f"{prefix}{table}")
        df.createOrReplaceTempView(names[-1])
    return names


def create_external_table(spark: SparkSession, name: str, path: str) -> None:
    """A catalog table over Parquet files that stay where they are."""
    spark.catalog.createTable(name, path=path, source="parquet")
