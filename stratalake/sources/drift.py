"""Schema drift between batches of raw JSON.

The types of all values of a batch are joined as an aggregate, in one pass and without a driver loop over records. The
paths and types that come out are kept per batch and compared with those of the batch before: a path may be added or
lost, its type widened (every earlier value still fits), narrowed, or contradicted (no type holds both)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.writers import write_parquet_overwrite

HISTORY = "batch string, path string, type string, record_count bigint"
# Types that hold all values of those before them. VOID stands for null alone, VARIANT for values of no common type.
NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")
_TOKEN = re.compile(r"\s*(`(?:[^`]|``)*`|[A-Za-z_0-9]+(?:\([0-9, ]*\))?|[<>:,])")


def paths_of(schema: str) -> dict[str, str]:
    """{path: type} of a schema as text (`OBJECT<a: ARRAY<BIGINT>>`); `[]` marks array elements. Objects and arrays are
    paths of their own."""
    tokens = _TOKEN.findall(schema)
    out: dict[str, str] = {}
    at = 0

    def kind(path: str) -> None:
        nonlocal at
        name = tokens[at]
        at += 1
        out[path] = "DECIMAL" if name.startswith("DECIMAL") else name
        if at < len(tokens) and tokens[at] == "<":
            at += 1
            while tokens[at] != ">":
                if name == "ARRAY":
                    kind(f"{path}[]")
                else:
                    field = tokens[at]
                    field = field[1:-1].replace("``", "`") if field.startswith("`") else field
                    at += 2  # the name and its colon
                    kind(f"{path}.{field}" if path else field)
                if tokens[at] == ",":
                    at += 1
            at += 1

    kind("")
    return out


def batch_schema(texts: DataFrame) -> tuple[dict[str, str], int]:
    """({path: type}, number of records) of the JSON values in `text`. Texts that are no JSON count as records without
    paths. As many paths come to the driver as the values have."""
    found = texts.agg(F.schema_of_variant_agg(F.try_parse_json("text")).alias("schema"), F.count(F.lit(1)).alias("n")).first()
    return paths_of(found["schema"] or "VOID"), found["n"]


def change_of(before: str | None, after: str | None) -> str | None:
    if before == after:
        return None
    if before is None or after is None:
        return "added" if before is None else "lost"
    if before == "VOID" or before in NUMBERS and after in NUMBERS and NUMBERS.index(before) < NUMBERS.index(after):
        return "widened"
    if after == "VOID" or before in NUMBERS and after in NUMBERS:
        return "narrowed"
    return "contradicted"


def drift(before: dict[str, str], after: dict[str, str]) -> list[tuple[str, str, str | None, str | None]]:
    """(path, change, type before, type after), by path."""
    rows = [(p, change_of(before.get(p), after.get(p)), before.get(p), after.get(p)) for p in sorted({*before, *after})]
    return [r for r in rows if r[1]]


def record_schema(spark: SparkSession, texts: DataFrame, history: str, batch: str) -> DataFrame:
    """Keep a batch's paths and types below `history`, and return what drifted since the batch before it (path, change,
    before, after). Batches are ordered by their names; recording one again replaces it. The first drifts from nothing:
    all its paths are added."""
    found, n = batch_schema(texts)
    rows = [(batch, path, kind, n) for path, kind in found.items()]
    write_parquet_overwrite(spark.createDataFrame(rows, HISTORY).coalesce(1), history, partition_by="batch")
    kept = spark.read.schema(HISTORY).parquet(history)
    last = kept.where(F.col("batch") < batch).agg(F.max("batch")).first()[0]
    before = {r["path"]: r["type"] for r in kept.where(F.col("batch") == last).collect()} if last else {}
    return spark.createDataFrame(drift(before, found), "path string, change string, before string, after string")
