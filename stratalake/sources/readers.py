"""Reading bronze JSON and silver Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.ordering import newest_top1
from stratalake.schemas import BRONZE, CORRUPT_COLUMN, SILVER, with_corrupt
from stratalake.session import work_dir
from stratalake.sources.json_values import parsed, scan_fragments, value_texts


def scan_bronze_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = BRONZE,
    multi_line: bool = False,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Envelopes from JSON files.

    By default each line is a value (JSON Lines), as `land_bronze` writes them. With `multi_line` files may have any
    layout, each its own: an array, values over several lines, or a value per line; see `json_values`. Both ways split
    files, so that many tasks share a large one; JSON Lines take one pass, the other three. `keep_corrupt` adds
    `_corrupt_record`: unreadable text, such as the lines of an array read as JSON Lines, becomes a row there instead
    of an envelope of nulls."""
    if multi_line:
        return parsed(value_texts(scan_fragments(spark, path)), schema, keep_corrupt)
    if keep_corrupt:
        schema = with_corrupt(schema)
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def unreadable(spark: SparkSession, staged: str) -> DataFrame:
    """The texts in a staged bronze table that were no envelopes."""
    rows = spark.read.schema(with_corrupt(BRONZE)).parquet(staged)
    return rows.select(F.col(CORRUPT_COLUMN).alias("text")).filter("text IS NOT NULL")


def conform_bronze(inferred: DataFrame) -> DataFrame:
    """A frame whose schema was inferred, brought to the bronze schema by field name at every level: fields
    that no record carried are added as null, further ones dropped."""
    return inferred.to(BRONZE)


def scan_silver_parquet(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A silver table's own columns, whether or not it lies in bucket folders."""
    return spark.read.schema(SILVER[table]).parquet(f"{base}/{table}").select(*SILVER[table].fieldNames())


def read_csv_export(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """An export read back, as text columns unless a schema is given; an empty text comes back as null.
    `multi_line` is only needed for texts with line breaks; without it files can be split."""
    reader = spark.read.options(header=True, escape='"', multiLine=multi_line)
    return (reader.schema(schema) if schema else reader).csv(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length) of every file below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "modificationTime", "length")


def latest_file(spark: SparkSession, path: str) -> Row:
    """Path and times of the file changed last; an empty folder is an error."""
    newest = newest_top1(list_files(spark, path)).first()
    if newest is None:
        raise FileNotFoundError(f"no files below {path}")
    return newest


def scan_latest_file(
    spark: SparkSession, path: str, schema: T.StructType = BRONZE, multi_line: bool = False
) -> DataFrame:
    """Only the newest file's envelopes. Just its path passes through the driver."""
    return scan_bronze_json(spark, latest_file(spark, path)["path"], schema, multi_line)


def latest_batch(spark: SparkSession, path: str) -> str:
    """The newest landed run's stamp, from file names alone; stamps sort as text."""
    stamp = F.regexp_extract("path", r"/batch_id=([^/]+)/", 1)
    newest = list_files(spark, path).agg(F.max(F.nullif(stamp, F.lit("")))).first()[0]
    if newest is None:
        raise FileNotFoundError(f"no landed batch below {path}")
    return newest


def scan_latest_batch(spark: SparkSession, path: str, schema: T.StructType = BRONZE) -> DataFrame:
    """The newest landed run: a run writes many files, so the run is the unit. The filter on the partition
    column prunes every other folder."""
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())])
    landed = scan_bronze_json(spark, path, with_batch)
    return landed.filter(F.col("batch_id") == latest_batch(spark, path)).select(*schema.fieldNames())


def flatten_schema(schema: T.StructType) -> list[tuple[str, str, bool]]:
    """(path, type, nullable) for every field, `[]` marking array elements."""

    def walk(kind: T.DataType, path: str, nullable: bool) -> list[tuple[str, str, bool]]:
        if isinstance(kind, T.StructType):
            prefix = f"{path}." if path else ""
            inner = [r for f in kind for r in walk(f.dataType, prefix + f.name, f.nullable)]
            return ([(path, "struct", nullable)] if path else []) + inner
        if isinstance(kind, T.ArrayType):
            return [(path, "array", nullable), *walk(kind.elementType, f"{path}[]", kind.containsNull)]
        return [(path, kind.simpleString(), nullable)]

    return walk(schema, "", True)


def infer_bronze(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Raw files under the schema that Spark infers from all their values. `multi_line`: files of any layout, whose
    values are written one per line first."""
    if multi_line:
        # A line break inside a JSON string is escaped, so those that stand there are only layout.
        lines = value_texts(scan_fragments(spark, path)).select(F.regexp_replace("text", "[\r\n]+", " "))
        path = work_dir(spark, "values")
        lines.write.text(path)
    return spark.read.json(path)


def inspect_schema(df: DataFrame) -> DataFrame:
    """(path, type, nullable, record_count): the frame's nested schema next to its row count."""
    fields = F.array(
        *(
            F.struct(F.lit(p).alias("path"), F.lit(t).alias("type"), F.lit(n).alias("nullable"))
            for p, t, n in flatten_schema(df.schema)
        )
    )
    counted = df.agg(F.count(F.lit(1)).alias("record_count"))
    return counted.select(F.inline(fields), "record_count")
