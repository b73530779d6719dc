"""Sinks. Each write is one job; the row count comes from the same pass."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.dates import iso_utc, utc_text
from stratalake.functions.values import decode_json
from stratalake.schemas import PAYLOAD
from stratalake.fixed_values import EXPORT_STAMP_FORMAT, LANDING_STAMP_FORMAT
from stratalake.session import importable
from stratalake.sources.lookup import key_index

# Landed JSON repeats its field names in every record: gzip makes it a tenth or less. One task reads a gzip file, so a
# file is closed after so many envelopes; a task that writes more begins another.
LANDED_CODEC = "gzip"
LANDED_ENVELOPES = 250_000
# Staged and ingested bronze take a quarter less room than with Snappy. Tables in buckets keep Snappy: their number of
# buckets follows their bytes.
INNER_CODEC = "zstd"
# A scan task gets files up to a size in bytes. Compressed tenfold and more, they would hold more rows than the task can
# sort in memory when it looks for first rows, so inner tables that are sorted next have files of bounded length: a file
# counts as 4 MB more than it has, which bounds a task's files and so its rows.
STAGED_ENVELOPES = 50_000
CHANGED_ROWS = 100_000


def write_parquet_overwrite(
    df: DataFrame, path: str, partition_by: str | None = None, key: str | None = None, codec: str = "snappy",
    file_rows: int | None = None, key_rows: int | None = None,
) -> None:
    """Replace a table. With `partition_by` only the partitions that occur in `df` are replaced. With `key` the files
    are made for look-ups by it, which are cheap if the rows are sorted by it; `key_rows`, if known, is the most that
    one of them holds. A file has at most `file_rows` rows, if given."""
    writer = df.write.mode("overwrite").option("compression", codec)
    if file_rows:
        writer = writer.option("maxRecordsPerFile", file_rows)
    if key:
        writer = writer.options(**key_index(key, rows=key_rows))
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    writer.parquet(path)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and what will hold its number of rows under `n` once it has been written."""
    seen = Observation(f"written-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def write_with_count(df: DataFrame, path: str, key: str | None = None) -> int:
    """Replace a Parquet table and return how many rows were written, without running the plan twice."""
    rows, seen = counted(df)
    write_parquet_overwrite(rows, path, key=key)
    return seen.get["n"]


def make_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def publish_with_count(df: DataFrame, path: str, key: str | None = None) -> int:
    """Replace a table by writing it beside the old one and renaming it when it is complete, so that a run that
    dies leaves the old table as it was. On stores without atomic rename the change-over is as short as their
    rename."""
    aside = f"{path.rstrip('/')}.{uuid.uuid4().hex[:12]}"
    count = write_with_count(df, aside, key)
    spark = df.sparkSession
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (aside, path))
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(old, True)
    if not files.rename(new, old):
        raise OSError(f"{aside} is complete but could not be renamed to {path}")
    return count


def export_stamp(ts: Column) -> Column:
    return utc_text(ts, EXPORT_STAMP_FORMAT)


def landing_stamp(ts: Column) -> Column:
    return utc_text(ts, LANDING_STAMP_FORMAT)


def write_csv_export(df: DataFrame, path: str) -> None:
    """CSV with a header. Null is an empty field, an empty text is quoted, a quote is doubled."""
    text_as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, escape='"', **text_as_is).csv(path)


def json_lines_writer(df: DataFrame, mode: str = "overwrite", codec: str = LANDED_CODEC) -> DataFrameWriter:
    """A writer of JSON Lines as they are landed. With the codec "none" a file has no end of its own and is read in
    splits; compressed ones are read by a task each."""
    writer = df.write.mode(mode).option("compression", codec)
    return writer if codec == "none" else writer.option("maxRecordsPerFile", LANDED_ENVELOPES)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    json_lines_writer(df, mode).json(path)


def write_json_arrays(df: DataFrame, path: str, per_file: int | None = None) -> None:
    """JSON files that hold one array each, written as the rows pass by: a file per partition, read in splits; or, with
    `per_file`, compressed files of so many neighbouring rows."""

    def bracketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, whole = 0, False
        for batch in batches:
            lines = []
            for text in batch.column(0).to_pylist():
                lines.append(("," if held else "[") + text)
                held, whole = held + 1, False
                if held == per_file:
                    lines.append("]")
                    held, whole = 0, True
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        if not whole:
            yield pa.RecordBatch.from_arrays([pa.array(["]" if held else "[]"])], ["value"])

    texts = importable(df.select(F.to_json(F.struct(*df.columns)).alias("value")))
    writer = texts.mapInArrow(bracketed, "value string").write.mode("overwrite")
    if per_file:
        # An array's lines are its rows and the closing bracket, so each file begins with the next array.
        writer = writer.option("compression", LANDED_CODEC).option("maxRecordsPerFile", per_file + 1)
    writer.text(path)


def make_envelopes(payloads: DataFrame, extracted_at: Column) -> DataFrame:
    """(artist_search, payload text) to envelopes. Unreadable payload text gives an envelope with null
    `data`: it stays countable in bronze and gives no silver rows."""
    return payloads.select(
        "artist_search",
        iso_utc(extracted_at).alias("extracted_at"),
        decode_json(F.col("payload"), PAYLOAD).alias("data"),
    )


def land_bronze(envelopes: DataFrame, path: str, run_ts: Column, codec: str = LANDED_CODEC) -> None:
    """Write one run's envelopes as JSON Lines below `batch_id=<stamp>`. Running the same stamp again
    replaces that run's folder only. Choose the codec "none" for a file that has to be read in splits."""
    (
        json_lines_writer(envelopes.withColumn("batch_id", landing_stamp(run_ts)), codec=codec)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .json(path)
    )
