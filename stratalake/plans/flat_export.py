"""The flat CSV export: wide artists, duplicates removed but rows without a key kept as one row."""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.fixed_values import ARTIST_URL_PREFIX, RELEASE_URL_PREFIX
from stratalake.functions.values import build_url
from stratalake.operators.dedup import keep_first
from stratalake.operators.projections import ALBUM_FIELDS, ARTIST_FIELDS_WIDE, SONG_FIELDS
from stratalake.plans import silver as s
from stratalake.plans.jobs import run_together, stage_bronze, staged_parts
from stratalake.schemas import BRONZE, CORRUPT_COLUMN, SILVER_KEYS, with_corrupt
from stratalake.session import drop_work_dir, short_lived_shuffles, work_dir
from stratalake.sources.readers import latest_file, scan_bronze_json, unreadable
from stratalake.sources.writers import export_stamp, write_csv_export, write_with_count

RAW_DATES = {"album": "release_date_raw", "song": "first_release_date_raw"}


# Envelopes, or per silver table the envelopes with only what that table needs of them.
Bronze = DataFrame | dict[str, DataFrame]


def first_rows(bronze: Bronze) -> dict[str, DataFrame]:
    """First row per key in document order, with URLs and with the date texts as they came."""
    parts = bronze if isinstance(bronze, dict) else dict.fromkeys(SILVER_KEYS, bronze)
    album = keep_first(s.flat_albums(parts["albums"]), "album_id", s.DOCUMENT_ORDER, ("extracted_at",))
    artist = keep_first(s.flat_artists(parts["artists"], wide=True), "artist_id", s.DOCUMENT_ORDER, ("extracted_at",))
    song = keep_first(s.flat_songs(parts["songs"]), "recording_id", s.DOCUMENT_ORDER, ("extracted_at",))
    album_url = build_url(RELEASE_URL_PREFIX, F.col("album_id")).alias("album_url")
    artist_url = build_url(ARTIST_URL_PREFIX, F.col("artist_id")).alias("artist_url")
    lineage = ["artist_search", "extracted_at"]
    return {
        "album": album.select(*ALBUM_FIELDS, album_url, *lineage),
        "artist": artist.select(*ARTIST_FIELDS_WIDE, artist_url, *lineage),
        "song": song.select(*SONG_FIELDS, *lineage),
    }


def flat_tables(bronze: Bronze) -> dict[str, DataFrame]:
    """album, artist and song rows as exported: partial dates completed, unusable ones null."""
    return {
        name: s.clean_dates(df, RAW_DATES[name]) if name in RAW_DATES else df
        for name, df in first_rows(bronze).items()
    }


def export_flat(spark: SparkSession, bronze: Bronze, out: str, run_ts: datetime) -> dict[str, str]:
    """Write `<out>/<table>_data/<table>_<stamp>` per table; returns the folders."""
    stamp = spark.range(1).select(export_stamp(F.lit(run_ts))).first()[0]
    tables = flat_tables(bronze)
    folders = {name: f"{out}/{name}_data/{name}_{stamp}" for name in tables}
    with short_lived_shuffles(spark):
        run_together(spark, {n: partial(write_csv_export, df, folders[n]) for n, df in tables.items()})
    return folders


def export_files(
    spark: SparkSession, path: str | list[str], out: str, run_ts: datetime, multi_line: bool = True
) -> dict[str, str | int]:
    """Raw files to CSV: the folder of each table's export, and under `unreadable` how many texts were no envelopes.
    Those texts are kept in `<out>/unreadable/unreadable_<stamp>` (Parquet), which is written whether or not there are
    any. Files of which nothing can be read are an error: then no table is written."""
    staged = work_dir(spark, "bronze")
    try:
        stage_bronze(scan_bronze_json(spark, path, multi_line=multi_line, keep_corrupt=True), staged)
        stamp = spark.range(1).select(export_stamp(F.lit(run_ts))).first()[0]
        kept = f"{out}/unreadable/unreadable_{stamp}"
        count = write_with_count(unreadable(spark, staged), kept)
        readable = spark.read.schema(with_corrupt(BRONZE)).parquet(staged).where(F.col(CORRUPT_COLUMN).isNull())
        if count and readable.isEmpty():
            raise ValueError(f"no envelope in {path}, only {count} texts that can't be read, kept in {kept}")
        return export_flat(spark, staged_parts(spark, staged), out, run_ts) | {"unreadable": count}
    finally:
        drop_work_dir(spark, staged)


def export_newest(
    spark: SparkSession, landing: str, out: str, archive: str, run_ts: datetime, multi_line: bool = True
) -> dict[str, str | int]:
    """The newest raw file of a landing folder to CSV, then the file to the archive folder; returns what
    `export_files` does. The file is moved last, and only if all that it holds is exported or kept as unreadable, so a
    run that dies is run again on the same file. One file is what one extraction wrote; use the incremental job for
    many."""
    newest = latest_file(spark, landing)["path"]
    result = export_files(spark, newest, out, run_ts, multi_line)
    path = spark._jvm.org.apache.hadoop.fs.Path
    source, target = path(newest), path(archive)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    if not files.rename(source, path(target, source.getName())):
        raise OSError(f"{newest} is exported but could not be moved to {archive}")
    return result
