"""Bronze envelopes to the three silver tables: unnest, keep keyed rows, first row per key, clean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.fixed_values import ARTIST_URL_PREFIX, RELEASE_URL_PREFIX
from stratalake.functions.dates import normalize_partial_date
from stratalake.functions.values import build_url
from stratalake.operators import generators as g
from stratalake.operators import projections as p
from stratalake.operators.dedup import keep_first
from stratalake.operators.filters import key_not_null
from stratalake.schemas import SILVER, SILVER_KEYS

# Which of two duplicates wins: earliest extraction (an unreadable time comes after all others), then search,
# then position in the document, then the remaining columns as projected (dates still as source text).
DOCUMENT_ORDER = ["extracted_at", "artist_search", "recording_pos", "item_pos"]
POSITIONS = ["recording_pos", "item_pos"]


def flat_artists(bronze: DataFrame, wide: bool = False, keep_empty: bool = False) -> DataFrame:
    """One row per credit, duplicates included."""
    credits = g.explode_artist_credits(g.explode_recordings(bronze, keep_empty), keep_empty)
    fields = p.ARTIST_FIELDS_WIDE if wide else p.ARTIST_FIELDS
    return p.project_fields(credits, fields, *g.LINEAGE, *POSITIONS)


def flat_albums(bronze: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per release, duplicates included, dates as in the source."""
    releases = g.explode_releases(g.explode_recordings(bronze, keep_empty), keep_empty)
    return p.project_fields(releases, p.ALBUM_FIELDS, *g.LINEAGE, *POSITIONS)


def flat_songs(bronze: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per recording, duplicates included, dates as in the source."""
    recordings = g.explode_recordings(bronze, keep_empty)
    no_item = F.lit(0).alias("item_pos")
    return p.project_fields(recordings, p.SONG_FIELDS, *g.LINEAGE, "recording_pos", no_item)


FLAT_ROWS = {"artists": flat_artists, "albums": flat_albums, "songs": flat_songs}


def clean_dates(df: DataFrame, raw: str) -> DataFrame:
    clean = normalize_partial_date(F.col(raw))
    return p.derive_and_drop(df, {raw.removesuffix("_raw"): clean}, raw)


def urls(table: str) -> dict[str, Column]:
    if table == "artists":
        return {"artist_url": build_url(ARTIST_URL_PREFIX, F.col("artist_id"))}
    if table == "albums":
        return {"album_url": build_url(RELEASE_URL_PREFIX, F.col("album_id"))}
    return {}


def keyed_rows(bronze: DataFrame, table: str) -> DataFrame:
    """A table's rows that have a key, duplicates included; for batch and streaming frames alike."""
    return key_not_null(FLAT_ROWS[table](bronze), SILVER_KEYS[table])


def merge_rows(rows: DataFrame, table: str) -> DataFrame:
    """The first row per key, positions kept. The rule is associative: merging a merged table with later
    rows gives what one merge of everything gives."""
    return keep_first(rows, SILVER_KEYS[table], DOCUMENT_ORDER, nulls_last=("extracted_at",))


def silver_view(merged: DataFrame, table: str) -> DataFrame:
    """Merged rows in the table's final shape. Dates and URLs are made after the shuffle: from the
    surviving rows only."""
    for raw in [c for c in merged.columns if c.endswith("_raw")]:
        merged = clean_dates(merged, raw)
    return merged.withColumns(urls(table)).select(*SILVER[table].fieldNames())


def transform_artists(bronze: DataFrame) -> DataFrame:
    return silver_view(merge_rows(keyed_rows(bronze, "artists"), "artists"), "artists")


def transform_albums(bronze: DataFrame) -> DataFrame:
    return silver_view(merge_rows(keyed_rows(bronze, "albums"), "albums"), "albums")


def transform_songs(bronze: DataFrame) -> DataFrame:
    return silver_view(merge_rows(keyed_rows(bronze, "songs"), "songs"), "songs")


TRANSFORMS = {"artists": transform_artists, "albums": transform_albums, "songs": transform_songs}
