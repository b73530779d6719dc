"""Struct leaves to flat, renamed and typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.values import number_of_text, safe_cast

# output column: (path in the unnested row, type)
ARTIST_FIELDS = {
    "artist_id": ("artist_credit.artist.id", "string"),
    "artist_name": ("artist_credit.artist.name", "string"),
    "artist_sort_name": ("artist_credit.artist.sort-name", "string"),
    "artist_disambiguation": ("artist_credit.artist.disambiguation", "string"),
}
ARTIST_FIELDS_WIDE = {
    **ARTIST_FIELDS,
    "artist_type": ("artist_credit.artist.type", "string"),
    "artist_country": ("artist_credit.artist.country", "string"),
}
ALBUM_FIELDS = {
    "album_id": ("release.id", "string"),
    "album_name": ("release.title", "string"),
    "release_date_raw": ("release.date", "string"),
    "country": ("release.country", "string"),
    "status": ("release.status", "string"),
    "track_count": ("release.track-count", "int"),
}
SONG_FIELDS = {
    "recording_id": ("recording.id", "string"),
    "title": ("recording.title", "string"),
    "length_ms": ("recording.length", "bigint"),
    "video": ("recording.video", "boolean"),
    "score": ("recording.score", "int"),
    "first_release_date_raw": ("recording.first-release-date", "string"),
}


def project_fields(df: DataFrame, fields: dict[str, tuple[str, str]], *carry: str | Column) -> DataFrame:
    """One projection: the mapped leaves, which are text, cast to their types; then the carried columns as they
    are."""
    cast = {"int": number_of_text, "bigint": number_of_text}
    leaves = [cast.get(kind, safe_cast)(F.col(path), kind).alias(name) for name, (path, kind) in fields.items()]
    return df.select(*leaves, *carry)


def derive_and_drop(df: DataFrame, derived: dict[str, Column], *dropped: str) -> DataFrame:
    return df.withColumns(derived).drop(*dropped)


def rename_columns(df: DataFrame) -> DataFrame:
    """Hyphens and capitals in top-level names to snake_case."""
    return df.select(*(F.col(f"`{c}`").alias(c.replace("-", "_").lower()) for c in df.columns))
