"""Group-bys behind the gold tables. All are algebraic or distinct counts, so Spark combines on the map
side; a search that holds a third of all rows reaches the reducer as one row per map task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import year_of
from stratalake.functions.values import country_or_unknown, ms_to_minutes, round_half_up


def song_stats(songs: DataFrame) -> DataFrame:
    release = F.col("first_release_date")
    return songs.groupBy("artist_search").agg(
        F.count("recording_id").alias("total_recordings"),
        round_half_up(ms_to_minutes(F.avg("length_ms")), 2).alias("avg_song_length_min"),
        F.min(release).alias("earliest_song_release"),
        F.max(release).alias("latest_song_release"),
    )


def album_stats(albums: DataFrame) -> DataFrame:
    release = F.col("release_date")
    return albums.groupBy("artist_search").agg(
        F.count("album_id").alias("total_albums"),
        F.count_distinct("country").alias("distinct_release_countries"),
        F.min(release).alias("earliest_album_release"),
        F.max(release).alias("latest_album_release"),
    )


def dated_albums(albums: DataFrame) -> DataFrame:
    """Albums with a known year, with the year and the country bucket they count for."""
    return albums.filter(F.col("release_date").isNotNull()).select(
        year_of(F.col("release_date")).alias("release_year"),
        country_or_unknown(F.col("country")).alias("country_code"),
        "album_id",
        "track_count",
        "artist_search",
    )


def yearly_country(dated: DataFrame) -> DataFrame:
    return dated.groupBy("release_year", "country_code").agg(
        F.count("album_id").alias("total_releases"),
        round_half_up(F.avg("track_count"), 1).alias("avg_tracks_per_album"),
        F.count_distinct("artist_search").alias("distinct_artists"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, row_count), counted in one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")) for df in tables.values()]
    named = [c.select(F.lit(n).alias("table"), "row_count") for n, c in zip(tables, counts)]
    return reduce(DataFrame.unionAll, named)
