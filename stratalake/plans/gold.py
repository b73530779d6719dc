"""Silver tables to the two gold tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators import aggregates as a
from stratalake.operators.joins import join_stats, left_join_stats
from stratalake.operators.ordering import by_year_and_releases


def audit_created_at(run_ts: datetime | Column | None = None) -> Column:
    """Load time. With a given run time a rerun writes the same rows; without one it is the clock."""
    if run_ts is None:
        return F.current_timestamp()
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp")


def build_artist_summary(
    artists: DataFrame, songs: DataFrame, albums: DataFrame, run_ts: datetime | Column | None = None
) -> DataFrame:
    """One row per credited artist with the statistics of the search that found it. The grain is the
    artist, the key of the statistics is the search: a featured artist shows the whole search's numbers,
    and an artist whose search has no songs or albums shows null, not 0."""
    stats = join_stats(a.song_stats(songs), a.album_stats(albums))
    joined = left_join_stats(artists, stats, spread_by="artist_id")
    return joined.withColumn("created_at", audit_created_at(run_ts))


def build_yearly_release_metrics(
    albums: DataFrame, run_ts: datetime | Column | None = None, sort: bool = True
) -> DataFrame:
    """Releases per year and country. `sort=False` saves the range shuffle for readers that sort anyway."""
    metrics = a.yearly_country(a.dated_albums(albums))
    if sort:
        metrics = by_year_and_releases(metrics)
    return metrics.withColumn("created_at", audit_created_at(run_ts))
