"""Statistics next to the artists they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_stats(rows: DataFrame, stats: DataFrame, spread_by: str, parts: int = 32) -> DataFrame:
    """`rows` left-joined with a table that has one row per `artist_search`.

    Each search's rows are spread over up to `parts` parts, so no task gets a whole hot search, and `stats` is
    repeated for the parts that really occur: at most `parts` times per search, and never more often than `rows`
    has rows. A null search matches nothing, as in any equi-join."""
    left = rows.withColumn("_part", F.pmod(F.xxhash64(spread_by), F.lit(parts)))
    occurring = left.select("artist_search", "_part").filter(F.col("artist_search").isNotNull()).distinct()
    right = occurring.join(stats, "artist_search")
    return left.join(right, ["artist_search", "_part"], "left").drop("_part")


def join_stats(song_stats: DataFrame, album_stats: DataFrame) -> DataFrame:
    """Both statistics in one row per search, so that the artists go through one join instead of two."""
    return song_stats.join(album_stats, "artist_search", "full_outer")
