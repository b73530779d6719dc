"""Unnesting: envelope -> recordings -> credits / releases.

Every level carries the search key, the extraction time and the element's position, so that later steps
know which of two duplicates came first in the document. `keep_empty` keeps a row (with a null element)
for an empty or missing array. The silver tables leave it off: their key filter would drop those padded
rows again, and Catalyst only filters empty arrays before a non-outer generator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import iso_timestamp

LINEAGE = ["artist_search", "extracted_at"]


def _unnest(df: DataFrame, keep: list, array: str, pos: str, item: str, keep_empty: bool) -> DataFrame:
    generator = F.posexplode_outer if keep_empty else F.posexplode
    return df.select(*keep, generator(array).alias(pos, item))


def explode_recordings(bronze: DataFrame, keep_empty: bool = False) -> DataFrame:
    # The time is parsed below the generator: once per envelope, not once per recording.
    envelopes = bronze.select(
        "artist_search",
        iso_timestamp(F.col("extracted_at")).alias("extracted_at"),
        F.col("data.recordings").alias("recordings"),
    )
    return _unnest(envelopes, LINEAGE, "recordings", "recording_pos", "recording", keep_empty)


def explode_artist_credits(recordings: DataFrame, keep_empty: bool = False) -> DataFrame:
    keep = [*LINEAGE, "recording_pos"]
    return _unnest(recordings, keep, "recording.artist-credit", "item_pos", "artist_credit", keep_empty)


def explode_releases(recordings: DataFrame, keep_empty: bool = False) -> DataFrame:
    keep = [*LINEAGE, "recording_pos"]
    return _unnest(recordings, keep, "recording.releases", "item_pos", "release", keep_empty)
