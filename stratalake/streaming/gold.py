"""Gold kept up to date by deltas.

The gold measures are kept as counted values: how many rows have a value, with signs for rows that go and come.
Counts and sums then follow by adding; minima, maxima and distinct values from the values whose count is not 0. A run
reads what changed in silver since the last one, adds it to the counted values it falls on, and makes those rows
of gold anew whose values or artists changed. All tables are kept in buckets, as silver is; those that nothing falls
into are neither read nor written."""

from __future__ import annotations

from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.values import ms_to_minutes, round_half_up
from stratalake.operators.aggregates import dated_albums
from stratalake.operators.joins import join_stats, left_join_stats
from stratalake.plans.gold import audit_created_at
from stratalake.plans.jobs import run_together
from stratalake.schemas import GOLD, SILVER, table_schema
from stratalake.sources.writers import counted
from stratalake.streaming import changefeed
from stratalake.streaming.upsert import (
    BUCKET_BYTES,
    BUCKETS,
    Kept,
    State,
    bucket_of,
    delete,
    exists,
    path_of,
    replace_buckets,
    snapshots,
    state_of,
    touch,
)

SILVER_TABLES = ("artists", "albums", "songs")
# What each kept table is counted from.
SOURCE = {"songs": "songs", "albums": "albums", "years": "albums", "artists": "artists"}
# Parts of a search in the summary: a search with a third of all artists is not one bucket.
PARTS = 32


# Counted values: the values, n (the rows that have them), and what is summed over those rows.
VALUES = {
    "songs": table_schema("artist_search string, first_release_date date"),
    "albums": table_schema("artist_search string, country string, release_date date"),
    "years": table_schema("release_year int, country_code string, artist_search string"),
}
COUNT, SUMS = table_schema("n bigint"), table_schema("sum bigint, known bigint")


def part_key(search: Column, artist_id: Column) -> Column:
    """A search in parts, for the summary's buckets."""
    return F.concat_ws("|", F.pmod(F.xxhash64(artist_id), F.lit(PARTS)).cast("string"), F.coalesce(search, F.lit("")))


def kept_tables(spark: SparkSession, base: str) -> dict[str, Kept]:
    search = F.col("artist_search")
    year = F.concat_ws("|", F.col("release_year").cast("string"), "country_code")
    schema = lambda name, *more: T.StructType([f for part in (VALUES[name], COUNT, *more) for f in part])
    tables = {
        "songs": (schema("songs", SUMS), search),
        "albums": (schema("albums"), search),
        "years": (schema("years", SUMS), year),
        "artists": (SILVER["artists"], part_key(search, F.col("artist_id"))),
    }
    return {name: Kept(spark, f"{base}/{name}", columns, key) for name, (columns, key) in tables.items()}


def values_changed(name: str, feed: DataFrame) -> DataFrame:
    """What a feed of songs or albums adds to the counted values; may be negative."""
    rows, sign = changefeed.signed_rows(feed), F.col("sign")
    if name == "years":
        # The sign goes along in place of the id.
        rows = dated_albums(rows.withColumn("album_id", sign)).withColumnRenamed("album_id", "sign")
    value = {"songs": "length_ms", "years": "track_count"}.get(name)
    sums = [F.sum(sign).alias("n")]
    if value:
        total = F.sum(F.col(value).cast("bigint") * sign)
        known = F.sum(F.when(F.col(value).isNotNull(), sign).otherwise(0))
        sums += [F.coalesce(total, F.lit(0)).alias("sum"), known.cast("bigint").alias("known")]
    changed = "n <> 0 OR sum <> 0 OR known <> 0" if value else "n <> 0"
    return rows.groupBy(*VALUES[name].fieldNames()).agg(*sums).where(changed)


def add_values(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counted values added up; those that no row has any more go."""
    sums = [c for c in old.columns if c in ("n", "sum", "known")]
    values = [c for c in old.columns if c not in sums]
    both = old.unionByName(new.select(*old.columns))
    return both.groupBy(*values).agg(*(F.sum(c).alias(c) for c in sums)).where("n <> 0")


def mean(scale: float = 1.0) -> Column:
    return F.when(F.sum("known") > 0, F.sum("sum") / F.sum("known") * F.lit(scale))


def song_stats(counted: DataFrame) -> DataFrame:
    date = F.col("first_release_date")
    return counted.groupBy("artist_search").agg(
        F.sum("n").alias("total_recordings"),
        round_half_up(ms_to_minutes(mean()), 2).alias("avg_song_length_min"),
        F.min(date).alias("earliest_song_release"),
        F.max(date).alias("latest_song_release"),
    )


def album_stats(counted: DataFrame) -> DataFrame:
    date = F.col("release_date")
    return counted.groupBy("artist_search").agg(
        F.sum("n").alias("total_albums"),
        F.count_distinct("country").alias("distinct_release_countries"),
        F.min(date).alias("earliest_album_release"),
        F.max(date).alias("latest_album_release"),
    )


def yearly(counted: DataFrame) -> DataFrame:
    return counted.groupBy("release_year", "country_code").agg(
        F.sum("n").alias("total_releases"),
        round_half_up(mean(), 1).alias("avg_tracks_per_album"),
        F.count("artist_search").alias("distinct_artists"),
    )


def follow(spark: SparkSession, state: str, base: str, buckets: int, bucket_bytes: int) -> None:
    """Bring the counted values, and the artists by search, to the last silver snapshots. A run that died is repeated:
    each table says itself which snapshot it has."""
    kept = kept_tables(spark, base)
    last = {t: state_of(spark, f"{state}/{t}").last for t in SILVER_TABLES}
    run_together(spark, {n: partial(follow_one, state, n, kept[n], last[SOURCE[n]], buckets, bucket_bytes) for n in kept})


def follow_one(state: str, name: str, kept: Kept, last: int, buckets: int, bucket_bytes: int) -> None:
    spark, table = kept.spark, SOURCE[name]
    mine = state_of(spark, kept.base, buckets)
    if mine.last == last:
        return
    # Silver keeps its last snapshots only; from anything older on, all is counted anew.
    known = mine.last in snapshots(spark, f"{state}/{table}")
    since, begin = (mine.last, mine) if known else (0, State(0, mine.buckets, {}))
    feed = changefeed.change_feed(spark, f"{state}/{table}", table, since, last)
    if name == "artists":
        # An artist's old row may lie in another bucket than its new one; both are in the signed rows.
        new, merge = changefeed.signed_rows(feed), replace_artists
    else:
        new, merge = values_changed(name, feed), add_values
    size = sum(b or 0 for b in state_of(spark, f"{state}/{table}").bytes.values()) if not known else 0
    if not kept.advance(begin, last, new, size, merge, bucket_bytes):
        # Nothing that counts has changed: the same buckets under the new number.
        kept.write(begin, last, spark.createDataFrame([], kept.schema), [], begin.buckets)


def replace_artists(old: DataFrame, new: DataFrame) -> DataFrame:
    columns = SILVER["artists"].fieldNames()
    kept = old.join(new.where("sign < 0").select("artist_id"), "artist_id", "left_anti").select(*columns)
    return kept.unionByName(new.where("sign > 0").select(*columns))


def shown(spark: SparkSession, base: str, out: str) -> dict[str, int]:
    """The silver snapshots that published gold has; none if it isn't there."""
    files, at = path_of(spark, f"{base}/published")
    marks = [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) and exists(spark, out) else []
    newest = max((tuple(map(int, m.split("-"))) for m in marks), default=(0, 0, 0))
    return dict(zip(SILVER_TABLES, newest, strict=True))


def run_gold_incremental(
    spark: SparkSession, state: str, gold_base: str, run_ts: datetime | Column | None = None, buckets: int = BUCKETS,
    bucket_bytes: int = BUCKET_BYTES,
) -> dict[str, int]:
    """Bring gold up to date with the silver tables kept below `state` by `run_incremental`; returns how many rows of
    each gold table were written. Rows that did not change keep their `created_at`. What gold is made from is kept in
    `<state>/gold`."""
    base = f"{state}/gold"
    follow(spark, state, base, buckets, bucket_bytes)
    kept = kept_tables(spark, base)
    states = {name: state_of(spark, k.base, buckets) for name, k in kept.items()}
    before = shown(spark, base, gold_base)
    now = {t: states[t].last for t in SILVER_TABLES}
    if now == before:
        return {"artist_summary": 0, "yearly_release_metrics": 0}
    stale = lambda name, table: sorted(b for b in range(states[name].buckets) if states[name].holder.get(b, 0) > before[table])

    # Searches whose values may have changed, and with them all their parts of the summary.
    written = [kept[t].rows(states[t], stale(t, t)).select("artist_search") for t in ("songs", "albums")]
    searches = written[0].unionByName(written[1]).distinct()
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    n = states["artists"].buckets
    key = F.concat_ws("|", F.col("part").cast("string"), F.coalesce("artist_search", F.lit("")))
    named = searches.select("artist_search", parts).select(bucket_of(key, n).alias("bucket")).distinct().collect()
    wanted = sorted({r["bucket"] for r in named} | set(stale("artists", "artists")))
    artists = kept["artists"].rows(states["artists"], wanted)
    # The values of all searches that these artists have.
    asked = artists.select("artist_search").distinct()
    stats = []
    for name, make in (("songs", song_stats), ("albums", album_stats)):
        rows = kept[name].rows(states[name], kept[name].buckets_of(asked, states[name].buckets))
        stats.append(make(rows))
    summary = left_join_stats(artists, join_stats(*stats), spread_by="artist_id")
    summary = summary.withColumn("created_at", audit_created_at(run_ts)).select(*GOLD["artist_summary"].fieldNames())
    metrics = yearly(kept["years"].rows(states["years"], stale("years", "albums")))
    metrics = metrics.withColumn("created_at", audit_created_at(run_ts)).select(*GOLD["yearly_release_metrics"].fieldNames())

    def write(table: str, name: str, rows: DataFrame) -> int:
        rows, seen = counted(kept[name].bucketed(rows, states[name].buckets))
        replace_buckets(spark, rows, f"{gold_base}/{table}", set(states[name].holder))
        return seen.get["n"]

    tables = {"artist_summary": ("artists", summary), "yearly_release_metrics": ("years", metrics)}
    counts = run_together(spark, {table: partial(write, table, *about) for table, about in tables.items()})
    touch(spark, f"{base}/published/" + "-".join(str(now[t]) for t in SILVER_TABLES))
    old = "-".join(str(before[t]) for t in SILVER_TABLES)
    delete(spark, f"{base}/published/{old}")
    return counts
