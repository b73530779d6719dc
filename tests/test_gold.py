from datetime import date, datetime, timezone

import pytest

from conftest import SF, rows
from stratalake.operators.aggregates import album_stats, song_stats
from stratalake.operators.ordering import top_n_per_key
from stratalake.plans.gold import build_artist_summary, build_yearly_release_metrics
from stratalake.registry.stage import layers
from stratalake.schemas import GOLD, SILVER
from pyspark.sql import functions as F

RUN = datetime(2024, 2, 1, tzinfo=timezone.utc)
AT = datetime(2024, 1, 1)


@pytest.fixture
def silver(spark):
    artists = [
        ("a1", "Main", None, None, "s1", AT, None),
        ("a2", "Featured", None, None, "s1", AT, None),
        ("a3", "Unheard", None, None, "s2", AT, None),
        ("a4", "Nameless", None, None, None, AT, None),
    ]
    songs = [
        ("r1", "t", 180000, None, 1, "s1", AT, date(2001, 1, 1)),
        ("r2", "t", None, None, 1, "s1", AT, date(1999, 1, 1)),
        ("r3", "t", 60000, None, 1, None, AT, None),
    ]
    albums = [
        ("l1", "t", "GB", None, 10, "s1", AT, date(2001, 5, 1), None),
        ("l2", "t", None, None, 11, "s1", AT, date(2001, 1, 1), None),
        ("l3", "t", None, None, None, "s3", AT, date(2001, 1, 1), None),
        ("l4", "t", "GB", None, 5, "s1", AT, None, None),
    ]
    data = {"artists": artists, "songs": songs, "albums": albums}
    return {t: spark.createDataFrame(r, SILVER[t]) for t, r in data.items()}


def test_summary(silver):
    df = build_artist_summary(silver["artists"], silver["songs"], silver["albums"], RUN)
    assert df.columns == GOLD["artist_summary"].fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in GOLD["artist_summary"]]
    got = {r["artist_id"]: r for r in df.collect()}
    main = got["a1"]
    assert main["total_recordings"] == 2 and main["avg_song_length_min"] == 3.0
    assert (main["earliest_song_release"], main["latest_song_release"]) == (date(1999, 1, 1), date(2001, 1, 1))
    assert main["total_albums"] == 3 and main["distinct_release_countries"] == 1
    assert main[7:] == got["a2"][7:]  # a featured artist shows the whole search's numbers
    assert got["a3"]["total_recordings"] is None and got["a3"]["total_albums"] is None  # null, not 0
    assert got["a4"]["total_recordings"] is None  # a null search matches nothing
    assert {r["created_at"] for r in got.values()} == {datetime(2024, 2, 1)}


def test_yearly(silver):
    df = build_yearly_release_metrics(silver["albums"], RUN)
    assert df.columns == GOLD["yearly_release_metrics"].fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in GOLD["yearly_release_metrics"]]
    assert [tuple(r)[:5] for r in df.collect()] == [
        (2001, "UNKNOWN", 2, 11.0, 2),
        (2001, "GB", 1, 10.0, 1),
    ]


def test_a_given_run_time_makes_reruns_equal(silver):
    args = (silver["artists"], silver["songs"], silver["albums"])
    assert rows(build_artist_summary(*args, RUN)) == rows(build_artist_summary(*args, RUN))
    assert build_artist_summary(*args).filter("created_at is null").count() == 0


def test_totals_add_up(spark):
    at = layers(spark, SF)
    summary = build_artist_summary(at.silver("artists"), at.silver("songs"), at.silver("albums"))
    assert summary.count() == at.silver("artists").count()
    per_search = at.silver("albums").groupBy("artist_search").count()
    assert per_search.agg({"count": "sum"}).first()[0] == at.silver("albums").count()
    yearly = build_yearly_release_metrics(at.silver("albums"), sort=False)
    dated = at.silver("albums").filter("release_date is not null").count()
    assert yearly.agg({"total_releases": "sum"}).first()[0] == dated


def test_top_n_in_two_rounds_equals_one_round(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("score"),
        "id",
    )
    data = [tuple(r) for r in df.collect()]
    expected = []
    for key in {k for k, _, _ in data}:
        expected += sorted((r for r in data if r[0] == key), key=lambda r: (-r[1], r[2]))[:7]
    got = top_n_per_key(df, "k", [F.desc("score"), F.asc("id")], 7, spread_by="id", parts=8)
    assert rows(got) == sorted(expected, key=repr)


def test_spread_join_equals_two_plain_joins(silver):
    df = build_artist_summary(silver["artists"], silver["songs"], silver["albums"], RUN)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan  # the repeated statistics are never broadcast
    plain = (
        silver["artists"]
        .join(song_stats(silver["songs"]), "artist_search", "left")
        .join(album_stats(silver["albums"]), "artist_search", "left")
    )
    assert rows(df.drop("created_at")) == rows(plain)
