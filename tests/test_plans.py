"""What the plans must look like to hold at scale."""

import pytest

from conftest import SF
from stratalake.plans import gold, silver
from stratalake.registry.stage import layers


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("table", list(silver.TRANSFORMS))
def test_one_shuffle_per_table_with_rows_cut_before_it(spark, table):
    text = plan(silver.TRANSFORMS[table](layers(spark, SF).bronze()))
    assert text.count("Exchange") == 1
    assert "Partial" in text.split("Exchange")[1] and "WindowGroupLimit" in text.split("Exchange")[1]


def leaves(df):
    scan = df._jdf.queryExecution().sparkPlan().collectLeaves().head()
    return scan.requiredSchema().simpleString()


def test_scans_read_only_the_leaves_they_use(spark):
    at = layers(spark, SF)
    artists = leaves(silver.transform_artists(at.bronze("artists")))
    assert "sort-name" in artists and "releases" not in artists and "title" not in artists
    albums = leaves(silver.transform_albums(at.bronze("albums")))
    assert "track-count" in albums and "artist-credit" not in albums and "score" not in albums
    songs = leaves(silver.transform_songs(at.bronze("songs")))
    assert "score" in songs and "artist-credit" not in songs and "releases" not in songs


def test_yearly_metrics_push_their_filter(spark):
    text = plan(gold.build_yearly_release_metrics(layers(spark, SF).silver("albums"), sort=False))
    assert "PushedFilters: [IsNotNull(release_date)]" in text


def test_artists_go_through_one_join(spark):
    at = layers(spark, SF)
    text = plan(gold.build_artist_summary(at.silver("artists"), at.silver("songs"), at.silver("albums")))
    joins = [line for line in text.splitlines() if "Join" in line]
    assert len([j for j in joins if "LeftOuter" in j]) == 1  # artists with both statistics at once
    assert len([j for j in joins if "FullOuter" in j]) == 1  # one row per search on either side
