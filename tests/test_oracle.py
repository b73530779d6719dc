"""Every registered query against its SQL over the flat tables, and again on tables with a hot key."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from conftest import SF, TABLES, duckdb_over
from stratalake.registry.oracle import all_sql
from stratalake.registry.queries import REGISTRY
from stratalake.session import work_dir

QUERIES = REGISTRY
SQL = all_sql()
SQL_TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


SLOW = "CartesianProduct BroadcastNestedLoopJoin BatchEvalPython ArrowEvalPython MapInPandas".split()

# Everything that groups, joins, ranks or merges.
HOT_QUERIES = """
    scan_bronze_json stream_bronze_ingest explode_recordings explode_releases dedup_any dedup_keep_first
    song_stats album_stats yearly_country_agg null_profile left_join_song_stats left_join_album_stats
    top_n_per_search stream_dedup_watermark incremental_upsert transform_artists transform_albums
    transform_songs build_artist_summary build_yearly_release_metrics legacy_flat_export clean_and_profile
    dq_unique_check
""".split()


def assert_same(df, con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert sorted(names) == sorted(df.columns)
    assert types == {f.name: SQL_TYPES[f.dataType.simpleString()] for f in df.schema}
    expected = Counter(result.fetchall())
    actual = Counter(tuple(r) for r in df.select(*(f"`{n}`" for n in names)).collect())
    assert actual == expected


@pytest.fixture(scope="module")
def con():
    return duckdb_over(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in SLOW if operator in plan]
    if name in SQL:
        assert_same(df, con, SQL[name])
    else:
        assert df.count() > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(all_sql())


@pytest.fixture(scope="module")
def hot_tables(spark):
    """Half of all line items belong to one order, are of one part, and are copies of one row."""
    folder = work_dir(spark, "hot")
    for name in TABLES:
        df = spark.read.parquet(f"{SF}/{name}.parquet")
        if name == "lineitem":
            hot = df.orderBy("l_orderkey", "l_partkey").limit(1)
            copies = hot.crossJoin(spark.range(6000)).drop("id")
            other_parts = hot.crossJoin(spark.range(3000)).withColumn("l_partkey", F.col("id")).drop("id")
            df = df.unionByName(copies).unionByName(other_parts)
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", HOT_QUERIES)
def test_hot_key_changes_no_result(spark, hot_tables, name):
    assert_same(QUERIES[name](spark, hot_tables), duckdb_over(hot_tables, parts=True), SQL[name])


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[:2] == ["artist_search", "artist_id"]
    assert df.count() == 170
