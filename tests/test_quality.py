from datetime import datetime

from pyspark.sql import types as T

from conftest import envelope, rows
from stratalake.operators import profile, quality
from stratalake.plans.clean_profile import clean_and_profile, clean_tables
from stratalake.sources.readers import scan_bronze_json


def test_rules_find_seeded_violations(spark):
    df = spark.createDataFrame(
        [("a", "2001"), ("a", "2001-00-00"), ("a", ""), ("b", None), (None, "2001-05"), (None, "x")],
        "k string, raw string",
    )
    assert rows(quality.dq_null_check(df, "t", ["k", "raw"])) == [
        ("t", "not_null", "k", 2),
        ("t", "not_null", "raw", 1),
    ]
    assert rows(quality.dq_unique_check(df, "t", "k")) == [("t", "unique", "k", 2)]
    assert rows(quality.dq_date_check(df, "t", ["raw"])) == [("t", "valid_date", "raw", 3)]


def test_schema_rule(spark):
    df = spark.range(4).selectExpr("id", "'x' AS name")
    expected = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("name", T.IntegerType()),
            T.StructField("gone", T.StringType()),
        ]
    )
    assert rows(quality.dq_schema_check(df, "t", expected)) == [
        ("t", "schema", "gone", 4),
        ("t", "schema", "id", 0),
        ("t", "schema", "name", 4),
    ]


def test_rules_on_an_empty_table(spark):
    df = spark.createDataFrame([], "k string, raw string")
    assert rows(quality.dq_null_check(df, "t", ["k"])) == [("t", "not_null", "k", 0)]
    assert rows(quality.dq_unique_check(df, "t", "k")) == [("t", "unique", "k", 0)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, datetime(2024, 1, 1))], "n int, at timestamp")
    assert rows(profile.null_profile(df, "t")) == [("t", "at", 1), ("t", "n", 0)]
    assert rows(profile.shape_dtypes(df, "t")) == [("t", "at", "timestamp", 2, 2), ("t", "n", "int", 2, 2)]


def test_clean_and_profile(spark, write_bronze):
    recordings = [
        {"id": "r1", "video": True, "first-release-date": "2001-00-00"},
        {"id": "r2", "first-release-date": "2001"},
        {"id": "r2", "title": "again"},
    ]
    bronze = scan_bronze_json(spark, write_bronze([envelope("s", recordings)]))
    got = {
        (r["stage"], r["column"]): r["null_count"]
        for r in clean_and_profile(bronze).filter("table = 'song'").collect()
    }
    assert got[("before", "video")] == 1 and got[("after", "video")] == 0
    assert got[("before", "first_release_date")] == 0 and got[("after", "first_release_date")] == 1
    assert sorted(r["video"] for r in clean_tables(bronze)["song"].collect()) == [False, True]
