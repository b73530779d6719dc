"""Schema drift and distinct-count sketches."""

import json

import pytest

from conftest import rows
from stratalake.operators import sketches
from stratalake.sources import drift


def texts(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "text string").repartition(3)


def test_paths_of_nested_values(spark):
    found, n = drift.batch_schema(texts(spark, {"a": 1, "b c": [{"x-y": None}, {"x-y": "t"}]}, {"a": 2.5, "d": {"e": [[True]]}}, {"z`": 1}, "no json"))
    assert n == 4
    assert found == {
        "": "OBJECT", "a": "DECIMAL", "b c": "ARRAY", "b c[]": "OBJECT", "b c[].x-y": "STRING",
        "d": "OBJECT", "d.e": "ARRAY", "d.e[]": "ARRAY", "d.e[][]": "BOOLEAN", "z`": "BIGINT",
    }


def test_values_of_no_common_type(spark):
    found, _ = drift.batch_schema(texts(spark, {"a": 1}, {"a": "x"}, {"a": {"b": 1}}))
    assert found["a"] == "VARIANT"


@pytest.mark.parametrize(
    "before, after, change",
    [("BIGINT", "BIGINT", None), (None, "STRING", "added"), ("STRING", None, "lost"), ("VOID", "STRING", "widened"), ("BIGINT", "DOUBLE", "widened"),
     ("DOUBLE", "BIGINT", "narrowed"), ("STRING", "VOID", "narrowed"), ("STRING", "OBJECT", "contradicted"), ("BIGINT", "VARIANT", "contradicted")],
)
def test_changes(before, after, change):
    assert drift.change_of(before, after) == change


def test_drift_is_told_from_the_batch_before(spark, folder):
    record = lambda batch, *values: rows(drift.record_schema(spark, texts(spark, *values), folder, batch))
    assert record("1", {"a": 1}) == [("", "added", None, "OBJECT"), ("a", "added", None, "BIGINT")]
    assert record("2", {"a": 1}) == []
    assert record("3", {"a": "x", "b": 1}) == [("a", "contradicted", "BIGINT", "STRING"), ("b", "added", None, "BIGINT")]
    assert record("3", {"a": 1.5}) == [("a", "widened", "BIGINT", "DECIMAL")]  # the same batch again
    assert record("4") == [("", "contradicted", "OBJECT", "VOID")] or record("4") == [("", "narrowed", "OBJECT", "VOID"), ("a", "lost", "DECIMAL", None)]


def test_sketches_of_batches_unite(spark):
    df = spark.range(30_000).selectExpr("id % 7 AS k", "if(id % 11 = 0, null, id * 31 % 20000) AS v")
    parts = [sketches.distinct_sketches(df.where(f"v % 3 = {n} OR v IS NULL AND {n} = 0"), ["k"], ["v"]) for n in range(3)]
    united = sketches.unite_sketches(parts[0].unionAll(parts[1]).unionAll(parts[2]), ["k"], ["v"])
    found = {r["k"]: r["v"] for r in sketches.estimate_distinct(united, ["k"], ["v"]).collect()}
    distinct = {r[0]: r[1] for r in df.distinct().where("v IS NOT NULL").groupBy("k").count().collect()}
    assert found.keys() == distinct.keys()
    assert all(abs(found[k] - n) <= sketches.ERROR_BOUND * n for k, n in distinct.items())
    few = sketches.distinct_sketches(spark.range(100).selectExpr("1 AS k", "id % 9 AS v"), ["k"], ["v"])
    assert sketches.estimate_distinct(few, ["k"], ["v"]).first()["v"] == 9


def test_profiles_of_batches_unite(spark):
    df = spark.range(20_000).selectExpr(
        "id AS k", "cast(if(id % 10 = 0, null, id % 1000) AS int) AS v", "concat('c', id % 4) AS c", "date_add(date'2020-01-01', cast(id % 100 AS int)) AS d",
        "cast(null AS double) AS none",
    )
    parts = [sketches.profile_states(df.where(f"k % 3 = {n}"), "t") for n in range(3)] + [sketches.profile_states(df.where("false"), "t")]
    states = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    found = {r["column"]: r for r in sketches.profile(sketches.unite_profiles(states)).collect()}
    assert {c: (r["row_count"], r["null_count"]) for c, r in found.items()} == {
        "k": (20_000, 0), "v": (20_000, 2000), "c": (20_000, 0), "d": (20_000, 0), "none": (20_000, 20_000),
    }
    for column, n in (("k", 20_000), ("v", 1000)):
        for rank, value in zip((0.25, 0.5, 0.75), found[column]["quantiles"]):
            assert abs(value / n - rank) < sketches.RANK_ERROR + 1 / 1000
    assert found["c"]["quantiles"] is None and found["none"]["quantiles"] is None
    assert sorted((f["item"], f["count"]) for f in found["c"]["frequent"])[0][1] == 5000
    assert [(f["item"], f["count"]) for f in found["v"]["frequent"]][0] == (None, 2000)
