"""Point look-ups: results against a plain filter, and what the scan reads for them."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import envelope, rows
from stratalake.plans.jobs import run_bronze_to_silver
from stratalake.schemas import SILVER
from stratalake.sources import lookup
from stratalake.sources.writers import write_parquet_overwrite
from stratalake.streaming import upsert
from stratalake.streaming.lookup import look_up_silver

ROWS = 400_000
PAGE = 100


def scanned(df):
    """(result rows, what the scan gave, files it read), from the finished plan's own figures."""
    found = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaf = plan.collectLeaves().head()
    figure = lambda name: leaf.metrics().apply(name).value()
    return sorted(map(tuple, found), key=repr), figure("numOutputRows"), figure("numFiles")


@pytest.fixture(scope="module")
def keyed(spark):
    """Keys in no order of their numbers: in files of key ranges with short pages, and dealt by hash in no order."""
    from stratalake.session import work_dir

    folder = work_dir(spark, "keyed")
    df = spark.range(ROWS).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), F.col("id").alias("n"))
    df.write.parquet(f"{folder}/plain")
    lookup.write_sorted(spark.read.parquet(f"{folder}/plain"), f"{folder}/sorted", "k", page_rows=PAGE)
    write_parquet_overwrite(df.repartition(8, "k").sortWithinPartitions("n"), f"{folder}/mixed", key="k")
    return folder


def keys_of(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "n bigint").select(F.sha2(F.col("n").cast("string"), 256).alias("wanted"))


def test_a_look_up_equals_a_filter_and_reads_a_page_per_key(spark, keyed):
    df = spark.read.parquet(f"{keyed}/sorted")
    keys = keys_of(spark, range(0, 2 * ROWS, ROWS // 200))  # 200 that are there, 200 that are not
    found, read, _ = scanned(lookup.look_up(df, "k", keys))
    assert [r[1] for r in sorted(found, key=lambda r: r[1])] == list(range(0, ROWS, ROWS // 200))
    assert found == rows(df.join(keys, df.k == keys.wanted, "left_semi"))
    assert 200 <= read <= 400 * PAGE <= ROWS / 10


def test_a_hot_key_is_split_over_files(spark, folder):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    lookup.write_sorted(df, folder, "k", "id")
    found = lookup.look_up(spark.read.parquet(folder), "k", spark.createDataFrame([("hot",), ("1",)], "k string"))
    assert found.where("k = 'hot'").count() == 6667 and found.count() == 6668


def test_keys_that_are_not_there_cost_no_row_even_in_unsorted_files(spark, keyed):
    found, read, _ = scanned(lookup.look_up(spark.read.parquet(f"{keyed}/mixed"), "k", keys_of(spark, range(ROWS, ROWS + 10))))
    assert found == [] and read == 0


def test_nulls_repeats_no_keys_and_numbers(spark, keyed, folder):
    df = spark.read.parquet(f"{keyed}/sorted")
    keys = keys_of(spark, [5, 5, 7]).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS wanted"))
    assert {r[1] for r in rows(lookup.look_up(df, "k", keys))} == {5, 7}
    assert rows(lookup.look_up(df, "k", keys.limit(0))) == []
    numbers = spark.sql("SELECT * FROM VALUES (1, 'a'), (1, 'b'), (NULL, 'c'), (3, 'd') t(k, v)")
    write_parquet_overwrite(numbers, f"{folder}/numbers", key="k")
    wanted = spark.sql("SELECT * FROM VALUES (1), (NULL), (9) t(v)")  # named like another column
    assert rows(lookup.look_up(spark.read.parquet(f"{folder}/numbers"), "k", wanted)) == [(1, "a"), (1, "b")]
    write_parquet_overwrite(numbers.limit(0), f"{folder}/none", key="k")
    assert rows(lookup.look_up(spark.read.parquet(f"{folder}/none"), "k", wanted)) == []


@pytest.mark.parametrize("count", [1, 9, 10, 11, 25, 200])
def test_any_number_of_keys_gives_the_same_as_a_join(spark, keyed, count, monkeypatch):
    df, keys = spark.read.parquet(f"{keyed}/sorted"), keys_of(spark, range(0, 3 * count, 3))
    found = rows(lookup.look_up(df, "k", keys))
    assert len(found) == count
    monkeypatch.setattr(lookup, "MOST_KEYS", count - 1)
    assert rows(lookup.look_up(df, "k", keys)) == found


def test_silver_is_looked_up_in_the_buckets_of_its_keys(spark, folder, write_bronze, monkeypatch):
    recordings = [{"id": f"r{n}", "title": f"t{n}"} for n in range(500)]
    landing = write_bronze([envelope("s", recordings)])
    upsert.run_incremental(spark, landing, f"{folder}/state", f"{folder}/silver", buckets=16)
    base, silver = f"{folder}/state/songs", f"{folder}/silver/songs"
    keys = spark.createDataFrame([("r7",), ("r7",), ("r450",), ("x",), (None,)], "k string")
    df = look_up_silver(spark, base, "songs", silver, keys)
    found, _, files = scanned(df)
    assert df.columns == SILVER["songs"].fieldNames() and [r[0] for r in found] == ["r450", "r7"]
    assert files <= 3
    monkeypatch.setattr("stratalake.sources.lookup.MOST_KEYS", 1)
    assert rows(look_up_silver(spark, base, "songs", silver, keys)) == found


def test_a_table_never_published_has_no_rows(spark, folder):
    keys = spark.createDataFrame([("a",)], "k string")
    assert look_up_silver(spark, f"{folder}/state/songs", "songs", f"{folder}/silver/songs", keys).count() == 0


def test_silver_files_of_both_jobs_are_sorted_by_key(spark, folder, write_bronze):
    for part in range(3):
        landing = write_bronze([envelope("s", [{"id": f"r{n * 7919 % 500}", "title": "t"} for n in range(part, 600, 3)])])
    run_bronze_to_silver(spark, landing, f"{folder}/batch")
    upsert.run_incremental(spark, landing, f"{folder}/state", f"{folder}/silver", buckets=4)
    for base in ("batch", "silver"):
        files = glob.glob(f"{folder}/{base}/songs/**/*.parquet", recursive=True)
        keys = [pq.read_table(f, columns=["recording_id"]).column(0).to_pylist() for f in files]
        assert sum(map(len, keys)) == 500 and all(k == sorted(k) for k in keys)


def test_a_small_file_has_a_small_filter(spark, folder):
    df = spark.range(200).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    lookup.write_sorted(df.coalesce(1), folder, "k")
    for name in glob.glob(f"{folder}/*.parquet"):
        column = pq.ParquetFile(name).metadata.row_group(0).column(0)
        with open(name, "rb") as file:
            assert len(file.read()) < column.total_compressed_size + 12_000
    key = df.first()["k"]
    assert lookup.look_up(spark.read.parquet(folder), "k", df.where(F.col("k") == key)).count() == 1
