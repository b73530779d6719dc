import gzip
import json
import os
import re
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import SF, envelope, rows
from stratalake.operators.filters import target_searches
from stratalake.operators.projections import rename_columns
from stratalake.operators.unions import union_searches
from stratalake.plans import jobs
from stratalake.plans.flat_export import export_flat
from stratalake.registry import queries
from stratalake.registry.bronze_from_tables import base_rows, envelopes
from stratalake.registry.stage import Layers, layers
from stratalake.schemas import BRONZE, bronze_schema
from stratalake.session import CLEAN_SHUFFLES, drop_work_dir, shared_dir, short_lived_shuffles, work_dir
from stratalake.sources import catalog, readers, writers
from stratalake.streaming import upsert

TWO = [envelope("a", [{"id": "r1"}]), envelope("b", [{"id": "r2"}, {"id": "r3"}])]


def searches(df):
    return sorted(r["artist_search"] for r in df.select("artist_search").collect())


def test_array_file_gives_one_row_per_envelope(spark, write_bronze):
    path = write_bronze(TWO, lines=False)
    assert searches(readers.scan_bronze_json(spark, path, multi_line=True)) == ["a", "b"]


def test_truncated_file_is_one_corrupt_row(spark, write_bronze):
    write_bronze(TWO, lines=False)
    path = write_bronze('[{"artist_search": "z", "data": ')
    df = readers.scan_bronze_json(spark, path, multi_line=True, keep_corrupt=True).cache()
    assert df.count() == 3
    assert df.filter("_corrupt_record is not null").count() == 1
    assert df.filter("_corrupt_record is null").count() == 2


def test_narrow_schema_reads_only_its_part(spark, write_bronze):
    path = write_bronze([envelope("a", [{"id": "r", "releases": [{"id": "l"}], "artist-credit": []}])])
    schema = bronze_schema(songs=False, credits=False)
    df = readers.scan_bronze_json(spark, path, schema)
    assert df.selectExpr("data.recordings[0].releases[0].id").first()[0] == "l"
    assert df.schema["data"].dataType["recordings"].dataType.elementType.fieldNames() == ["releases"]


def test_latest_file(spark, write_bronze):
    path = write_bronze(TWO[:1], "z-old.json")
    write_bronze(TWO[1:], "a-new.json")
    past = time.time() - 1000
    os.utime(f"{path}/z-old.json", (past, past))
    assert readers.latest_file(spark, path)["path"].endswith("a-new.json")
    assert searches(readers.scan_latest_file(spark, path)) == ["b"]


def test_latest_of_nothing_is_an_error(spark, folder):
    os.makedirs(folder)
    with pytest.raises(FileNotFoundError):
        readers.latest_file(spark, folder)
    with pytest.raises(FileNotFoundError):
        readers.latest_batch(spark, folder)


def test_landing_again_replaces_only_its_batch(spark, folder):
    payloads = spark.createDataFrame(
        [("a", '{"recordings": [{"id": "r1"}]}'), ("b", "no json")], "artist_search string, payload string"
    )
    first, second = (F.lit(t).cast("timestamp") for t in ("2024-01-01 10:00:00", "2024-01-02 10:00:00"))
    for ts in (first, second, second):
        writers.land_bronze(writers.make_envelopes(payloads, ts), folder, ts)
    landed = readers.scan_bronze_json(spark, folder)
    assert landed.count() == 4
    assert {"batch_id=20240101_100000", "batch_id=20240102_100000"} <= set(os.listdir(folder))
    latest = readers.scan_latest_batch(spark, folder)
    assert {r["extracted_at"] for r in latest.collect()} == {"2024-01-02T10:00:00.000000+00:00"}
    assert latest.count() == 2


def test_csv_round_trip(spark, folder):
    texts = [(1, None), (3, 'say "hi", ok'), (4, "two\nlines"), (5, "back\\slash"), (6, " spaced ")]
    df = spark.createDataFrame(texts, "k int, t string")
    writers.write_csv_export(df, folder)
    assert rows(readers.read_csv_export(spark, folder, df.schema, multi_line=True)) == rows(df)


def test_csv_tells_empty_text_from_null(spark, folder):
    writers.write_csv_export(spark.createDataFrame([(1, None), (2, "")], "k int, t string").coalesce(1), folder)
    assert sorted(r[0] for r in spark.read.text(folder).collect()) == ["1,", '2,""', "k,t"]


def test_partitioned_overwrite_replaces_only_what_is_written(spark, folder):
    old = spark.createDataFrame([(1, 2000), (2, 2001)], "k int, y int")
    writers.write_parquet_overwrite(old, folder, partition_by="y")
    writers.write_parquet_overwrite(spark.createDataFrame([(3, 2001)], "k int, y int"), folder, partition_by="y")
    assert rows(spark.read.parquet(folder)) == [(1, 2000), (3, 2001)]


def test_written_rows_are_counted(spark, folder):
    assert writers.write_with_count(spark.range(1000).toDF("n"), folder) == 1000
    assert writers.write_with_count(spark.range(10).toDF("n"), folder) == 10
    assert spark.read.parquet(folder).count() == 10


def test_jobs_run_twice_give_the_same_tables(spark, folder):
    at = layers(spark, SF)
    results = []
    for run in ("first", "second"):
        counts = jobs.run_bronze_to_silver(spark, at.bronze_json(), f"{folder}/silver")
        gold = jobs.run_silver_to_gold(spark, f"{folder}/silver", f"{folder}/gold", F.lit("2024-02-01").cast("timestamp"))
        assert counts.pop("unreadable") == 0
        tables = [f"silver/{t}" for t in counts] + [f"gold/{t}" for t in gold]
        results.append({t: rows(spark.read.parquet(f"{folder}/{t}")) for t in tables})
        assert all(len(results[-1][f"silver/{t}"]) == n for t, n in counts.items())
        assert all(len(results[-1][f"gold/{t}"]) == n for t, n in gold.items())
    assert results[0] == results[1]


def test_catalog(spark, folder):
    writers.write_parquet_overwrite(spark.range(3).toDF("n"), folder)
    assert catalog.register_tables({"t": spark.read.parquet(folder)}, prefix="check_") == ["check_t"]
    assert spark.sql("SELECT sum(n) FROM check_t").first()[0] == 3
    catalog.create_external_table(spark, "check_external", folder)
    assert spark.sql("SELECT count(*) FROM check_external").first()[0] == 3
    spark.sql("DROP TABLE check_external")
    assert spark.read.parquet(folder).count() == 3


def test_targets_as_list_and_as_table(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "artist_search string")
    wanted = spark.createDataFrame([("b",), ("b",), ("x",)], "artist_search string")
    assert rows(target_searches(df, ["b", "x"])) == [("b",)]
    assert rows(target_searches(df, wanted)) == [("b",)]


def test_union_fills_missing_columns(spark):
    a, b = spark.range(1).toDF("x"), spark.range(1).selectExpr("5L AS y", "id + 9 AS x")
    assert rows(union_searches([a, b]).select("x", "y")) == [(0, None), (9, 5)]


def test_rename(spark):
    df = spark.range(1).selectExpr("1 AS `Track-Count`", "2 AS `first-release-date`")
    assert rename_columns(df).columns == ["track_count", "first_release_date"]


def test_inspect_schema(spark, write_bronze):
    df = readers.inspect_schema(spark.read.json(write_bronze(TWO)))
    got = {r["path"]: (r["type"], r["record_count"]) for r in df.collect()}
    assert got["data.recordings[].id"] == ("string", 2)


def test_work_folders_follow_the_session(spark, monkeypatch):
    kept = spark.conf.get("spark.checkpoint.dir", None)
    if kept:
        assert shared_dir(spark) == kept.rstrip("/")
        assert work_dir(spark, "x").startswith(kept)
    assert work_dir(spark, "x") != work_dir(spark, "x")


def test_only_work_folders_can_be_dropped(spark, folder):
    spark.range(1).write.parquet(folder)
    with pytest.raises(ValueError):
        drop_work_dir(spark, "/tmp/elsewhere")
    drop_work_dir(spark, folder)
    assert not os.path.exists(folder)


def test_inspection_counts_all_values(spark, folder, write_bronze):
    path = write_bronze(TWO * 10)
    write_bronze(TWO, lines=False)
    df = readers.inspect_schema(readers.infer_bronze(spark, path, multi_line=True))
    assert {r["record_count"] for r in df.collect()} == {22}


def test_array_files_round_trip(spark, folder):
    df = spark.range(1000).selectExpr("id", "concat('a[\"{', id) AS t").repartition(3)
    writers.write_json_arrays(df, folder)
    got = spark.read.option("multiLine", True).schema("id bigint, t string").json(folder)
    assert rows(got) == rows(df)
    writers.write_json_arrays(df.where("false"), f"{folder}/none")
    assert spark.read.option("multiLine", True).schema("id bigint").json(f"{folder}/none").count() == 0


def files_below(folder, ending):
    return [f for d, _, files in os.walk(folder) for f in files if f.endswith(ending)]


def test_landed_files_are_compressed_and_bounded(spark, folder, monkeypatch):
    monkeypatch.setattr(writers, "LANDED_ENVELOPES", 4)
    envelopes = spark.createDataFrame([("s" + str(i), None, None) for i in range(10)], BRONZE).coalesce(1)
    ts = F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc))
    writers.land_bronze(envelopes, f"{folder}/landing", ts)
    writers.write_json_lines(envelopes, f"{folder}/lines")
    for path in (f"{folder}/landing", f"{folder}/lines"):
        assert len(files_below(path, ".json.gz")) == 3 and not files_below(path, ".json")
        assert searches(readers.scan_bronze_json(spark, path)) == ["s" + str(i) for i in range(10)]
    writers.write_json_lines(envelopes, f"{folder}/lines", mode="append")
    assert readers.scan_bronze_json(spark, f"{folder}/lines").count() == 20
    # A file that has to be read in splits is not compressed, and whole.
    writers.land_bronze(envelopes, f"{folder}/split", ts, codec="none")
    assert len(files_below(f"{folder}/split", ".json")) == 1 and not files_below(f"{folder}/split", ".gz")


@pytest.mark.parametrize("rows, arrays", [(0, [0]), (1, [1]), (3, [3]), (6, [3, 3]), (7, [3, 3, 1])])
def test_json_arrays_of_neighbouring_rows(spark, folder, rows, arrays):
    envelopes = spark.createDataFrame([("s" + str(i), None, None) for i in range(rows)], BRONZE).coalesce(1)
    writers.write_json_arrays(envelopes, folder, per_file=3)
    found = []
    for name in files_below(folder, ".txt.gz"):
        with gzip.open(f"{folder}/{name}", "rt") as text:
            found.append(json.load(text))
    assert sorted(map(len, found), reverse=True) == arrays
    assert searches(readers.scan_bronze_json(spark, folder, multi_line=True)) == ["s" + str(i) for i in range(rows)]


def test_customers_join_before_the_items(spark):
    """Their join must not shuffle the items' rows where customers are too many to be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = base_rows(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = [line for line in plan.splitlines() if "Join Inner, (" in line]
    depth = {key: min(line.index("Join") for line in lines if key in line) for key in ("o_custkey", "o_orderkey")}
    assert depth["o_orderkey"] < depth["o_custkey"]


def test_staged_files_are_short_and_dense(spark, folder, monkeypatch):
    """However densely rows are compressed, the files a task is given hold no more of them than it can sort."""
    monkeypatch.setattr("stratalake.plans.jobs.STAGED_ENVELOPES", 4)
    monkeypatch.setattr("stratalake.streaming.upsert.CHANGED_ROWS", 4)
    recordings = [{"id": str(i)} for i in range(3)]
    data = [("s" + str(i), "2024-01-01T00:00:00", {"recordings": recordings}) for i in range(10)]
    envelopes = spark.createDataFrame(data, BRONZE).coalesce(1)
    jobs.stage_bronze(envelopes, f"{folder}/staged")
    assert len(files_below(f"{folder}/staged", ".zstd.parquet")) == 3 and not files_below(f"{folder}/staged", ".snappy.parquet")
    assert jobs.read_staged(spark, f"{folder}/staged").count() == 10
    writers.write_json_lines(envelopes, f"{folder}/landing")
    upsert.append_changes(spark, f"{folder}/landing", f"{folder}/base", f"{folder}/checkpoint", "songs")
    assert len(files_below(f"{folder}/base/changes", ".parquet")) == 8
    assert spark.read.parquet(f"{folder}/base/changes").count() == 30


def test_envelopes_are_compiled(spark):
    """No lambda function over a row's items, which would then be evaluated without compiled code."""
    plan = envelopes(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    filtered = re.findall(r"filter\((.{12})", plan)
    assert set(filtered) <= {"[null], lamb", "array(null),"}, filtered


def test_only_the_silver_tables_asked_for_are_written(spark):
    at = Layers(spark, SF)
    assert at.silver("albums").count() > 0
    assert sorted(os.listdir(at.silver_path)) == ["albums"]
    assert at.silver_base() == at.silver_path and at.silver("songs").count() > 0
    assert sorted(os.listdir(at.silver_path)) == ["albums", "artists", "songs"]


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_layers_leave_no_shuffle_files(spark, folder):
    """They would lie beside the tables they went into until the driver collects garbage."""
    before, at = shuffle_files(spark), Layers(spark, SF)
    at.bronze_json()
    assert not shuffle_files(spark) - before
    at.silver_base("songs")
    assert not shuffle_files(spark) - before
    export_flat(spark, at.bronze_parts(), folder, datetime(2024, 2, 1, tzinfo=timezone.utc))
    assert not shuffle_files(spark) - before


def test_shuffles_are_short_lived_inside_only(spark):
    before = spark.conf.get(CLEAN_SHUFFLES)
    with pytest.raises(ValueError), short_lived_shuffles(spark):
        assert spark.conf.get(CLEAN_SHUFFLES) == "true"
        raise ValueError
    assert spark.conf.get(CLEAN_SHUFFLES) == before


@pytest.mark.parametrize("name", ["stream_bronze_ingest", "ingest_contents", "stream_dedup_watermark", "stream_earliest", "incremental_upsert", "change_feed"])
def test_landing_folders_go_when_they_are_worked_off(spark, monkeypatch, name):
    made = []
    monkeypatch.setattr(queries, "work_dir", lambda *about: made.append(work_dir(*about)) or made[-1])
    result = queries.REGISTRY[name](spark, SF)
    landing = [path for path in made if "/landing-" in path]
    assert landing and not any(os.path.exists(path) for path in landing)
    assert result.count() > 0


def staged_in_files(spark, folder, files):
    """Layers whose bronze lies in so many files, of ten envelopes each."""
    rows_ = [(f"s{n}", f"2024-01-01T00:00:{n % 60:02}", {"recordings": [{"id": str(n)}] * (n % 3)}) for n in range(10 * files)]
    at = Layers(spark, folder, parquet_path=f"{folder}/staged")
    spark.createDataFrame(rows_, BRONZE).repartition(files).write.parquet(at.parquet_path)
    return at


def test_plain_arrays_lie_on_disk_share_by_share(spark, folder, monkeypatch):
    """Every share is written in at most four array files and dropped before the next one; together they are all rows."""
    at, made, beside = staged_in_files(spark, folder, 9), [], []

    def write(df, path, **options):
        beside.append([p for p in made if os.path.exists(p)])
        made.append(path)
        writers_write(df, path, **options)
        assert 0 < len(files_below(path, ".txt")) <= 4

    writers_write = writers.write_json_arrays
    monkeypatch.setattr(writers, "write_json_arrays", write)
    monkeypatch.setattr(queries, "ARRAY_SHARE", 4)
    found = queries.scan_array_splits(at)
    assert len(made) == 3 and beside == [[], [], []] and not any(os.path.exists(p) for p in made)
    assert rows(found) == rows(queries.sized(at.bronze())) and found.count() == 90


def test_no_single_task_lands_the_run_that_is_looked_for(spark, folder, monkeypatch):
    at, landings = staged_in_files(spark, folder, 12), []
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for name in before:
        spark.conf.set(name, "4000")
    try:
        monkeypatch.setattr(queries, "work_dir", lambda *about: landings.append(work_dir(*about)) or landings[-1])
        found = queries.newest_file_top1(at).collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert [r["batch_id"] for r in found] == ["20240201_000000"]
    assert len(files_below(f"{landings[0]}/batch_id=20240201_000000", ".json.gz")) > 1
    landed = readers.scan_bronze_json(spark, landings[0])
    assert rows(queries.sized(landed)) == rows(queries.sized(at.bronze()))
