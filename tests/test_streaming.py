import json
import os
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import envelope, rows
from stratalake.plans import silver
from stratalake.plans.flat_export import export_newest
from stratalake.plans.jobs import run_bronze_to_silver, run_silver_to_gold
from stratalake.schemas import BRONZE, GOLD
from stratalake.sources.readers import read_csv_export, scan_bronze_json, scan_silver_parquet
from stratalake.sources.lookup import key_index
from stratalake.streaming import changefeed, earliest, gold, ingest, upsert


def song(key, title, at):
    return envelope(f"s-{title}", [{"id": key, "title": title, "releases": [{"id": f"l{key}", "date": "2001"}]}], at)


DAYS = [f"2024-01-0{n}T00:00:00+00:00" for n in range(1, 6)]


def test_each_file_is_read_once(spark, folder, write_bronze):
    landing = write_bronze([song("1", "a", DAYS[0])])

    def run():
        ingest.ingest_bronze(spark, landing, f"{folder}/out", f"{folder}/state")
        return spark.read.parquet(f"{folder}/out").count()

    assert run() == 1
    assert run() == 1  # nothing new, nothing added
    write_bronze([song("2", "b", DAYS[1]), song("3", "c", DAYS[1])])
    assert run() == 3
    assert rows(spark.read.schema(BRONZE).parquet(f"{folder}/out")) == rows(scan_bronze_json(spark, landing))


def test_files_with_old_times_are_read_too(spark, folder, write_bronze):
    landing = write_bronze([song("1", "a", DAYS[0])])
    ingest.ingest_bronze(spark, landing, f"{folder}/out", f"{folder}/state")
    write_bronze([song("2", "b", DAYS[1])], "back-fill.json")
    a_year_ago = time.time() - 365 * 86400
    os.utime(f"{landing}/back-fill.json", (a_year_ago, a_year_ago))
    ingest.ingest_bronze(spark, landing, f"{folder}/out", f"{folder}/state")
    assert spark.read.parquet(f"{folder}/out").count() == 2


@pytest.mark.parametrize("lines", [True, False])
def test_files_of_one_array_are_read_by_the_incremental_job(spark, folder, write_bronze, lines):
    landing = write_bronze([song("1", "a", DAYS[0]), song("2", "b", DAYS[1])], lines=lines)
    counts = upsert.run_incremental(spark, landing, f"{folder}/state", f"{folder}/silver", multi_line=not lines)
    assert counts == {"artists": 0, "albums": 2, "songs": 2, "unreadable": 0}


def test_unreadable_text_is_kept_and_counted(spark, folder, write_bronze):
    landing = write_bronze([song("1", "a", DAYS[0])])
    write_bronze([song("2", "b", DAYS[1])], lines=False)  # an array over several lines, read as JSON Lines
    write_bronze('{"artist_search": "cut o')
    counts = upsert.run_incremental(spark, landing, f"{folder}/state", f"{folder}/silver")
    assert counts["songs"] == 1 and counts["unreadable"] > 5
    batch = run_bronze_to_silver(spark, landing, f"{folder}/batch")
    assert batch == counts
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/batch/unreadable").collect()]
    assert len(texts) == counts["unreadable"] and '{"artist_search": "cut o' in texts


def test_a_run_without_news_writes_nothing(spark, folder, write_bronze):
    landing = write_bronze([song("1", "a", DAYS[0])])
    run = lambda: upsert.run_incremental(spark, landing, f"{folder}/state", f"{folder}/silver")

    def written():
        every = [os.path.join(d, f) for d, _, files in os.walk(folder) for f in files if f.startswith("part-")]
        return {f: os.path.getmtime(f) for f in every}

    first, before = run(), written()
    assert run() == first and written() == before


def test_a_table_left_behind_by_a_dead_run_is_published_by_the_next(spark, folder, write_bronze, monkeypatch):
    landing = write_bronze([song("1", "a", DAYS[0])])
    run = lambda: upsert.run_incremental(spark, landing, f"{folder}/state", f"{folder}/silver")
    run()
    write_bronze([song("2", "b", DAYS[1])])
    with monkeypatch.context() as broken:
        broken.setattr(upsert, "publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert spark.read.parquet(f"{folder}/silver/songs").count() == 1  # the old table is still whole
    write_bronze([song("3", "c", DAYS[1])])  # the next run has news of its own
    assert run()["songs"] == 3
    assert spark.read.parquet(f"{folder}/silver/songs").count() == 3


def test_only_touched_buckets_are_written(spark, folder, write_bronze):
    landing = write_bronze([song(str(n), "a", DAYS[0]) for n in range(200)])
    run = lambda: upsert.run_incremental(spark, landing, f"{folder}/state", f"{folder}/silver")
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(f"{folder}/silver/songs") for f in names if f.startswith("part-")}
    run()
    before = files()
    write_bronze([song("7", "b", "2023-01-01T00:00:00+00:00")])
    run()
    gone = before - files()
    assert len(gone) == 1 and len(before) > 40
    titles = {r["recording_id"]: r["title"] for r in scan_silver_parquet(spark, f"{folder}/silver", "songs").collect()}
    assert len(titles) == 200 and titles["7"] == "b" and titles["8"] == "a"


def test_the_newest_file_is_exported_and_archived(spark, folder, write_bronze):
    landing = write_bronze([song("1", "old", DAYS[0])], "old.json", lines=False)
    write_bronze([song("2", "new", DAYS[1])], "new.json", lines=False)
    os.utime(f"{landing}/old.json", (1, 1))
    now = datetime(2024, 2, 1, tzinfo=timezone.utc)
    folders = export_newest(spark, landing, f"{folder}/out", f"{folder}/done", now)
    assert [r["title"] for r in read_csv_export(spark, folders["song"]).collect()] == ["new"]
    assert os.listdir(landing) == ["old.json"] or sorted(os.listdir(landing)) == [".old.json.crc", "old.json"]
    assert "new.json" in os.listdir(f"{folder}/done")


NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)


def titles_of(spark, result):
    return sorted(r["title"] for r in read_csv_export(spark, result["song"]).collect())


@pytest.mark.parametrize("layout", ["lines", "array", "objects"])
def test_any_layout_is_exported_whole(spark, folder, write_bronze, layout):
    songs = [song(str(n), f"t{n:02}", DAYS[0]) for n in range(20)]
    texts = {"lines": "\n".join(map(json.dumps, songs)), "array": json.dumps(songs), "objects": "\n".join(json.dumps(s, indent=1) for s in songs)}
    landing = write_bronze(texts[layout], "new.json")
    result = export_newest(spark, landing, f"{folder}/out", f"{folder}/done", NOW)
    assert titles_of(spark, result) == [f"t{n:02}" for n in range(20)] and result["unreadable"] == 0
    assert "new.json" in os.listdir(f"{folder}/done")


def test_a_truncated_file_leaves_its_text(spark, folder, write_bronze):
    landing = write_bronze(json.dumps([song("1", "a", DAYS[0]), song("2", "b", DAYS[0])])[:-30], "cut.json")
    result = export_newest(spark, landing, f"{folder}/out", f"{folder}/done", NOW)
    assert titles_of(spark, result) == ["a"] and result["unreadable"] == 1
    (kept,) = spark.read.parquet(f"{folder}/out/unreadable/*").collect()
    assert '"s-b"' in kept["text"]


def test_a_file_of_which_nothing_can_be_read_stays(spark, folder, write_bronze):
    landing = write_bronze([song("1", "a", DAYS[0]), song("2", "b", DAYS[0])], "array.json", lines=False)
    with pytest.raises(ValueError):
        export_newest(spark, landing, f"{folder}/out", f"{folder}/done", NOW, multi_line=False)
    assert "array.json" in os.listdir(landing) and not os.path.exists(f"{folder}/out/song_data")
    assert spark.read.parquet(f"{folder}/out/unreadable/*").count() > 5


def test_texts_that_were_unreadable_before_are_not_reported_again(spark, folder, write_bronze):
    landing = write_bronze([song("1", "a", DAYS[0])], "a.json")
    write_bronze("broken", "b.json")
    assert run_bronze_to_silver(spark, landing, f"{folder}/silver")["unreadable"] == 1
    assert run_bronze_to_silver(spark, f"{landing}/a.json", f"{folder}/silver")["unreadable"] == 0
    assert spark.read.parquet(f"{folder}/silver/unreadable").count() == 0


def test_batch_and_incremental_runs_take_mixed_layouts(spark, folder, write_bronze):
    landing = write_bronze([song(str(n), f"t{n}", DAYS[0]) for n in range(20)])
    write_bronze([song(str(n), f"t{n}", DAYS[0]) for n in range(20, 30)], lines=False)
    want = {"artists": 0, "albums": 30, "songs": 30, "unreadable": 0}
    assert run_bronze_to_silver(spark, landing, f"{folder}/batch", multi_line=True) == want
    run = lambda: upsert.run_incremental(spark, landing, f"{folder}/state", f"{folder}/silver", multi_line=True)
    assert run() == want and run() == want
    write_bronze(json.dumps(song("99", "more", DAYS[1]), indent=2) + "\n{broken")
    assert run() == {"artists": 0, "albums": 31, "songs": 31, "unreadable": 1}


def test_a_run_without_files(spark, folder):
    os.makedirs(f"{folder}/in")
    for any_layout in (False, True):
        counts = upsert.run_incremental(spark, f"{folder}/in", f"{folder}/state", f"{folder}/silver", multi_line=any_layout)
        assert set(counts.values()) == {0}


def test_files_are_archived_by_a_later_batch(spark, folder, write_bronze):
    spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", "0")  # clean within the batch
    try:
        for n in range(3):
            landing = write_bronze([song(str(n), "x", DAYS[n])])
            ingest.ingest_bronze(spark, landing, f"{folder}/out", f"{folder}/state", archive_dir=f"{folder}/done")
    finally:
        spark.conf.unset("spark.sql.streaming.fileSource.cleaner.numThreads")
    archived = [f for _, _, files in os.walk(f"{folder}/done") for f in files if f.endswith(".json")]
    pending = [f for f in os.listdir(landing) if f.endswith(".json")]
    assert archived and sorted(archived + pending) == ["part-0.json", "part-1.json", "part-2.json"]
    assert spark.read.parquet(f"{folder}/out").count() == 3


def test_watermark_dedup_keeps_first_arrival(spark, folder, write_bronze):
    landing = write_bronze([song("1", "arrived first", DAYS[1]), song("2", "b", DAYS[1])])

    def run():
        rows_ = ingest.stream_dedup_watermark(ingest.read_new_bronze(spark, landing), "songs")
        ingest.run_available(rows_, f"{folder}/out", f"{folder}/state")
        return sorted(r["title"] for r in spark.read.parquet(f"{folder}/out").collect())

    assert run() == ["arrived first", "b"]
    write_bronze([song("1", "earlier but late", "2024-01-01T23:00:00+00:00"), song("3", "c", DAYS[1])])
    assert run() == ["arrived first", "b", "c"]


def test_the_earliest_row_wins_within_the_delay(spark, folder, write_bronze):
    def run():
        earliest.keep_earliest(ingest.read_new_bronze(spark, landing), "songs", f"{folder}/out", f"{folder}/state", delay="2 days")
        return sorted((r["recording_id"], r["title"]) for r in earliest.earliest_rows(spark, f"{folder}/out", "songs").collect())

    landing = write_bronze([song("1", "later", DAYS[3]), song("2", "b", DAYS[3])])
    assert run() == [("1", "later"), ("2", "b")]
    write_bronze([song("1", "earlier", DAYS[2]), song("2", "later still", DAYS[4]), song("3", "c", DAYS[2])])
    assert run() == [("1", "earlier"), ("2", "b"), ("3", "c")]
    assert run() == [("1", "earlier"), ("2", "b"), ("3", "c")]
    write_bronze([song("1", "too late", "2023-12-01T00:00:00+00:00"), song("4", "d", DAYS[4])])
    assert run() == [("1", "earlier"), ("2", "b"), ("3", "c"), ("4", "d")]


def test_a_batch_merged_twice_changes_nothing(spark, folder, write_bronze, monkeypatch):
    landing = write_bronze([song("1", "a", DAYS[1]), song("2", "b", DAYS[1])])
    run = lambda: earliest.keep_earliest(ingest.read_new_bronze(spark, landing), "songs", f"{folder}/out", f"{folder}/state")
    with monkeypatch.context() as broken:  # the merge is done, the batch is not marked as done
        broken.setattr(upsert, "forget", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            run()
    run()
    assert rows(earliest.earliest_rows(spark, f"{folder}/out", "songs")) == rows(silver.transform_songs(scan_bronze_json(spark, landing)))


def test_incremental_runs_equal_one_batch_run(spark, folder, write_bronze):
    """Later extractions arrive first; some files come one by one, one run finds nothing new."""
    arrivals = [
        [song("1", "late", DAYS[4]), song("2", "x", DAYS[3])],
        [],
        [song("1", "early", DAYS[0])],
        [song("1", "middle", DAYS[2]), song("3", "y", DAYS[1]), song("2", "x again", DAYS[3])],
    ]
    for batch in arrivals:
        landing = write_bronze(batch) if batch else landing  # noqa: F821
        counts = upsert.run_incremental(spark, landing, f"{folder}/state", f"{folder}/silver")
    bronze = scan_bronze_json(spark, landing)
    for table, make in silver.TRANSFORMS.items():
        stored = scan_silver_parquet(spark, f"{folder}/silver", table)
        assert rows(stored) == rows(make(bronze))
        assert stored.count() == counts[table]
    # three batches brought something, so there were three snapshots, of which two are kept with all that they refer to
    kept = upsert.snapshots(spark, f"{folder}/state/songs")
    assert sorted(kept) == [2, 3]
    for number, state in kept.items():
        assert upsert.bucket_rows(spark, f"{folder}/state/songs", "songs", state).count() == (2 if number == 2 else 3)
    assert ("1", "early") in [(r["recording_id"], r["title"]) for r in silver.transform_songs(bronze).collect()]


def test_merging_is_associative(spark, write_bronze, folder):
    import itertools

    parts = [[song("1", "a", DAYS[2])], [song("1", "b", DAYS[0]), song("2", "c", DAYS[1])], [song("2", "d", DAYS[0])]]
    frames = []
    for n, part in enumerate(parts):
        name = f"only-{n}.json"
        path = write_bronze(part, name)
        frames.append(silver.keyed_rows(scan_bronze_json(spark, f"{path}/{name}"), "songs"))
    once = rows(upsert.upserted(frames, "songs"))
    for a, b, c in itertools.permutations(frames):
        step = upsert.upserted([upsert.upserted([a, b], "songs"), c], "songs")
        assert rows(step) == once


def test_a_snapshot_the_log_does_not_name_is_made_again(spark, folder, write_bronze):
    landing = write_bronze([song("1", "b", DAYS[1])])
    upsert.append_changes(spark, landing, folder, f"{folder}/state", "songs")
    spark.range(3).write.parquet(f"{folder}/snapshots/number=1")  # left over from a run that died
    assert [r["title"] for r in upsert.advance_snapshot(spark, folder, "songs").collect()] == ["b"]
    assert list(upsert.snapshots(spark, folder)) == [1]
    # nothing new: the same snapshot, no further one
    assert upsert.advance_snapshot(spark, folder, "songs").count() == 1
    assert list(upsert.snapshots(spark, folder)) == [1]


def test_changes_of_a_run_that_died_are_taken_with_the_next(spark, folder, write_bronze):
    """The stream has committed, the snapshot has not been made: both runs' rows get the same number."""
    landing = write_bronze([song("1", "a", DAYS[1])])
    upsert.append_changes(spark, landing, folder, f"{folder}/state", "songs")
    write_bronze([song("2", "b", DAYS[1])])
    upsert.append_changes(spark, landing, folder, f"{folder}/state", "songs")
    assert sorted(r["title"] for r in upsert.advance_snapshot(spark, folder, "songs").collect()) == ["a", "b"]
    write_bronze([song("3", "c", DAYS[1])])
    upsert.append_changes(spark, landing, folder, f"{folder}/state", "songs")
    assert sorted(r["title"] for r in upsert.advance_snapshot(spark, folder, "songs").collect()) == ["a", "b", "c"]


def incremental(spark, folder, landing, **sizes):
    return upsert.run_incremental(spark, landing, f"{folder}/state", f"{folder}/silver", **sizes)


def test_linear_hashing_moves_rows_only_from_their_parents(spark):
    df = spark.range(20_000).selectExpr("cast(id as string) k")
    for old, new in ((1, 2), (3, 5), (64, 65), (64, 300), (100, 300), (7, 7)):
        places = df.select(upsert.bucket_of("k", old).alias("a"), upsert.bucket_of("k", new).alias("b")).collect()
        assert all(0 <= p.a < old and 0 <= p.b < new and upsert.parent(p.b, old) == p.a for p in places)
        assert len({p.b for p in places}) == new


def test_buckets_split_as_the_table_grows(spark, folder, write_bronze):
    songs = lambda a, b, title: [song(str(n), title, DAYS[0]) for n in range(a, b)]
    sizes = {"buckets": 2, "bucket_bytes": 5_000}
    landing = write_bronze(songs(0, 50, "a"))
    incremental(spark, folder, landing, **sizes)
    base = f"{folder}/state/songs"
    assert upsert.state_of(spark, base).buckets == 2
    write_bronze(songs(50, 5000, "b"))
    counts = incremental(spark, folder, landing, **sizes)
    state = upsert.state_of(spark, base)
    assert state.buckets > 4 and max(state.bytes.values()) < 3 * 5_000
    assert counts["songs"] == 5000 == sum(state.rows.values()) == scan_silver_parquet(spark, f"{folder}/silver", "songs").count()
    # One more row: its bucket is written, and what a further split takes; all others stay.
    write_bronze([song("7", "first", "2023-01-01T00:00:00+00:00")])
    incremental(spark, folder, landing, **sizes)
    after = upsert.state_of(spark, base)
    changed = [b for b in after.holder if after.holder[b] != state.holder.get(b)]
    assert len(changed) <= 1 + 2 * (after.buckets - state.buckets)
    for table, make in silver.TRANSFORMS.items():
        assert rows(scan_silver_parquet(spark, f"{folder}/silver", table)) == rows(make(scan_bronze_json(spark, landing)))


def test_a_run_that_dies_in_a_split_is_made_good(spark, folder, write_bronze, monkeypatch):
    sizes = {"buckets": 1, "bucket_bytes": 5_000}
    landing = write_bronze([song(str(n), "a", DAYS[1]) for n in range(100)])
    incremental(spark, folder, landing, **sizes)
    for step in ("write_parquet_overwrite", "replace_buckets", "touch"):
        n = len(os.listdir(landing)) * 1000
        write_bronze([song(str(n + i), "b", DAYS[0]) for i in range(400)])
        with monkeypatch.context() as broken:
            broken.setattr(upsert, step, lambda *a, **b: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                incremental(spark, folder, landing, **sizes)
        counts = incremental(spark, folder, landing, **sizes)
        stored = scan_silver_parquet(spark, f"{folder}/silver", "songs")
        assert rows(stored) == rows(silver.transform_songs(scan_bronze_json(spark, landing)))
        assert counts["songs"] == stored.count()
    assert upsert.state_of(spark, f"{folder}/state/songs").buckets > 1


def test_feed_leads_from_one_snapshot_to_the_next(spark, folder, write_bronze):
    sizes = {"buckets": 2, "bucket_bytes": 8_000}
    landing = write_bronze([song(str(n), "a", DAYS[3]) for n in range(300)])
    incremental(spark, folder, landing, **sizes)
    write_bronze([song(str(n), "b", DAYS[1]) for n in range(250, 900)])
    incremental(spark, folder, landing, **sizes)
    base = f"{folder}/state/songs"
    feed = changefeed.change_feed(spark, base, "songs", 1, 2)
    assert {r["change"]: r["count"] for r in feed.groupBy("change").count().collect()} == {"update": 50, "insert": 600}
    old, new = (changefeed.as_of(spark, base, "songs", n) for n in (1, 2))
    assert rows(changefeed.apply_feed(old, feed, "songs")) == rows(new) and old.count() == 300
    back = changefeed.change_feed(spark, base, "songs", 2, 1)
    assert back.where("change = 'delete'").count() == 600
    assert rows(changefeed.apply_feed(new, back, "songs")) == rows(old)
    assert rows(changefeed.apply_feed(new.limit(0), changefeed.change_feed(spark, base, "songs", 0, 2), "songs")) == rows(new)
    with pytest.raises(LookupError):
        changefeed.change_feed(spark, base, "songs", 1, 7)


def full(search, key, at, artists=(), country="X", date="2001-05", length=60000, tracks=3):
    release = {"id": f"l{key}", "date": date, "country": country, "track-count": tracks}
    credits = [{"artist": {"id": a, "name": a}} for a in artists]
    return envelope(search, [{"id": f"r{key}", "length": length, "first-release-date": date, "releases": [release], "artist-credit": credits}], at)


def test_gold_by_deltas_equals_a_rebuild(spark, folder, write_bronze):
    """Rows that come, move between searches, years and countries, or lose the least or largest date of a group."""
    arrivals = [
        [full("s1", 1, DAYS[3], ["a", "b"]), full("s1", 2, DAYS[3], ["a"], date="1990"), full("s2", 3, DAYS[3], ["c"], country=None, tracks=None)],
        [full("s2", 2, DAYS[1], ["a"], date="1995", country="Y"), full("s3", 4, DAYS[1], ["d"], date=None)],
        [full("s1", 1, DAYS[0], ["b"], date="2010-01-01", length=None), full("s9", 3, DAYS[0], ["c"], date="bad")],
        [],
        [full(f"t{n}", n, DAYS[0], [f"x{n}"], date=str(1960 + n % 40)) for n in range(100, 300)],
    ]
    sizes = {"buckets": 2, "bucket_bytes": 6_000}
    for n, batch in enumerate(arrivals):
        landing = write_bronze(batch) if batch else landing  # noqa: F821
        incremental(spark, folder, landing, **sizes)
        if n == 2:
            continue  # two silver snapshots in one go
        counts = gold.run_gold_incremental(spark, f"{folder}/state", f"{folder}/gold", NOW, **sizes)
        run_silver_to_gold(spark, f"{folder}/silver", f"{folder}/rebuilt", NOW)
        for table, schema in GOLD.items():
            read = lambda at: spark.read.schema(schema).parquet(f"{folder}/{at}/{table}").select(*schema.fieldNames())  # noqa: E731, B023
            assert rows(read("gold")) == rows(read("rebuilt"))
        assert gold.run_gold_incremental(spark, f"{folder}/state", f"{folder}/gold", NOW, **sizes) == dict.fromkeys(counts, 0)


def test_gold_by_deltas_writes_only_what_changed(spark, folder, write_bronze):
    landing = write_bronze([full(f"s{n}", n, DAYS[1], [f"a{n}"], date=str(1900 + n % 100)) for n in range(400)])
    run = lambda: (incremental(spark, folder, landing), gold.run_gold_incremental(spark, f"{folder}/state", f"{folder}/gold", NOW))[1]
    first = run()
    assert first["artist_summary"] == 400
    write_bronze([full("s7", 7000, DAYS[1], ["a7"], date="1907")])
    second = run()
    # One search of the counted values' buckets, and its parts' buckets of the summary.
    assert 0 < second["yearly_release_metrics"] < 20 and 0 < second["artist_summary"] < 400
    row = spark.read.parquet(f"{folder}/gold/artist_summary").where("artist_id = 'a7'").first()
    assert row["total_recordings"] == 2


def test_gold_is_made_good_after_a_run_that_died(spark, folder, write_bronze, monkeypatch):
    landing = write_bronze([full("s1", 1, DAYS[2], ["a"])])
    make = lambda: gold.run_gold_incremental(spark, f"{folder}/state", f"{folder}/gold", NOW)
    incremental(spark, folder, landing)
    make()
    for step in ("replace_buckets", "touch", "values_changed"):
        write_bronze([full(f"s-{step}", step, DAYS[1], [step])])
        incremental(spark, folder, landing)
        with monkeypatch.context() as broken:
            broken.setattr(gold, step, lambda *a, **b: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                make()
        make()
        run_silver_to_gold(spark, f"{folder}/silver", f"{folder}/rebuilt", NOW)
        for table, schema in GOLD.items():
            read = lambda at: spark.read.schema(schema).parquet(f"{folder}/{at}/{table}").select(*schema.fieldNames())  # noqa: E731, B023
            assert rows(read("gold")) == rows(read("rebuilt"))


def test_small_buckets_share_files_and_keep_their_rows_apart(spark, folder, write_bronze):
    """A state of hundreds of small buckets lies in few files; what a later snapshot took over is not read from them."""
    sizes = {"buckets": 2, "bucket_bytes": 500}
    landing = write_bronze([song(str(n), "a", DAYS[2]) for n in range(3000)])
    incremental(spark, folder, landing, **sizes)
    base = f"{folder}/state/songs"
    first = upsert.state_of(spark, base)
    files = [f for _, _, names in os.walk(f"{base}/snapshots/number=1") for f in names if f.endswith(".parquet")]
    assert first.buckets > 20 and len(files) == 1
    assert sum(first.rows.values()) == 3000 and set(first.pack.values()) == {upsert.PACK_BYTES // 500}
    for n, day in ((7, 1), (8, 0), (9, 0)):
        write_bronze([song(str(n), "b", DAYS[day])])
        incremental(spark, folder, landing, **sizes)
        # One bucket, or all that there are, from a file that holds others and older rows.
        state = upsert.state_of(spark, base)
        some = sorted(state.holder)[::3]
        got = {b: upsert.bucket_rows(spark, base, "songs", state, [b]).count() for b in some[:3]}
        assert got == {b: state.rows[b] for b in got}
        stored = upsert.bucket_rows(spark, base, "songs", state)
        assert stored.count() == 3000 == stored.select("recording_id").distinct().count()
        assert upsert.bucket_rows(spark, base, "songs", state, some).count() == sum(state.rows[b] for b in some)
    assert rows(scan_silver_parquet(spark, f"{folder}/silver", "songs")) == rows(silver.transform_songs(scan_bronze_json(spark, landing)))


def test_states_in_a_folder_per_bucket_are_read_on(spark, folder, write_bronze, monkeypatch):
    """What versions before wrote: a folder per bucket, and logs that don't say how many share one."""
    sizes = {"buckets": 8, "bucket_bytes": 100_000}
    landing = write_bronze([song(str(n), "a", DAYS[1]) for n in range(100)])
    with monkeypatch.context() as older:
        older.setattr(upsert, "PACK_BYTES", 0)
        incremental(spark, folder, landing, **sizes)
    base = f"{folder}/state/songs"
    assert os.path.isdir(f"{base}/snapshots/number=1/bucket={min(upsert.state_of(spark, base).holder)}")
    log = f"{base}/log/snapshot=1"
    spark.read.parquet(log).drop("pack").localCheckpoint().write.mode("overwrite").parquet(log)
    for n in (3, 4, 105):
        write_bronze([song(str(n), "b", DAYS[0])])
        incremental(spark, folder, landing, **sizes)
    assert rows(scan_silver_parquet(spark, f"{folder}/silver", "songs")) == rows(silver.transform_songs(scan_bronze_json(spark, landing)))


def test_filters_are_no_larger_than_the_files_need():
    options = lambda rows: {k.split(".")[-1].split("#")[0]: v for k, v in key_index("k", rows=rows).items()}
    small, large, unknown = options(1000), options(10**7), options(None)
    assert small["bytes"] == "8192" and small["number"] == "1"
    assert large == unknown and large["bytes"] == str(4_194_304) and large["number"] == "10"
