"""Files of any layout, cut anywhere, against Python's own parser."""

import json
import os
import random

import pytest

from conftest import envelope
from stratalake.schemas import BRONZE
from stratalake.sources import json_values, readers

SPLITS = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@pytest.fixture
def small_splits(spark):
    """Files are cut every few bytes."""

    def cut(size):
        for name in SPLITS:
            spark.conf.set(name, str(size))

    yield cut
    for name in SPLITS:
        spark.conf.unset(name)


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as out:
        out.write(text if isinstance(text, bytes) else text.encode())
    return f"{folder}/{name}"


def texts(spark, path):
    return sorted(r["text"].strip() for r in json_values.value_texts(json_values.scan_fragments(spark, path)).collect())


def awkward(rng):
    """A value with everything that looks like structure inside its strings."""
    string = lambda: "".join(rng.choice('ab{}[],:"\\/\n é日') for _ in range(rng.randint(0, 12)))
    value = lambda depth: rng.choice([
        string, lambda: rng.randint(-5, 5), lambda: None, lambda: True,
        lambda: [value(depth - 1) for _ in range(rng.randint(0, 3))] if depth else [],
        lambda: {string(): value(depth - 1) for _ in range(rng.randint(0, 3))} if depth else {},
    ])()
    return {"k": rng.randint(0, 10**6), string(): value(3), "end": "}"}


@pytest.mark.parametrize("layout", ["array", "indented array", "lines", "values", "indented values", "one line"])
@pytest.mark.parametrize("size", [7, 64, 100_000])
def test_every_value_comes_out_whatever_the_cuts(spark, folder, small_splits, layout, size):
    rng = random.Random(f"{layout}{size}")
    values = [awkward(rng) for _ in range(40)]
    as_text = {
        "array": lambda: json.dumps(values),
        "indented array": lambda: "\n " + json.dumps(values, indent=2, ensure_ascii=False) + "\n\n",
        "lines": lambda: "\n".join(json.dumps(v, ensure_ascii=False) for v in values) + "\n",
        "values": lambda: " \n".join(json.dumps(v) for v in values),
        "indented values": lambda: "\n".join(json.dumps(v, indent=1) for v in values),
        "one line": lambda: "".join(json.dumps(v) for v in values),
    }
    path = write(folder, "file.json", as_text[layout]())
    small_splits(size)
    parts = json_values.scan_fragments(spark, path)
    if size < 100:
        assert parts.select("start").distinct().count() > 10
    got = [json.loads(r["text"]) for r in json_values.value_texts(parts).collect()]
    key = lambda v: json.dumps(v, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, values))


def test_files_of_different_layouts_lie_in_one_folder(spark, folder, small_splits):
    rng = random.Random(3)
    values = [awkward(rng) for _ in range(30)]
    write(folder, "a.json", json.dumps(values[:10]))
    write(folder, "b.json", "﻿" + "\n".join(map(json.dumps, values[10:20])))
    write(folder, "c.json", json.dumps(values[20], indent=4))
    write(folder, "d.json", "[]")
    write(folder, "e.json", "")
    write(folder, "f.json", " \n ")
    write(folder, "g.json", json.dumps(values[21:]) + "\n" + json.dumps([]))
    small_splits(50)
    got = [json.loads(t) for t in texts(spark, folder)]
    assert sorted(v["k"] for v in got) == sorted(v["k"] for v in values)


@pytest.mark.parametrize("size", [5, 1000])
@pytest.mark.parametrize(
    "content, want",
    [
        ('[{"a":1},{"a":2},{"a":', ['{"a":', '{"a":1}', '{"a":2}']),
        ('[{"a":1},', ["[", '{"a":1}']),
        ('[{"a":1},{', ['{', '{"a":1}']),
        ('[{"a":1} {"a":2}]', ['{"a":1}', '{"a":2}']),
        ('[{"a":1}, null, 7, [{"b":1},{"b":2}]]', ["7", '[{"b":1},{"b":2}]', "null", '{"a":1}']),
        ('{"a":1}\n{"a":\n{"a":3}\n', ['{"a":', '{"a":1}', '{"a":3}']),
        ('{"a":1}\n{"a":"x\n{"a":3}{"a":4}\n', ['{"a":"x', '{"a":1}', '{"a":3}', '{"a":4}']),
        ('garbage\n{"a":1}\n', ["garbage", '{"a":1}']),
        ('{"a":"\\\\"}\n{"b":"\\""}', ['{"a":"\\\\"}', '{"b":"\\""}']),
    ],
)
def test_broken_text_stays_and_costs_no_more_than_itself(spark, folder, small_splits, content, want, size):
    path = write(folder, "file.json", content)
    small_splits(size)
    assert texts(spark, path) == sorted(want)


def test_compressed_files(spark, folder):
    import gzip

    write(folder, "a.json.gz", gzip.compress(b'[{"a":1},{"a":2}]'))
    write(folder, "b.json.gz", gzip.compress(b'{"a":3}\n{"a":4}\n'))
    assert texts(spark, folder) == [f'{{"a":{n}}}' for n in (1, 2, 3, 4)]


def test_rows_equal_those_of_whole_file_parsing(spark, folder, small_splits):
    rows = [envelope(f"s{i}", [{"id": f"r{i}", "length": 7, "releases": [{"id": "l", "track-count": "12.0"}]}]) for i in range(200)]
    write(folder, "a.json", json.dumps(rows[:150], indent=1))
    write(folder, "b.json", json.dumps(rows[150:]))
    want = spark.read.schema(BRONZE).option("multiLine", True).json(folder).collect()
    small_splits(500)
    assert sorted(readers.scan_bronze_json(spark, folder, multi_line=True).collect(), key=repr) == sorted(want, key=repr)


def test_what_is_no_object_is_kept_as_text(spark, folder):
    path = write(folder, "a.json", '[{"artist_search":"a"}, null, [{"artist_search":"b"},{"artist_search":"c"}], 5, {"artist_search":{]')
    df = readers.scan_bronze_json(spark, path, multi_line=True, keep_corrupt=True)
    bad = sorted(r["_corrupt_record"].strip() for r in df.collect() if r["_corrupt_record"] is not None)
    assert bad == ["5", '[{"artist_search":"b"},{"artist_search":"c"}]', "null", '{"artist_search":{]']
    assert [r["artist_search"] for r in df.collect() if r["_corrupt_record"] is None] == ["a"]


def test_states_beyond_a_broadcast_give_the_same(spark, folder, small_splits, monkeypatch):
    rng = random.Random(9)
    values = [awkward(rng) for _ in range(30)]
    path = write(folder, "a.json", json.dumps(values))
    small_splits(40)
    want = texts(spark, path)
    monkeypatch.setattr(json_values, "BROADCAST_SPLITS", 2)
    assert texts(spark, path) == want


def test_files_of_one_split_are_gone_through_twice(spark, folder):
    """No value has parts in them, so the pass that looks for parts is left out; with longer files it is not."""
    for number in range(3):
        spark.range(200).selectExpr("'[' || concat_ws(',', collect_list(to_json(struct(id, 'é{\"' AS text)))) || ']' AS value").coalesce(1).write.mode("append").text(folder)
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    texts = json_values.value_texts(json_values.scan_fragments(spark, folder))
    assert scans(texts) == 1
    assert sorted(json.loads(r["text"])["id"] for r in texts.collect()) == sorted([*range(200)] * 3)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    try:
        split = json_values.value_texts(json_values.scan_fragments(spark, folder))
        assert scans(split) > 1
        assert sorted(r["text"] for r in split.collect()) == sorted(r["text"] for r in texts.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
