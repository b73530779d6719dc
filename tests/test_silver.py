"""Hand-made envelopes with the odd cases of real data."""

import itertools
import random
from datetime import date

from pyspark.sql import functions as F

from conftest import envelope, rows
from stratalake.fixed_values import ARTIST_URL_PREFIX, RELEASE_URL_PREFIX
from stratalake.plans import silver
from stratalake.plans.flat_export import flat_tables
from stratalake.schemas import BRONZE, SILVER
from stratalake.sources.readers import conform_bronze, scan_bronze_json


def credit(key, name="N", **more):
    return {"artist": {"id": key, "name": name, **more}}


def release(key, **more):
    return {"id": key, **more}


ODD = [
    envelope("empty", []),
    {"artist_search": "no data", "extracted_at": "2024-01-01T00:00:00+00:00"},
    {"artist_search": "null data", "extracted_at": "2024-01-01T00:00:00+00:00", "data": None},
    {"artist_search": "no recordings", "extracted_at": "2024-01-01T00:00:00+00:00", "data": {}},
    envelope("bare", [{"id": "r1", "title": "only a song"}]),
    envelope("null ids", [{"id": None, "artist-credit": [credit(None)], "releases": [release(None)]}]),
    envelope(
        "rich",
        [
            {
                "id": "r2",
                "length": 200000,
                "score": 99,
                "first-release-date": "2001-05",
                "artist-credit": [credit("a1", **{"sort-name": "S"}), credit("a2", "featured")],
                "releases": [
                    release("l1", title="T", date="2001", country="GB", status="Official", **{"track-count": 9}),
                    release("l2", date="2001-00-00"),
                    release("l3", date=""),
                ],
            },
            {"id": "r3", "artist-credit": [], "releases": []},
        ],
    ),
]


def test_odd_envelopes(spark, write_bronze):
    bronze = scan_bronze_json(spark, write_bronze(ODD))
    assert bronze.count() == len(ODD)

    songs = silver.transform_songs(bronze)
    assert songs.schema.simpleString() == SILVER["songs"].simpleString()
    assert {r["recording_id"]: r["first_release_date"] for r in songs.collect()} == {
        "r1": None,
        "r2": date(2001, 5, 1),
        "r3": None,
    }
    assert songs.filter("video is not null").count() == 0  # absent everywhere: column there, null

    artists = {r["artist_id"]: r for r in silver.transform_artists(bronze).collect()}
    assert set(artists) == {"a1", "a2"}
    assert artists["a1"]["artist_sort_name"] == "S"
    assert artists["a1"]["artist_disambiguation"] is None
    assert artists["a2"]["artist_url"] == f"{ARTIST_URL_PREFIX}a2"

    albums = {r["album_id"]: r for r in silver.transform_albums(bronze).collect()}
    assert {k: r["release_date"] for k, r in albums.items()} == {"l1": date(2001, 1, 1), "l2": None, "l3": None}
    assert albums["l1"]["track_count"] == 9
    assert albums["l1"]["album_url"] == f"{RELEASE_URL_PREFIX}l1"


def test_columns_come_in_table_order(spark, write_bronze):
    bronze = scan_bronze_json(spark, write_bronze(ODD))
    for table, make in silver.TRANSFORMS.items():
        assert make(bronze).columns == SILVER[table].fieldNames()


def test_padded_rows_never_reach_silver(spark, write_bronze):
    """Outer unnesting plus the key filter gives the rows of inner unnesting plus the key filter."""
    bronze = scan_bronze_json(spark, write_bronze(ODD))
    for table, key in (("artists", "artist_id"), ("albums", "album_id"), ("songs", "recording_id")):
        outer = silver.FLAT_ROWS[table](bronze, keep_empty=True).filter(F.col(key).isNotNull())
        assert rows(outer) == rows(silver.keyed_rows(bronze, table))


def test_earliest_extraction_then_search_then_position_wins(spark, write_bronze):
    def found(search, at, *countries):
        return envelope(search, [{"id": "r", "releases": [release("x", country=k) for k in countries]}], at)

    late, early = "2024-01-02T00:00:00+00:00", "2024-01-01T23:00:00"
    path = write_bronze([found("a", late, "US"), found("c", early, "FR"), found("b", early, "GB", "DE")])
    album = silver.transform_albums(scan_bronze_json(spark, path)).collect()
    assert [(r["artist_search"], r["country"]) for r in album] == [("b", "GB")]


def test_file_order_and_reruns_do_not_matter(spark, folder):
    import json
    import os

    rng = random.Random(7)
    envelopes = [
        envelope(
            rng.choice("abc"),
            [
                {
                    "id": f"r{rng.randrange(5)}",
                    "title": f"t{i}",
                    "releases": [release(f"l{rng.randrange(4)}", title=f"t{i}", country=rng.choice(["GB", None]))],
                    "artist-credit": [credit(f"a{rng.randrange(4)}", f"n{i}")],
                }
            ],
            f"2024-01-0{rng.randrange(1, 4)}T00:00:00+00:00",
        )
        for i in range(60)
    ]
    results = []
    for attempt in range(3):
        rng.shuffle(envelopes)
        path = f"{folder}/{attempt}"
        os.makedirs(path)
        for n, part in enumerate(itertools.batched(envelopes, 7 + attempt * 5)):
            with open(f"{path}/{n}.json", "w") as out:
                out.write("\n".join(json.dumps(e) for e in part))
        bronze = scan_bronze_json(spark, path)
        results.append({t: rows(make(bronze)) for t, make in silver.TRANSFORMS.items()})
        for table, make in silver.TRANSFORMS.items():
            key = SILVER[table].fieldNames()[0]
            assert make(bronze).select(key).distinct().count() == make(bronze).count()
    assert results[0] == results[1] == results[2]


def test_flat_export_keeps_one_row_without_key(spark, write_bronze):
    path = write_bronze(
        [
            envelope("s", [{"id": None, "title": "first"}, {"id": None, "title": "second"}, {"id": "r"}]),
            envelope("s", [{"artist-credit": [credit("", type="Person", country="GB"), credit(None)]}]),
        ]
    )
    tables = flat_tables(scan_bronze_json(spark, path))
    songs = {r["recording_id"]: r["title"] for r in tables["song"].collect()}
    assert set(songs) == {None, "r"}
    artists = {r["artist_id"]: r for r in tables["artist"].collect()}
    assert set(artists) == {"", None}
    assert artists[""]["artist_url"] is None and artists[""]["artist_type"] == "Person"


def test_inferred_schemas_are_conformed(spark, write_bronze):
    path = write_bronze([envelope("s", [{"id": "r", "tags": ["x"], "releases": [{"id": "l", "date": "2001"}]}])])
    bronze = conform_bronze(spark.read.json(path))
    assert bronze.schema == BRONZE
    for make in silver.TRANSFORMS.values():
        assert rows(make(bronze)) == rows(make(scan_bronze_json(spark, path)))


def by_hand(envelopes, table):
    """The table's rows from plain loops over the documents."""
    leaves = {
        "artists": ["id", "name", "sort-name", "disambiguation"],
        "albums": ["id", "title", "date", "country", "status", "track-count"],
        "songs": ["id", "title", "length", "video", "score", "first-release-date"],
    }[table]
    best = {}
    for e in envelopes:
        at = e["extracted_at"].removesuffix("+00:00")
        for r, recording in enumerate((e.get("data") or {}).get("recordings") or []):
            found = {
                "artists": [x.get("artist") or {} for x in recording.get("artist-credit") or []],
                "albums": recording.get("releases") or [],
                "songs": [recording],
            }[table]
            for i, item in enumerate(found):
                if item.get("id") is None:
                    continue
                values = [item.get(leaf) for leaf in leaves]
                rank = [at, e["artist_search"], r, i, *values[1:]]
                rank = [(x is not None, x) for x in rank]
                if item["id"] not in best or rank < best[item["id"]][0]:
                    best[item["id"]] = (rank, values, e["artist_search"])
    return sorted(((*values, search) for _, values, search in best.values()), key=repr)


def test_tables_equal_plain_loops_on_random_documents(spark, write_bronze):
    rng = random.Random(11)

    def maybe(value, chance=0.7):
        return value if rng.random() < chance else None

    def some(make, most):
        kind = rng.random()
        return None if kind < 0.1 else [make() for _ in range(rng.randrange(most))]

    def drop_nulls(item):
        return {k: x for k, x in item.items() if x is not None or rng.random() < 0.5}

    def a_release():
        return drop_nulls(
            {
                "id": maybe(f"l{rng.randrange(25)}", 0.9),
                "title": maybe(rng.choice("xyz")),
                "country": maybe(rng.choice(["GB", "US"])),
                "track-count": maybe(rng.randrange(5)),
            }
        )

    def a_credit():
        artist = drop_nulls({"id": maybe(f"a{rng.randrange(15)}", 0.9), "name": maybe(rng.choice("xyz"))})
        return {"artist": maybe(artist, 0.95)}

    def a_recording():
        return drop_nulls(
            {
                "id": maybe(f"r{rng.randrange(30)}", 0.9),
                "title": maybe(rng.choice("xyz")),
                "length": maybe(rng.randrange(9)),
                "video": maybe(rng.random() < 0.5),
                "score": maybe(rng.randrange(4)),
                "artist-credit": some(a_credit, 3),
                "releases": some(a_release, 4),
            }
        )

    envelopes = [
        envelope(rng.choice("abc"), some(a_recording, 6), f"2024-01-01T00:00:0{rng.randrange(6)}+00:00")
        for _ in range(300)
    ]
    bronze = scan_bronze_json(spark, write_bronze(envelopes))
    for table, make in silver.TRANSFORMS.items():
        merged = silver.merge_rows(silver.keyed_rows(bronze, table), table)
        columns = [c for c in merged.columns if c not in (*silver.POSITIONS, "extracted_at")]
        assert rows(merged.select(*columns)) == by_hand(envelopes, table)
        assert make(bronze).count() == merged.count()


def test_numbers_in_any_json_form_survive(spark, write_bronze):
    forms = [("180000", 180000), ('"180000"', 180000), ("180000.0", 180000), ("1.8E5", 180000), ('"9007199254740993"', 2**53 + 1),
             ("12.5", 12), ("-7", -7), ('"x"', None), ("null", None), ('"9223372036854775808"', None)]
    lines = [
        f'{{"artist_search":"s","data":{{"recordings":[{{"id":"{i}","length":{text},"score":{text},"video":"true"}}]}}}}'
        for i, (text, _) in enumerate(forms)
    ]
    songs = {r["recording_id"]: r for r in silver.transform_songs(scan_bronze_json(spark, write_bronze("\n".join(lines)))).collect()}
    assert [songs[str(i)]["length_ms"] for i in range(len(forms))] == [n for _, n in forms]
    assert songs["0"]["score"] == 180000 and songs["4"]["score"] is None and songs["0"]["video"] is True


def test_a_row_with_an_unreadable_time_loses(spark, write_bronze):
    landing = write_bronze([envelope("s", [{"id": "1", "title": "no time"}], "soon"), envelope("s", [{"id": "1", "title": "dated"}])])
    assert [r["title"] for r in silver.transform_songs(scan_bronze_json(spark, landing)).collect()] == ["dated"]
