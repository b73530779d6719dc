"""The registered queries' answers as SQL over the flat test tables: no JSON, no arrays, no explode."""

from __future__ import annotations

from stratalake import fixed_values as v
from stratalake.registry.bronze_from_tables import FIRST_EXTRACTION, ORDERS_PER_SECOND

RUN_EPOCH = 1706745600  # 2024-02-01 00:00:00 UTC, the run time handed to the jobs


def raw_date(selector: str, ts: str) -> str:
    return (
        f"CASE ({selector}) % 6 WHEN 0 THEN strftime({ts}, '%Y') WHEN 1 THEN strftime({ts}, '%Y-%m') "
        f"WHEN 2 THEN strftime({ts}, '%Y-%m-%d') WHEN 3 THEN '' WHEN 4 THEN strftime({ts}, '%Y-00-00') END"
    )


def clean_date(selector: str, ts: str) -> str:
    return (
        f"CAST(CAST(CASE ({selector}) % 6 WHEN 0 THEN date_trunc('year', {ts}) "
        f"WHEN 1 THEN date_trunc('month', {ts}) WHEN 2 THEN date_trunc('day', {ts}) END AS DATE) AS VARCHAR)"
    )


def half_up(value: str, digits: int) -> str:
    """Decimal half-up, as Spark rounds doubles; the small term puts binary near-ties on the upper side."""
    return f"floor(({value}) * 1e{digits} + 0.5 + 1e-9) / 1e{digits}"


CTES = f"""
WITH base AS (
  SELECT o.*, l.*, c_name, c_mktsegment, c_nationkey, n_name AS artist_search,
         CAST({FIRST_EXTRACTION} + o_orderkey // {ORDERS_PER_SECOND} AS BIGINT) AS extracted_at,
         CAST(coalesce(l_linenumber, 0) AS INT) AS item
  FROM orders o
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN lineitem l ON l_orderkey = o_orderkey),
recording AS (
  SELECT *, 0 AS recording_pos, 'order' AS kind,
         CASE WHEN o_orderkey % 97 <> 5 THEN 'rec-' || o_orderkey END AS recording_id,
         o_orderpriority AS title,
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS length_ms,
         CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 2 = 0 END AS video,
         CAST((o_orderkey + item) % 101 AS INT) AS score,
         {raw_date("o_orderkey", "o_orderdate")} AS first_release_date_raw,
         {clean_date("o_orderkey", "o_orderdate")} AS first_release_date
  FROM base WHERE item > 0 OR o_orderkey % 4 = 3
  UNION ALL
  SELECT *, 1, 'part', 'trk-' || l_partkey, 'Track ' || l_partkey, CAST(floor(l_extendedprice) AS BIGINT),
         CAST(NULL AS BOOLEAN), item, {raw_date("1", "l_shipdate")}, {clean_date("1", "l_shipdate")}
  FROM base WHERE item > 0 AND item % 2 = 0),
credit AS (
  SELECT artist_search, extracted_at, recording_pos, 0 AS item_pos,
         CASE WHEN o_orderkey % 89 <> 7 THEN 'art-' || o_custkey END AS artist_id,
         c_name AS artist_name, upper(c_name) AS artist_sort_name, c_mktsegment AS artist_disambiguation,
         o_orderstatus AS artist_type,
         CASE WHEN o_custkey % 4 <> 0 THEN 'C' || c_nationkey END AS artist_country
  FROM recording WHERE kind = 'order' AND o_orderkey % 83 <> 3
  UNION ALL
  SELECT artist_search, extracted_at, recording_pos, 1, 'feat-' || (o_orderkey % 50),
         'Feat ' || (o_orderkey % 50), NULL, NULL, 'guest', NULL
  FROM recording WHERE kind = 'order' AND o_orderkey % 83 <> 3 AND o_orderkey % 5 = 0
  UNION ALL
  SELECT artist_search, extracted_at, recording_pos, 0, 'sup-' || l_suppkey, 'Supplier ' || l_suppkey,
         NULL, NULL, NULL, l_returnflag
  FROM recording WHERE kind = 'part'),
release AS (
  SELECT artist_search, extracted_at, recording_pos, 0 AS item_pos, recording_id,
         CASE WHEN l_partkey % 71 <> 3 THEN 'rel-' || l_partkey END AS album_id,
         'T' || l_partkey AS album_name,
         {raw_date("item + 5", "l_shipdate")} AS release_date_raw,
         {clean_date("item + 5", "l_shipdate")} AS release_date,
         CASE WHEN item <> 3 THEN l_returnflag END AS country,
         l_linestatus AS status, CAST(l_quantity AS INT) AS track_count
  FROM recording WHERE kind = 'order' AND item > 0
  UNION ALL
  SELECT artist_search, extracted_at, recording_pos, 1, recording_id, 'rel-s' || l_suppkey, 'S' || l_suppkey,
         {raw_date("0", "o_orderdate")}, {clean_date("0", "o_orderdate")}, l_linestatus,
         CAST(NULL AS VARCHAR), CAST(NULL AS INT)
  FROM recording WHERE kind = 'order' AND item > 0 AND item % 3 = 0),
first_artist AS (
  SELECT *, '{v.ARTIST_URL_PREFIX}' || artist_id AS artist_url FROM credit
  QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY extracted_at NULLS LAST, artist_search, recording_pos,
    item_pos, artist_name NULLS FIRST, artist_sort_name NULLS FIRST, artist_disambiguation NULLS FIRST) = 1),
first_artist_wide AS (
  SELECT *, '{v.ARTIST_URL_PREFIX}' || artist_id AS artist_url FROM credit
  QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY extracted_at NULLS LAST, artist_search, recording_pos,
    item_pos, artist_name NULLS FIRST, artist_sort_name NULLS FIRST, artist_disambiguation NULLS FIRST,
    artist_type NULLS FIRST, artist_country NULLS FIRST) = 1),
first_album AS (
  SELECT *, '{v.RELEASE_URL_PREFIX}' || album_id AS album_url FROM release
  QUALIFY row_number() OVER (PARTITION BY album_id ORDER BY extracted_at NULLS LAST, artist_search, recording_pos,
    item_pos, album_name NULLS FIRST, release_date_raw NULLS FIRST, country NULLS FIRST,
    status NULLS FIRST, track_count NULLS FIRST) = 1),
first_song AS (
  SELECT * FROM recording
  QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY extracted_at NULLS LAST, artist_search, recording_pos,
    title NULLS FIRST, length_ms NULLS FIRST, video NULLS FIRST, score NULLS FIRST,
    first_release_date_raw NULLS FIRST) = 1),
artists AS (
  SELECT artist_id, artist_name, artist_sort_name, artist_disambiguation, artist_search, extracted_at,
         artist_url FROM first_artist WHERE artist_id IS NOT NULL),
albums AS (
  SELECT album_id, album_name, country, status, track_count, artist_search, extracted_at, release_date,
         album_url FROM first_album WHERE album_id IS NOT NULL),
songs AS (
  SELECT recording_id, title, length_ms, video, score, artist_search, extracted_at, first_release_date
  FROM first_song WHERE recording_id IS NOT NULL),
odd_songs AS (
  SELECT recording_id, title, length_ms, video, score, artist_search, extracted_at, first_release_date FROM (
    SELECT * FROM recording WHERE extracted_at % 2 = 1 AND recording_id IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY extracted_at NULLS LAST, artist_search, recording_pos,
      title NULLS FIRST, length_ms NULLS FIRST, video NULLS FIRST, score NULLS FIRST,
      first_release_date_raw NULLS FIRST) = 1)),
song_stats AS (
  SELECT artist_search, count(recording_id) AS total_recordings,
         {half_up("avg(length_ms) / 1000 / 60", 2)} AS avg_song_length_min,
         min(first_release_date) AS earliest_song_release, max(first_release_date) AS latest_song_release
  FROM songs GROUP BY artist_search),
album_stats AS (
  SELECT artist_search, count(album_id) AS total_albums,
         count(DISTINCT country) AS distinct_release_countries,
         min(release_date) AS earliest_album_release, max(release_date) AS latest_album_release
  FROM albums GROUP BY artist_search),
yearly AS (
  SELECT CAST(substr(release_date, 1, 4) AS INT) AS release_year,
         coalesce(country, '{v.UNKNOWN_COUNTRY}') AS country_code, count(album_id) AS total_releases,
         {half_up("avg(track_count)", 1)} AS avg_tracks_per_album,
         count(DISTINCT artist_search) AS distinct_artists
  FROM albums WHERE release_date IS NOT NULL GROUP BY 1, 2),
envelope AS (
  SELECT artist_search, extracted_at,
         CAST(CASE WHEN item > 0 THEN 1 + CAST(item % 2 = 0 AS INT) WHEN o_orderkey % 4 = 3 THEN 1
                   WHEN o_orderkey % 4 = 2 THEN 0 END AS INT) AS recordings
  FROM base)
"""

ENVELOPES = "SELECT artist_search, extracted_at, recordings FROM envelope"
SUMMARY = (
    "SELECT a.*, s.* EXCLUDE (artist_search), b.* EXCLUDE (artist_search) FROM artists a "
    "LEFT JOIN song_stats s ON s.artist_search = a.artist_search "
    "LEFT JOIN album_stats b ON b.artist_search = a.artist_search"
)


def _nulls(stage: str, table: str, source: str, columns: str, **instead: str) -> str:
    """UNION ALL of null counts, one row per column."""
    lead = f"'{stage}' AS stage, " if stage else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{table}' AS \"table\", '{c}' AS \"column\", "
        f"CAST(count(*) FILTER (WHERE {instead.get(c, c)} IS NULL) AS BIGINT) AS null_count FROM {source}"
        for c in columns.split()
    )


_ALBUM = "album_id album_name release_date country status track_count album_url artist_search extracted_at"
_ARTIST = (
    "artist_id artist_name artist_sort_name artist_disambiguation artist_type artist_country artist_url "
    "artist_search extracted_at"
)
_SONG = "recording_id title length_ms video score first_release_date artist_search extracted_at"
_SILVER = {
    "artists": "artist_id artist_name artist_sort_name artist_disambiguation artist_search extracted_at artist_url",
    "albums": "album_id album_name country status track_count artist_search extracted_at release_date album_url",
    "songs": "recording_id title length_ms video score artist_search extracted_at first_release_date",
}
_DTYPES = {
    "track_count": "int",
    "score": "int",
    "length_ms": "bigint",
    "video": "boolean",
    "extracted_at": "timestamp",
    "release_date": "date",
    "first_release_date": "date",
}


def _cols(columns: str) -> str:
    return ", ".join(columns.split())


def _rows(source: str, columns: str) -> str:
    return f"SELECT {_cols(columns)} FROM {source}"


_NO_RECORDING = "FROM envelope WHERE coalesce(recordings, 0) = 0"

_FLAT_CREDIT = f"{_SILVER['artists']}".replace(" artist_url", " recording_pos item_pos")
_FLAT_RELEASE = (
    "album_id album_name release_date_raw country status track_count artist_search extracted_at recording_pos item_pos"
)
_FLAT_SONG = (
    "recording_id title length_ms video score first_release_date_raw artist_search extracted_at recording_pos"
)

# Queries over the nested envelopes and what is built from them.
NESTED = {
    "scan_bronze_json": ENVELOPES,
    "scan_array_splits": ENVELOPES,
    "scan_latest_batch": ENVELOPES + " WHERE extracted_at % 2 = 1",
    "stream_bronze_ingest": ENVELOPES,
    "ingest_contents": ENVELOPES,
    "archive_processed": "SELECT *, CASE extracted_at % 2 WHEN 0 THEN 'archived' ELSE 'pending' END AS place FROM envelope",
    "scan_latest_file": ENVELOPES + " WHERE extracted_at % 8 = 7",
    "newest_file_top1": "SELECT '20240201_000000' AS batch_id",
    "count_unreadable": "SELECT o_orderkey, count(*) OVER () AS reported FROM orders WHERE o_orderkey % 10 = 0",
    "land_bronze": "SELECT artist_search, CAST(%d AS BIGINT) AS extracted_at, recordings FROM envelope" % RUN_EPOCH,
    "union_searches": ENVELOPES,
    "scan_silver_parquet": "SELECT * FROM albums",
    "write_parquet_overwrite": "SELECT * FROM songs",
    "write_csv_export": "SELECT * FROM albums",
    "write_with_count": "SELECT 'artists' AS \"table\", count(*) AS row_count FROM artists UNION ALL "
    "SELECT 'albums', count(*) FROM albums UNION ALL SELECT 'songs', count(*) FROM songs",
    "register_tables": "SELECT country, status, count(*) AS albums_found, CAST(sum(track_count) AS BIGINT) AS tracks "
    "FROM albums GROUP BY country, status",
    "explode_recordings": "SELECT artist_search, extracted_at, recording_pos, recording_id, title FROM recording "
    f"UNION ALL SELECT artist_search, extracted_at, NULL, NULL, NULL {_NO_RECORDING}",
    "explode_artist_credits": "SELECT artist_search, extracted_at, recording_pos, item_pos, artist_id, artist_name FROM credit "
    "UNION ALL SELECT artist_search, extracted_at, recording_pos, NULL, NULL, NULL FROM recording "
    "WHERE kind = 'order' AND o_orderkey % 83 = 3 "
    f"UNION ALL SELECT artist_search, extracted_at, NULL, NULL, NULL, NULL {_NO_RECORDING}",
    "explode_releases": "SELECT artist_search, extracted_at, recording_pos, item_pos, album_id, album_name FROM release "
    "UNION ALL SELECT artist_search, extracted_at, recording_pos, NULL, NULL, NULL FROM recording "
    "WHERE kind = 'part' OR item = 0 "
    f"UNION ALL SELECT artist_search, extracted_at, NULL, NULL, NULL, NULL {_NO_RECORDING}",
    "flatten_inner": "SELECT artist_search, extracted_at, recording_pos, item_pos, album_id, album_name FROM release",
    "nested_get_default": "SELECT artist_search, extracted_at, coalesce(recordings, 0) AS recordings FROM envelope",
    "project_artist_fields": _rows("credit", _FLAT_CREDIT),
    "project_album_fields": _rows("release", _FLAT_RELEASE),
    "project_song_fields": _rows("recording", _FLAT_SONG),
    "project_artist_fields_wide": _rows(
        "credit",
        "artist_id artist_name artist_sort_name artist_disambiguation artist_type artist_country artist_search extracted_at",
    ),
    "carry_lineage": _rows("recording", "artist_search extracted_at recording_id"),
    "derive_and_drop": _rows("release", "album_id album_name country release_date"),
    "filter_key_not_null": _rows("credit", _FLAT_CREDIT) + " WHERE artist_id IS NOT NULL",
    "filter_year_not_null": "SELECT CAST(substr(release_date, 1, 4) AS INT) AS release_year, "
    f"coalesce(country, '{v.UNKNOWN_COUNTRY}') AS country_code, album_id, track_count, artist_search "
    "FROM albums WHERE release_date IS NOT NULL",
    "first_element": "SELECT artist_search, extracted_at, "
    "CASE WHEN item > 0 OR o_orderkey % 4 = 3 THEN o_orderpriority END AS first_title, "
    "CASE WHEN item > 0 THEN 'T' || l_partkey END AS first_release_title FROM base",
    "filter_target_searches": "SELECT s.* FROM songs s WHERE artist_search IN (SELECT n_name FROM nation "
    "JOIN region ON r_regionkey = n_regionkey WHERE r_regionkey <= 1)",
    "rename_columns": "SELECT artist_id AS id, artist_name AS name, artist_sort_name AS sort_name, "
    "artist_disambiguation AS disambiguation, artist_type AS type, artist_country AS country FROM credit",
    "fill_false_bool": "SELECT recording_id, score, coalesce(video, false) AS video FROM recording",
    "audit_created_at": f"SELECT album_id, CAST({RUN_EPOCH} AS BIGINT) AS created_at FROM albums",
    "dedup_any": "SELECT DISTINCT album_id FROM release",
    "dedup_keep_first": _rows("first_artist_wide", _ARTIST.replace("artist_url ", "")),
    "song_stats": "SELECT * FROM song_stats",
    "album_stats": "SELECT * FROM album_stats",
    "yearly_country_agg": "SELECT * FROM yearly",
    "count_non_null": "SELECT artist_search, count(country) AS with_country, count(track_count) AS with_tracks, "
    "count(release_date) AS with_date FROM albums GROUP BY artist_search",
    "count_distinct": "SELECT artist_search, count(DISTINCT country) AS countries, count(DISTINCT release_date) AS dates "
    "FROM albums GROUP BY artist_search",
    "distinct_sketches": "SELECT artist_search, count(DISTINCT country) AS exact_country, count(DISTINCT album_id) AS exact_album_id, "
    "true AS near_country, true AS near_album_id FROM albums GROUP BY artist_search",
    "profile_sketches": " UNION ALL ".join(
        f"SELECT 'albums' AS \"table\", '{column}' AS \"column\", count(*) AS row_count, CAST(count(*) FILTER (WHERE {column} IS NULL) AS BIGINT) AS null_count, "
        + (f"(SELECT max(n) FROM (SELECT count(*) AS n FROM albums GROUP BY {column}))" if column in ("status", "country") else "CAST(NULL AS BIGINT)")
        + " AS most, true AS median_is_near FROM albums"
        for column in ("album_id", "country", "status", "track_count")
    ),
    "avg_ignore_null": f"SELECT artist_search, {half_up('avg(track_count)', 4)} AS avg_tracks FROM albums GROUP BY artist_search",
    "min_max_date": "SELECT artist_search, min(first_release_date) AS earliest, max(first_release_date) AS latest "
    "FROM songs GROUP BY artist_search",
    "table_count": "SELECT 'artists' AS \"table\", count(*) AS row_count FROM artists UNION ALL "
    "SELECT 'albums', count(*) FROM albums UNION ALL SELECT 'songs', count(*) FROM songs UNION ALL "
    "SELECT 'bronze', count(*) FROM envelope",
    "null_profile": " UNION ALL ".join(_nulls("", t, t, cols) for t, cols in _SILVER.items()),
    "shape_dtypes_profile": " UNION ALL ".join(
        f"SELECT stage AS \"table\", d.\"column\", d.dtype, n AS row_count, CAST({len(columns.split())} AS BIGINT) AS column_count FROM (VALUES "
        + ", ".join(f"('{c}', '{_DTYPES.get(c, 'string')}')" for c in columns.split())
        + f") d(\"column\", dtype), (SELECT '{t}' AS stage, count(*) AS n FROM {t} UNION ALL "
        f"SELECT '{t} with duplicates', count(*) FROM {source} WHERE {columns.split()[0]} IS NOT NULL) c"
        for (t, columns), source in zip(_SILVER.items(), ("credit", "release", "recording"))
    ),
    "left_join_song_stats": "SELECT a.artist_id, a.artist_search, s.* EXCLUDE (artist_search) FROM artists a "
    "LEFT JOIN song_stats s ON s.artist_search = a.artist_search",
    "left_join_album_stats": "SELECT a.artist_id, a.artist_search, b.* EXCLUDE (artist_search) FROM artists a "
    "LEFT JOIN album_stats b ON b.artist_search = a.artist_search",
    "order_by_year_releases": "SELECT * FROM yearly ORDER BY release_year DESC, total_releases DESC, country_code",
    "preview_head": " UNION ALL ".join(
        f"(SELECT '{t}' AS \"table\", {columns.split()[0]} AS id, artist_search, extracted_at FROM {t} ORDER BY id LIMIT 5)"
        for t, columns in _SILVER.items()
    ),
    "top_n_per_search": "SELECT * FROM songs QUALIFY row_number() OVER (PARTITION BY artist_search "
    f"ORDER BY score DESC, recording_id) <= {v.RECORDINGS_PER_SEARCH}",
    "stream_dedup_watermark": "SELECT DISTINCT recording_id FROM recording WHERE recording_id IS NOT NULL AND extracted_at % 2 = 0 "
    "UNION ALL SELECT 'nat-' || n_nationkey FROM nation",
    "stream_earliest": "SELECT * FROM songs",
    "incremental_upsert": "SELECT * FROM songs",
    # The songs of the later half alone go where the earlier half has an earlier row; the others come.
    "point_lookup": "SELECT t AS \"table\", s.* FROM songs s, (VALUES ('batch'), ('incremental'), ('ranges')) v(t) WHERE recording_id IN "
    "(SELECT 'rec-' || o_orderkey FROM orders WHERE o_orderkey % 100 = 0)",
    "change_feed": "SELECT -1::BIGINT AS sign, o.* FROM odd_songs o JOIN songs s USING (recording_id) WHERE s.extracted_at % 2 = 0 "
    "UNION ALL SELECT 1::BIGINT AS sign, s.* FROM songs s WHERE extracted_at % 2 = 0",
    "transform_artists": "SELECT * FROM artists",
    "transform_albums": "SELECT * FROM albums",
    "transform_songs": "SELECT * FROM songs",
    "build_artist_summary": SUMMARY.replace("b.* EXCLUDE (artist_search)", f"b.* EXCLUDE (artist_search), CAST({RUN_EPOCH} AS BIGINT) AS created_at"),
    "build_yearly_release_metrics": f"SELECT *, CAST({RUN_EPOCH} AS BIGINT) AS created_at FROM yearly",
    "run_bronze_to_silver": " UNION ALL BY NAME ".join(f"SELECT '{t}' AS \"table\", * FROM {t}" for t in ("artists", "albums", "songs")),
    "run_silver_to_gold": f"SELECT 'artist_summary' AS \"table\", CAST({RUN_EPOCH} AS BIGINT) AS created_at, * FROM ({SUMMARY}) "
    f"UNION ALL BY NAME SELECT 'yearly_release_metrics' AS \"table\", CAST({RUN_EPOCH} AS BIGINT) AS created_at, * FROM yearly",
    "incremental_gold": f"SELECT 'artist_summary' AS \"table\", CAST({RUN_EPOCH} AS BIGINT) AS created_at, * FROM ({SUMMARY}) "
    f"UNION ALL BY NAME SELECT 'yearly_release_metrics' AS \"table\", CAST({RUN_EPOCH} AS BIGINT) AS created_at, * FROM yearly",
    "legacy_flat_export": " UNION ALL BY NAME ".join(
        f"SELECT '{name}' AS \"table\", "
        + ", ".join(c if c == "extracted_at" else f"CAST({c} AS VARCHAR) AS {c}" for c in columns.split())
        + f" FROM {source}"
        for name, columns, source in [
            ("album", _ALBUM, "first_album"),
            ("artist", _ARTIST, "first_artist_wide"),
            ("song", _SONG, "first_song"),
        ]
    ),
    "clean_and_profile": " UNION ALL ".join(
        [
            _nulls("before", "album", "first_album", _ALBUM, release_date="release_date_raw"),
            _nulls("before", "artist", "first_artist_wide", _ARTIST),
            _nulls("before", "song", "first_song", _SONG, first_release_date="first_release_date_raw"),
            _nulls("after", "album", "first_album", _ALBUM),
            _nulls("after", "artist", "first_artist_wide", _ARTIST),
            _nulls("after", "song", "first_song", _SONG, video="coalesce(video, false)"),
        ]
    ),
    "dq_null_check": " UNION ALL ".join(
        f"SELECT 'release rows' AS \"table\", 'not_null' AS rule, '{c}' AS \"column\", "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM release"
        for c in ["album_id", "country", "status", "track_count"]
    ),
    "dq_unique_check": "SELECT 'release rows' AS \"table\", 'unique' AS rule, 'album_id' AS \"column\", "
    "CAST(count(album_id) - count(DISTINCT album_id) AS BIGINT) AS violations FROM release UNION ALL "
    "SELECT 'albums', 'unique', 'album_id', CAST(count(album_id) - count(DISTINCT album_id) AS BIGINT) FROM albums",
    "dq_date_check": "SELECT 'release rows' AS \"table\", 'valid_date' AS rule, 'release_date_raw' AS \"column\", "
    "CAST(count(*) FILTER (WHERE release_date_raw IS NOT NULL AND release_date IS NULL) AS BIGINT) AS violations "
    "FROM release UNION ALL SELECT 'recording rows', 'valid_date', 'first_release_date_raw', "
    "CAST(count(*) FILTER (WHERE first_release_date_raw IS NOT NULL AND first_release_date IS NULL) AS BIGINT) FROM recording",
    "dq_schema_check": " UNION ALL ".join(
        [
            f"SELECT 'albums' AS \"table\", 'schema' AS rule, '{c}' AS \"column\", CAST(0 AS BIGINT) AS violations"
            for c in _SILVER["albums"].split()
        ]
        + [
            f"SELECT 'release rows', 'schema', '{c}', "
            + ("CAST(count(*) AS BIGINT) FROM release" if c in ("release_date", "album_url") else "CAST(0 AS BIGINT)")
            for c in _SILVER["albums"].split()
        ]
    ),
    "inspect_schema": "SELECT p.path, p.type, true AS nullable, n AS record_count FROM (VALUES "
    "('artist_search', 'string'), ('extracted_at', 'string'), ('data', 'struct'), "
    "('data.recordings', 'array'), ('data.recordings[]', 'struct'), ('data.recordings[].id', 'string'), "
    "('data.recordings[].title', 'string'), ('data.recordings[].length', 'string'), "
    "('data.recordings[].video', 'string'), ('data.recordings[].score', 'string'), "
    "('data.recordings[].first-release-date', 'string'), ('data.recordings[].artist-credit', 'array'), "
    "('data.recordings[].artist-credit[]', 'struct'), ('data.recordings[].artist-credit[].artist', 'struct'), "
    "('data.recordings[].artist-credit[].artist.id', 'string'), "
    "('data.recordings[].artist-credit[].artist.name', 'string'), "
    "('data.recordings[].artist-credit[].artist.sort-name', 'string'), "
    "('data.recordings[].artist-credit[].artist.disambiguation', 'string'), "
    "('data.recordings[].artist-credit[].artist.type', 'string'), "
    "('data.recordings[].artist-credit[].artist.country', 'string'), "
    "('data.recordings[].releases', 'array'), ('data.recordings[].releases[]', 'struct'), "
    "('data.recordings[].releases[].id', 'string'), ('data.recordings[].releases[].title', 'string'), "
    "('data.recordings[].releases[].date', 'string'), ('data.recordings[].releases[].country', 'string'), "
    "('data.recordings[].releases[].status', 'string'), ('data.recordings[].releases[].track-count', 'string')"
    ") p(path, type), (SELECT count(*) AS n FROM envelope) c",
}

# Scalar functions, checked row by row on whole flat tables.
FLAT = {
    "build_url": f"SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 1 THEN '{v.RELEASE_URL_PREFIX}' || o_orderkey END AS url FROM orders",
    "str_length": "SELECT doc_id, CAST(length(text) AS INT) AS characters FROM documents",
    "case_when": "SELECT l_orderkey, l_partkey, CASE WHEN l_quantity < 10 THEN 'single' WHEN l_quantity < 30 THEN 'short' "
    "WHEN l_returnflag = 'R' THEN 'returned' END AS size FROM lineitem",
    "normalize_partial_date": f"SELECT event_id, {raw_date('event_id', 'ts')} AS raw, {clean_date('event_id', 'ts')} AS date, "
    "CASE event_id % 6 WHEN 0 THEN 'year' WHEN 1 THEN 'month' WHEN 2 THEN 'day' END AS precision FROM events",
    "to_date_fmt": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date FROM orders",
    "to_timestamp_iso": "SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN epoch_us(ts) - 7200000000 "
    "ELSE epoch_us(ts) END AS micros FROM events",
    "coerce_datetime": "SELECT event_id, CASE event_id % 6 WHEN 2 THEN epoch_us(date_trunc('day', ts)) END AS micros FROM events",
    "cast_types": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderkey AS INT) END AS as_int, "
    "CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey END AS as_long, "
    "CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS as_bool FROM orders",
    "year_of": "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS order_year FROM orders",
    "coalesce_default": f"SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber = 3 THEN '{v.UNKNOWN_COUNTRY}' ELSE l_returnflag END AS country_code FROM lineitem",
    "round_half_up": f"SELECT l_orderkey, l_partkey, {half_up('l_quantity / 8', 2)} AS two, {half_up('l_quantity / 20', 1)} AS one FROM lineitem",
    "ms_to_minutes": "SELECT l_orderkey, l_partkey, l_extendedprice / 1000 / 60 AS minutes FROM lineitem",
    "format_batch_stamp": "SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS landing, strftime(ts, '%Y-%m-%d-%H-%M-%S') AS export FROM events",
    "format_iso_utc": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS iso FROM events",
    "replace_substring": f"SELECT page_id, replace('{v.PENDING_FOLDER}/' || url, '{v.PENDING_FOLDER}', '{v.DONE_FOLDER}') AS path, "
    "md5(replace(html, '<', '[')) AS html_md5 FROM pages",
    "schema_drift": "SELECT d.*, n AS record_count FROM (VALUES ('keys[]', 'contradicted', 'BIGINT', 'OBJECT'), "
    "('keys[].k', 'added', NULL, 'BIGINT'), ('new', 'added', NULL, 'OBJECT'), ('new.a-b', 'added', NULL, 'STRING'), "
    "('old', 'lost', 'BOOLEAN', NULL), ('price', 'widened', 'BIGINT', 'DECIMAL'), ('state', 'contradicted', 'STRING', 'BIGINT')"
    ") d(path, change, before, after), (SELECT count(*) AS n FROM orders)",
    "json_decode_encode": "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, "
    "'{\"k\":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS encoded FROM events",
}


def all_sql() -> dict[str, str]:
    return {**{name: CTES + sql for name, sql in NESTED.items()}, **FLAT}
