"""One query per operator. Each takes (spark, sf_dir) and reads whole tables, or what Spark derives from them."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake import fixed_values as v
from stratalake.functions import dates as d
from stratalake.functions import values as f
from stratalake.operators import aggregates, filters, generators, joins, ordering, profile, quality, sketches
from stratalake.operators import projections as p
from stratalake.operators.dedup import keep_any, keep_first
from stratalake.operators.unions import union_searches
from stratalake.plans import clean_profile, flat_export, gold, jobs, silver
from stratalake.registry.stage import Layers, comparable, layers
from stratalake.operators.generators import LINEAGE
from stratalake.schemas import BRONZE, GOLD, SILVER, SILVER_KEYS
from stratalake.session import drop_work_dir, work_dir
from stratalake.sources import catalog, drift, lookup, readers, writers
from stratalake.streaming import changefeed, contents, earliest, ingest, upsert
from stratalake.streaming import gold as gold_deltas
from stratalake.streaming import lookup as silver_lookup

RUN_TS = datetime(2024, 2, 1, tzinfo=timezone.utc)
EARLIER_RUN_TS = datetime(2024, 1, 31, tzinfo=timezone.utc)
ENVELOPES_PER_FILE_BITS = 10  # multi-line files of at most 1,024 envelopes, each made from one row: about 1 MB
# Files of staged bronze, of at most 50,000 envelopes each, whose text lies on disk uncompressed at once: about 10 GB.
ARRAY_SHARE = 360

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

c = F.col


def query(build: Callable[[Layers], DataFrame]) -> Callable[[Layers], DataFrame]:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(layers(spark, sf_dir)))

    REGISTRY[build.__name__] = run
    return build


def table(at: Layers, name: str) -> DataFrame:
    return at.spark.read.parquet(f"{at.sf_dir}/{name}.parquet")


def sized(envelopes: DataFrame) -> DataFrame:
    """An envelope as (search, time, number of recordings)."""
    return envelopes.select(
        "artist_search",
        d.iso_timestamp(c("extracted_at")).alias("extracted_at"),
        F.array_size("data.recordings").alias("recordings"),
    )


def run_ts(ts: datetime = RUN_TS) -> Column:
    return F.lit(ts)


def half(at: Layers, odd: int) -> DataFrame:
    """The envelopes extracted in even or odd seconds: two batches that together are the whole."""
    second = F.unix_seconds(d.iso_timestamp(c("extracted_at")))
    return at.bronze().filter(second % 2 == odd)


def land_two_batches(at: Layers) -> str:
    landing = work_dir(at.spark, "landing")
    writers.land_bronze(half(at, 0), landing, run_ts(EARLIER_RUN_TS))
    writers.land_bronze(half(at, 1), landing, run_ts(RUN_TS))
    return landing


# Sources and sinks


@query
def scan_bronze_json(at: Layers) -> DataFrame:
    """Files holding one JSON array each. Neighbouring rows of a scan task share a file. An envelope of the
    derived data comes from one row of the flat tables, so a file of a thousand is small."""
    path = work_dir(at.spark, "multiline")
    writers.write_json_arrays(at.bronze(), path, per_file=1 << ENVELOPES_PER_FILE_BITS)
    return sized(readers.scan_bronze_json(at.spark, path, multi_line=True))


@query
def scan_array_splits(at: Layers) -> DataFrame:
    """All of bronze in four array files (fewer if the scan has fewer tasks), which many tasks read, each its splits. The
    text isn't compressed, so a bronze of very many files goes through in shares, each in four array files that are read
    and dropped before the next share is written; what was read of them is kept."""
    found = work_dir(at.spark, "array_envelopes")
    files = sorted(at.bronze().inputFiles())
    for begin in range(0, max(1, len(files)), ARRAY_SHARE):
        path = work_dir(at.spark, "arrays")
        share = at.spark.read.schema(BRONZE).parquet(*files[begin : begin + ARRAY_SHARE]) if files else at.bronze()
        writers.write_json_arrays(share.coalesce(4), path)
        sized(readers.scan_bronze_json(at.spark, path, multi_line=True)).write.parquet(f"{found}/share={begin}")
        drop_work_dir(at.spark, path)
    return at.spark.read.parquet(found).drop("share")


@query
def scan_silver_parquet(at: Layers) -> DataFrame:
    return at.silver("albums")


@query
def inspect_schema(at: Layers) -> DataFrame:
    """The schema as Spark infers it from all raw files, next to the record count."""
    return readers.inspect_schema(at.spark.read.json(at.bronze_json()))


@query
def schema_drift(at: Layers) -> DataFrame:
    """Two batches of records made from all orders; the second has gained, lost and changed fields."""
    key, history = c("o_orderkey"), work_dir(at.spark, "schemas")
    first = F.struct(key.alias("id"), F.floor("o_totalprice").alias("price"), c("o_orderstatus").alias("state"), F.array(key).alias("keys"), (key > 0).alias("old"))
    second = F.struct(key.alias("id"), (F.floor("o_totalprice") + F.lit(0.5).cast("decimal(2,1)")).alias("price"), key.alias("state"),
                      F.array(F.struct(key.alias("k"))).alias("keys"), F.struct(c("o_orderstatus").alias("a-b")).alias("new"))
    for batch, record in (("1", first), ("2", second)):
        found = drift.record_schema(at.spark, table(at, "orders").select(F.to_json(record).alias("text")), history, batch)
    records = at.spark.read.schema(drift.HISTORY).parquet(history).where("batch = '2'").agg(F.max("record_count")).first()[0]
    return found.withColumn("record_count", F.lit(records).cast("bigint"))


def land_eighth_last(at: Layers, single: bool = True) -> str:
    """Bronze in two runs, of which the later one is an eighth. `single`: as one file, which grows with the input, is
    written as its rows pass by, and is read in splits; else in as many as there are tasks."""
    landing = work_dir(at.spark, "landing")
    last = F.unix_seconds(d.iso_timestamp(c("extracted_at"))) % 8 == 7
    writers.land_bronze(at.bronze().filter(~last), landing, run_ts(EARLIER_RUN_TS))
    if single:
        writers.land_bronze(at.bronze().filter(last).coalesce(1), landing, run_ts(), codec="none")
    else:
        writers.land_bronze(at.bronze().filter(last), landing, run_ts())
    return landing


@query
def scan_latest_file(at: Layers) -> DataFrame:
    return sized(readers.scan_latest_file(at.spark, land_eighth_last(at)))


@query
def count_unreadable(at: Layers) -> DataFrame:
    """Landed text of which every tenth order's line is cut off: the job reports how many, and keeps them."""
    whole = F.concat(F.lit('{"artist_search":"'), c("o_orderkey").cast("string"), F.lit('","data":{"recordings":[]}}'))
    cut = F.when(c("o_orderkey") % 10 == 0, F.expr("left(value, length(value) - 5)")).otherwise(c("value"))
    landing, silver_base = work_dir(at.spark, "landing"), work_dir(at.spark, "silver")
    table(at, "orders").select("o_orderkey", whole.alias("value")).select(cut.alias("value")).write.text(landing)
    counts = jobs.run_bronze_to_silver(at.spark, landing, silver_base)
    kept = at.spark.read.schema("text string").parquet(f"{silver_base}/unreadable")
    return kept.select(F.regexp_extract("text", "[0-9]+", 0).cast("bigint").alias("o_orderkey"), F.lit(counts["unreadable"]).cast("bigint").alias("reported"))


@query
def scan_latest_batch(at: Layers) -> DataFrame:
    return sized(readers.scan_latest_batch(at.spark, land_two_batches(at)))


@query
def stream_bronze_ingest(at: Layers) -> DataFrame:
    """Two runs over a landing folder with a batch arriving in between; each file is read once."""
    landing, out, state = (work_dir(at.spark, n) for n in ("landing", "ingested", "state"))
    for odd, ts in ((0, EARLIER_RUN_TS), (1, RUN_TS)):
        writers.land_bronze(half(at, odd), landing, run_ts(ts))
        ingest.ingest_bronze(at.spark, landing, out, state)
    drop_work_dir(at.spark, landing)
    return sized(at.spark.read.schema(BRONZE).parquet(out))


@query
def ingest_contents(at: Layers) -> DataFrame:
    """Three runs: half of bronze; the same files under other names, beside the other half; the first run's files once
    more, under a third name. Each content is taken once."""
    folders = ("landing", "ingested", "state", "manifest")
    landing, out, state, manifest = (work_dir(at.spark, n) for n in folders)
    other_names = datetime(2024, 1, 30, tzinfo=timezone.utc), datetime(2024, 1, 29, tzinfo=timezone.utc)
    for batch in ([(0, EARLIER_RUN_TS)], [(0, other_names[0]), (1, RUN_TS)], [(0, other_names[1])]):
        for odd, ts in batch:
            writers.land_bronze(half(at, odd), landing, run_ts(ts))
        contents.ingest_contents(at.spark, landing, out, state, manifest)
    drop_work_dir(at.spark, landing)
    return sized(at.spark.read.schema(BRONZE).parquet(out))


@query
def archive_processed(at: Layers) -> DataFrame:
    """Two ingestion runs with archiving on: where each envelope's file lies afterwards. The second run moves
    the first run's files."""
    landing, out, state, done = (work_dir(at.spark, n) for n in ("landing", "ingested", "state", "done"))
    cleaners = "spark.sql.streaming.fileSource.cleaner.numThreads"
    before = at.spark.conf.get(cleaners)
    at.spark.conf.set(cleaners, "0")  # move files within the run, not beside it
    try:
        for odd, ts in ((0, EARLIER_RUN_TS), (1, RUN_TS)):
            writers.land_bronze(half(at, odd), landing, run_ts(ts))
            ingest.ingest_bronze(at.spark, landing, out, state, archive_dir=done)
    finally:
        at.spark.conf.set(cleaners, before)
    reader = at.spark.read.schema(BRONZE).option("recursiveFileLookup", "true")
    places = {"pending": reader.json(landing), "archived": reader.json(done)}
    return profile.stack_profiles([sized(df).withColumn("place", F.lit(p)) for p, df in places.items()])


@query
def land_bronze(at: Layers) -> DataFrame:
    payloads = at.bronze().select("artist_search", f.encode_json(c("data")).alias("payload"))
    path = work_dir(at.spark, "landing")
    writers.land_bronze(writers.make_envelopes(payloads, run_ts()), path, run_ts())
    return sized(readers.scan_bronze_json(at.spark, path))


@query
def write_parquet_overwrite(at: Layers) -> DataFrame:
    path = work_dir(at.spark, "overwritten")
    writers.write_parquet_overwrite(at.silver("albums"), path)
    writers.write_parquet_overwrite(at.silver("songs"), path)
    return at.spark.read.schema(SILVER["songs"]).parquet(path)


@query
def write_csv_export(at: Layers) -> DataFrame:
    path = work_dir(at.spark, "csv")
    writers.write_csv_export(at.silver("albums"), path)
    return readers.read_csv_export(at.spark, path, SILVER["albums"])


@query
def write_with_count(at: Layers) -> DataFrame:
    path = work_dir(at.spark, "counted")
    counts = jobs.write_tables(at.spark, {t: at.silver(t) for t in SILVER}, path)
    rows = F.explode(F.create_map(*(F.lit(x) for pair in counts.items() for x in pair)))
    counted = at.spark.range(1).select(rows.alias("table", "row_count"))
    return counted.withColumn("row_count", c("row_count").cast("bigint"))


@query
def register_tables(at: Layers) -> DataFrame:
    catalog.register_tables({t: at.silver(t) for t in SILVER}, prefix="silver_")
    return at.spark.sql(
        "SELECT country, status, count(*) AS albums_found, sum(track_count) AS tracks "
        "FROM silver_albums GROUP BY country, status"
    )


# Generators, projections, filters


@query
def explode_recordings(at: Layers) -> DataFrame:
    rows = generators.explode_recordings(at.bronze(), keep_empty=True)
    return rows.select(
        *generators.LINEAGE,
        "recording_pos",
        c("recording.id").alias("recording_id"),
        c("recording.title").alias("title"),
    )


@query
def explode_artist_credits(at: Layers) -> DataFrame:
    return silver.flat_artists(at.bronze("artists"), keep_empty=True).select(
        *generators.LINEAGE, *silver.POSITIONS, "artist_id", "artist_name"
    )


@query
def explode_releases(at: Layers) -> DataFrame:
    return silver.flat_albums(at.bronze("albums"), keep_empty=True).select(
        *generators.LINEAGE, *silver.POSITIONS, "album_id", "album_name"
    )


@query
def flatten_inner(at: Layers) -> DataFrame:
    return silver.flat_albums(at.bronze("albums")).select(
        *generators.LINEAGE, *silver.POSITIONS, "album_id", "album_name"
    )


@query
def nested_get_default(at: Layers) -> DataFrame:
    found = F.array_size(f.items_or_empty(c("data.recordings"))).alias("recordings")
    extracted = d.iso_timestamp(c("extracted_at")).alias("extracted_at")
    return at.bronze().select("artist_search", extracted, found)


@query
def project_artist_fields(at: Layers) -> DataFrame:
    return silver.flat_artists(at.bronze("artists"))


@query
def project_album_fields(at: Layers) -> DataFrame:
    return silver.flat_albums(at.bronze("albums"))


@query
def project_song_fields(at: Layers) -> DataFrame:
    return silver.flat_songs(at.bronze("songs")).drop("item_pos")


@query
def project_artist_fields_wide(at: Layers) -> DataFrame:
    return silver.flat_artists(at.bronze("artists"), wide=True).drop(*silver.POSITIONS)


@query
def carry_lineage(at: Layers) -> DataFrame:
    rows = generators.explode_recordings(at.bronze())
    return rows.select(*generators.LINEAGE, c("recording.id").alias("recording_id"))


@query
def derive_and_drop(at: Layers) -> DataFrame:
    rows = silver.flat_albums(at.bronze("albums")).select("album_id", "album_name", "country", "release_date_raw")
    clean = d.normalize_partial_date(c("release_date_raw"))
    return p.derive_and_drop(rows, {"release_date": clean}, "release_date_raw")


@query
def filter_key_not_null(at: Layers) -> DataFrame:
    return filters.key_not_null(silver.flat_artists(at.bronze("artists")), "artist_id")


@query
def filter_year_not_null(at: Layers) -> DataFrame:
    return aggregates.dated_albums(at.silver("albums"))


@query
def first_element(at: Layers) -> DataFrame:
    first = f.first_element(c("data.recordings"))
    return at.bronze().select(
        "artist_search",
        d.iso_timestamp(c("extracted_at")).alias("extracted_at"),
        first["title"].alias("first_title"),
        f.first_element(first["releases"])["title"].alias("first_release_title"),
    )


@query
def filter_target_searches(at: Layers) -> DataFrame:
    """Targets from a table: the nations of the first two regions."""
    nation, region = table(at, "nation"), table(at, "region").filter("r_regionkey <= 1")
    targets = nation.join(region, c("n_regionkey") == c("r_regionkey"), "left_semi")
    return filters.target_searches(at.silver("songs"), targets.select(c("n_name").alias("artist_search")))


@query
def rename_columns(at: Layers) -> DataFrame:
    credits = generators.explode_artist_credits(generators.explode_recordings(at.bronze()))
    return p.rename_columns(credits.select("artist_credit.artist.*"))


# Scalar functions


@query
def build_url(at: Layers) -> DataFrame:
    key = c("o_orderkey")
    text = f.case_when((key % 10 == 0, F.lit("")), (key % 10 > 1, key.cast("string")))
    return table(at, "orders").select(key, f.build_url(v.RELEASE_URL_PREFIX, text).alias("url"))


@query
def str_length(at: Layers) -> DataFrame:
    return table(at, "documents").select("doc_id", f.text_length(c("text")).alias("characters"))


@query
def case_when(at: Layers) -> DataFrame:
    size = f.case_when(
        (c("l_quantity") < 10, F.lit("single")),
        (c("l_quantity") < 30, F.lit("short")),
        (c("l_returnflag") == "R", F.lit("returned")),
    )
    return table(at, "lineitem").select("l_orderkey", "l_partkey", size.alias("size"))


def partial_dates(at: Layers) -> DataFrame:
    """Each event's time as year, month, day, empty, impossible or no date text."""
    kind = c("event_id") % 6
    raw = f.case_when(
        (kind == 0, F.date_format("ts", "yyyy")),
        (kind == 1, F.date_format("ts", "yyyy-MM")),
        (kind == 2, F.date_format("ts", "yyyy-MM-dd")),
        (kind == 3, F.lit("")),
        (kind == 4, F.date_format("ts", "yyyy-'00-00'")),
    )
    return table(at, "events").select("event_id", raw.alias("raw"))


@query
def normalize_partial_date(at: Layers) -> DataFrame:
    raw = c("raw")
    return partial_dates(at).select(
        "event_id", raw, d.normalize_partial_date(raw).alias("date"), d.date_precision(raw).alias("precision")
    )


@query
def to_date_fmt(at: Layers) -> DataFrame:
    good = F.date_format("o_orderdate", v.DATE_FORMAT)
    text = F.when(c("o_orderkey") % 3 == 2, F.concat(good, F.lit("x"))).otherwise(good)
    return table(at, "orders").select("o_orderkey", d.parse_date(text).alias("date"))


@query
def to_timestamp_iso(at: Layers) -> DataFrame:
    clock = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    kind = c("event_id") % 4
    tail = f.case_when(
        (kind == 0, F.lit("+00:00")), (kind == 1, F.lit("")), (kind == 2, F.lit("+02:00")), (kind == 3, F.lit("?"))
    )
    parsed = d.iso_timestamp(F.concat(clock, tail))
    return table(at, "events").select("event_id", F.unix_micros(parsed).alias("micros"))


@query
def coerce_datetime(at: Layers) -> DataFrame:
    parsed = d.coerce_datetime(c("raw"))
    return partial_dates(at).select("event_id", F.unix_micros(parsed).alias("micros"))


@query
def cast_types(at: Layers) -> DataFrame:
    key = c("o_orderkey")
    number = F.when(key % 4 < 2, key.cast("string")).otherwise(F.concat(key.cast("string"), F.lit("x")))
    flag = f.case_when((key % 3 == 0, F.lit("true")), (key % 3 == 1, F.lit("false")), default=F.lit("maybe"))
    return table(at, "orders").select(
        key,
        f.safe_cast(number, "int").alias("as_int"),
        f.safe_cast(number, "bigint").alias("as_long"),
        f.safe_cast(flag, "boolean").alias("as_bool"),
    )


@query
def year_of(at: Layers) -> DataFrame:
    return table(at, "orders").select("o_orderkey", d.year_of(c("o_orderdate")).alias("order_year"))


@query
def coalesce_default(at: Layers) -> DataFrame:
    country = F.when(c("l_linenumber") != 3, c("l_returnflag"))
    return table(at, "lineitem").select(
        "l_orderkey", "l_partkey", f.country_or_unknown(country).alias("country_code")
    )


@query
def round_half_up(at: Layers) -> DataFrame:
    return table(at, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        f.round_half_up(c("l_quantity") / 8, 2).alias("two"),
        f.round_half_up(c("l_quantity") / 20, 1).alias("one"),
    )


@query
def ms_to_minutes(at: Layers) -> DataFrame:
    return table(at, "lineitem").select(
        "l_orderkey", "l_partkey", f.ms_to_minutes(c("l_extendedprice")).alias("minutes")
    )


@query
def audit_created_at(at: Layers) -> DataFrame:
    return at.silver("albums").select("album_id", gold.audit_created_at(RUN_TS).alias("created_at"))


@query
def fill_false_bool(at: Layers) -> DataFrame:
    return silver.flat_songs(at.bronze("songs")).select(
        "recording_id", "score", f.flag_or_false(c("video")).alias("video")
    )


@query
def format_batch_stamp(at: Layers) -> DataFrame:
    ts = d.as_timestamp(c("ts"))
    return table(at, "events").select(
        "event_id", writers.landing_stamp(ts).alias("landing"), writers.export_stamp(ts).alias("export")
    )


@query
def format_iso_utc(at: Layers) -> DataFrame:
    return table(at, "events").select("event_id", d.iso_utc(d.as_timestamp(c("ts"))).alias("iso"))


@query
def replace_substring(at: Layers) -> DataFrame:
    path = F.concat(F.lit(f"{v.PENDING_FOLDER}/"), c("url"))
    return table(at, "pages").select(
        "page_id",
        f.replace_substring(path, v.PENDING_FOLDER, v.DONE_FOLDER).alias("path"),
        F.md5(f.replace_substring(c("html"), "<", "[")).alias("html_md5"),
    )


@query
def json_decode_encode(at: Layers) -> DataFrame:
    decoded = f.decode_json(c("props"), "k int")
    return table(at, "events").select(
        "event_id", decoded["k"].alias("k"), f.encode_json(decoded).alias("encoded")
    )


# De-duplication


@query
def dedup_any(at: Layers) -> DataFrame:
    """Only the keys: which row stays is open."""
    return keep_any(silver.flat_albums(at.bronze("albums")), "album_id").select("album_id")


@query
def dedup_keep_first(at: Layers) -> DataFrame:
    rows = silver.flat_artists(at.bronze("artists"), wide=True)
    return keep_first(rows, "artist_id", silver.DOCUMENT_ORDER).drop(*silver.POSITIONS)


# Aggregations


@query
def song_stats(at: Layers) -> DataFrame:
    return aggregates.song_stats(at.silver("songs"))


@query
def album_stats(at: Layers) -> DataFrame:
    return aggregates.album_stats(at.silver("albums"))


@query
def yearly_country_agg(at: Layers) -> DataFrame:
    return aggregates.yearly_country(aggregates.dated_albums(at.silver("albums")))


@query
def count_non_null(at: Layers) -> DataFrame:
    return at.silver("albums").groupBy("artist_search").agg(
        F.count("country").alias("with_country"),
        F.count("track_count").alias("with_tracks"),
        F.count("release_date").alias("with_date"),
    )


@query
def count_distinct(at: Layers) -> DataFrame:
    return at.silver("albums").groupBy("artist_search").agg(
        F.count_distinct("country").alias("countries"), F.count_distinct("release_date").alias("dates")
    )


@query
def distinct_sketches(at: Layers) -> DataFrame:
    """Sketches of two batches, kept as Parquet and united, against exact counts of the whole."""
    keys, columns, path = ["artist_search"], ["country", "album_id"], work_dir(at.spark, "sketches")
    albums = at.silver("albums")
    odd = F.length("album_id") % 2 == 1
    for number, part in enumerate((albums.where(odd), albums.where(~odd))):
        writers.write_parquet_overwrite(sketches.distinct_sketches(part, keys, columns), f"{path}/batch={number}")
    kept = at.spark.read.parquet(path)
    united = sketches.estimate_distinct(sketches.unite_sketches(kept, keys, columns), keys, columns)
    exact = albums.groupBy(*keys).agg(*(F.count_distinct(x).alias(f"exact_{x}") for x in columns))
    rows = united.join(exact, "artist_search")
    near = lambda x: F.abs(c(x) - c(f"exact_{x}")) <= F.ceil(c(f"exact_{x}") * sketches.ERROR_BOUND)
    return rows.select(
        "artist_search", "exact_country", "exact_album_id", near("country").alias("near_country"), near("album_id").alias("near_album_id"),
    )


@query
def avg_ignore_null(at: Layers) -> DataFrame:
    mean = f.round_half_up(F.avg("track_count"), 4)
    return at.silver("albums").groupBy("artist_search").agg(mean.alias("avg_tracks"))


@query
def min_max_date(at: Layers) -> DataFrame:
    date = c("first_release_date")
    return at.silver("songs").groupBy("artist_search").agg(
        F.min(date).alias("earliest"), F.max(date).alias("latest")
    )


@query
def table_count(at: Layers) -> DataFrame:
    return aggregates.table_counts({**{t: at.silver(t) for t in SILVER}, "bronze": at.bronze()})


@query
def null_profile(at: Layers) -> DataFrame:
    return profile.stack_profiles([profile.null_profile(at.silver(t), t) for t in SILVER])


@query
def profile_sketches(at: Layers) -> DataFrame:
    """Profiles of two batches of albums, kept as Parquet and united: exact counts, the most frequent status, and
    whether the median's rank is as near as stated."""
    albums, path = at.silver("albums").select("album_id", "country", "status", "track_count"), work_dir(at.spark, "profiles")
    odd = F.length("album_id") % 2 == 1
    for number, part in enumerate((albums.where(odd), albums.where(~odd))):
        writers.write_parquet_overwrite(sketches.profile_states(part, "albums"), f"{path}/batch={number}")
    found = sketches.profile(sketches.unite_profiles(at.spark.read.parquet(path).drop("batch")), (0.5,), 1)
    median = found.where("column = 'track_count'").first()["quantiles"][0]
    ranks = albums.where("track_count IS NOT NULL").agg(F.avg((c("track_count") < median).cast("int")).alias("low"), F.avg((c("track_count") <= median).cast("int")).alias("high")).first()
    near = ranks["low"] - sketches.RANK_ERROR <= 0.5 <= ranks["high"] + sketches.RANK_ERROR
    often = F.when(c("column").isin("status", "country"), c("frequent")[0]["count"])
    return found.select("table", "column", "row_count", "null_count", often.alias("most"), F.lit(near).alias("median_is_near"))


@query
def shape_dtypes_profile(at: Layers) -> DataFrame:
    shapes = []
    for t in SILVER:
        before = silver.silver_view(silver.keyed_rows(at.bronze(t), t), t)
        shapes += [profile.shape_dtypes(at.silver(t), t), profile.shape_dtypes(before, f"{t} with duplicates")]
    return profile.stack_profiles(shapes)


# Joins


@query
def left_join_song_stats(at: Layers) -> DataFrame:
    artists = at.silver("artists").select("artist_id", "artist_search")
    return joins.left_join_stats(artists, aggregates.song_stats(at.silver("songs")), "artist_id")


@query
def left_join_album_stats(at: Layers) -> DataFrame:
    artists = at.silver("artists").select("artist_id", "artist_search")
    return joins.left_join_stats(artists, aggregates.album_stats(at.silver("albums")), "artist_id")


# Sort, limit, top-n


@query
def order_by_year_releases(at: Layers) -> DataFrame:
    metrics = aggregates.yearly_country(aggregates.dated_albums(at.silver("albums")))
    return ordering.by_year_and_releases(metrics)


@query
def newest_file_top1(at: Layers) -> DataFrame:
    """The run that the newest of all landed files belongs to. Only names and times are looked at, so all tasks land the
    later run together."""
    newest = ordering.newest_top1(readers.list_files(at.spark, land_eighth_last(at, single=False)))
    return newest.select(F.regexp_extract("path", "/batch_id=([^/]+)/", 1).alias("batch_id"))


@query
def preview_head(at: Layers) -> DataFrame:
    heads = {t: ordering.preview_head(at.silver(t), key) for t, key in SILVER_KEYS.items()}
    return profile.stack_profiles(
        [df.select(F.lit(t).alias("table"), c(SILVER_KEYS[t]).alias("id"), *LINEAGE) for t, df in heads.items()]
    )


@query
def top_n_per_search(at: Layers) -> DataFrame:
    order = [F.desc_nulls_last("score"), F.asc("recording_id")]
    return ordering.top_n_per_key(
        at.silver("songs"), "artist_search", order, v.RECORDINGS_PER_SEARCH, spread_by="recording_id"
    )


# Unions


@query
def union_searches_query(at: Layers) -> DataFrame:
    return sized(union_searches([half(at, 0), half(at, 1)]))


# Streaming


@query
def stream_dedup_watermark(at: Layers) -> DataFrame:
    """Three runs: half of bronze; a recording per nation, extracted a month later, which moves the watermark past all
    the rest; the other half, which is late by then and dropped."""
    landing, out, state = (work_dir(at.spark, n) for n in ("landing", "deduped", "state"))
    recording = F.concat(F.lit('{"recordings":[{"id":"nat-'), c("n_nationkey").cast("string"), F.lit('"}]}'))
    nations = table(at, "nation").select(c("n_name").alias("artist_search"), recording.alias("payload"))
    for batch in (half(at, 0), writers.make_envelopes(nations, run_ts()), half(at, 1)):
        writers.write_json_lines(batch, landing, mode="append")
        envelopes = ingest.read_new_bronze(at.spark, landing)
        ingest.run_available(ingest.stream_dedup_watermark(envelopes, "songs"), out, state)
    drop_work_dir(at.spark, landing)
    return at.spark.read.parquet(out).select("recording_id")


@query
def stream_earliest(at: Layers) -> DataFrame:
    """The later half of bronze arrives first; within the delay the earlier half's rows still win."""
    landing, base, state = (work_dir(at.spark, n) for n in ("landing", "earliest", "state"))
    for odd, ts in ((1, EARLIER_RUN_TS), (0, RUN_TS)):
        writers.land_bronze(half(at, odd), landing, run_ts(ts))
        earliest.keep_earliest(ingest.read_new_bronze(at.spark, landing), "songs", base, state, delay="400 days")
    drop_work_dir(at.spark, landing)
    return earliest.earliest_rows(at.spark, base, "songs")


@query
def incremental_upsert(at: Layers) -> DataFrame:
    """The later half arrives first: the merge must still let the earlier rows win."""
    landing, base, state = (work_dir(at.spark, n) for n in ("landing", "upsert", "state"))
    for odd, ts in ((1, EARLIER_RUN_TS), (0, RUN_TS)):
        writers.land_bronze(half(at, odd), landing, run_ts(ts))
        upsert.append_changes(at.spark, landing, base, state, "songs")
        merged = upsert.advance_snapshot(at.spark, base, "songs")
    drop_work_dir(at.spark, landing)
    return silver.silver_view(merged, "songs")


def two_incremental_runs(at: Layers, after_each: Callable[[str], None]) -> str:
    """The later half of bronze arrives first, then the earlier; buckets are few and small, so that they split."""
    landing, state, base = (work_dir(at.spark, n) for n in ("landing", "state", "silver"))
    for odd, ts in ((1, EARLIER_RUN_TS), (0, RUN_TS)):
        writers.land_bronze(half(at, odd), landing, run_ts(ts))
        upsert.run_incremental(at.spark, landing, state, base, buckets=3, bucket_bytes=100_000)
        after_each(state)
    drop_work_dir(at.spark, landing)
    return state


@query
def point_lookup(at: Layers) -> DataFrame:
    """The songs of every hundredth order, and of orders that are not there, looked up in silver as the batch job and as
    the incremental job write it, and in files of key ranges."""
    state, base, whole, ranges = two_incremental_runs(at, lambda state: None), *(work_dir(at.spark, n) for n in ("silver", "whole", "ranges"))
    upsert.publish(at.spark, f"{state}/songs", "songs", f"{base}/songs")
    jobs.write_tables(at.spark, {"songs": silver.transform_songs(at.bronze("songs"))}, whole, SILVER_KEYS)
    lookup.write_sorted(readers.scan_silver_parquet(at.spark, whole, "songs"), f"{ranges}/songs", "recording_id")
    key = c("o_orderkey")
    keys = table(at, "orders").where(key % 100 == 0).select(F.explode(F.array(F.concat(F.lit("rec-"), key), F.concat(F.lit("none-"), key))))
    kept = silver_lookup.look_up_silver(at.spark, f"{state}/songs", "songs", f"{base}/songs", keys).withColumn("table", F.lit("incremental"))
    for name, folder in (("batch", whole), ("ranges", ranges)):
        found = lookup.look_up(readers.scan_silver_parquet(at.spark, folder, "songs"), "recording_id", keys)
        kept = kept.unionByName(found.withColumn("table", F.lit(name)))
    return kept


@query
def change_feed(at: Layers) -> DataFrame:
    """What the second of two incremental runs changed in the songs, as the rows that go and those that come."""
    state = two_incremental_runs(at, lambda state: None)
    return changefeed.signed_rows(changefeed.change_feed(at.spark, f"{state}/songs", "songs", 1, 2))


@query
def incremental_gold(at: Layers) -> DataFrame:
    """Gold kept by deltas over two incremental runs."""
    base = work_dir(at.spark, "gold")
    two_incremental_runs(at, lambda state: gold_deltas.run_gold_incremental(at.spark, state, base, RUN_TS, buckets=3, bucket_bytes=100_000))
    summary, yearly = (
        at.spark.read.schema(GOLD[t]).parquet(f"{base}/{t}").select(*GOLD[t].fieldNames()).withColumn("table", F.lit(t)) for t in GOLD
    )
    return summary.unionByName(yearly, allowMissingColumns=True)


# Whole jobs


@query
def transform_artists(at: Layers) -> DataFrame:
    return silver.transform_artists(at.bronze("artists"))


@query
def transform_albums(at: Layers) -> DataFrame:
    return silver.transform_albums(at.bronze("albums"))


@query
def transform_songs(at: Layers) -> DataFrame:
    return silver.transform_songs(at.bronze("songs"))


@query
def build_artist_summary(at: Layers) -> DataFrame:
    return gold.build_artist_summary(at.silver("artists"), at.silver("songs"), at.silver("albums"), RUN_TS)


@query
def build_yearly_release_metrics(at: Layers) -> DataFrame:
    return gold.build_yearly_release_metrics(at.silver("albums"), RUN_TS)


@query
def run_bronze_to_silver(at: Layers) -> DataFrame:
    base = work_dir(at.spark, "silver")
    jobs.run_bronze_to_silver(at.spark, at.bronze_json(), base)
    written = {t: readers.scan_silver_parquet(at.spark, base, t).withColumn("table", F.lit(t)) for t in SILVER}
    artists, albums, songs = written.values()
    return artists.unionByName(albums, allowMissingColumns=True).unionByName(songs, allowMissingColumns=True)


@query
def run_silver_to_gold(at: Layers) -> DataFrame:
    base = work_dir(at.spark, "gold")
    jobs.run_silver_to_gold(at.spark, at.silver_base(), base, RUN_TS)
    summary, yearly = (
        at.spark.read.schema(GOLD[t]).parquet(f"{base}/{t}").withColumn("table", F.lit(t))
        for t in ("artist_summary", "yearly_release_metrics")
    )
    return summary.unionByName(yearly, allowMissingColumns=True)


@query
def legacy_flat_export(at: Layers) -> DataFrame:
    folders = flat_export.export_flat(at.spark, at.bronze_parts(), work_dir(at.spark, "export"), RUN_TS)
    rows = {
        name: readers.read_csv_export(at.spark, folder).withColumn("table", F.lit(name))
        for name, folder in folders.items()
    }
    album, artist, song = (rows[n] for n in ("album", "artist", "song"))
    every = album.unionByName(artist, allowMissingColumns=True).unionByName(song, allowMissingColumns=True)
    return every.withColumn("extracted_at", c("extracted_at").cast("timestamp"))


@query
def clean_and_profile(at: Layers) -> DataFrame:
    return clean_profile.clean_and_profile(at.bronze_parts())


# Data quality


@query
def dq_null_check(at: Layers) -> DataFrame:
    rows = silver.flat_albums(at.bronze("albums"))
    return quality.dq_null_check(rows, "release rows", ["album_id", "country", "status", "track_count"])


@query
def dq_unique_check(at: Layers) -> DataFrame:
    before = quality.dq_unique_check(silver.flat_albums(at.bronze("albums")), "release rows", "album_id")
    return before.unionByName(quality.dq_unique_check(at.silver("albums"), "albums", "album_id"))


@query
def dq_date_check(at: Layers) -> DataFrame:
    albums = quality.dq_date_check(silver.flat_albums(at.bronze("albums")), "release rows", ["release_date_raw"])
    songs = silver.flat_songs(at.bronze("songs"))
    return albums.unionByName(quality.dq_date_check(songs, "recording rows", ["first_release_date_raw"]))


@query
def dq_schema_check(at: Layers) -> DataFrame:
    """Silver albums as stored, and the uncleaned release rows, which lack two columns."""
    stored = at.spark.read.parquet(f"{at.silver_base('albums')}/albums")
    good = quality.dq_schema_check(stored, "albums", SILVER["albums"])
    rows = silver.flat_albums(at.bronze("albums"))
    return good.unionByName(quality.dq_schema_check(rows, "release rows", SILVER["albums"]))


REGISTRY["union_searches"] = REGISTRY.pop("union_searches_query")
