import re
from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.functions import dates as d
from stratalake.functions import values as f


def apply(spark, expression, inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[1] for r in df.select("i", expression(F.col("x"))).orderBy("i").collect()]


EDGE_DATES = {
    "1999-04-26": date(1999, 4, 26),
    "2001-05": date(2001, 5, 1),
    "2001": date(2001, 1, 1),
    "": None,
    "2001-5": None,
    "2001-00-00": None,
    "2001-13-01": None,
    "2001-02-30": None,
    "abcdefghij": None,
    "abcd": None,
    "2001-1-1": None,
    "2001-01-011": None,
    None: None,
}


def test_partial_dates(spark):
    assert apply(spark, d.normalize_partial_date, list(EDGE_DATES)) == list(EDGE_DATES.values())


def test_date_precision(spark):
    texts = ["1999-04-26", "2001-05", "2001", "2001-00-00", "", None]
    assert apply(spark, d.date_precision, texts) == ["day", "month", "year", None, None, None]


def by_hand(text):
    if text is None or len(text) not in (4, 7, 10):
        return None
    full = text + "-01-01"[: 10 - len(text)] if len(text) == 4 else text + "-01" if len(text) == 7 else text
    if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", full):
        return None
    try:
        return date.fromisoformat(full)
    except ValueError:
        return None


YEARS = st.integers(1583, 2999).map(str)
PARTS = st.integers(0, 40).map(lambda n: f"{n:02d}")
TEXTS = st.one_of(
    YEARS,
    st.tuples(YEARS, PARTS).map("-".join),
    st.tuples(YEARS, PARTS, PARTS).map("-".join),
    st.text("0123456789-x ", max_size=11).filter(lambda t: not re.match(r"0[0-9]{3}|1[0-5]", t)),
    st.none(),
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXTS, min_size=50, max_size=200))
def test_partial_dates_against_brute_force(spark, texts):
    assert apply(spark, d.normalize_partial_date, texts) == [by_hand(t) for t in texts]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_iso_timestamps_ignore_the_session_zone(spark, zone):
    cases = {
        "2024-01-31T08:15:00+00:00": 1706688900000000,
        "2024-01-31T08:15:00.123456": 1706688900123456,
        "2024-01-31T10:15:00+02:00": 1706688900000000,
        "2024-01-31T08:15:00Z": 1706688900000000,
        "2024-01-31": 1706659200000000,
        "nonsense": None,
        "": None,
        None: None,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = apply(spark, lambda x: F.unix_micros(d.iso_timestamp(x)), list(cases))
        text = apply(spark, lambda x: d.iso_utc(d.iso_timestamp(x)), ["2024-01-31T10:15:00+02:00"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == list(cases.values())
    assert text == ["2024-01-31T08:15:00.000000+00:00"]


def test_coerce_datetime_wants_a_full_date(spark):
    got = apply(spark, d.coerce_datetime, ["2024-01-31", "2024-01", "2024", "x" * 12])
    assert got == [datetime(2024, 1, 31), None, None, None]


def test_stamps(spark):
    ts = datetime(2024, 1, 31, 8, 15, 7, tzinfo=timezone.utc)
    row = spark.range(1).select(
        d.utc_text(F.lit(ts), "yyyyMMdd_HHmmss"), d.utc_text(F.lit(ts), "yyyy-MM-dd-HH-mm-ss")
    )
    assert tuple(row.first()) == ("20240131_081507", "2024-01-31-08-15-07")


def test_urls(spark):
    assert apply(spark, lambda x: f.build_url("u/", x), ["a", "", None]) == ["u/a", None, None]


def test_safe_casts(spark):
    assert apply(spark, lambda x: f.safe_cast(x, "int"), ["7", "x", "99999999999", None]) == [7, None, None, None]
    assert apply(spark, f.flag_or_false, [True, False, None], "boolean") == [True, False, False]


def test_round_half_up(spark):
    got = apply(spark, lambda x: f.round_half_up(x, 2), [1.005, 2.675, 0.125, None], "double")
    assert got == [1.01, 2.68, 0.13, None]


def test_case_when_takes_the_first_branch(spark):
    def size(x):
        return f.case_when((x < 5, F.lit("s")), (x < 50, F.lit("m")))

    assert apply(spark, size, [1, 10, 100, None], "int") == ["s", "m", None, None]


def test_array_defaults(spark):
    arrays = [[3, 4], [], None]
    assert apply(spark, f.first_element, arrays, "array<int>") == [3, None, None]
    assert apply(spark, f.items_or_empty, arrays, "array<int>") == [[3, 4], [], []]


def test_json(spark):
    assert apply(spark, lambda x: f.encode_json(f.decode_json(x, "k int")), ['{"k": 5}', "{}", "{"]) == [
        '{"k":5}',
        "{}",
        "{}",
    ]


def test_replace(spark):
    got = apply(spark, lambda x: f.replace_substring(x, "to_processed", "processed"), ["raw/to_processed/a.json"])
    assert got == ["raw/processed/a.json"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_iso_forms_do_not_depend_on_the_session_zone(spark, zone):
    forms = {
        "2024-01-31T08:15:00+00": 0, "2024-01-31T08:15": 0, "2024-01-31T08:15:00Z": 0, "2024-01-31 08:15:00": 0,
        "2024-01-31T08:15:00+0200": -7200, "2024-01-31T10:15:00+02": 0, "2024-01-31T08:15:00-05:00": 18000, "2024-01-31": -29700,
        "soon": None, "2024-01-31T08:15:00?": None, None: None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in forms], "t string")
        got = {r[0]: r[1] for r in df.select("t", F.unix_seconds(d.iso_timestamp(F.col("t")))).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == {t: None if s is None else 1706688900 + s for t, s in forms.items()}
