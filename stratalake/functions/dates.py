"""Date and time expressions. Nothing here depends on the session time zone: text without an offset is
UTC, and text made from a timestamp is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.fixed_values import DATE_FORMAT

_FIRST_DAY_TAIL = "-01-01"
_PRECISION = {4: "year", 7: "month", 10: "day"}


def parse_date(text: Column, fmt: str = DATE_FORMAT) -> Column:
    """Text to date by pattern; text that is no such date gives null, also under ANSI mode."""
    return F.try_to_date(text, fmt)


def complete_date(raw: Column) -> Column:
    """`YYYY` and `YYYY-MM` filled up to the first day; a length other than 4, 7 or 10 gives null."""
    filled = F.substring(F.concat(raw, F.lit(_FIRST_DAY_TAIL)), 1, 10)
    return F.when(F.length(raw).isin(*_PRECISION), filled)


def normalize_partial_date(raw: Column) -> Column:
    return parse_date(complete_date(raw))


def date_precision(raw: Column) -> Column:
    """What part of the date the source really gave: year, month or day; null where no date came out."""
    pairs = [F.lit(v) for item in _PRECISION.items() for v in item]
    named = F.try_element_at(F.create_map(*pairs), F.length(raw))
    return F.when(normalize_partial_date(raw).isNotNull(), named)


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to timestamp. An offset in the text (`Z`, `+hh`, `+hhmm`, `+hh:mm`) counts; without one the
    text is UTC, whatever the session zone. Seconds may be missing."""
    has_offset = text.rlike(r"[T ].*(Z|[+-]\d{2}(:?\d{2})?)$")
    wall_clock = text.try_cast("timestamp_ntz").cast("string")
    return F.when(has_offset, text.try_cast("timestamp")).otherwise(
        F.concat(wall_clock, F.lit("+00:00")).try_cast("timestamp")
    )


def coerce_datetime(text: Column) -> Column:
    """Full ISO dates and date-times become timestamps, everything else (partial dates too) null."""
    return F.when(F.length(text) >= 10, iso_timestamp(text))


def as_timestamp(ts: Column) -> Column:
    """A zone-less test-table timestamp read as UTC wall-clock time."""
    return iso_timestamp(ts.cast("timestamp_ntz").cast("string"))


def year_of(date: Column) -> Column:
    return F.year(date).cast("int")


def utc_text(ts: Column, fmt: str) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), fmt)


def iso_utc(ts: Column) -> Column:
    """`2024-01-31T08:15:00.123456+00:00`"""
    return F.concat(utc_text(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
