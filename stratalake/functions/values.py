"""Scalar expressions on single columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.fixed_values import UNKNOWN_COUNTRY


def build_url(prefix: str, key: Column) -> Column:
    """Prefix + id; a null or empty id has no page, so the URL is null."""
    return F.concat(F.lit(prefix), F.nullif(key, F.lit("")))


def text_length(text: Column) -> Column:
    return F.length(text).cast("int")


def case_when(*branches: tuple[Column, Column], default: Column | None = None) -> Column:
    """The value of the first branch whose condition holds, else the default (null when not given)."""
    (condition, value), *rest = branches
    chain = F.when(condition, value)
    for condition, value in rest:
        chain = chain.when(condition, value)
    return chain if default is None else chain.otherwise(default)


def safe_cast(value: Column, to: str | T.DataType) -> Column:
    """Cast that gives null for what does not fit, also under ANSI mode."""
    return value.try_cast(to)


def number_of_text(text: Column, to: str) -> Column:
    """An integer from text such as `12`, `12.0` or `1.8E5`, exact up to the type's bounds; a fraction is cut
    off (12.5 gives 12), anything else gives null. The decimal in between holds every bigint."""
    return text.try_cast("decimal(38,10)").try_cast(to)


def country_or_unknown(country: Column) -> Column:
    return F.coalesce(country, F.lit(UNKNOWN_COUNTRY))


def flag_or_false(flag: Column) -> Column:
    return F.coalesce(safe_cast(flag, "boolean"), F.lit(False))


def round_half_up(value: Column, digits: int) -> Column:
    return F.round(value.cast("double"), digits)


def ms_to_minutes(ms: Column) -> Column:
    return ms / F.lit(1000) / F.lit(60)


def replace_substring(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def decode_json(text: Column, schema: str | T.DataType) -> Column:
    return F.from_json(text, schema)


def encode_json(value: Column) -> Column:
    return F.to_json(value)


def first_element(items: Column) -> Column:
    """First array element, null for an empty or null array."""
    return F.try_element_at(items, F.lit(1))


def items_or_empty(items: Column) -> Column:
    """The array, or an empty one where the container is missing."""
    return F.coalesce(items, F.array())
