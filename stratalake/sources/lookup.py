"""Point look-ups in Parquet tables by key.

Tables written with `key_index` carry, beside the usual minima and maxima, a Bloom filter of the key in each row group
and short pages. Where rows are sorted by key inside their files, a look-up of a few keys opens the row groups that may
hold one of them, and of these only the pages that do. Where files hold ranges of keys (`write_sorted`), that is so for
any number of keys: one page each. In files dealt by hash every file spans all keys, so a row group that one key is in
is read at the places of all. Nothing is shuffled, and no other structure has to be kept in step."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys that become a condition; more are joined, as reading nearly everything is then the shorter way.
MOST_KEYS = 2_000
# Up to so many values Spark hands the reader as equalities, each held against minima, pages and Bloom filter. A longer
# list only meets the row groups' minima and maxima as one range, and every Bloom filter lets some of its values pass.
PER_CLAUSE = 10
PAGE_ROWS = 5_000
# BITS_PER_KEY for each of the 1.5 million keys of a usual row group.
BLOOM_BYTES = 4_194_304
BITS_PER_KEY = 22
# Filters of several sizes, each half the one before, are tried: down to 8 KB, for small files.
SMALLEST_BLOOM = 8_192
FALSE_POSITIVES = 0.001


def key_index(key: str, page_rows: int = PAGE_ROWS, rows: int | None = None) -> dict[str, str]:
    """Parquet write options for a table that is looked up by `key`. The filter's size follows the row group's distinct
    keys; a row group whose keys are dictionary-coded has none, as the dictionary serves. Every open file has the
    filters of all sizes in memory, and each key enters them all; if no file has more than `rows` rows, those that are
    too large for so many are left out."""
    largest = SMALLEST_BLOOM
    while largest < BLOOM_BYTES and (rows is None or largest * 8 < rows * BITS_PER_KEY):
        largest *= 2
    sizes = (largest // SMALLEST_BLOOM).bit_length()
    return {
        f"parquet.bloom.filter.enabled#{key}": "true",
        f"parquet.bloom.filter.fpp#{key}": str(FALSE_POSITIVES),
        "parquet.bloom.filter.adaptive.enabled": "true",
        f"parquet.bloom.filter.candidates.number#{key}": str(sizes),
        "parquet.bloom.filter.max.bytes": str(largest),
        "parquet.page.row.count.limit": str(page_rows),
    }


def write_sorted(df: DataFrame, path: str, key: str, *then: str, page_rows: int = PAGE_ROWS) -> None:
    """Replace a table by one whose files hold ranges of the key, sorted, for look-ups. `df` should be a scan, because
    the borders are drawn from a sample of it, which reads it twice. Name further columns in `then` where one key may
    have very many rows: they are then split over files."""
    rows = df.repartitionByRange(key, *then).sortWithinPartitions(key, *then)
    rows.write.mode("overwrite").option("compression", "snappy").options(**key_index(key, page_rows)).parquet(path)


def one_of(key: str, values: list) -> Column:
    """Whether the key is one of the values: a hash set for the rows, equalities for the files."""
    ordered = sorted(values)
    clauses = [F.col(key).isin(ordered[i : i + PER_CLAUSE]) for i in range(0, len(ordered), PER_CLAUSE)]
    if not clauses:
        return F.lit(False)
    while len(clauses) > 1:  # a tree as deep as the logarithm of the number of clauses
        clauses = [reduce(or_, clauses[i : i + 2]) for i in range(0, len(clauses), 2)]
    return F.col(key).isin(ordered) & clauses[0]


def wanted_keys(keys: DataFrame, *more: Column) -> list | None:
    """The distinct keys that are not null (the only column), with further columns made from them; None if there are
    more than MOST_KEYS."""
    (key,) = keys.columns
    distinct = keys.where(F.col(key).isNotNull()).distinct()
    found = distinct.limit(MOST_KEYS + 1).select(key, *more).collect()
    return found if len(found) <= MOST_KEYS else None


def look_up(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of a table whose key is among `keys` (one column, nulls and repeats allowed). A null key is never found.
    Up to MOST_KEYS of them pass through the driver; more are joined."""
    found = wanted_keys(keys)
    if found is None:
        return semi_join(df, key, keys)
    return df.where(one_of(key, [r[0] for r in found]))


def semi_join(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    (name,) = keys.columns
    return df.join(keys.select(F.col(name).alias(key)), key, "left_semi").select(*df.columns)
