"""Bronze envelopes derived from the flat test tables, so that the whole path from nested JSON to gold runs
on data whose answer a plain SQL query over those tables gives.

Each row of orders left-joined with lineitem makes one envelope, from its own columns alone: at most two
recordings, each with at most two credits and two releases. No rows are collected into arrays, so an order,
part or customer that holds a third of all rows makes no envelope larger, and one pass suffices.
All the odd cases of real data are in it: absent, empty and null containers, null ids, partial and
impossible dates, missing flags, numbers as text with and without a fraction, times with and without an offset or in no
known form, many duplicates with differing content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.schemas import BRONZE, CREDIT, PAYLOAD, RELEASE

FIRST_EXTRACTION = 1704067200  # 2024-01-01 00:00:00 UTC
ORDERS_PER_SECOND = 10

RECORDING = PAYLOAD["recordings"].dataType.elementType
ARTIST = CREDIT["artist"].dataType

c = F.col


def _record(schema: T.StructType, **values: Column) -> Column:
    """A struct of the schema's fields; fields not given are null."""
    given = dict(values)
    return F.struct(
        *(given.pop(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema), *given.values()
    )


def _tag(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def _unless(hidden: Column, value: Column) -> Column:
    """The value, or null where the condition holds; JSON then lacks the field."""
    return F.when(~hidden, value)


def _number_text(selector: Column, number: Column) -> Column:
    """By selector mod 3: the whole number as text, with a zero fraction, or with an exponent."""
    whole = number.cast("bigint").cast("string")
    return F.when(selector % 3 == 0, whole).when(selector % 3 == 1, F.concat(whole, F.lit(".0"))).otherwise(F.concat(whole, F.lit("e0")))


def _mixed_date(selector: Column, ts: Column) -> Column:
    """By selector mod 6: year, month, day, empty, impossible or absent date text."""
    patterns = ["yyyy", "yyyy-MM", "yyyy-MM-dd", "''", "yyyy-'00-00'"]
    kind, text = selector % 6, F.lit(None).cast("string")
    for i, pattern in enumerate(patterns):
        made = F.lit("") if pattern == "''" else F.date_format(ts, pattern)
        text = F.when(kind == i, made).otherwise(text)
    return text


def _one_or_two(first: Column, both: Column, second: Column) -> Column:
    """An array of the first item and, where the condition holds, the second. A slice is compiled; a filter over the
    array would have every row's items evaluated expression by expression."""
    return F.slice(F.array(first, F.when(both, second)), F.lit(1), F.when(both, F.lit(2)).otherwise(F.lit(1)))


def base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer x nation, left-joined with lineitem. Written as inner join plus the orders without
    items: adaptive execution may split a hot order in this form, but not in a left outer join. Customers join the
    orders first: after the items, a large customer table would have every item's wide row shuffled once more."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    customers = table("customer").join(table("nation"), c("c_nationkey") == c("n_nationkey"))
    orders, items = table("orders").join(customers, c("o_custkey") == c("c_custkey")), table("lineitem")
    # Building envelopes costs far more than this shuffle, which spreads it even over one small input file.
    with_items = orders.hint("merge").join(items, c("o_orderkey") == c("l_orderkey"))
    ordered = items.select("l_orderkey").distinct()
    without = orders.join(ordered, c("o_orderkey") == c("l_orderkey"), "left_anti")
    return with_items.unionByName(without, allowMissingColumns=True)


def _order_recording(key: Column, item: Column) -> Column:
    main = _record(
        ARTIST,
        id=_unless(key % 89 == 7, _tag("art-", c("o_custkey"))),
        name=c("c_name"),
        **{"sort-name": F.upper("c_name")},
        disambiguation=c("c_mktsegment"),
        type=c("o_orderstatus"),
        country=_unless(c("o_custkey") % 4 == 0, _tag("C", c("c_nationkey"))),
    )
    featured = _record(
        ARTIST, id=_tag("feat-", key % 50), name=_tag("Feat ", key % 50), type=F.lit("guest")
    )
    of_part = _record(
        RELEASE,
        id=_unless(c("l_partkey") % 71 == 3, _tag("rel-", c("l_partkey"))),
        title=_tag("T", c("l_partkey")),
        date=_mixed_date(item + 5, c("l_shipdate")),
        country=_unless(item == 3, c("l_returnflag")),
        status=c("l_linestatus"),
        **{"track-count": _number_text(key, c("l_quantity"))},
    )
    of_supplier = _record(
        RELEASE,
        id=_tag("rel-s", c("l_suppkey")),
        title=_tag("S", c("l_suppkey")),
        date=F.date_format("o_orderdate", "yyyy"),
        country=c("l_linestatus"),
    )
    no_release = F.array_compact(F.array(F.lit(None).cast(RELEASE)))
    return _record(
        RECORDING,
        id=_unless(key % 97 == 5, _tag("rec-", key)),
        title=c("o_orderpriority"),
        length=_unless(key % 7 == 0, _number_text(item, F.floor("o_totalprice"))),
        video=_unless(key % 3 == 0, key % 2 == 0),
        score=_number_text(key + 1, (key + item) % 101),
        **{
            "first-release-date": _mixed_date(key, c("o_orderdate")),
            "artist-credit": _unless(
                key % 83 == 3,
                _one_or_two(_record(CREDIT, artist=main), key % 5 == 0, _record(CREDIT, artist=featured)),
            ),
        },
        releases=F.when(item > 0, _one_or_two(of_part, item % 3 == 0, of_supplier)).when(
            key % 8 == 7, no_release
        ),
    )


def _part_recording(item: Column) -> Column:
    supplier = _record(
        ARTIST, id=_tag("sup-", c("l_suppkey")), name=_tag("Supplier ", c("l_suppkey")), country=c("l_returnflag")
    )
    return _record(
        RECORDING,
        id=_tag("trk-", c("l_partkey")),
        title=_tag("Track ", c("l_partkey")),
        length=F.floor("l_extendedprice"),
        score=item,
        **{
            "first-release-date": F.date_format("l_shipdate", "yyyy-MM"),
            "artist-credit": F.array(_record(CREDIT, artist=supplier)),
        },
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with items have recordings. Those without have, by key mod 4, no `data`, an empty `data`, an
    empty array, or one recording without releases."""
    key, item = c("o_orderkey"), F.coalesce(c("l_linenumber"), F.lit(0))
    recordings = (
        F.when(
            (item > 0) | (key % 4 == 3),
            _one_or_two(_order_recording(key, item), (item > 0) & (item % 2 == 0), _part_recording(item)),
        )
        .when(key % 4 == 2, F.array_compact(F.array(F.lit(None).cast(RECORDING))))
    )
    seconds = F.lit(FIRST_EXTRACTION) + ((key - key % ORDERS_PER_SECOND) / ORDERS_PER_SECOND).cast("bigint")
    clock = F.timestamp_seconds(seconds)
    utc = F.date_format(F.to_utc_timestamp(clock, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")
    offset = F.when(key % 2 == 0, F.lit("+00:00")).otherwise(F.lit(""))
    return base_rows(spark, sf_dir).select(
        c("n_name").alias("artist_search"),
        F.concat(utc, offset).alias("extracted_at"),
        _unless((item == 0) & (key % 4 == 0), _record(BRONZE["data"].dataType, recordings=recordings)).alias(
            "data"
        ),
    )
