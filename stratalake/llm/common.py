"""What the operators share: staged tables, fresh column names, joins of a checked size, global ranks."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.session import work_dir

# The class of white space that the operators split words at: space and \t \n \v \f \r.
BLANKS = r"[\x20\x09-\x0D]+"

# A table of at most this many rows, of a few short columns each, may be broadcast: some tens of MB.
BROADCAST_ROWS = 100_000
SALTS = 32


def importable(df: DataFrame) -> DataFrame:
    """Let Python workers import this package where they see the driver's copy of it (one machine, or a shared
    disk) but were started elsewhere; other clusters install the package or get it by --py-files. Returns the
    frame."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return df


def map_arrow(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    return importable(df).mapInArrow(run, schema)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write the frame below the shared work folder and read it back: cuts the lineage, survives the loss
    of executors, and makes row tags and random choices final."""
    path = work_dir(df.sparkSession, label)
    # Texts take a third less room this way than by the default codec, for a few CPU seconds per GB.
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have, in whatever case."""
    taken, name = {c.lower() for c in df.columns}, f"_{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """The maximal runs without white space; null counts as empty."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), lambda w: w != "")


def left_join_table(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left-join a per-key table, null keys matching each other. The table is broadcast when its counted rows
    are at most BROADCAST_ROWS; beyond that rows are spread over SALTS parts of each key and the table
    is repeated once per part, so that a key with a third of all rows does not meet in one task."""
    mine, salt = fresh(rows, "key"), fresh(rows, "salt")
    table = table.withColumnRenamed(key, mine)
    if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), rows[key].eqNullSafe(table[mine]), "left").drop(mine)
    other = fresh(rows, "salt_")
    rows = rows.withColumn(salt, F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    table = table.withColumn(other, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    same = rows[key].eqNullSafe(table[mine]) & (rows[salt] == table[other])
    return rows.join(table, same, "left").drop(mine, salt, other)


def global_rank(df: DataFrame, order: list[str], name: str, label: str) -> tuple[DataFrame, int]:
    """Number all rows from 0 in the order of the given columns, and count them. Rows are range-partitioned, sorted in
    parts and staged with their place in the part; only one count per part passes through the driver.
    Ties in all columns of `order` are numbered in any order, fixed once staged."""
    spark, place, part = df.sparkSession, fresh(df, "place"), fresh(df, "part")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = staged(ranged.withColumn(place, F.monotonically_increasing_id()), label)
    ranged = ranged.withColumn(part, F.shiftright(place, 33)).withColumn(place, F.col(place).bitwiseAND((1 << 33) - 1))
    starts, total = [], 0
    for p, n in sorted(tuple(r) for r in ranged.groupBy(part).count().collect()):
        starts.append((p, total))
        total += n
    offsets = spark.createDataFrame(starts, f"{part} bigint, {name} bigint")
    ranked = ranged.join(F.broadcast(offsets), part).withColumn(name, F.col(name) + F.col(place))
    return ranked.drop(place, part), total
