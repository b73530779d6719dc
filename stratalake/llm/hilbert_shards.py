"""Shards along a Hilbert curve.

Language, source and length are quantised to six bits each by their place in the order of the corpus, a Hilbert
curve joins the three to one index, and documents sorted by it are cut into runs of equal row count. Neighbours
on the curve are near in all three, so each shard's files have narrow bounds in every dimension and a filter on
any of them skips most."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import global_rank, importable, left_join_table

BITS = 6
SHARDS = 40
OVERHEAD = 16


def hilbert_index(axes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of each row of coordinates (n, dimensions), each below 2**bits. Works on
    whole columns: rotations and reflections from the highest bit down, then a Gray code over the interleaved
    bits."""
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        low = q - 1
        for d in range(dims):
            high = (x[d] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if d:
                x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
    x ^= flip
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            index = index << 1 | (x[d] >> b & 1)
    return index


def quantised(docs: DataFrame, column: str, out: str, bits: int = BITS) -> DataFrame:
    """The frame with `out` added: the value's place among the column's distinct values in order, scaled to
    2**bits cells; nulls are in cell 0. The distinct values are ranked by range partitions, so there may be any
    number of them."""
    distinct = docs.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    ranked, n = global_rank(distinct, ["value"], "rank", "values")
    cells = ranked.select(F.col("value").alias(column), F.floor(F.col("rank") * (1 << bits) / max(n, 1)).cast("int").alias(out))
    return left_join_table(docs, cells, column).fillna(0, [out])


def length_cell(size: Column, bits: int = BITS) -> Column:
    """Two cells per doubling of the size from 16 bytes on; sizes of 49 GB (2**35.5) and more share the last."""
    return F.least(F.floor(F.log2(size.cast("double")) * 2 - 8), F.lit((1 << bits) - 1.0)).cast("int")


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                  dimensions: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, curve, shard, slot. Shard sizes differ by one row at
    most; slots number each shard's rows from 0 along the curve. size is the text's bytes in UTF-8 plus 16, a
    null text has none and the checksum of the empty text. Rows of one cell are ordered by id (nulls first),
    then checksum and size; rows equal in all these are interchangeable. Fewer rows than shards leave some
    shards empty. Texts themselves are not moved."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("bigint") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col(dimensions[0]).alias("dim0"),
        F.col(dimensions[1]).alias("dim1"),
    )
    rows = quantised(quantised(rows, "dim0", "x"), "dim1", "y").withColumn("z", length_cell(F.col("size")))

    @F.pandas_udf("bigint")
    def curve(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.column_stack([x, y, z])))

    rows = importable(rows).select("doc_id", "size", "text_crc32", curve("x", "y", "z").alias("curve"))
    ranked, n = global_rank(rows, ["curve", "doc_id", "text_crc32", "size"], "place", "curve")
    # Shard s holds the places from floor(s * n / shards): runs of n / shards rows, rounded up or down.
    shard = F.expr(f"((place + 1) * {shards} - 1) div {max(n, 1)}")
    start = F.expr(f"(shard * {n}) div {shards}")
    return ranked.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", "curve", "shard", (F.col("place") - start).cast("bigint").alias("slot")
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the documents as one folder of Parquet per shard, each in slot order. Ids must be unique and not
    null for this."""
    place = assigned.select(F.col("doc_id").alias(id_col), "shard", "slot")
    rows = docs.drop("shard", "slot").join(place, id_col)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )
