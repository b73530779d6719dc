"""Mixing sources to target weights by Poisson replication.

Each source has a rate: how often one of its documents shall occur on average. A document's count is the Poisson
quantile, at that rate, of a number that a hash of seed and document spreads evenly over (0, 1): the same on
every run and on any cluster. Documents are repeated by their count and sorted by another hash, which shuffles
them globally."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import fresh, left_join_table

SEED = 20240601
# Rates above this are split into equal parts, whose independent counts are added; a part's quantile table stays
# short.
PART_RATE = 16.0
TABLE = 96


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) with 52 bits, from the MD5 of the parts joined by colons."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def poisson_count(rate: Column, key: Column, seed: int = SEED) -> Column:
    """The quantile of Poisson(rate) at a hash of (seed, key). Rates up to PART_RATE take one look-up; a null or
    non-positive rate gives 0."""
    rate = F.greatest(F.coalesce(rate.cast("double"), F.lit(0.0)), F.lit(0.0))
    parts = F.greatest(F.ceil(rate / PART_RATE), F.lit(1))
    part = rate / parts
    # How many k have P(X <= k) below the number u; terms by P(k) = P(k-1) * rate / k, summed from the left.

    def quantile(u: Column) -> Column:
        first = F.exp(-part)
        start = F.struct(u.alias("u"), part.alias("r"), first.alias("p"), first.alias("c"), F.lit(0).alias("n"))

        def step(acc: Column, k: Column) -> Column:
            p = acc["p"] * acc["r"] / k
            n = acc["n"] + (acc["c"] < acc["u"]).cast("int")
            return F.struct(acc["u"].alias("u"), acc["r"].alias("r"), p.alias("p"), (acc["c"] + p).alias("c"), n.alias("n"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(TABLE)), start, step, lambda acc: acc["n"])

    draws = F.sequence(F.lit(1).cast("bigint"), parts)
    return F.aggregate(draws, F.lit(0), lambda n, j: n + quantile(uniform(F.lit(seed), key, j)))


def target_rates(docs: DataFrame, weights: dict[str, float] | None = None, size: float = 1.0, smoothing: float = 0.5,
                 source_col: str = "source") -> DataFrame:
    """(source, rate): how often each source's documents shall occur so that it makes up its share of size *
    rows.

    `weights` names the shares (sources not named get none; they need not add up to 1). Without it, shares
    follow the sources' row counts to the power `smoothing`. A null source is a source of its own, named only by
    the second way."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n"))
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(smoothing)))
    else:
        named = docs.sparkSession.createDataFrame(list(weights.items()) or [("", 0.0)], "source string, weight double")
        counts = counts.join(F.broadcast(named), "source", "left").fillna(0.0, ["weight"])
    total = counts.agg(F.sum("n"), F.sum("weight")).first()
    scale = size * (total[0] or 0) / total[1] if total[1] else 0.0
    return counts.select("source", (F.col("weight") * F.lit(scale) / F.col("n")).alias("rate"))


def document_key(doc_id: Column, text: Column) -> Column:
    """What a document is known by: its id, or its text's digest where the id is null."""
    return F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))


def order_key(key: Column, copy: Column, seed: int = SEED) -> Column:
    """Where a copy stands in the shuffled order."""
    return F.md5(F.concat_ws(":", F.lit("order"), F.lit(str(seed)), key, copy.cast("string")))


def mix(docs: DataFrame, rates: DataFrame, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", copy_col: str = "copy", order_col: str = "order_key") -> DataFrame:
    """Every document as often as its count says, in globally shuffled order, with columns `copy` (from 1) and
    `order_key` added; columns of the input by those names are replaced.

    A document is known by its id, or by its text's digest where the id is null; repeated rows get the same
    count. A source without a rate is left out; a null source takes the rate of null. Texts may be null. No
    documents give no rows."""
    key, rate, n = fresh(docs, "key"), fresh(docs, "rate"), fresh(docs, "n")
    rows = docs.drop(copy_col, order_col)
    rows = rows.withColumn(key, document_key(F.col(id_col), F.col(text_col)))
    # Source names may differ from `rates` only in the column's name.
    rates = rates.select(F.col("source").alias(source_col), F.col("rate").alias(rate))
    rows = left_join_table(rows, rates, source_col)
    rows = rows.withColumn(n, poisson_count(F.col(rate), F.col(key), seed))
    rows = rows.withColumn(copy_col, F.explode(F.when(F.col(n) > 0, F.sequence(F.lit(1), F.col(n)))))
    return rows.withColumn(order_col, order_key(F.col(key), F.col(copy_col), seed)).drop(key, rate, n).orderBy(order_col)


def mix_rows(docs: DataFrame) -> DataFrame:
    """The mixed documents with the columns of the input only."""
    return mix(docs, target_rates(docs), copy_col=fresh(docs, "copy"), order_col=fresh(docs, "order")).select(*docs.columns)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs, target_rates(docs)).select("doc_id", "text", "lang", "source", "n_chars", "copy", "order_key")
