"""From raw documents to token ids: quality rules, exact dedup, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a frame. `run` writes every stage's rows as Parquet below the
shared work folder and reads them back for the next, so a lost executor costs one stage's tasks and no stage is
computed twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.bpe import decode_documents, encode_documents
from stratalake.llm.common import fresh, staged
from stratalake.llm.exact_dedup import drop_duplicates
from stratalake.llm.mixing import document_key, mix_rows, order_key
from stratalake.llm.near_dup import drop_near_duplicates
from stratalake.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rules, weighed against each other over all documents, call good."""
    return keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return drop_duplicates(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources approach their target shares, in shuffled order."""
    return mix_rows(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every remaining copy, the SHA-256 of the text that its ids decode to, and what tells
    copies apart: copy (from 1 for each document) and order_key, by which sorting gives the mixed order."""
    key = fresh(docs, "key")
    keyed = docs.withColumn(key, document_key(F.col("doc_id"), F.col("text")))
    rows = decode_documents(encode_documents(keyed, carry=(key,)))
    rows = rows.withColumn("decoded_sha256", F.sha2("decoded", 256))
    same = Window.partitionBy(key, "decoded_sha256").orderBy("n_tokens")
    rows = rows.withColumn("copy", F.row_number().over(same))
    return rows.select("doc_id", "n_tokens", "ids", "decoded_sha256", "copy", order_key(F.col(key), F.col("copy")).alias("order_key"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encode", bpe_encode),
]

# Posterior votes, similarity components and merges can't be put in SQL; the tests hold the rows against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
