"""Hard input that every operator and stage must take: nulls anywhere, empty and very long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
PROSE = (
    "The committee met on Tuesday to review the plans for the new bridge. It was agreed that the work should begin in the spring, "
    "once the river is low and the roads are dry. The cost of the bridge is to be shared by the two towns on its banks. "
    "Both of them have long asked for a safe way to cross. A report on the design will be read to the public in May."
)
ROWS = [
    (1, PROSE, "en", "a", 1),
    (2, PROSE.replace(" ", "  "), "en", "a", 1),
    (2, PROSE.replace(" ", "  "), "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", "fr", "b", 3),
    (None, PROSE, None, "b", None),
    (None, "four words only here", "en", None, 1),
    (6, "four words only here", "de", "b", 1),
    (7, LONG, "en", "c", 2),
    (8, LONG + " tail", "en", "c", 2),
    (9, "été ÉTÉ ñ 日本語 \U0001f600", "fr", "c", 2),
    (9, "another text under the same id", "fr", "c", 2),
    (10, "x" * 50_000, "en", "a", 9),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ["tag", "_tag", "kept", "digest", "_digest", "key", "_key", "copy", "order_key", "rate", "n", "node", "block", "shard", "slot",
            "place", "_place", "_part", "votes", "_votes", "value", "file", "host", "tokens", "set_hash", "ids", "Keep_Id", "id"]


def hard_documents(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHING])


def no_documents(spark):
    return hard_documents(spark).where("false")
