"""Quality rules as weak supervision.

Each rule looks at one property of a text and votes good (1), bad (-1) or abstains (0). Nobody says which rule
to trust: expectation- maximisation over all documents estimates, for either class, how often each rule votes
each way, and with it the chance that a document is good given all its votes. The votes of all documents are
first counted by pattern, of which there are at most 3 to the power of the number of rules whatever the corpus;
the iterations run over those counts."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import BLANKS, fresh, staged, words

SYMBOLS = r"[#*$%&|<>]"

# Very common words of English, French, German and Spanish.
COMMON_WORDS = (
    "a al an and are as at be by das de del den der des die du ein el elle en es est et for from für hat he il in is ist it "
    "la las le les los mit nicht no of on or para pas por pour que qui se sie su sur that the this to un una und une von was "
    "with y zu"
).split()

# Rules: a ratio of two measures, and the bounds of good and bad. (name, numerator, denominator, bad below, good
# from, good to, bad above)
RULES = (
    ("symbols", "n_symbols", "n_words", None, 0.0, 0.02, 0.1),
    ("repeated words", "n_repeat_words", "n_words", None, 0.0, 0.15, 0.4),
    ("repeated lines", "n_dup_lines", "n_lines", None, 0.0, 0.1, 0.34),
    ("word length", "word_chars", "n_words", 3.0, 3.5, 7.0, 10.0),
    ("different words", "n_different_words", "n_words", 0.15, 0.35, 1.0, None),
    ("letters", "n_letters", "word_chars", 0.6, 0.8, 1.0, None),
    ("common words", "n_common_words", "n_words", 0.01, 0.05, 0.7, 0.9),
    ("sentence ends", "n_ended_lines", "n_lines", 0.1, 0.6, 1.0, None),
)
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MEASURES = [*BASE, "n_lines", "n_different_words", "n_letters", "n_common_words", "n_ended_lines"]


def measured(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """The frame with one struct column of measures and one of votes added; returns it and the two columns'
    names.

    A null text is an empty one: all measures 0, all rules abstain. Every step is an array or string function,
    so whole texts are measured without a shuffle; repeated three-word windows are found by sorting a text's
    window hashes, not by comparing pairs."""
    t, w, lines, tri, runs, at = (fresh(docs, s) for s in ("text_", "words", "lines", "windows", "runs", "at"))
    names = {"measures": fresh(docs, "measures"), "votes": fresh(docs, "votes")}
    df = docs.withColumn(t, F.coalesce(F.col(text_col), F.lit("")))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    df = df.withColumn(w, words(F.col(t))).withColumn(lines, F.filter(F.split(t, "\n", -1), has_word))

    window = lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    df = df.withColumn(
        tri, F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)).otherwise(F.array().cast("array<bigint>"))
    )
    # Most texts repeat no window, which the number of different hashes tells; the others sort (hash, place).
    with_place = F.array_sort(F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn(runs, F.when(F.size(F.array_distinct(tri)) < F.size(tri), with_place))
    met = lambda i: (F.get(runs, i)["h"] == F.get(runs, i - 1)["h"]) | (F.get(runs, i)["h"] == F.get(runs, i + 1)["h"])
    df = df.withColumn(
        at,
        F.when(
            F.col(runs).isNotNull(),
            F.transform(
                F.filter(F.sequence(F.lit(0), F.size(runs) - 1), lambda i: F.coalesce(met(i), F.lit(False))),
                lambda i: F.get(runs, i)["i"],
            ),
        ).otherwise(F.array().cast("array<int>")),
    )
    covered = F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2))))

    stripped = lambda pattern: F.length(F.regexp_replace(t, pattern, ""))
    made = {
        "n_words": F.size(w),
        "word_chars": stripped(BLANKS),
        "n_symbols": F.length(t) - stripped(SYMBOLS),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.size(covered),
        "n_lines": F.size(lines),
        "n_different_words": F.size(F.array_distinct(w)),
        "n_letters": stripped(r"\P{L}+"),
        "n_common_words": F.size(F.filter(w, lambda x: F.lower(x).isin(COMMON_WORDS))),
        "n_ended_lines": F.size(F.filter(lines, lambda x: x.rlike(r"[.!?…][\"'»”)]*[\x20\x09-\x0D]*\z"))),
    }
    df = df.withColumn(names["measures"], F.struct(*[made[m].cast("bigint").alias(m) for m in MEASURES]))
    votes = F.array(*[vote(rule, F.col(names["measures"])) for rule in RULES])
    return df.withColumn(names["votes"], votes).drop(t, w, lines, tri, runs, at), names


def vote(rule: tuple, m: Column) -> Column:
    _, above, below, bad_below, good_from, good_to, bad_above = rule
    x = m[above].cast("double") / F.when(m[below] > 0, m[below]).cast("double")
    bad = F.lit(False)
    if bad_below is not None:
        bad = bad | (x < bad_below)
    if bad_above is not None:
        bad = bad | (x > bad_above)
    return F.when(x.isNull(), 0).when(bad, -1).when(x.between(good_from, good_to), 1).otherwise(0)


@dataclass(frozen=True)
class VoteModel:
    """The share of good documents, and for class good and bad how often each rule votes -1, 0, 1."""

    good: float = 0.9
    votes: dict[str, list[list[float]]] = field(default_factory=dict)
    rounds: int = 0

    def posterior(self, votes: Column) -> Column:
        """The chance that a document with these votes is good."""
        odds = F.lit(math.log(self.good) - math.log1p(-self.good))
        for j, (a, b) in enumerate(zip(self.votes["good"], self.votes["bad"], strict=True)):
            weight = [math.log(p) - math.log(q) for p, q in zip(a, b, strict=True)]
            # A rule may turn out to be worthless, but its bad vote never speaks for a document nor its good
            # vote against one.
            weight[0], weight[2] = min(weight[0], 0.0), max(weight[2], 0.0)
            v = F.get(votes, F.lit(j))
            odds = odds + F.when(v == -1, weight[0]).when(v == 1, weight[2]).otherwise(weight[1])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def fit_votes(votes: DataFrame, column: str, rounds: int = 40, tolerance: float = 1e-4) -> VoteModel:
    """Expectation-maximisation from all documents' votes. It starts from the guess that a document with a bad
    vote is bad. Without documents the model is a flat one, under which everything is good. Half a document is
    added to each count."""
    n_rules = len(RULES)
    patterns = staged(votes.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n")), "patterns")
    posterior = F.when(F.array_contains("v", -1), 0.1).otherwise(0.95)
    model = VoteModel(0.9, {c: [[1 / 3] * 3 for _ in range(n_rules)] for c in ("good", "bad")})
    for k in range(rounds):
        # One row of sums a round: the expected number of good documents, and of good ones by rule and vote; the
        # rest are bad.
        p = patterns.coalesce(1).withColumn("p", posterior * F.col("n"))
        sums = [F.sum("p"), F.sum("n")]
        for j in range(n_rules):
            for v in (-1, 0, 1):
                chosen = F.get("v", F.lit(j)) == v
                sums += [F.sum(F.when(chosen, F.col("p"))), F.sum(F.when(chosen, F.col("n")))]
        s = [float(x or 0) for x in p.agg(*sums).first()]
        if s[1] == 0:
            break
        share = min(max((s[0] + 0.5) / (s[1] + 1), 1e-6), 1 - 1e-6)
        tables = {"good": [], "bad": []}
        for j in range(n_rules):
            cells = [s[2 + 6 * j + 2 * i : 4 + 6 * j + 2 * i] for i in range(3)]
            tables["good"].append([(g + 0.5) / (s[0] + 1.5) for g, _ in cells])
            tables["bad"].append([(n - g + 0.5) / (s[1] - s[0] + 1.5) for g, n in cells])
        moved = abs(share - model.good)
        model = VoteModel(share, tables, k + 1)
        posterior = model.posterior(F.col("v"))
        if moved < tolerance:
            break
    return model


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the base measures, base_failed, kept and quality (the chance that it is
    good). A document is kept if it passes the base rule and its quality is at least one half; ties count as
    good. Repeated rows get equal answers."""
    df, names = measured(docs, text_col)
    m = F.col(names["measures"])
    rows = df.select(F.col(id_col).alias("doc_id"), *[m[c].alias(c) for c in BASE], base_failed(m).alias("base_failed"), F.col(names["votes"]).alias("votes"))
    rows = staged(rows, "votes")
    quality = fit_votes(rows, "votes").posterior(F.col("votes"))
    kept = ~F.col("base_failed") & (quality >= 0.5)
    return rows.select("doc_id", *BASE, "base_failed", kept.alias("kept"), quality.alias("quality"), "votes")


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows that `judge` keeps, with their own columns. Each text is measured once: the rows are written with
    their votes, which are counted over all of them, and then judged where they are read again."""
    df, names = measured(docs, text_col)
    failed = fresh(docs, "failed")
    rows = df.withColumn(failed, base_failed(F.col(names["measures"]))).select(*docs.columns, failed, names["votes"])
    rows = staged(rows, "voted")
    model = fit_votes(rows, names["votes"])
    return rows.where(~F.col(failed) & (model.posterior(F.col(names["votes"])) >= 0.5)).select(*docs.columns)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
