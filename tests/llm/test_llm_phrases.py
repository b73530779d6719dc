"""Phrases and hard negatives against brute force."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from llm_cases import hard_documents, no_documents
from pyspark.sql import functions as F

from stratalake.llm import hard_negatives as hn
from stratalake.llm import phrases as ph

DOCS = "doc_id bigint, text string, lang string"


def brute_phrases(docs, longest, least, top):
    counts, totals = {}, Counter()
    for _, text, lang in docs:
        lang = lang if lang is not None else "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = lambda p, q: len(p) < len(q) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        rows = []
        for p, a in candidates.items():
            if any(inside(p, q) and 100 * b >= 80 * a for q, b in candidates.items()):
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        rows.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(rows[:top])]
    return sorted(out)


def as_rows(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("seed, least, top, held", [(1, 3, 2000, 10**7), (2, 5, 7, 300), (3, 2, 40, 1)])
def test_phrases_equal_brute_force(spark, monkeypatch, seed, least, top, held):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "Éa", "éa", "a\x00b", "\xa0", "x-y", "ok", "u\x1cv\x85", "."]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "\x0b", " ; "]
    text = lambda: "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randint(0, 40)))
    fixed = "new york city hall, " * 3 + "ice cream van"
    docs = [(i, rng.choice([text(), text(), fixed, None, ""]), rng.choice(["en", "fr", None, "und"])) for i in range(80)]
    monkeypatch.setattr(ph, "HELD_BYTES", held)
    df = spark.createDataFrame(docs, DOCS).repartition(4)
    got = ph.collocations(df, least=least, top=top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert as_rows(got) == brute_phrases(docs, 4, least, top)


def test_phrase_counts_do_not_depend_on_the_filter(spark, monkeypatch):
    docs = hard_documents(spark).select("doc_id", "text", "lang")
    want = brute_phrases([tuple(r) for r in docs.collect()], 4, 2, 50)
    monkeypatch.setattr(ph.Filter, "has", lambda self, h: np.ones(len(h), bool))
    assert as_rows(ph.collocations(hard_documents(spark), least=2, top=50)) == want



def test_phrases_of_nothing(spark):
    assert ph.collocations(no_documents(spark)).collect() == []
    empty = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, " . ", "en")], DOCS)
    assert ph.collocations(empty, least=1).collect() == []


def brute_negatives(rows):
    """rows: (vec_id, label, vector), anchors those whose id 5 divides."""
    whole = []
    for i, (vec, label, v) in enumerate(rows):
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole.append((i, vec, label, [int(np.floor(Fraction(float(x)) * 256)) for x in v]))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    key = lambda s, r: (-s, r[1] is None, r[1] or 0)
    out = []
    for a in whole:
        if a[1] is None or a[1] % 5:
            continue
        scored = [(dot(a[3], b[3]), b) for b in whole if b[0] != a[0]]
        positives = sorted((x for x in scored if x[1][2] == a[2]), key=lambda x: key(*x))[: hn.POSITIVES]
        for p, b in positives:
            fit = sorted((x for x in scored if x[1][2] != a[2] and 50 * p <= 100 * x[0] <= 95 * p), key=lambda x: key(*x))
            out += [(a[1], b[1], k + 1, n[1], p, s) for k, (s, n) in enumerate(fit[: hn.NEGATIVES])]
    return sorted(out, key=repr)


def mined(df):
    return sorted((tuple(r) for r in hn.mine_hard_negatives(df, F.col("vec_id") % 5 == 0).collect()), key=repr)


VECTORS = "vec_id bigint, label int, embedding array<double>, row string, task string, v int, anchor int"
CLASH = ("own", "own", 1, 2)


@pytest.mark.parametrize("seed, block, task, chunk", [(1, 2048, 16384, 8192), (2, 7, 20, 3), (3, 16, 16, 2), (4, 5, 1000, 1000)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, seed, block, task, chunk):
    for name, value in (("BLOCK_ROWS", block), ("TASK_ROWS", task), ("ANCHORS_HELD", chunk), ("LEAST_TASKS", 1)):
        monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 6))
    rows = []
    for i in range(120):
        label = int(rng.integers(0, 4)) if i % 3 else 0
        v = centres[label] * 0.5 + rng.normal(size=6) * 0.6
        rows.append((i, label, [float(x) for x in (np.round(v, 1) if seed == 3 else v)]))
    rows += [(200, None, [1.0] * 6), (205, 1, None), (210, 1, [1.0, None, 0, 0, 0, 0]), (215, 1, [float("nan")] * 6), (220, 2, [float("-inf")] * 6)]
    rows += [(225, 2, [0.0] * 6), (230, 2, [0.7] * 3), (235, 3, []), (240, 9, [0.3] * 6), (None, 1, rows[1][2]), (None, 0, rows[3][2])]
    # One text many times over.
    rows += [(1000 + i, 3, rows[7][2]) for i in range(40)]
    df = spark.createDataFrame([(*r, *CLASH) for r in rows], VECTORS).repartition(5)
    assert mined(df) == brute_negatives(rows)


def test_scores_past_64_bits_are_compared_exactly():
    big = 1 << 62
    rows = np.array([[big, 1], [big, 2], [-big, 5]], object)
    best = hn.Best(2, -(1 << 200), 1 << 200)
    hn.threshold_search(hn.Lists(rows), np.array([big, 1], object), np.ones(3, bool), [(False, i, i) for i in range(3)], [best])
    assert [-s for s, _ in best.rows] == [big * big + 2, big * big + 1]
    assert hn.exact(rows, rows) is object and hn.exact(np.array([[3]]), np.array([[4]])) is np.float64


def test_reading_stops_at_the_threshold():
    rng = np.random.default_rng(5)
    rows = rng.integers(0, 1000, (4000, 2))
    best = hn.Best(3, -(1 << 62), 1 << 62)
    anchor = np.array([5, 3])
    scored = hn.threshold_search(hn.Lists(rows), anchor, np.ones(4000, bool), [(False, i, i) for i in range(4000)], [best])
    assert scored < 1000
    assert [-s for s, _ in best.rows] == sorted(rows @ anchor)[:-4:-1]


def test_no_vectors_and_no_anchors(spark):
    none = spark.createDataFrame([], VECTORS)
    assert mined(none) == []
    assert mined(spark.createDataFrame([(1, 1, [1.0], *CLASH), (2, 2, [0.6], *CLASH)], VECTORS)) == []
    assert mined(spark.createDataFrame([(5, 1, [1.0], *CLASH)], VECTORS)) == []
