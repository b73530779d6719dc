"""Decontamination against brute force over all windows."""

import random
import re

import numpy as np
import pytest
from llm_cases import ROWS, hard_documents, no_documents

from stratalake.llm import decontaminate as d

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window):
    wins = {}
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        for i in range(len(w) - m + 1) if w else ():
            wins.setdefault(tuple(w[i : i + m]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, named = set(), set()
        for m in {len(k) for k in wins}:
            for i in range(len(w) - m + 1):
                if (k := tuple(w[i : i + m])) in wins:
                    hit |= set(range(i, i + m))
                    named |= wins[k] - {None}
        out.append((doc, len(w), len(hit), sorted(map(str, named)), bool(hit)))
    return sorted(out, key=repr)


def answers(found):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in found.collect()), key=repr)


def random_case(seed, vocabulary):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "c9", "é", "日本"][:vocabulary]) + rng.choice(["", "", "x"])
    text = lambda n: rng.choice([" ", ", ", "\n"]).join(word() for _ in range(n))
    items = [(rng.choice([i, i, 3, None]), text(rng.randint(0, 14))) for i in range(12)] + [(90, None), (91, "!?")]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    docs += [(100 + i, " ".join([text(3), items[i][1] or "", text(5), items[-4][1] or ""])) for i in range(10)]
    return [*docs, (7, docs[7][1]), (None, docs[8][1]), (200, None)], [*items, items[0]]


@pytest.mark.parametrize("seed, vocabulary, part_bytes", [(1, 5, 10**6), (2, 2, 10**6), (3, 3, 60), (4, 4, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, vocabulary, part_bytes):
    docs, items = random_case(seed, vocabulary)
    frames = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    found = d.find_contaminated(*frames, window=5, part_bytes=part_bytes)
    assert answers(found) == brute(docs, items, 5)


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_is_sorted_and_longest_matches_are_longest(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("abcdefghi"[: 2 + seed]) for _ in range(n))
    body = [text(rng.randint(0, 50)) for _ in range(20)]
    items = [(str(i), text(rng.randint(1, 30)).encode()) for i in range(8)]
    tests = d.Items.of(items, 4)
    docs = [*body, body[0], f"{text(3)} {items[0][1].decode()} zzz {items[1][1].decode()}"]
    ids = [[tests.vocabulary.get(w, 0) for w in d.words_of(t.encode())] + [0] for t in docs]
    shard = d.Shard(np.array([w for t in ids for w in t], np.int32), tests)

    def suffix(at):
        end = at
        while shard.ids[end]:
            end += 1
        return tuple(shard.ids[at:end])

    listed = [suffix(p) for p in shard.order]
    longest = max(len(t.split()) for _, t in items)
    assert [s[:longest] for s in listed] == sorted(s[:longest] for s in listed)
    best, place = shard.longest()
    flat = [w for t in ids for w in t]
    for at, n, where in zip(tests.suffixes, best, place):
        mine = tests.ids[at : at + int(d.run_lengths(tests.ids)[at])]
        common = lambda p: next((k for k in range(len(mine)) if flat[p + k] != mine[k]), len(mine))
        want = max(common(p) for p in range(len(flat)))
        least = min(tests.lengths)
        assert n == want if want >= least else n <= want
        assert where < 0 or common(where) == n


def test_longest_matches_name_item_and_place(spark):
    docs = spark.createDataFrame([(1, "x one two three four y"), (2, "two three four five six"), (3, None)], DOCS)
    items = spark.createDataFrame([(9, "One two three four five"), (8, "six"), (7, "absent")], ITEMS)
    rows = {(r.item_id, r.item_at): (r.n_words, r.doc_id, r.doc_at) for r in d.longest_matches(docs, items, window=3).collect()}
    assert rows == {("9", 0): (4, 1, 1), ("9", 1): (4, 2, 0), ("9", 2): (3, 2, 1), ("8", 0): (1, 2, 4)}


def test_affected_documents_go_and_others_keep_their_columns(spark):
    docs = hard_documents(spark)
    items = spark.createDataFrame([(1, "begin in the spring once the river is low and the roads are dry"), (2, "日本語"), (3, None)], ITEMS)
    kept = d.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r.doc_id for r in kept.collect()))) == sorted(repr(i) for i, t, *_ in ROWS if "spring" not in (t or "") and "日本" not in (t or ""))


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert d.find_contaminated(no_documents(spark), none).collect() == []
    rows = d.find_contaminated(hard_documents(spark), none).collect()
    assert len(rows) == len(ROWS) and not any(r.contaminated for r in rows)
    assert d.longest_matches(hard_documents(spark), none).collect() == []
    assert d.decontaminate(hard_documents(spark), none).count() == len(ROWS)
