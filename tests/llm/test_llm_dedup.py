"""Exact and near de-duplication, components and mixing against brute force."""

import hashlib
import math
import os
import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from conftest import SF
from llm_cases import hard_documents

import corpus_pipeline
from stratalake.llm import bpe, exact_dedup, mixing, near_dup, quality
from stratalake.llm.components import components
from stratalake.llm.registry import QUERIES


def test_of_equal_texts_the_smallest_id_stays(spark):
    rows = exact_dedup.find_duplicates(hard_documents(spark), exact_dedup.new_index(spark)).collect()
    prose = [r for r in rows if r.group_size == 4]
    assert [r.doc_id for r in prose if r.kept] == [1] and {r.keep_id for r in prose} == {1}
    empty = {r.doc_id: r for r in rows if r.doc_id in (3, 4, 5)}
    assert (empty[3].keep_id, empty[4].keep_id, empty[5].keep_id) == (3, 3, 5)
    assert sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})


def test_of_repeated_rows_one_stays(spark):
    df = spark.createDataFrame([(7, "same"), (7, "same"), (7, " same"), (None, "n"), (None, "n")], "doc_id bigint, text string")
    kept = exact_dedup.drop_duplicates(df).collect()
    assert sorted(map(repr, kept)) == sorted(map(repr, [df.where("text = ' same'").first(), df.where("text = 'same'").first(), df.where("text = 'n'").first()]))


def documents(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id bigint, text string")


def forget_catalog(spark):
    """Only the catalog's entries, as a new session would; the files stay."""
    for table in spark.catalog.listTables():
        if table.name.startswith("digests_"):
            spark.sql(f"DROP TABLE {table.name}")


def test_index_persists_and_takes_batches(spark, folder):
    index = exact_dedup.DigestIndex(spark, f"{folder}/index", buckets=4)
    exact_dedup.find_duplicates(documents(spark, (5, "a"), (6, "b")), index).collect()
    forget_catalog(spark)
    index = exact_dedup.DigestIndex(spark, f"{folder}/index", buckets=4)
    second = documents(spark, (1, "a"), (2, "c"), (3, "c"))
    found = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.find_duplicates(second, index).collect()}
    assert found == {1: (5, False), 2: (2, True), 3: (2, False)}
    again = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.find_duplicates(second, index).collect()}
    assert again == found and index.rows().count() == 3


def test_reopened_index_keeps_its_buckets(spark, folder):
    """Three sessions, each asking for another number of buckets."""
    docs = spark.range(300).selectExpr("id doc_id", "concat('text ', id) text")
    for buckets in (8, 3, 16):
        forget_catalog(spark)
        index = exact_dedup.DigestIndex(spark, f"{folder}/index", buckets=buckets)
        assert index.buckets == 8
        found = exact_dedup.find_duplicates(docs, index).collect()
        assert all(r.kept and r.keep_id == r.doc_id for r in found)
        assert index.rows().count() == 300


def test_indexes_of_similar_paths_are_apart(spark, folder):
    deep = "x" * 120
    paths = [f"{folder}/a_b/{deep}", f"{folder}/a-b/{deep}", f"{folder}/a/b/{deep}"]
    for n, path in enumerate(paths):
        index = exact_dedup.DigestIndex(spark, path, buckets=2)
        assert index.rows().count() == 0
        exact_dedup.find_duplicates(documents(spark, *[(i, f"t{i}") for i in range(n + 1)]), index).collect()
    assert [exact_dedup.DigestIndex(spark, p).rows().count() for p in paths] == [1, 2, 3]


def test_a_folder_of_something_else_is_no_index(spark, folder):
    spark.range(3).write.parquet(folder)
    with pytest.raises(ValueError):
        exact_dedup.DigestIndex(spark, folder)


def test_generations_are_merged_and_unfinished_ones_ignored(spark, folder, monkeypatch):
    monkeypatch.setattr(exact_dedup, "GENERATIONS", 2)
    index = exact_dedup.DigestIndex(spark, f"{folder}/index", buckets=2)
    for n in range(5):
        exact_dedup.find_duplicates(documents(spark, (n, f"t{n}"), (n + 100, "t0")), index).collect()
        assert len(index.generations()) <= 3 and index.rows().count() == n + 1
    # What dead runs leave: a merge that was marked and not finished, a generation without its mark.
    os.makedirs(f"{folder}/index/merged=90")
    os.makedirs(f"{folder}/index/generation=91")
    index = exact_dedup.DigestIndex(spark, f"{folder}/index")
    assert index.rows().count() == 5
    exact_dedup.find_duplicates(documents(spark, (9, "t9")), index).collect()
    assert sorted(r.keep_id for r in index.rows().collect()) == [0, 1, 2, 3, 4, 9]


@pytest.mark.parametrize("batches", [1, 2, 7])
def test_batches_of_a_corpus_give_one_answer(spark, folder, batches):
    rng = random.Random(batches)
    docs = [(rng.choice([None, i - 30, i, 1 << 62, -(1 << 62)]), rng.choice("abcdefgh")) for i in range(120)]
    index = exact_dedup.DigestIndex(spark, f"{folder}/index", buckets=3)
    rows = exact_dedup.find_duplicates(documents(spark, *docs).repartition(4), index, batches=batches).collect()
    ids = {t: [d for d, x in docs if x == t] for _, t in docs}
    best = {hashlib.sha256(t.encode()).hexdigest(): (min((d for d in of if d is not None), default=None), len(of)) for t, of in ids.items()}
    assert len(rows) == len(docs) and sum(r.kept for r in rows) == len(best)
    assert all((r.keep_id, r.group_size) == best[r.text_sha256] for r in rows)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_index_is_neither_shuffled_nor_sorted(spark, folder):
    index = exact_dedup.DigestIndex(spark, f"{folder}/index", buckets=4)
    for n in range(2):
        exact_dedup.find_duplicates(documents(spark, *[(1000 * n + i, f"{n} {i}") for i in range(200)]), index).collect()
    groups = spark.range(50).selectExpr("cast(id as string) digest", "id keep_id")
    plan = index.unseen(groups)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("LeftAnti") == 2
    # One exchange and one sort, both of the batch.
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def word_sets(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(docs):
    """{doc_id: smallest id of its component} by comparing all pairs."""
    sets = [(d, word_sets(t)) for d, t in docs]
    root = {d: d for d, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d, _ in docs}


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_equal_brute_force(spark):
    rng, docs = random.Random(3), []
    for group in range(12):
        base = " ".join(f"w{group}x{rng.randrange(60)}" for _ in range(rng.choice([3, 6, 9, 40, 150])))
        docs += [edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 6])) for _ in range(18)]
    # A star: each copy is near the base alone. A chain: each copy is near its neighbours alone.
    star = " ".join(f"s{i}" for i in range(200))
    docs += [star, *(edited(random.Random(k), star, 4) for k in range(40))]
    docs += [" ".join(f"c{i}" for i in range(10 * k, 10 * k + 100)) for k in range(30)]
    docs += ["", " \n", "One", "one", "ONE two", "É b c d e f", "é b c d e f"]
    docs = [(i * 7 % 1009, t) for i, t in enumerate(docs)]
    found = near_dup.group_near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(docs)
    assert {r.doc_id: r.n_shingles for r in found} == {d: len(word_sets(t)) for d, t in docs}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_buckets_of_many_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 1200)
    rng = random.Random(5)
    base = " ".join(f"w{i}" for i in range(120))
    docs = [(i, edited(rng, base, rng.choice([1, 2, 3, 4, 5]))) for i in range(260)]
    found = near_dup.group_near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(docs)


def test_near_duplicates_of_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op6_minhash"](spark, SF).collect()
    assert {r.doc_id: r.component_id for r in found} == brute_components(docs)


def test_densified_bins_agree_as_often_as_sets_are_similar():
    rng, same, union = np.random.default_rng(1), 0, 0
    for _ in range(300):
        pool = np.unique(rng.integers(0, 2**63, 9, np.uint64))
        a, b = near_dup.bucket_keys(pool[:8]), near_dup.bucket_keys(pool[1:])  # 7 of 9 shared
        same, union = same + (a == b).sum(), union + len(a)
    assert abs(same / union - (7 / 9) ** near_dup.BAND_BINS) < 0.03
    one = near_dup.bucket_keys(np.array([5], np.uint64))
    assert len(one) == near_dup.BANDS


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components_equal_brute_force(spark, shape):
    rng = random.Random(2)
    links = {
        "chain": [(k, k + 1) for k in range(200)],
        "star": [(500, k) for k in range(300)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(7, 7)],
    }[shape]
    root = {n: n for link in links for n in link}
    for _ in root:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            changed |= root[a] != least or root[b] != least
            root[a] = root[b] = least
        if not changed:
            break
    rng.shuffle(links)
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in found} == root


def poisson_quantile(rate, u):
    p = c = math.exp(-rate)
    k = 0
    while c < u:
        k += 1
        p *= rate / k
        c += p
    return k


def test_poisson_counts_follow_the_quantile(spark):
    from pyspark.sql import functions as F

    df = spark.range(3000).withColumn("rate", F.when(F.col("id") % 3 == 0, 0.4).when(F.col("id") % 3 == 1, 2.5).otherwise(50.0))
    df = df.select("id", "rate", mixing.poisson_count(F.col("rate"), F.col("id").cast("string")).alias("n"), mixing.uniform(F.lit(mixing.SEED), F.col("id"), F.lit(1)).alias("u"))
    rows = df.collect()
    assert all(r.n == poisson_quantile(r.rate, r.u) for r in rows if r.rate <= mixing.PART_RATE)
    for rate in (0.4, 2.5, 50.0):
        n = np.array([r.n for r in rows if r.rate == rate])
        assert abs(n.mean() - rate) < 5 * (rate / len(n)) ** 0.5 and abs(n.var() / rate - 1) < 0.25
    assert spark.range(1).select(mixing.poisson_count(F.lit(None), F.lit("k"))).first()[0] == 0


def test_shares_approach_their_targets(spark):
    docs = spark.range(20_000).selectExpr("id doc_id", "'t' text", "if(id % 10 = 0, 'small', 'large') source")
    mixed = mixing.mix(docs, mixing.target_rates(docs, weights={"small": 0.5, "large": 0.5}, size=0.5))
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(counts["small"] - 5000) < 400 and abs(counts["large"] - 5000) < 400


def test_pipeline_equals_brute_force(spark):
    """Every stage by its plain definition, over the rows that the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in quality.judge(docs).collect() if r.kept}
    rows = [r for r in docs.collect() if r.doc_id in good]
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(_squeezed(r.text), r)
    rows = list(first.values())
    component = brute_components([(r.doc_id, r.text) for r in rows])
    rows = [r for r in rows if component[r.doc_id] == r.doc_id]
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + 1
    scale = len(rows) / sum(n**0.5 for n in sizes.values())
    coder, want = bpe.WordBpe(bpe.default_path()), []
    for r in rows:
        copies = poisson_quantile(scale * sizes[r.source] ** 0.5 / sizes[r.source], _uniform(r.doc_id))
        ids = coder.encode(r.text)
        want += [(r.doc_id, len(ids) // 4, ids)] * copies
    found = corpus_pipeline.run(spark, SF).collect()
    got = [(r.doc_id, r.n_tokens, bytes(r.ids)) for r in found]
    assert sorted(got) == sorted(want) and len(got) > 50
    # Copies are told apart, and come with the places that the mixing gave them.
    counts = Counter(r.doc_id for r in found)
    assert sorted((r.doc_id, r.copy) for r in found) == sorted((d, k) for d, n in counts.items() for k in range(1, n + 1))
    assert all(r.order_key == hashlib.md5(f"order:{mixing.SEED}:{r.doc_id}:{r.copy}".encode()).hexdigest() for r in found)


def _squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def _uniform(doc_id):
    digest = hashlib.md5(f"{mixing.SEED}:{doc_id}:1".encode()).hexdigest()
    return (int(digest[:13], 16) + 0.5) / 2**52


def test_clean_documents_stay_in_the_pipeline(spark):
    docs = hard_documents(spark)
    assert 1 in {r.doc_id for r in quality.keep_good(docs).collect()}


def plain_links(groups, sides, sets):
    """Whether a pair that is wanted is linked, by comparing all."""
    n = len(sets)
    return {
        (i, j) for i in range(n) for j in range(i)
        if groups[i] != groups[j] and (not any(sides) or sides[i] or sides[j])
        and 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    }


@pytest.mark.parametrize("seed", range(12))
def test_links_of_a_block_join_what_all_pairs_join(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(60):
        if sets and rng.random() < 0.5:
            base = sets[rng.integers(len(sets))]
            kept = base[rng.random(len(base)) < 0.9]
            made = np.concatenate([kept, rng.integers(0, 1 << 40, rng.integers(0, 3)).astype(np.uint64)])
        else:
            made = rng.integers(0, 60 if seed % 2 else 1 << 40, rng.integers(1, 12)).astype(np.uint64)
        sets.append(np.unique(made if len(made) else np.array([1], np.uint64)))
    groups = [int(g) for g in rng.integers(0, 50, 60)]
    sides = [int(x) for x in rng.random(60) < 0.3] if seed % 3 == 0 else [0] * 60
    found = near_dup.block_links(list(range(60)), groups, sides, sets)

    def classes(pairs):
        root = list(groups)
        for a, b in pairs:
            x, y = root[a], root[b]
            root = [x if r == y else r for r in root]
        return [root.index(r) for r in root]

    wanted = plain_links(groups, sides, sets)
    assert classes(found) == classes(wanted)
    assert all((max(a, b), min(a, b)) in wanted or groups[a] == groups[b] for a, b in found)


def test_short_texts_with_a_shingle_in_common_take_time_in_proportion():
    """Six-word texts that share one of two shingles: no pair is linked, and none is compared."""
    def seconds(n):
        sets = [np.array([1, i + 2], np.uint64) for i in range(n)]
        began = time.perf_counter()
        assert near_dup.block_links(list(range(n)), list(range(n)), [0] * n, sets) == []
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(200_000) < 40 * max(seconds(20_000), 0.01)
