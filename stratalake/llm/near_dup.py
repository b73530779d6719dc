"""Near-duplicate groups by one-permutation MinHash.

A document's set of five-word shingles is hashed once. The hash range is cut into bins and each bin keeps its
least value; an empty bin borrows the value of another, chosen by a hash of its own number and an attempt count,
the same for all documents (optimal densification). Three bins make a band, and documents that agree in a band
share a bucket. In a bucket candidates form a star: its centre is compared with the others; those that the star
leaves apart are compared by further stars among themselves. All comparisons are exact, on full sets, and happen
inside blocks of bounded size, from which only links that join something come out, so neither pairs nor sets
pile up for large groups. Linked documents form components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import map_arrow, staged
from stratalake.llm.components import components

SHINGLE_WORDS = 5
LEAST_PERCENT = 75
# A pair of similarity 0.75 misses all 24 bands with a chance of 2 in a million, one of 0.8 with 1 in 30 million.
BANDS, BAND_BINS = 24, 3
BINS = BANDS * BAND_BINS
ATTEMPTS = 4096
SEED = 20240601
# A block of sets that one task compares at once holds about this many shingles at most (8 MB), or one larger
# set and its centre.
BLOCK_SHINGLES = 1_000_000
WORDS_KEPT = 200_000
TEXTS_AT_ONCE = 256

M1, M2, ODD = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
SHIFT = np.uint64(33)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; one-to-one."""
    h = (h ^ (h >> SHIFT)) * M1
    h = (h ^ (h >> SHIFT)) * M2
    return h ^ (h >> SHIFT)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        h = xxhash.xxh64_intdigest(word, SEED)
        if len(word) <= 64:
            self[word] = h
        return h


_words = WordHashes()
_borrow: list[np.ndarray] = []


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles: five words in a row, or all words if there are
    fewer. Words are runs without ASCII white space, with A-Z lowered."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    k = min(SHINGLE_WORDS, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = mixed((out + h[i : i + n]) * ODD)
    return np.unique(out)


def borrowing() -> np.ndarray:
    """For each bin the order in which it asks others for a value when it is empty."""
    if not _borrow:
        _borrow.append(np.random.default_rng(SEED).integers(0, BINS, (BINS, ATTEMPTS), np.uint8))
    return _borrow[0]


def bucket_keys(shingles: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per band, of a non-empty sorted set. Being sorted, a bin's least value is its first."""
    top = shingles >> np.uint64(32)
    bins = (top * np.uint64(BINS)) >> np.uint64(32)
    first = np.searchsorted(bins, np.arange(BINS, dtype=np.uint64))
    full = first < len(bins)
    full[full] = bins[first[full]] == np.flatnonzero(full)
    values = np.zeros(BINS, np.uint64)
    values[full] = shingles[first[full]]
    empty = np.flatnonzero(~full)
    for width in (32, ATTEMPTS):
        if not len(empty):
            break
        asked = borrowing()[empty, :width]
        has = full[asked]
        found = has.any(1)
        lender = asked[np.arange(len(empty)), has.argmax(1)]
        values[empty[found]] = values[lender[found]]
        empty = empty[~found]
    # With so many attempts none stays empty but by a chance far below one in a billion; then the least value
    # stands in.
    values[empty] = shingles[0]
    key = np.arange(BANDS, dtype=np.uint64)
    for column in values.reshape(BANDS, BAND_BINS).T:
        key = mixed((key + column) * ODD)
    return key.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """tag, doc_id, text_key, n_shingles, set_hash (128 bits; null for an empty set), buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                sets = [shingle_set(t) for t in part.column(3).to_pylist()]
                sizes = pa.array([len(s) for s in sets], pa.int64())
                digest = lambda s: hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                hashes = pa.array([digest(s) if len(s) else None for s in sets], pa.binary())
                buckets = pa.array([bucket_keys(s) if len(s) else [] for s in sets], pa.list_(pa.int64()))
                names = ["tag", "doc_id", "text_key", "n_shingles", "set_hash", "buckets"]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], sizes, hashes, buckets], names)

    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.monotonically_increasing_id().alias("tag"), F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_key"), text.alias("text"),
    )
    schema = "tag bigint, doc_id bigint, text_key bigint, n_shingles bigint, set_hash binary, buckets array<bigint>"
    return map_arrow(rows, run, schema)


def linked(a: int, b: int, both: np.ndarray | int) -> np.ndarray | bool:
    return 100 * both >= LEAST_PERCENT * (a + b - both)


def block_links(nodes: list[int], groups: list[int], sides: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between the sets of one block that join nodes not yet in one group. Stars are drawn one after the
    other: a centre is compared at once with all sets of other groups that have one of its rarest shingles. If there
    are nodes of side 1, only pairs with one of them are wanted."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    group = np.unique(np.array(groups), return_inverse=True)[1]
    side = np.array(sides)
    # Numbering the shingles of the block turns a comparison into a look-up.
    _, ids = np.unique(flat, return_inverse=True)
    often = np.bincount(ids)
    # A linked set has three quarters of its shingles in another one: others need no comparison.
    shared = np.add.reduceat((often[ids] > 1).astype(np.int64), starts)
    possible = 100 * shared >= LEAST_PERCENT * sizes
    holders = np.repeat(np.arange(len(sets)), sizes)[np.argsort(ids, kind="stable")]
    begin = np.cumsum(often) - often
    mark = np.zeros(len(often), bool)
    links = []
    centres = np.flatnonzero(side == 1) if side.any() else np.arange(len(sets))
    for c in centres[possible[centres]]:
        others = group != group[c]
        if not others.any():
            if (group == group[0]).all():
                break
            continue
        mine = ids[starts[c] : starts[c] + sizes[c]]
        # So of any quarter of its shingles and one more, at least one is in each set that it is linked with: the rarest
        # tell which sets to look at.
        few = len(mine) - (LEAST_PERCENT * len(mine) + 99) // 100 + 1
        rare = mine[np.argsort(often[mine], kind="stable")[:few]]
        if 2 * often[rare].sum() < len(flat):
            lengths = often[rare]
            inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            look = np.unique(holders[np.repeat(begin[rare], lengths) + inner])
        else:
            look = np.arange(len(sets))
        look = look[others[look] & linked(sizes[c], sizes[look], np.minimum(sizes[c], sizes[look]))]
        if not len(look):
            continue
        lengths = sizes[look]
        first = np.cumsum(lengths) - lengths
        inner = np.arange(lengths.sum()) - np.repeat(first, lengths)
        mark[mine] = True
        both = np.add.reduceat(mark[ids[np.repeat(starts[look], lengths) + inner]], first, dtype=np.int64)
        mark[mine] = False
        for o in look[linked(sizes[c], lengths, both)]:
            if group[o] != group[c]:
                links.append((nodes[c], nodes[o]))
                group[group == group[o]] = group[c]
    return links


def compare_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) found in blocks. `members`: block, node, grp, side; `sets`: node, shingles. A block's rows
    lie together in one task and are read one block at a time."""
    rows = members.join(sets, "node").select("block", "node", "grp", "side", "shingles")
    rows = rows.repartition("block").sortWithinPartitions("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, ([], [], [], [])

        def found() -> pa.RecordBatch:
            links = block_links(*held) if len(held[0]) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                for b, node, group, side, raw in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if b != block:
                        if len(held[0]) > 1:
                            yield found()
                        block, held = b, ([], [], [], [])
                    for values, value in zip(held, (node, group, side, np.frombuffer(raw, np.uint64)), strict=True):
                        values.append(value)
        if len(held[0]) > 1:
            yield found()

    return map_arrow(rows, run, "a bigint, b bigint")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the documents in `wanted` (doc_id, text_key, node), read again from their texts."""
    text = F.col(text_col).cast("string")
    key = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), key.alias("key"), text.alias("text"))
    # Near-duplicates grow with the corpus, so they are merged with it and not broadcast, at any size.
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))
    rows = rows.join(wanted.hint("merge"), same).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                sets = pa.array([shingle_set(t).tobytes() for t in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), sets], ["node", "shingles"])

    # Rows equal in id and text come once per copy.
    return map_arrow(rows, run, "node bigint, shingles binary").dropDuplicates(["node"])


def set_links(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) that connect all nodes whose sets are linked, directly or over others. `nodes`: node,
    doc_id, text_key, n_shingles, buckets."""
    entries = nodes.select("node", "n_shingles", F.explode("buckets").alias("bucket"))
    who = F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("who")
    sums = [F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("size"), who]
    shared = entries.groupBy("bucket").agg(*sums).where("n > 1")
    # Copies meet in many buckets with the same members; one of those is enough.
    shared = shared.groupBy("n", "size", "who").agg(F.min("bucket").alias("bucket")).select("bucket", "n", "size")
    shared = staged(shared, "buckets")
    members = staged(entries.join(shared, "bucket"), "members")
    wanted = staged(members.select("node").distinct().join(nodes.select("node", "doc_id", "text_key"), "node"), "wanted")
    sets = staged(shingle_sets(docs, wanted, id_col, text_col), "sets")

    # First blocks: a bucket's members, in parts if it is large, each part with the bucket's centre: the member
    # that meets most others.
    large = F.col("size") > BLOCK_SHINGLES
    parts = F.when(large, F.ceil(F.col("size") * 2 / BLOCK_SHINGLES)).otherwise(1)
    placed = members.withColumn("part", F.pmod(F.xxhash64("node", "bucket"), parts)).select("bucket", "part", "node")
    split = members.where(large)
    any_split = not split.isEmpty()
    if any_split:
        weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
        centre = split.join(weight, "node").groupBy("bucket", "size").agg(F.max(F.struct("weight", "node")).alias("c"))
        centre = centre.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
        placed = placed.unionByName(centre.select("bucket", "part", F.col("c.node").alias("node"))).distinct()
    block = F.xxhash64("bucket", "part").alias("block")
    placed = placed.select(block, "node", F.col("node").alias("grp"), F.lit(0).alias("side"))
    links = staged(compare_blocks(placed, sets), "links")
    if not any_split:
        return links

    # Buckets of more than one block may still hold members apart. Those outside a bucket's largest group are
    # compared with all members of other groups, block by block.
    apart = split.join(components(links), "node", "left")
    apart = apart.select("bucket", "size", "node", "n_shingles", F.coalesce("root", "node").alias("grp"))
    sizes = apart.groupBy("bucket", "size", "grp").agg(F.sum("n_shingles").alias("of_group"))
    largest = F.max(F.struct("of_group", "grp")).alias("m")
    main = sizes.groupBy("bucket", "size").agg(largest, F.count(F.lit(1)).alias("groups")).where("groups > 1")
    main = main.selectExpr("bucket", "m.grp AS main", "size - m.of_group AS outside")
    apart = staged(apart.join(main, "bucket"), "apart")
    if apart.isEmpty():
        return links
    outer, inner = (F.ceil(F.col(c) * 2 / BLOCK_SHINGLES) for c in ("outside", "size"))
    spread = lambda k, seed: F.pmod(F.xxhash64("node", F.lit(seed)), k)
    numbers = lambda k: F.explode(F.sequence(F.lit(0).cast("bigint"), k - 1))
    # Each outsider is a centre in every part of the bucket; every member is looked at by every part of the outsiders.
    ones = apart.where("grp <> main").withColumn("o", spread(outer, 1)).withColumn("i", numbers(inner))
    alls = apart.withColumn("i", spread(inner, 2)).withColumn("o", numbers(outer))
    ones, alls = ones.withColumn("side", F.lit(1)), alls.withColumn("side", F.lit(0))
    # An outsider that is both in a block stays a centre.
    placed = ones.unionByName(alls).groupBy("bucket", "o", "i", "node", "grp").agg(F.max("side").alias("side"))
    placed = placed.select(F.xxhash64("bucket", "o", "i").alias("block"), "node", "grp", "side")
    return links.unionByName(staged(compare_blocks(placed, sets), "links"))


def group_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: tag, doc_id, text_key, n_shingles, component_id, kept.

    Documents are linked if their sets overlap by 75 % or more of their union; equal sets are linked whatever
    their size. component_id is the smallest doc_id of the component (null if it has none); kept tells whether
    that is the row's own id, so rows that repeat an id share the answer. A null text or one without words has
    an empty set and is alone. An empty table gives no rows."""
    rows = staged(sketches(docs, id_col, text_col), "sketches")
    # The first row stands for all with its set: the smallest id, null ids last, and of equal ids any one.
    about = ["doc_id", "tag", "text_key", "n_shingles", "buckets"]
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), *about)).alias("f")
    sets = rows.where("set_hash IS NOT NULL").groupBy("set_hash").agg(first)
    sets = staged(sets.select("set_hash", *[F.col(f"f.{c}").alias(c) for c in about]).withColumnRenamed("tag", "node"), "nodes")
    roots = components(set_links(docs, sets, id_col, text_col))
    # The smallest id of a component is not always that of its root node, since tags follow the files.
    named = sets.select("set_hash", "node", "doc_id").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = staged(named.join(smallest, "root").select("set_hash", "component_id"), "names")
    rows = rows.join(named.withColumn("named", F.lit(True)), "set_hash", "left")
    component = F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id"))
    rows = rows.withColumn("component_id", component).withColumn("kept", F.col("doc_id").eqNullSafe(component))
    return rows.select("tag", "doc_id", "text_key", "n_shingles", "component_id", "kept")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `group_near_duplicates` keeps, with their own columns. Ids tell documents apart
    here together with their texts."""
    gone = group_near_duplicates(docs, id_col, text_col).where("NOT kept").select(
        F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key")
    )
    gone = staged(gone.distinct(), "dropped")
    key = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    return docs.join(gone, docs[id_col].cast("bigint").eqNullSafe(gone["gone_id"]) & (key == gone["gone_key"]), "left_anti")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = group_near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")
