"""Hard negatives by Fagin's threshold algorithm.

Rows are ranked by label and cut into blocks. A task that gets a block sorts it once by each dimension. An anchor
reads these lists in step, from the top where its own component is positive and from the bottom where it is negative
(sorted access); each row met for the first time is scored whole, in integers (random access). What is unread scores
at most the threshold: the anchor's product with the components read last. A window is done when the threshold is
strictly below its k-th score, or below all that it admits.

Anchors are a query set against all rows: they meet the blocks chunk by chunk, first those of their own label for the
positives, then the others for the negatives, whose windows follow from the positives' scores. A task takes several
blocks one after the other and carries each window's best rows along, so that later blocks stop early; what tasks find
is merged by a rank per window."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import global_rank, left_join_table, map_arrow, staged

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
# A negative scores between these percentages of its positive.
LEAST_PERCENT, MOST_PERCENT = 50, 95
SCALE = 256
# Rows of a block, rows of all blocks that a task takes in turn, and anchors that it holds.
BLOCK_ROWS, TASK_ROWS, ANCHORS_HELD = 2048, 16_384, 8_192
# Small tables are cut finer, into about so many tasks.
LEAST_TASKS = 48
FIRST_DEPTH, DEEPER = 8, 4
LONGEST = (1 << 63) - 1
# Scores of numpy's own types stay inside these.
FAR = 1 << 62
# The ends of a window without ends.
NO_END = 10**37

FOUND = "anchor bigint, slot int, row bigint, vec_id bigint, score bigint"


def quantised(vector: Column) -> Column:
    """floor(256 x) of each component; what passes 64 bits stays at their end."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))


def usable(vector: Column) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    return vector.isNotNull() & F.coalesce(F.forall(vector, number), F.lit(False))


class Lists:
    """A block's rows, and for each dimension its rows by falling and by rising component."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        rising = np.argsort(rows, axis=0, kind="stable").T
        self.order = np.stack([rising, rising[:, ::-1]])
        self.values = np.stack([np.sort(rows, axis=0).T, np.sort(rows, axis=0).T[:, ::-1]])


class Best:
    """The best rows of a window so far: `least` <= score <= `most`, at most `k`, by falling score, then by place."""

    def __init__(self, k: int, least: int, most: int):
        self.k, self.least, self.most = k, least, most
        self.rows: list[tuple[int, tuple]] = []

    def add(self, scores: np.ndarray, rows: np.ndarray, places: list[tuple]) -> None:
        low, high = (max(-FAR, min(FAR, x)) for x in (self.floor(), self.most))
        inside = np.flatnonzero((scores >= low) & (scores <= high)) if scores.dtype != object else [
            i for i, x in enumerate(scores) if self.floor() <= x <= self.most]
        if len(inside):
            found = [(-int(scores[i]), places[rows[i]]) for i in inside]
            self.rows = sorted(self.rows + found)[: self.k]

    def floor(self) -> int:
        """The least score that can still get in; an equal one may, by its place."""
        return max(self.least, -self.rows[-1][0]) if len(self.rows) == self.k else self.least

    def done(self, threshold: int) -> bool:
        return threshold < self.floor() or self.least > self.most


def exact(rows: np.ndarray, anchors: np.ndarray) -> type:
    """A type in which products of these are exact: floating point, 64-bit, or Python's integers."""
    top = lambda x: max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    bound = top(rows) * top(anchors) * max(1, rows.shape[1])
    return np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 62 else object


def threshold_search(lists: Lists, anchor: np.ndarray, admits: np.ndarray, places: list[tuple], windows: list[Best]) -> int:
    """Bring the windows up to date with one block; returns how many rows were scored. `admits`: which rows count at
    all; `places`: how equal scores are ordered."""
    n = len(lists.rows)
    used = np.flatnonzero(anchor != 0)
    side = (anchor[used] > 0).astype(np.intp)
    weights = anchor[used]
    bound = lambda depth: weights @ lists.values[side, used, depth]
    seen = np.zeros(n, bool)
    depth, scored = 0, 0
    # Nothing is read where even the best components together fall short of every window.
    open_ = [w for w in windows if not w.done(bound(0))] if n else []
    while open_ and depth < n:
        deeper = min(n, max(FIRST_DEPTH, depth * DEEPER))
        met = np.zeros(n, bool)
        if len(used):
            met[lists.order[side, used, depth:deeper].ravel()] = True
        else:
            met[:] = True  # every score is 0
        fresh = np.flatnonzero(met & ~seen)
        seen |= met
        depth = deeper
        fresh = fresh[admits[fresh]]
        scored += len(fresh)
        if len(fresh):
            scores = lists.rows[fresh] @ anchor
            for window in open_:
                window.add(scores, fresh, places)
        threshold = bound(depth - 1)
        open_ = [w for w in open_ if not w.done(threshold)] if len(used) else []
    return scored


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integers; a shorter vector counts as having zeros behind it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def widest(column: pa.Array) -> int:
    return int(np.diff(column.offsets.to_numpy()).max(initial=0))


def search_blocks(groups: DataFrame, same: bool) -> DataFrame:
    """What the windows of each group's anchors find in its rows. `groups`: chunk, task, block (null for anchors), row,
    vec_id, label, v, least, most (of an anchor's windows). `same`: whether rows of the anchor's label are wanted, or
    the others. A group's rows lie together in one task, anchors first, and are read block by block."""
    ordered = groups.repartition("chunk", "task").sortWithinPartitions("chunk", "task", F.asc_nulls_first("block"))
    k = POSITIVES if same else NEGATIVES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, bests, held, key, block = None, [], [], None, None

        def scan() -> None:
            """The held block against all anchors."""
            nonlocal anchors
            rows = pa.Table.from_batches(held)
            vectors = rows["v"].combine_chunks()
            width = max(widest(vectors), anchors.width())
            values, queries = matrix(vectors, width), anchors.matrix(width)
            kind = exact(values, queries)
            values, queries = values.astype(kind), queries.astype(kind)
            labels = np.array(rows["label"].to_pylist())
            # Equal scores go by id, rows without one last.
            places = [(i is None, i or 0, r) for i, r in zip(rows["vec_id"].to_pylist(), rows["row"].to_pylist(), strict=True)]
            numbers = np.array(rows["row"].to_pylist())
            lists: dict = {}
            for at, label in enumerate(anchors.labels):
                part = lists.get(label)
                if part is None:
                    inside = np.flatnonzero((labels == label) == same)
                    # Other labels' blocks have no row of this one: one set of lists does for all such anchors.
                    whole = len(inside) == len(labels)
                    part = lists.get(None) if whole else None
                    part = part or (Lists(values[inside]), [places[i] for i in inside], numbers[inside])
                    lists[None if whole else label] = lists[label] = part
                block_lists, block_places, block_numbers = part
                if len(block_numbers):
                    threshold_search(block_lists, queries[at], block_numbers != anchors.rows[at], block_places, bests[at])
            held.clear()

        def close() -> pa.RecordBatch:
            if held:
                scan()
            out = [(row, slot, place[2], None if place[0] else place[1], max(-LONGEST, min(LONGEST, -score)))
                   for row, windows in zip(anchors.rows, bests, strict=True)
                   for slot, window in enumerate(windows) for score, place in window.rows]
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["anchor", "slot", "row", "vec_id", "score"])

        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True))
            edges = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for begin, end in zip(edges, edges[1:]):
                if begin == end:
                    continue
                *group, number = keys[begin]
                part = batch.slice(begin, end - begin)
                if group != key:
                    if anchors and len(anchors.rows):
                        yield close()
                    held.clear()
                    anchors, bests, key, block = Anchors(), [], group, number
                if number is None:
                    anchors.add(part)
                    for least, most in zip(part.column("least").to_pylist(), part.column("most").to_pylist(), strict=True):
                        bests.append([Best(k, int(a), int(b)) for a, b in zip(least, most, strict=True)])
                    continue
                if number != block:
                    if held:
                        scan()
                    block = number
                if bests:
                    held.append(part)
        if anchors and len(anchors.rows):
            yield close()

    return map_arrow(ordered.select("chunk", "task", "block", "row", "vec_id", "label", "v", "least", "most"), run, FOUND)


class Anchors:
    """The anchors of a group, in the order in which they came."""

    def __init__(self):
        self.rows: list[int] = []
        self.labels: list[int] = []
        self.parts: list[pa.Array] = []

    def add(self, batch: pa.RecordBatch) -> None:
        self.rows += batch.column("row").to_pylist()
        self.labels += batch.column("label").to_pylist()
        self.parts.append(batch.column("v"))

    def width(self) -> int:
        return max(map(widest, self.parts))

    def matrix(self, width: int) -> np.ndarray:
        return np.concatenate([matrix(p, width) for p in self.parts])


def mine_hard_negatives(
    vectors: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its first
    5 other rows of the same label, the first 3 rows of other labels that score 50 to 95 % of the positive. First are
    higher integer scores, then smaller ids.

    Rows without a label or a vector, and rows with a null or non-finite component, take no part. Rows without an id
    come after all others of their score and are told apart as rows; so are rows that repeat an id. A shorter vector
    counts as having zeros behind it. Scores are exact, also past 64 bits, where the returned number stays at their end.
    Without rows or anchors there is nothing. Extra columns play no part."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"),
                          F.col(vector_col).alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    rows = rows.where(F.col("label").isNotNull() & usable(F.col("v")))
    rows = rows.withColumn("v", quantised(F.col("v")))
    rows, total = global_rank(rows, ["label", "vec_id"], "row", "ranked")
    size = max(1, min(TASK_ROWS, -(-total // LEAST_TASKS)))
    block = max(1, min(BLOCK_ROWS, size))
    rows = staged(rows.withColumn("task", F.floor(F.col("row") / size)).withColumn("block", F.floor(F.col("row") / block)), "rows")
    anchors = rows.where("is_anchor").drop("is_anchor", "task", "block")
    chunks = max(1, -(-anchors.count() // ANCHORS_HELD))
    chunk = F.pmod(F.xxhash64("row"), F.lit(chunks)).cast("int").alias("chunk")
    anchors = staged(anchors.select("*", chunk), "anchors")

    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    no_window = F.lit(None).cast("array<decimal(38,0)>")
    candidates = rows.select(every_chunk, "task", "block", "row", "vec_id", "label", "v", no_window.alias("least"), no_window.alias("most"))
    last_task = max(0, (total - 1) // size)

    def found(asked: DataFrame, first: Column, last: Column, same: bool) -> DataFrame:
        """What `asked` (anchors with windows) find in the tasks from `first` to `last`, ranked per window."""
        copies = asked.withColumn("task", F.explode(F.sequence(first, last)))
        copies = copies.select("chunk", "task", F.lit(None).cast("bigint").alias("block"), "row", "vec_id", "label", "v", "least", "most")
        hits = search_blocks(copies.unionByName(candidates), same)
        order = [F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("row")]
        place = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(*order))
        return hits.withColumn("rank", place).where(F.col("rank") <= (POSITIVES if same else NEGATIVES))

    # Rows lie by label, so a label's rows are in a run of tasks.
    where = staged(rows.groupBy("label").agg(F.min("task").alias("first"), F.max("task").alias("last")), "labels")
    open_window = [F.array(F.lit(Decimal(end)).cast("decimal(38,0)")).alias(name) for end, name in ((-NO_END, "least"), (NO_END, "most"))]
    asked = left_join_table(anchors, where, "label").select("*", *open_window)
    positives = staged(found(asked, F.col("first"), F.col("last"), True), "positives")

    # One window for each positive, in the order of their ranks. Bounds are integers: 50 p <= 100 n <= 95 p.
    score = lambda p: p["score"].cast("decimal(38,0)")
    least = F.transform("found", lambda p: F.ceil(score(p) * LEAST_PERCENT / 100).cast("decimal(38,0)"))
    most = F.transform("found", lambda p: F.floor(score(p) * MOST_PERCENT / 100).cast("decimal(38,0)"))
    each = positives.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("found"))
    each = each.select(F.col("anchor").alias("row"), least.alias("least"), most.alias("most"))
    asked = anchors.join(each, "row")
    negatives = found(asked, F.lit(0).cast("bigint"), F.lit(last_task).cast("bigint"), False)

    positive = positives.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    out = negatives.join(positive, ["anchor", "slot"]).join(named, "anchor")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                      "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % ANCHOR_EVERY == 0)
