"""JSON files of any layout, read by many tasks each.

A file may hold one array of values, values one after the other (over any number of lines), or one value per line.
Spark's own reader parses an array file whole in one task. Here files are cut at any byte. A first pass tells for
every split what it does to the scanner's state: whether it turns a position outside strings into one inside, and how
much deeper it ends, for both ways of entering it. A prefix scan over a file's splits gives the state in which each
one really begins, and so a second pass finds the borders of the values in all splits at once. What lies between the
last border of a split and the first one of a later split is put together again by the split that it begins in, in a
third pass, which files that are all read in one split each don't take."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.schemas import CORRUPT_COLUMN, with_corrupt
from stratalake.session import importable, work_dir

# Records of the text reader end here, so a split has many, wherever it begins. It takes the brace away; each record
# gets it back, also the last one of a file, which had none.
BRACE = b"{"
# Splits whose states may be sent to all tasks: some MB. Beyond it rows are joined and sorted again.
BROADCAST_SPLITS = 100_000
BLANK = b" \t\r\n\xef\xbb\xbf"

STATE = (
    "file bigint, start bigint, size bigint, turns int, outside bigint, inside bigint, first int, bytes bigint, "
    "lines bigint, objects bigint"
)
SPLITS = "file bigint, start bigint, inside int, depth bigint, layout string, last boolean, brace boolean"
PIECE = "file bigint, start bigint, kind int, lines boolean, text string"
WHOLE, MORE, BEGUN = 0, 1, 2


def fragments(rows: DataFrame) -> DataFrame:
    """(file, start, size, value) of a text scan with BRACE as line separator: the file's hash, where the split starts,
    the file's size, and the text up to the next brace, in order within a split."""
    about = F.col("_metadata")
    file = F.xxhash64(about["file_path"]).alias("file")
    return rows.select(file, about["file_block_start"].alias("start"), about["file_size"].alias("size"), F.col("value").cast("binary").alias("value"))


def scan_fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return fragments(spark.read.option("lineSep", BRACE.decode()).text(path))


@dataclass
class Scan:
    """Brackets and quotes of some bytes."""

    data: np.ndarray
    quotes: np.ndarray = field(init=False)
    deeper: np.ndarray = field(init=False)

    def __post_init__(self):
        data = self.data
        quote = data == 0x22
        back = np.flatnonzero(data == 0x5C)
        if len(back):
            # A quote is text if an odd number of backslashes ends right before it.
            begin = np.flatnonzero(np.diff(back, prepend=-2) > 1)
            length = np.diff(np.append(begin, len(back)))
            behind = back[begin] + length
            behind = behind[(length % 2 == 1) & (behind < len(data))]
            quote[behind] = False
        self.quotes = np.cumsum(quote, dtype=np.int32)
        self.deeper = ((data == 0x7B) | (data == 0x5B)).astype(np.int8) - ((data == 0x7D) | (data == 0x5D)).astype(np.int8)

    def turns(self) -> int:
        return int(self.quotes[-1] & 1) if len(self.quotes) else 0

    def outside(self, inside: int) -> np.ndarray:
        """Which bytes are no part of a string, if the bytes begin inside one or not."""
        return (self.quotes & 1) == inside


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """(values of the first two columns, begin, end) of the rows that share them."""
    keys = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:2]]
    if not batch.num_rows:
        return
    change = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])) + 1
    edges = [0, *change.tolist(), batch.num_rows]
    for begin, end in zip(edges, edges[1:]):
        yield (int(keys[0][begin]), int(keys[1][begin])), begin, end


def _bytes(column: pa.Array, begin: int, end: int) -> bytes:
    values = column.slice(begin, end - begin).cast(pa.large_binary())
    together = pa.LargeListArray.from_arrays(pa.array([0, end - begin], pa.int64()), values)
    return pc.binary_join(together, pa.scalar(BRACE, pa.large_binary()))[0].as_py() + BRACE


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each split does to the scanner's state: rows (file, start, size, value) to STATE."""
    key, held = None, {}

    def row() -> pa.RecordBatch:
        columns = [[key[0]], [key[1]], *([held[n]] for n in ("size", "turns", 0, 1, "first", "bytes", "lines", "objects"))]
        kinds = [*[pa.int64()] * 3, pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 3]
        names = ["file", "start", "size", "turns", "outside", "inside", "first", "bytes", "lines", "objects"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        for run, begin, end in _runs(batch):
            if run != key:
                if key:
                    yield row()
                key, held = run, {"size": batch.column(2)[begin].as_py(), "turns": 0, 0: 0, 1: 0, "first": None, "bytes": 0, "lines": 0, "objects": 0}
            data = _bytes(batch.column(3), begin, end)
            held["bytes"] += len(data)
            held["lines"] += data.count(b"\n")
            held["objects"] += data.count(b"\n{")
            if held["first"] is None and (text := data.lstrip(BLANK)):
                held["first"] = text[0]
            scan = Scan(np.frombuffer(data, np.uint8))
            for entered in (0, 1):
                held[entered] += int(scan.deeper[scan.outside(entered ^ held["turns"])].sum())
            held["turns"] ^= scan.turns()
    if key:
        yield row()


def split_states(parts: DataFrame) -> DataFrame:
    """The scanner's state at the start of each split (SPLITS): inside a string or not, and the depth; with it how the
    file is laid out, whether the split is its last, and whether the file itself ends in a brace. A file that begins
    with a bracket is an array. Any other holds values one after the other; if its brackets and quotes don't come out
    even and most of its lines begin with a brace, it is read line by line, so that a broken line costs no more than
    itself."""
    effects = importable(parts).mapInArrow(_effects, STATE)
    # One row for each split of a file.
    by_file = Window.partitionBy("file")
    before = by_file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    rows = effects.withColumn("inside_before", (so_far("turns") % 2).cast("int"))
    rows = rows.withColumn("delta", F.when(F.col("inside_before") == 0, F.col("outside")).otherwise(F.col("inside")))
    rows = rows.withColumn("depth", so_far("delta"))
    first = F.min(F.when(F.col("first").isNotNull(), F.struct("start", "first"))).over(by_file)["first"]
    # The reader leaves out a byte order mark. A compressed file has another size: it counts as ending without a brace.
    length = F.sum("bytes").over(by_file)
    brace = (length == F.col("size")) | (length == F.col("size") - 3)
    even = (F.sum("delta").over(by_file) == F.when(brace, 0).otherwise(1)) & (F.sum("turns").over(by_file) % 2 == 0)
    by_lines = F.sum("objects").over(by_file) * 2 >= F.sum("lines").over(by_file)
    layout = F.when(first == ord("["), "array").when(even | ~by_lines, "values").otherwise("lines")
    last = F.col("start") == F.max("start").over(by_file)
    inside = F.col("inside_before").alias("inside")
    return rows.select("file", "start", inside, "depth", layout.alias("layout"), last.alias("last"), brace.alias("brace"))


def borders(data: np.ndarray, scan: Scan, inside: int, depth: int, layout: str) -> tuple[np.ndarray, np.ndarray]:
    """(end, next): where pieces end, and where the next one begins. Commas, the array's own brackets and line ends are
    no part of a piece."""
    if layout == "lines":
        cut = np.flatnonzero(data == 0x0A)
        return cut, cut + 1
    out = scan.outside(inside)
    after = depth + np.cumsum(np.where(out, scan.deeper, 0), dtype=np.int64)
    top = 1 if layout == "array" else 0
    closed = out & (scan.deeper < 0) & (after == top)
    if layout == "array":
        dropped = out & (((data == 0x2C) & (after == 1)) | ((data == 0x5B) & (after == 1)) | ((scan.deeper < 0) & (after == 0)))
    else:
        dropped = out & (data == 0x0A) & (after == 0)
    # An opening bracket of a value in an array goes to depth 2, so depth 1 is the array's own.
    cut = np.flatnonzero(closed | dropped)
    keeps = closed[cut]
    return np.where(keeps, cut + 1, cut), cut + 1


def _values_of_line(line: bytes) -> list[bytes]:
    """A line's values, which may be more than one if it is whole."""
    if not re.search(rb"\}\s*\{", line):
        return [line]
    data = np.frombuffer(line, np.uint8)
    ends, nexts = borders(data, Scan(data), 0, 0, "values")
    at = [0, *nexts.tolist()]
    return [line[a:b] for a, b in zip(at, [*ends.tolist(), len(line)])]


def _utf8(texts: list[bytes]) -> pa.Array:
    """Texts as strings; bytes that are no UTF-8 are replaced."""
    try:
        return pa.array(texts, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([text.decode("utf-8", "replace") for text in texts], pa.string())


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values of each split, and what it holds of values that reach over its ends: rows (file, start, value, and the
    split's state) to PIECE."""
    key, state, texts, kinds, open_, bordered = None, {}, [], [], [], False

    def put(kind: int, *found: bytes) -> None:
        if state["layout"] == "lines" and kind == WHOLE:
            found = [value for text in found for value in _values_of_line(text)]
        held = [text for text in found if text.strip(BLANK)]
        texts.extend(held)
        kinds.extend([kind] * len(held))

    def close() -> None:
        rest = b"".join(open_)
        if state["last"]:
            if not state["brace"]:
                rest = rest[:-1]
            open_array = state["layout"] == "array" and (state["inside"] or state["depth"] != (0 if state["brace"] else 1))
            if open_array and not rest.strip(BLANK):
                rest = b"["  # the array that is never closed
        if state["last"] and key[1] == 0:
            put(WHOLE, rest)  # the file's only split
        elif key[1] == 0 or bordered:
            # Also without text it begins what a later split goes on with.
            texts.append(rest)
            kinds.append(BEGUN)
        else:
            put(MORE, rest)

    def done() -> pa.RecordBatch:
        n = len(texts)
        columns = [pa.array([k] * n, pa.int64()) for k in key]
        columns += [pa.array(kinds, pa.int32()), pa.array([state["layout"] == "lines"] * n, pa.bool_()), _utf8(texts)]
        texts.clear()
        kinds.clear()
        return pa.RecordBatch.from_arrays(columns, ["file", "start", "kind", "lines", "text"])

    for batch in batches:
        for run, begin, end in _runs(batch):
            if run != key:
                if key:
                    close()
                    yield done()
                about = batch.select([n for n in batch.schema.names if n != "value"]).slice(begin, 1).to_pylist()[0]
                key, state, open_, bordered = run, about, [], False
            data = _bytes(batch.column(2), begin, end)
            flat = np.frombuffer(data, np.uint8)
            scan = Scan(flat)
            ends, nexts = borders(flat, scan, state["inside"], state["depth"], state["layout"])
            if len(ends):
                open_.append(data[: ends[0]])
                put(WHOLE if bordered or key[1] == 0 else MORE, b"".join(open_))
                open_.clear()
                bordered = True
                put(WHOLE, *(data[a:b] for a, b in zip(nexts[:-1].tolist(), ends[1:].tolist(), strict=True)))
            open_.append(data[nexts[-1] :] if len(ends) else data)
            state["depth"] += int(scan.deeper[scan.outside(state["inside"])].sum())
            state["inside"] ^= scan.turns()
            if texts:
                yield done()
    if key:
        close()
        yield done()


def value_texts(parts: DataFrame) -> DataFrame:
    """(text) of every value in the files whose fragments (file, start, value) are given, and of what is no value."""
    spark = parts.sparkSession
    path = work_dir(spark, "splits")
    split_states(parts).write.parquet(path)
    states = spark.read.schema(SPLITS).parquet(path)
    if states.limit(BROADCAST_SPLITS + 1).count() <= BROADCAST_SPLITS:
        rows = parts.join(F.broadcast(states), ["file", "start"])
    else:
        order = parts.withColumn("n", F.monotonically_increasing_id())
        rows = order.join(states, ["file", "start"]).repartition("file", "start").sortWithinPartitions("file", "start", "n")
    rows = rows.select("file", "start", "value", "inside", "depth", "layout", "last", "brace")
    pieces = importable(rows).mapInArrow(_pieces, PIECE)
    whole = pieces.where(F.col("kind") == WHOLE).select("text")
    if states.where("start > 0").isEmpty():
        return whole  # no file has a second split, so no value has parts, and the text isn't gone through again
    # At most two parts of values for each split. A part belongs to the last split before it in which a value begins.
    owner = F.last(F.when(F.col("kind") == BEGUN, F.col("start")), ignorenulls=True)
    by_file = Window.partitionBy("file").orderBy("start", "kind")
    parts_of = pieces.where(F.col("kind") != WHOLE).withColumn("owner", owner.over(by_file))
    together = parts_of.groupBy("file", "owner", "lines")
    together = together.agg(F.array_sort(F.collect_list(F.struct("start", "kind", "text"))).alias("p"))
    joined = together.select("lines", F.array_join("p.text", "").alias("text"))

    def split_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lines, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for piece in _values_of_line(text.encode()) if lines else [text.encode()]:
                    if piece.strip(BLANK):
                        out.append(piece.decode())
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["text"])

    return whole.unionAll(importable(joined).mapInArrow(split_lines, "text string"))


def parsed(texts: DataFrame, schema: T.StructType, keep_corrupt: bool = False) -> DataFrame:
    """Texts of values as rows of the schema, which are null where a text is no object; with `keep_corrupt` that text
    is in `_corrupt_record`."""
    value = F.from_json("text", with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    is_object = F.col("text").rlike(r"^[ \t\r\n﻿]*\{")
    rows = texts.select("text", F.when(is_object, value).alias("value"))
    bad = F.when(F.col("value").isNull(), F.col("text")).otherwise(F.col(f"value.{CORRUPT_COLUMN}"))
    columns = [F.col("value")[name].alias(name) for name in schema.fieldNames()]
    return rows.select(*columns, *([bad.alias(CORRUPT_COLUMN)] if keep_corrupt else []))
