"""Benchmark decontamination by suffix arrays over the training texts.

Each task reads its documents in shards of bounded size and sorts a suffix array of every shard, by words. Every
suffix of every test item is then looked up by binary search: its place in the array gives its longest verbatim
match in the shard, and the suffixes that share its window lie around that place. Documents are never shuffled;
only the tests are sent to all tasks, in parts of bounded size, with one pass over the documents for each part.

Words that no test has end every match, so suffixes are only sorted inside runs of test words that are long enough
to hold the shortest window."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from stratalake.llm.common import fresh, map_arrow, staged

WINDOW_WORDS = 10
# Words of documents in a suffix array, about 60 MB of work space; a longer document makes a longer array.
SHARD_WORDS = 1_000_000
# Text of the test items that are sent to all tasks at once; what is beyond takes another pass.
PART_BYTES = 16_000_000
TEXTS_AT_ONCE = 256

# A-Z lowered, digits, letters and everything beyond ASCII kept, the rest made a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

FOUND = "tag bigint, doc_id {}, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"
LONGEST = "item_id string, item_at int, n_words int, doc_at int, doc_id {}"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_FOLD).split()


def run_lengths(ids: np.ndarray) -> np.ndarray:
    """For each place how many words follow, itself included, up to the next 0."""
    at = np.arange(len(ids))
    stop = np.where(ids == 0, at, len(ids))
    return np.minimum.accumulate(stop[::-1])[::-1] - at


def packed(ids: np.ndarray, bits: int, per: int) -> np.ndarray:
    """For each place its next `per` words in one number that sorts as they do; nothing counts behind a 0."""
    padded = np.concatenate([ids, np.zeros(per, ids.dtype)]).astype(np.int64)
    out, alive = np.zeros(len(ids), np.int64), np.ones(len(ids), bool)
    for k in range(per):
        word = padded[k : k + len(ids)]
        alive &= word > 0
        out = (out << bits) | np.where(alive, word, 0)
    return out


@dataclass
class Items:
    """Test items as numbered words: `ids` holds all items, each with a 0 behind it. `suffixes` are the places of
    windows, `lengths` their words, `owners` their items."""

    window: int
    vocabulary: dict[bytes, int]
    ids: np.ndarray
    names: list[str | None]
    suffixes: np.ndarray
    lengths: np.ndarray
    owners: np.ndarray
    starts: np.ndarray
    bits: int
    per: int
    packs: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[str | None, bytes | None]], window: int) -> Items:
        vocabulary: dict[bytes, int] = {}
        ids, suffixes, lengths, owners, starts, names = [], [], [], [], [], []
        at = 0
        for name, text in items:
            words = words_of(text)
            if not words:
                continue
            n = max(1, len(words) - window + 1)
            suffixes.append(np.arange(at, at + n))
            lengths.append(np.full(n, min(window, len(words))))
            owners.append(np.full(n, len(names)))
            starts.append(at)
            names.append(name)
            ids.extend(vocabulary.setdefault(w, len(vocabulary) + 1) for w in words)
            ids.append(0)
            at += len(words) + 1
        ids = np.array(ids, np.int32)
        flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        bits = max(1, len(vocabulary).bit_length())
        per = 63 // bits
        return cls(window, vocabulary, ids, names, flat(suffixes), flat(lengths), flat(owners), np.array(starts, np.int64),
                   bits, per, packed(ids, bits, per))


class Shard:
    """The suffix array of some documents' words. `ids` holds the documents one after the other, each with a 0 behind
    it; 0 also stands for words that no test has."""

    def __init__(self, ids: np.ndarray, tests: Items):
        self.tests = tests
        # Only runs of known words that can hold a window, each with its 0.
        known = ids > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[0], known.view(np.int8), [0]])))
        begin, end = edge[::2], edge[1::2]
        wide = end - begin >= tests.lengths.min()
        turn = np.zeros(len(ids) + 1, np.int8)
        turn[begin[wide]] += 1
        turn[end[wide] + 1] -= 1
        self.places = np.flatnonzero(np.cumsum(turn[:-1], dtype=np.int64))
        self.ids = ids[self.places]
        self.packs = packed(self.ids, tests.bits, tests.per)
        self.left = run_lengths(self.ids)
        self.order = self._sorted()

    def _sorted(self) -> np.ndarray:
        """Suffixes in order, by doubling: ranks by the first words, then by pairs of ranks, until all differ or are
        told apart as far as any test reaches. Equal suffixes keep the order of their places."""
        order = np.flatnonzero(self.ids > 0)
        order = order[np.argsort(self.packs[order], kind="stable")]
        key = self.packs[order]
        depth, longest = self.tests.per, int(run_lengths(self.tests.ids).max(initial=0))
        rank = np.zeros(len(self.ids) + 1, np.int64)
        while len(order):
            new = np.concatenate([[True], key[1:] != key[:-1]])
            rank[order] = np.cumsum(new)
            tied = ~new
            tied[:-1] |= ~new[1:]
            if depth >= longest or not (self.left[order[tied]] > depth).any():
                break
            further = np.where(self.left[order] > depth, rank[np.minimum(order + depth, len(self.ids))], 0)
            key = rank[order] * (len(order) + 1) + further
            # Only tied suffixes move, and only inside their group.
            where = np.flatnonzero(tied)
            resorted = where[np.argsort(key[where], kind="stable")]
            order[where], key[where] = order[resorted], key[resorted]
            depth *= 2
        return order

    def _compare(self, mine: np.ndarray, theirs: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each pair: this array's suffix against the test's, over at most `depth` words."""
        bits, per = self.tests.bits, self.tests.per
        out = np.zeros(len(mine), np.int8)
        active = np.arange(len(mine))
        at = 0
        while len(active):
            a, b = self.packs[mine[active] + at], self.tests.packs[theirs[active] + at]
            cut = np.maximum(per - (depth[active] - at), 0) * bits
            a, b = a >> cut, b >> cut
            out[active] = np.sign(a - b)
            more = (a == b) & (cut == 0) & (b & ((1 << bits) - 1) > 0) & (depth[active] > at + per)
            active = active[more]
            at += per
        return out

    def search(self, suffixes: np.ndarray, depth: np.ndarray, after: bool = False) -> np.ndarray:
        """For each test suffix the number of this array's suffixes below it (with `after` also the equal ones), by
        binary search over at most `depth` words."""
        low, high = np.zeros(len(suffixes), np.int64), np.full(len(suffixes), len(self.order))
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            sign = self._compare(self.order[middle], suffixes[open_], depth[open_])
            up = sign <= 0 if after else sign < 0
            low[open_[up]] = middle[up] + 1
            high[open_[~up]] = middle[~up]
        return low

    def common(self, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """How many first words the pairs have in common."""
        bits, per = self.tests.bits, self.tests.per
        out = np.zeros(len(mine), np.int64)
        active = np.arange(len(mine))
        at = 0
        while len(active):
            a, b = self.packs[mine[active] + at], self.tests.packs[theirs[active] + at]
            equal = np.zeros(len(active), np.int64)
            for k in range(1, per + 1):
                cut = (per - k) * bits
                equal += ((a >> cut) == (b >> cut)) & ((b >> cut) & ((1 << bits) - 1) > 0)
            out[active] += equal
            active = active[equal == per]
            at += per
        return out

    def longest(self) -> tuple[np.ndarray, np.ndarray]:
        """For each test suffix the words of its longest verbatim match here, and where it is (-1: nowhere). The match
        stands next to the suffix's own place in the order."""
        suffixes = self.tests.suffixes
        if not len(self.order):
            return np.zeros(len(suffixes), np.int64), np.full(len(suffixes), -1)
        whole = np.full(len(suffixes), len(self.tests.ids))
        at = self.search(suffixes, whole)
        best, place = np.zeros(len(suffixes), np.int64), np.full(len(suffixes), -1)
        for beside in (at - 1, at):
            inside = (beside >= 0) & (beside < len(self.order))
            mine = self.order[np.clip(beside, 0, len(self.order) - 1)]
            words = np.where(inside, self.common(mine, suffixes), 0)
            better = words > best
            best[better], place[better] = words[better], self.places[mine[better]]
        return best, place

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, words, range) of every occurrence of a window, and for each window its range: windows of equal words
        share one, so an occurrence comes once however many items have it. -1 for windows that do not occur."""
        suffixes, lengths = self.tests.suffixes, self.tests.lengths
        low, high = self.search(suffixes, lengths), self.search(suffixes, lengths, after=True)
        found = np.flatnonzero(high > low)
        kinds, range_of = np.unique(np.stack([low[found], lengths[found]]), axis=1, return_inverse=True)
        ranges = np.full(len(suffixes), -1)
        ranges[found] = range_of.reshape(-1)
        first = np.zeros(kinds.shape[1], np.int64)
        first[ranges[found]] = found
        sizes = (high - low)[first]
        kind = np.repeat(np.arange(len(first)), sizes)
        inner = np.arange(len(kind)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = self.places[self.order[np.repeat(low[first], sizes) + inner]]
        return np.stack([place, lengths[first][kind], kind]), ranges, first


@dataclass
class Documents:
    """The documents of a shard: their tags and ids, and where each begins in `ids`, which has a 0 behind each."""

    tags: list[int]
    names: list
    starts: np.ndarray
    ids: np.ndarray

    def at(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1


def _shards(batches: Iterator[pa.RecordBatch], tests: Items) -> Iterator[Documents]:
    """The documents (tag, doc_id, text as bytes), shard by shard."""
    tags, names, parts, total = [], [], [], 0
    known = tests.vocabulary.get

    def done() -> Documents:
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return Documents(tags, names, starts, np.concatenate(parts))

    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            part = batch.slice(at, TEXTS_AT_ONCE)
            for tag, name, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                words = words_of(text)
                ids = np.zeros(len(words) + 1, np.int32)
                ids[:-1] = np.fromiter(map(known, words, repeat(0)), np.int32, len(words))
                tags.append(tag)
                names.append(name)
                parts.append(ids)
                total += len(ids)
                if total >= SHARD_WORDS:
                    yield done()
                    tags, names, parts, total = [], [], [], 0
    if tags:
        yield done()


def _hits(docs: Documents, tests: Items) -> tuple[tuple, tuple]:
    """(document, start, end) of the runs of hit words, and (document, item) for the items that a document has."""
    none = np.zeros(0, np.int64)
    if not len(tests.suffixes):
        return (none, none, none), (none, none)
    shard = Shard(docs.ids, tests)
    (place, words, kind), ranges, first = shard.windows()
    if not len(place):
        return (none, none, none), (none, none)
    turn = np.zeros(len(docs.ids) + 1, np.int64)
    np.add.at(turn, place, 1)
    np.add.at(turn, place + words, -1)
    hit = np.cumsum(turn)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    doc = docs.at(edge[::2])
    spans = doc, edge[::2] - docs.starts[doc], edge[1::2] - docs.starts[doc]
    # Which ranges a document has, then which items a range has: each pair once.
    seen = np.unique(docs.at(place) * len(first) + kind)
    used = np.flatnonzero(ranges >= 0)
    owners = np.unique(ranges[used] * len(tests.names) + tests.owners[used])
    counts = np.bincount(owners // len(tests.names), minlength=len(first))
    begin = np.cumsum(counts) - counts
    many = counts[seen % len(first)]
    inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    owner = owners[np.repeat(begin[seen % len(first)], many) + inner] % len(tests.names)
    pair = np.unique(np.repeat(seen // len(first), many) * len(tests.names) + owner)
    return spans, (pair // len(tests.names), pair % len(tests.names))


def _found(docs: Documents, tests: Items, id_type: pa.DataType) -> pa.RecordBatch:
    """A row per document of a shard."""
    n = len(docs.tags)
    spans, items = _hits(docs, tests)
    offsets = lambda doc: pa.array(np.searchsorted(doc, np.arange(n + 1)), pa.int32())
    ends = [pa.array(x, pa.int32()) for x in spans[1:]]
    names = pa.array([tests.names[i] for i in items[1]], pa.string())
    columns = [
        pa.array(docs.tags, pa.int64()), pa.array(docs.names, id_type), pa.array(np.diff(docs.starts) - 1, pa.int64()),
        pa.ListArray.from_arrays(offsets(spans[0]), pa.StructArray.from_arrays(ends, ["start", "end"])),
        pa.ListArray.from_arrays(offsets(items[0]), names),
    ]
    return pa.RecordBatch.from_arrays(columns, ["tag", "doc_id", "n_words", "spans", "items"])


def parts_of_tests(tests: DataFrame, id_col: str, text_col: str, part_bytes: int) -> DataFrame:
    """The distinct (item_id, text, part) rows of the tests, in parts of at most `part_bytes` of text; a part over that
    is a single item."""
    rows = tests.select(F.col(id_col).cast("string").alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    rows = staged(rows.where("length(text) > 0").distinct(), "tests")
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // part_bytes))
    while True:
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))
        sums = dealt.groupBy("part").agg(F.sum(F.length("text")).alias("bytes"), F.count(F.lit(1)).alias("n"))
        if sums.where(f"n > 1 AND bytes > {part_bytes}").isEmpty():
            return staged(dealt, "tests")
        parts *= 2


def _each_part(rows: DataFrame, tests: DataFrame, run: Callable, schema: str) -> tuple[DataFrame, int]:
    """What `run` gives for all documents (tag, doc_id, text) and each part of the tests, and the number of parts. Each
    part is one pass over the documents."""
    spark = rows.sparkSession
    numbers = [r["part"] for r in tests.select("part").distinct().orderBy("part").collect()] or [0]
    if len(numbers) > 1:
        rows = staged(rows, "docs")  # so that all passes see the same tags
    results = []
    for number in numbers:
        items = [(r["item_id"], bytes(r["text"])) for r in tests.where(F.col("part") == number).collect()]
        found = map_arrow(rows, run(spark.sparkContext.broadcast(items)), schema)
        results.append(staged(found, "found") if len(numbers) > 1 else found)
    return reduce(DataFrame.unionAll, results), len(numbers)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string").cast("binary").alias("text")
    return docs.select(F.monotonically_increasing_id().alias("tag"), F.col(id_col).alias("doc_id"), text)


def _hit_words(spans: Column) -> Column:
    """The words inside sorted spans, which may overlap."""
    none = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("words"))

    def step(a: Column, s: Column) -> Column:
        more = F.greatest(s["end"] - F.greatest(s["start"], a["end"]), F.lit(0)).cast("bigint")
        return F.struct(F.greatest(a["end"], s["end"]).alias("end"), (a["words"] + more).alias("words"))

    return F.aggregate(spans, none, step, lambda a: a["words"])


def _search(rows: DataFrame, parts: DataFrame, window: int) -> DataFrame:
    """tag, doc_id, n_words, spans, items, n_hit of the documents (tag, doc_id, text)."""
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)

    def run(sent: Broadcast) -> Callable:
        def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = Items.of(sent.value, window)
            for shard in _shards(batches, tests):
                yield _found(shard, tests, id_type)

        return one_pass

    found, passes = _each_part(rows, parts, run, FOUND.format(rows.schema["doc_id"].dataType.simpleString()))
    if passes > 1:
        # A document has a row for each part of the tests.
        spans, items = F.flatten(F.collect_list("spans")), F.flatten(F.collect_list("items"))
        found = found.groupBy("tag").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                                         F.array_sort(spans).alias("spans"), F.array_distinct(items).alias("items"))
    return found.withColumn("n_hit", _hit_words(F.col("spans")))


def find_contaminated(
    docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW_WORDS, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside an occurrence of a window), spans (start and end of
    hit runs, in words; runs found for different parts of the tests may overlap), item_ids (of the items with such
    windows, as text, sorted), contaminated.

    A window is `window` words in a row of an item, or all its words if it has fewer. Null and wordless texts and items
    match nothing. An item without an id marks words but isn't named. Repeated rows get equal answers, a repeated item
    counts once. Without tests nothing is contaminated; without documents there are no rows. Extra columns play no
    part."""
    parts = parts_of_tests(tests, item_col, item_text_col, part_bytes)
    found = _search(_texts(docs, id_col, text_col), parts, window)
    names = F.array_sort(F.array_distinct(F.filter("items", lambda i: i.isNotNull())))
    return found.select("doc_id", "n_words", "n_hit", "spans", names.alias("item_ids"), (F.col("n_hit") > 0).alias("contaminated"))


def longest_matches(
    docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW_WORDS, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """For every suffix of a test item that occurs with at least its window: item_id, item_at (its first word), n_words
    of its longest verbatim match in all documents, and one place of it: doc_id and doc_at. Items without words have no
    rows."""
    rows = _texts(docs, id_col, text_col)
    id_type = to_arrow_type(rows.schema["doc_id"].dataType)

    def run(sent: Broadcast) -> Callable:
        def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = Items.of(sent.value, window)
            for shard in _shards(batches, tests) if len(tests.suffixes) else ():
                best, place = Shard(shard.ids, tests).longest()
                hit = np.flatnonzero(best >= tests.lengths)
                owner, doc = tests.owners[hit], shard.at(place[hit])
                names = pa.array([tests.names[i] for i in owner], pa.string())
                numbers = [pa.array(x, pa.int32()) for x in (tests.suffixes[hit] - tests.starts[owner], best[hit], place[hit] - shard.starts[doc])]
                ids = pa.array([shard.names[d] for d in doc], id_type)
                yield pa.RecordBatch.from_arrays([names, *numbers, ids], ["item_id", "item_at", "n_words", "doc_at", "doc_id"])

        return one_pass

    parts = parts_of_tests(tests, item_col, item_text_col, part_bytes)
    found, _ = _each_part(rows, parts, run, LONGEST.format(rows.schema["doc_id"].dataType.simpleString()))
    best = found.groupBy("item_id", "item_at").agg(F.max(F.struct("n_words", "doc_id", "doc_at")).alias("m"))
    return best.select("item_id", "item_at", "m.n_words", "m.doc_id", "m.doc_at")


def decontaminate(
    docs: DataFrame, tests: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW_WORDS,
) -> DataFrame:
    """The documents without any test window, with their own columns; see `find_contaminated`."""
    tag = fresh(docs, "tag")
    rows = staged(docs.withColumn(tag, F.monotonically_increasing_id()), "tagged")
    texts = rows.select(F.col(tag).alias("tag"), F.col(tag).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    found = _search(texts, parts_of_tests(tests, item_col, item_text_col, PART_BYTES), window)
    gone = staged(found.where("n_hit > 0").select(F.col("tag").alias(tag)), "dropped")
    return rows.join(gone, tag, "left_anti").select(*docs.columns)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = find_contaminated(*tables)
    digest = F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), digest, "contaminated")
