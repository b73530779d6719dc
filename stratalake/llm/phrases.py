"""Phrases by the stripes pattern.

A stripe is keyed by a prefix of words (and the language) and counts the words that come next. Tasks build stripes
from the texts, stripes of equal keys are merged by adding them up word by word, and what the phrases need is read
off the merged stripes: the extensions of a prefix and their counts, the prefix's own count as an entry of a shorter
stripe, and the strongest longer phrase around a phrase, over both its sides.

Stripes are built one prefix length at a time, with a pass over the texts for each. A phrase can only be frequent if
what is left of it without its first and without its last word is, so a pass counts just those places whose two
shorter phrases may be frequent. What may be is told by a Bloom filter of the frequent ones, whose size has a bound;
it lets through too much at times, never too little, and all counts are exact."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import map_arrow, staged
from stratalake.operators.ordering import top_n_per_key

PHRASE_WORDS = 4
LEAST_COUNT = 30
TOP = 2000
SCALE = 2_000_000
SUBSUMED_PERCENT = 80
UNKNOWN_LANG = "und"
# Bytes of text whose stripes a task holds at once, about 150 MB of work space; a longer text is counted by itself.
HELD_BYTES = 16_000_000
# A hot stripe comes in so many parts, by a hash of the next word. Hot are the empty prefix and prefixes that are at
# least one in HOT_SHARE of all words, so there are at most that many.
PARTS, HOT_SHARE = 256, 1000
# Bits of a filter for each frequent phrase, and at most: 32 MB.
FILTER_BITS, MOST_BITS = 16, 28
CHUNK_BYTES = 1 << 16

# A-Z lowered, ends of pieces made a dot, tabs a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 46 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b for b in range(256))
# Next words with a space between them, and their counts as 32-bit integers.
STRIPES = "lang string, prefix string, part int, words string, counts binary"

ODD, MULTIPLY, SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD), np.uint64(32)


def joined_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a phrase from those of its first words and its last word."""
    h = (left * ODD ^ (left >> SHIFT)) + right
    h = (h ^ (h >> SHIFT)) * MULTIPLY
    return h ^ (h >> SHIFT)


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


class Filter:
    """Which phrases may be frequent, by two bits of their hash."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    @staticmethod
    def places(h: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
        return (h & mask).astype(np.int64), ((h >> SHIFT) & mask).astype(np.int64)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in self.places(h, self.mask):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        return out


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 for equal keys, and a place of each number."""
    numbers, kinds = pd.factorize(keys)
    place = np.empty(len(kinds), np.int64)
    place[numbers] = np.arange(len(keys))
    return numbers, place


class Held:
    """Texts by language, until their stripes are made."""

    def __init__(self):
        self.texts: dict[str, list[bytes]] = {}
        self.bytes = 0

    def add(self, lang: str, text: bytes | None) -> None:
        if text:
            self.texts.setdefault(lang, []).append(text)
            self.bytes += len(text)

    def words(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The different words, with a dot first, and all words by number, 0 at the ends of pieces and texts; with the
        number of words of each language."""
        parts = [pa.array(["."])]
        for texts in self.texts.values():
            joined = b".".join([b"", *texts, b""]).translate(_FOLD).replace(b".", b" . ")
            text = pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, len(joined)], np.int32)), pa.py_buffer(joined)])
            found = pc.ascii_split_whitespace(text).flatten()
            parts.append(found.filter(pc.not_equal(found, "")))
        coded = pa.concat_arrays(parts).dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy()[1:].astype(np.int64), np.array([len(p) for p in parts[1:]])

    def stripes(self, size: int, known: Filter | None, hot: set[tuple[str, str]]) -> pa.RecordBatch:
        """The stripes of all prefixes of `size` - 1 words."""
        names, ids, sizes = self.words()
        langs = list(self.texts)
        lang = np.repeat(np.arange(len(langs), dtype=np.int32), sizes)
        n, kinds = len(ids), len(names)
        word_hashes = np.fromiter((word_hash(w.encode()) for w in names.to_pylist()), np.uint64, kinds)
        if known is None:
            at = np.flatnonzero(ids)
        else:
            # Places where both shorter phrases may be frequent.
            hashes = word_hashes[ids]
            h = joined_hash(np.fromiter((word_hash(x.encode()) for x in langs), np.uint64, len(langs))[lang], hashes)
            whole = ids > 0
            for k in range(1, size - 1):
                h = joined_hash(h[: n - k], hashes[k:])
                whole = whole[: n - k] & (ids[k:] > 0)
            where = np.flatnonzero(whole)
            may = np.zeros(len(whole) + 1, bool)
            may[where] = known.has(h[where])
            at = np.flatnonzero(may[:-1] & may[1:])
            del h, hashes, whole, where, may
        # Prefixes get numbers level by level, so that keys are exact and fit 64 bits. `origin`: a place of each prefix.
        prefix, origin = lang[at].astype(np.int64), at
        for k in range(size - 1):
            prefix, origin = numbered(prefix * kinds + ids[at + k])
        entry, place = numbered(prefix * kinds + ids[at + size - 1])
        counts = np.bincount(entry, minlength=len(place))
        prefix, following = prefix[place], ids[at + size - 1][place]
        of_langs = pa.array(langs, pa.string())
        if size == 1:
            many = np.arange(len(langs))
            of_lang, texts = of_langs, pa.array([""] * len(langs), pa.string())
            is_hot = np.ones(len(langs), bool)
        else:
            many = at[origin]
            of_lang = of_langs.take(pa.array(lang[many]))
            texts = pc.binary_join_element_wise(*[names.take(pa.array(ids[many + k])) for k in range(size - 1)], " ")
            is_hot = np.zeros(len(many), bool)
            if hot:
                wanted = pa.array([f"{x} {y}" for x, y in hot])
                is_hot = pc.is_in(pc.binary_join_element_wise(of_lang, texts, " "), wanted).to_numpy(zero_copy_only=False)
        part = np.where(is_hot[prefix], (word_hashes % np.uint64(PARTS))[following].astype(np.int64), 0)
        order = np.argsort(prefix * PARTS + part)
        prefix, part, following, counts = prefix[order], part[order], following[order], counts[order]
        begin = np.flatnonzero(np.concatenate([[True], (prefix[1:] != prefix[:-1]) | (part[1:] != part[:-1])])[: len(prefix)])
        ends = np.append(begin, len(prefix)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), names.take(pa.array(following)))
        numbers = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends * 4), pa.py_buffer(counts.astype("<u4"))])
        place = pa.array(prefix[begin])
        columns = [of_lang.take(place), texts.take(place), pa.array(part[begin], pa.int32()), pc.binary_join(lists, " "), numbers]
        return pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "part", "words", "counts"])


def partial_stripes(docs: DataFrame, size: int, known: Broadcast | None, hot: set[tuple[str, str]]) -> DataFrame:
    """The stripes that tasks find in their documents (lang, text as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        check = None if known is None else Filter(np.frombuffer(known.value, np.uint8))
        held = Held()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for lang, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    held.add(lang, text)
                    if held.bytes >= HELD_BYTES:
                        yield held.stripes(size, check, hot)
                        held = Held()
        if held.texts:
            yield held.stripes(size, check, hot)

    return map_arrow(docs, run, STRIPES)


def merged_stripes(partial: DataFrame, least: int) -> DataFrame:
    """Stripes of equal lang, prefix and part added up word by word: a row (lang, prefix, word, f) for each entry that
    is not rarer than `least`, and one with a null word for the stripe's total. Stripes are merged while they are read,
    one key after the other; what is in memory is a batch and the sums of the key that goes on behind it."""
    rows = partial.repartition("lang", "prefix", "part").sortWithinPartitions("lang", "prefix", "part")
    keys = ["lang", "prefix", "part"]

    def entries(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.Table]:
        """The batch's keys, and (key, word, n) with the keys by number."""
        change = np.zeros(batch.num_rows, bool)
        for name in keys:
            column = batch.column(name)
            change[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        number = np.cumsum(change)
        change[0] = True
        words = pc.split_pattern(batch.column("words"), " ")
        counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), "<u4").astype(np.int64)
        of_key = np.repeat(number, pc.list_value_length(words).to_numpy())
        names = batch.select(keys).take(pa.array(np.flatnonzero(change)))
        return names, pa.table({"key": of_key, "word": words.flatten(), "n": counts})

    def added(table: pa.Table) -> pa.Table:
        return table.group_by(["key", "word"]).aggregate([("n", "sum")]).rename_columns(["key", "word", "n"])

    def finished(names: pa.RecordBatch, sums: pa.Table) -> pa.RecordBatch:
        """`names`: the keys (lang, prefix) by number."""
        key, n = sums["key"].to_numpy(), sums["n"].to_numpy()
        totals = np.bincount(key, n.astype(np.float64), names.num_rows) if n.sum() < 1 << 52 else None
        if totals is None:
            totals = np.zeros(names.num_rows, np.int64)
            np.add.at(totals, key, n)
        kept = np.flatnonzero(n >= least)
        place = pa.array(np.concatenate([key[kept], np.arange(names.num_rows)]))
        words = pa.concat_arrays([sums["word"].combine_chunks().take(pa.array(kept)), pa.nulls(names.num_rows, pa.string())])
        f = pa.array(np.concatenate([n[kept], totals.astype(np.int64)]))
        columns = [names.column("lang").take(place), names.column("prefix").take(place), words, f]
        return pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "word", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last key of a batch may go on in the next: its sums so far, and its name.
        held: tuple[pa.RecordBatch, pa.Table] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names, table = entries(batch)
            if held:
                if held[0].to_pylist() == names.slice(0, 1).to_pylist():
                    table = pa.concat_tables([held[1], table])
                else:
                    yield finished(held[0], held[1])
            sums = added(table)
            last = names.num_rows - 1
            open_ = np.asarray(sums["key"]) == last
            if last:
                yield finished(names.slice(0, last), sums.filter(pa.array(~open_)))
            rest = sums.filter(pa.array(open_))
            held = names.slice(last, 1), rest.set_column(0, "key", pa.array(np.zeros(rest.num_rows, np.int64)))
        if held:
            yield finished(*held)

    return map_arrow(rows, run, "lang string, prefix string, word string, f bigint")


def filter_of(stripes: DataFrame, size: int) -> Broadcast:
    """A filter of the phrases in merged stripes. Its bits are set in chunks by tasks; at most 32 MB come together."""
    spark = stripes.sparkSession
    phrases = stripes.where("word IS NOT NULL")
    bits = 1 << min(MOST_BITS, max(19, (FILTER_BITS * phrases.count()).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, prefix, word = (c.to_pylist() for c in batch.columns)
            columns = [lang, *(zip(*(p.split(" ") for p in prefix), strict=True) if size > 1 and prefix else ()), word]
            hashes = [np.fromiter((word_hash(w.encode()) for w in c), np.uint64, len(c)) for c in columns]
            h = hashes[0]
            for more in hashes[1:]:
                h = joined_hash(h, more)
            at = np.unique(np.concatenate(Filter.places(h, np.uint64(bits - 1))))
            yield pa.RecordBatch.from_arrays([pa.array((at >> 3) // CHUNK_BYTES, pa.int32()), pa.array(at)], ["chunk", "at"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            chunk, at = (c.to_numpy() for c in batch.columns)
            for number in np.unique(chunk):
                inside = at[chunk == number] - int(number) * CHUNK_BYTES * 8
                block = held.setdefault(int(number), np.zeros(CHUNK_BYTES, np.uint8))
                np.bitwise_or.at(block, inside >> 3, (1 << (inside & 7)).astype(np.uint8))
        data = [pa.array(list(held), pa.int32()), pa.array([b.tobytes() for b in held.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(data, ["chunk", "block"])

    found = map_arrow(phrases.select("lang", "prefix", "word"), places, "chunk int, at bigint")
    blocks = map_arrow(found.repartition("chunk"), chunks, "chunk int, block binary")
    table = np.zeros(bits // 8, np.uint8)
    for row in blocks.collect():
        at = row["chunk"] * CHUNK_BYTES
        table[at : at + CHUNK_BYTES] = np.frombuffer(row["block"], np.uint8)
    return spark.sparkContext.broadcast(table.tobytes())


def frequent_phrases(docs: DataFrame, lang_col: str, text_col: str, longest: int, least: int) -> tuple[list[DataFrame], DataFrame]:
    """For each length the merged stripes' entries (lang, prefix, word, f), and (lang, n) for all words."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang")
    texts = docs.select(lang, F.col(text_col).cast("string").cast("binary").alias("text"))
    levels, known, hot, totals, words = [], None, set(), None, 0
    for size in range(1, longest + 1):
        stripes = staged(merged_stripes(partial_stripes(texts, size, known, hot), least), f"stripes{size}")
        entries = stripes.where("word IS NOT NULL")
        levels.append(entries)
        if size == 1:
            totals = staged(stripes.where("word IS NULL").groupBy("lang").agg(F.sum("f").alias("n")), "totals")
            words = totals.agg(F.sum("n")).first()[0] or 0
        if size < longest:
            known = filter_of(stripes, size)
            often = entries.where(F.col("f").cast("decimal(28,0)") * HOT_SHARE >= words).select("lang", phrase().alias("phrase"))
            hot = {tuple(r) for r in often.collect()}  # at most HOT_SHARE rows
    return levels, totals


def phrase(prefix: str = "prefix", word: str = "word") -> Column:
    return F.when(F.col(prefix) == "", F.col(word)).otherwise(F.concat_ws(" ", prefix, word))


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", longest: int = PHRASE_WORDS, least: int = LEAST_COUNT,
    top: int = TOP,
) -> DataFrame:
    """The `top` phrases of 2 to `longest` words of each language: lang, rank, phrase, a, l, r, n, score.

    a is how often the phrase occurs (`least` times or more), n how many words the language has. A phrase is cut into two
    parts, which occur l and r times, where floor(2000000 a / (l + r)) is least (the first such cut), and that is its
    score. A phrase goes if some longer one around it has 80 % or more of its occurrences. Phrases are ranked by score,
    then a, both falling, then by their bytes. Case is that of A-Z only; phrases end at . , ; : ! ? and line breaks.
    A null language is `und`, a null text has no words; without documents there are no rows. Extra columns play no part,
    repeated rows count each time."""
    levels, totals = frequent_phrases(docs, lang_col, text_col, longest, least)
    named = [level.select("lang", phrase().alias("phrase"), F.lit(k + 1).alias("size"), "f") for k, level in enumerate(levels)]
    every, candidates = named[0], None
    for level in named[1:]:
        every = every.unionAll(level)
        candidates = level if candidates is None else candidates.unionAll(level)
    # What is around a phrase by more than a word is not more frequent than what is around it by one.
    longer = every.where("size > 2")
    without_last = F.regexp_replace("phrase", " [^ ]+$", "")
    without_first = F.regexp_replace("phrase", "^[^ ]+ ", "")
    longer = longer.select("lang", F.explode(F.array(without_last, without_first)).alias("phrase"), "f")
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    wide = lambda c: F.col(c).cast("decimal(28,0)")
    kept = candidates.join(longer, ["lang", "phrase"], "left")
    kept = kept.where(F.col("around").isNull() | (100 * wide("around") < SUBSUMED_PERCENT * wide("f")))

    words = F.split("phrase", " ")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    counts = every.select("lang", "phrase", "f")
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr(f"(cast(a as decimal(28,0)) * {SCALE}) div (cast(l as decimal(28,0)) + r)")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = top_n_per_key(best, "lang", order, top, "phrase")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))
