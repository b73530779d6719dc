"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A three-letter window is the product of its letters' vectors,
shifted by two, one and no places, so order counts; a text is the sum of its windows, and a language the sum of
its texts' unit vectors. The language whose prototype has the largest cosine with a text is predicted, and the
cosine is the score."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import map_arrow

DIMENSIONS = 1024
SEED = 20240601
# The prototypes are learned from about this many texts of each language at most, chosen by a hash of the id.
TRAINING_TEXTS = 4000
# Work is cut so that arrays stay small whatever the texts: characters and texts at once, windows at once.
CHARS_AT_ONCE = 1 << 20
TEXTS_AT_ONCE = 256
WINDOWS_AT_ONCE = 8192


class Profiles:
    """Turns texts into vectors. One per Python worker; it grows by a vector for each letter met."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        every = np.frombuffer("".join(map(chr, range(0xD800))).encode("utf-32-le"), np.uint32)
        self.symbol = np.full(sys.maxunicode + 1, -1, np.int32)  # -1: not met yet; 0: not a letter
        letters = np.fromiter(map(str.isalpha, map(chr, every)), bool, len(every))
        self.symbol[: len(every)][~letters] = 0
        self.vectors = np.zeros((64, dimensions), np.int8)
        self.vectors[0] = self.random(0)
        self.met = 1

    def random(self, code: int) -> np.ndarray:
        return np.random.default_rng([SEED, code]).integers(0, 2, self.dimensions, np.int8) * 2 - 1

    def symbols(self, text: str) -> np.ndarray:
        """Lower-case letters as small numbers, every run of anything else as one 0."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        found = self.symbol[codes]
        if (found < 0).any():
            for code in np.unique(codes[found < 0]).tolist():
                self.symbol[code] = self.add(code) if chr(code).isalpha() else 0
            found = self.symbol[codes]
        kept = found != 0
        kept[:1] = True
        kept[1:] |= found[:-1] != 0
        return found[kept]

    def add(self, code: int) -> int:
        if self.met == len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
        self.vectors[self.met] = self.random(code)
        self.met += 1
        return self.met - 1

    def texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(vectors as rows, whether the text has a letter)."""
        out, letters = np.zeros((len(texts), self.dimensions), np.float32), np.zeros(len(texts), bool)
        rows, parts, size = [], [], 0
        for row, text in enumerate(texts):
            # A very long text goes in pieces that overlap by two characters, so that no window is lost.
            for at in range(0, max(len(text), 1), CHARS_AT_ONCE):
                piece = text[max(at - 2, 0) : at + CHARS_AT_ONCE]
                if size and (size + len(piece) > CHARS_AT_ONCE or len(rows) >= TEXTS_AT_ONCE):
                    self.bundle(rows, parts, out, letters)
                    rows, parts, size = [], [], 0
                rows.append(row)
                parts.append((" " if at == 0 else "") + piece + (" " if at + CHARS_AT_ONCE >= len(text) else ""))
                size += len(piece)
        if rows:
            self.bundle(rows, parts, out, letters)
        return out, letters

    def bundle(self, rows: list[int], parts: list[str], out: np.ndarray, letters: np.ndarray) -> None:
        """Add the parts' windows to their rows of `out`."""
        arrays = [self.symbols(p) for p in parts]
        lengths = [len(a) for a in arrays]
        s, owner = np.concatenate(arrays).astype(np.int64), np.repeat(np.arange(len(rows)), lengths)
        with_letter = np.bincount(owner, s != 0, len(rows)) > 0
        letters[rows] |= with_letter
        whole = owner[2:] == owner[:-2]
        n = self.met
        codes, owner = ((s[:-2] * n + s[1:-1]) * n + s[2:])[whole], owner[2:][whole]
        if not len(codes):
            return
        if n**3 <= 1 << 22:
            present = np.bincount(codes, minlength=n**3) > 0
            windows, column = np.flatnonzero(present), (np.cumsum(present) - 1)[codes]
        else:
            windows, column = np.unique(codes, return_inverse=True)
        sums = np.zeros((len(rows), self.dimensions), np.float32)
        for at in range(0, len(windows), WINDOWS_AT_ONCE):
            w = windows[at : at + WINDOWS_AT_ONCE]
            bound = np.roll(self.vectors, 2, 1)[w // (n * n)] * np.roll(self.vectors, 1, 1)[w // n % n] * self.vectors[w % n]
            here = (column >= at) & (column < at + len(w)) if len(windows) > WINDOWS_AT_ONCE else slice(None)
            cells = owner[here] * len(w) + column[here] - at
            counts = np.bincount(cells, minlength=len(rows) * len(w)).reshape(len(rows), len(w))
            sums += counts.astype(np.float32) @ bound.astype(np.float32)
        np.add.at(out, rows, sums)


_profiles: list[Profiles] = []


def profiles() -> Profiles:
    if not _profiles:
        _profiles.append(Profiles())
    return _profiles[0]


def unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms > 0, norms, 1)


def held_out(doc_id: Column) -> Column:
    """Whether a document's language may not be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def learn(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", bound: int = TRAINING_TEXTS
) -> dict[str, np.ndarray]:
    """A prototype per non-null language of the given rows. Of a language with more than `bound` rows exactly that
    many are taken, those of the smallest hashes of text and row number, so that neither ids nor copies decide.
    Languages are few, so the prototypes (4 KB each) come to the driver; texts do not. The row number follows the
    frame's partitions: the same files in the same splits give the same draw."""
    text = F.col(text_col).cast("string").alias("text")
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), text, F.monotonically_increasing_id().alias("row"))
    rows = rows.where(F.col("lang").isNotNull())
    rows = rows.select("lang", "text", F.xxhash64(F.lit(SEED), F.coalesce("text", F.lit("")), "row").alias("draw"))
    # Each task hands on `bound` numbers per language at most.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    drawn = rows.select("lang", "draw").withColumn("place", place).where(F.col("place") <= bound)
    limits = {r["lang"]: r["limit"] for r in drawn.groupBy("lang").agg(F.max("draw").alias("limit")).collect()}
    if not limits:
        return {}
    limit = F.lit(None).cast("bigint")
    for lang, value in limits.items():
        limit = F.when(F.col("lang") == lang, F.lit(value)).otherwise(limit)
    sample = rows.where(F.col("draw") <= limit).select("lang", "text").repartition(16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                vectors, _ = profiles().texts([t or "" for t in part.column(1).to_pylist()])
                langs = np.array(part.column(0).to_pylist(), object)
                for lang in set(langs.tolist()):
                    sums[lang] = sums.get(lang, 0.0) + unit(vectors[langs == lang]).sum(0, dtype=np.float64)
        names, values = list(sums), [v.tolist() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.list_(pa.float64()))], ["lang", "v"])

    parts = map_arrow(sample, run, "lang string, v array<double>").collect()  # 16 tasks x languages
    found = {lang: np.zeros(DIMENSIONS) for lang in limits}
    for r in parts:
        found[r["lang"]] += np.array(r["v"])
    return {lang: v for lang, v in sorted(found.items()) if v.any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) per document, from its whole text alone. `und` with score 0 if the text is
    null or has no letter, or if nothing was learned; ties go to the first language by name; a negative cosine
    scores 0. No shuffle."""
    names = list(prototypes)
    matrix = unit(np.array([prototypes[n] for n in names]).reshape(len(names), DIMENSIONS)).T.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                vectors, letters = profiles().texts([t or "" for t in part.column(1).to_pylist()])
                if names:
                    cosines = unit(vectors) @ matrix
                    best = cosines.argmax(1)
                    lang = [names[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
                    score = np.where(letters, np.clip(cosines.max(1), 0, 1), 0).astype(np.float64)
                else:
                    lang, score = ["und"] * part.num_rows, np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"]
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(rows, run, "doc_id bigint, lang_pred string, score double")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = predict(docs, learn(docs.where(~held_out(F.col("doc_id")))))
    return found.withColumn("held_out", held_out(F.col("doc_id"))).select("doc_id", "held_out", "lang_pred", "score")
