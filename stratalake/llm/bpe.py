"""BPE encoding and decoding with the merges of a public tokenizer file.

A text is normalised and cut into words as the file says; each word's symbols are merged with a segment tree
over the ranks of adjacent pairs. The root holds the leftmost pair of lowest rank; a merge changes three leaves
at most, so a word of n symbols takes n log n steps however long it is. Words already met by a task are looked
up."""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import map_arrow

NAME = "word_bpe_49k.json"
NO_PAIR = (1 << 62) - 1
PLACE_BITS = 34
WORDS_KEPT = 400_000
ROWS_AT_ONCE = 256


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(NAME)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where Latin-1 prints it, else the next free letter
    from U+0100."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


# Contractions, runs of letters, single digits, runs of other symbols. Letters that the newest Unicode version
# added may be symbols to the tokenizers library, whose tables are older or newer than the regex module's; all
# others agree.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


class PairTree:
    """A segment tree of (rank, place) over the adjacent pairs of one word; the least is at the root."""

    def __init__(self, ranks: list[int]):
        self.width = 1 << max(0, (len(ranks) - 1).bit_length())
        self.nodes = [NO_PAIR] * (2 * self.width)
        for place, rank in enumerate(ranks):
            self.nodes[self.width + place] = rank << PLACE_BITS | place if rank >= 0 else NO_PAIR
        for i in range(self.width - 1, 0, -1):
            self.nodes[i] = min(self.nodes[2 * i], self.nodes[2 * i + 1])

    def first(self) -> int:
        """The place of the leftmost pair of lowest rank, or -1."""
        least = self.nodes[1]
        return -1 if least == NO_PAIR else least & ((1 << PLACE_BITS) - 1)

    def put(self, place: int, rank: int) -> None:
        nodes, i = self.nodes, self.width + place
        nodes[i] = rank << PLACE_BITS | place if rank >= 0 else NO_PAIR
        i >>= 1
        while i:
            least = min(nodes[2 * i], nodes[2 * i + 1])
            if nodes[i] == least:
                break
            nodes[i] = least
            i >>= 1


class WordBpe:
    """Encoder and decoder for one file of lower-case word BPE with word ends. Only the parts that decide ids
    are read from it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, self.end = model["vocab"], model["end_of_word_suffix"]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [b""] * (1 + max([*vocab.values(), *specials.values()]))
        for token, i in [*vocab.items(), *specials.items()]:
            self.tokens[i] = token.encode()
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[vocab[a] << 32 | vocab[b]] = (rank, vocab[a + b])
        letters = byte_letters()
        self.inside = [vocab[c] for c in letters]
        self.last = [vocab[c + self.end] for c in letters]
        self.special_ids = {s: i.to_bytes(4, "little") for s, i in specials.items()}
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.word = regex.compile(WORD)
        self.known: dict[str, bytes] = {}

    def merge(self, word: str) -> bytes:
        """The ids of one word, as little-endian 32-bit integers."""
        raw = word.encode()
        ids = [self.inside[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        n = len(ids)
        if n > 1:
            merges, none = self.merges, (-1, -1)
            tree = PairTree([merges.get(ids[i] << 32 | ids[i + 1], none)[0] for i in range(n - 1)])
            after, before = [*range(1, n), -1], [*range(-1, n - 1)]
            while (at := tree.first()) >= 0:
                gone = after[at]
                ids[at] = merges[ids[at] << 32 | ids[gone]][1]
                ids[gone] = -1
                after[at] = right = after[gone]
                if gone < n - 1:
                    tree.put(gone, -1)
                if right >= 0:
                    before[right] = at
                    tree.put(at, merges.get(ids[at] << 32 | ids[right], none)[0])
                else:
                    tree.put(at, -1)
                if (left := before[at]) >= 0:
                    tree.put(left, merges.get(ids[left] << 32 | ids[at], none)[0])
        packed = array("I", (i for i in ids if i >= 0))
        return packed.tobytes()

    def words(self, text: str) -> list[str]:
        # Lower case letter by letter: the sigma at a word's end is no exception.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return self.word.findall(text)

    def encode(self, text: str) -> bytes:
        known, out = self.known, []
        parts = self.special.split(text) if self.special else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.special_ids[part])
                continue
            for word in self.words(part):
                ids = known.get(word)
                if ids is None:
                    if len(known) >= WORDS_KEPT:
                        known.clear()
                    ids = self.merge(word)
                    if len(word) <= 64:
                        known[word] = ids
                out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens with one space between them, as the file names no decoder. An unknown id is left out."""
        tokens = self.tokens
        return b" ".join([tokens[i] for i in array("I", ids) if i < len(tokens) and tokens[i]]).decode()


_coders: dict[str, WordBpe] = {}


def coder(path: str) -> WordBpe:
    """One coder per Python worker and file."""
    if path not in _coders:
        _coders[path] = WordBpe(path)
    return _coders[path]


def encode_documents(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, n_tokens, ids) and the carried columns: the whole texts' ids as little-endian 32-bit integers. A null
    text is the empty text, which has no tokens. One row per row of the input, whatever its other columns; no shuffle."""
    path = path or default_path()
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)
    names = ["doc_id", "n_tokens", "ids", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                ids = [bpe.encode(t or "") for t in part.column(1).to_pylist()]
                counts = pa.array([len(i) // 4 for i in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), counts, pa.array(ids, pa.binary()), *part.columns[2:]], names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[2:]]
    return map_arrow(rows, run, ", ".join(["doc_id bigint, n_tokens bigint, ids binary", *kinds]))


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The columns of `encode_documents`, and `decoded`. Null ids decode to the empty text."""
    path = path or default_path()
    names = [*encoded.columns, "decoded"]
    at_ids = encoded.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = pa.array([bpe.decode(i or b"") for i in part.column(at_ids).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields]
    return map_arrow(encoded, run, ", ".join([*kinds, "decoded string"]))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of ids and of the decoded text; see `encode_documents`."""
    rows = decode_documents(encode_documents(docs, path), path)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))
