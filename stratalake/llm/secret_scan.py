"""Secret scans that look through encodings.

A worklist starts with the text. Each layer is scanned by the base patterns, then unwrapped: percent escapes and
Unicode escapes anywhere in it, runs of base64, also over lines, and gzip or zlib data in base64 or escapes, in
any depth. What comes out is a new layer, until nothing new comes; large layers are read in windows. Each character of a layer knows the span of the original
text that it came from, so finds in any depth are reported there."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from itertools import islice
from urllib.parse import unquote_to_bytes

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import map_arrow

# The base patterns, and the least length of group 2 of assign and of the whole match of the others.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U000[0-9A-Fa-f]{5}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2})+")
ONE_UNICODE = re.compile(r"\\(?:u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|u\{([0-9A-Fa-f]{1,6})\}|x([0-9A-Fa-f]{2}))")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")

# Every find, and every run that decodes to one, is at least so many ASCII characters in a row.
ASCII_RUN = re.compile(rb"[\t\n\r\x20-\x7e]{12}")

# Lines of base64, with what may part them.
WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*[A-Za-z0-9+/_-]+)+={0,2}"
)
LINE = re.compile(r"(?<!\\)[A-Za-z0-9+/_-]+={0,2}|(?<=\\n)[A-Za-z0-9+/_-]+={0,2}|(?<=\\r\\n)[A-Za-z0-9+/_-]+={0,2}")
UTF8 = re.compile(
    rb"(?:[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+"
)
# Compressed data with escapes: how they begin, and of what they are made.
PERCENT_ZIP = re.compile(r"%1[Ff]%8[Bb]|(?:%[0-7]8|[8HXhx(])(?:%[0-9A-Fa-f]{2}|[!-$&-~])")
PERCENT_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2}|[!-$&-~])*")
HEX_BYTE = r"\\x[0-9A-Fa-f]{2}|\\u00[0-9A-Fa-f]{2}"
ESCAPED_ZIP = re.compile(rf"\\(?:x|u00)1[Ff]\\(?:x|u00)8[Bb]|(?:\\(?:x|u00)[0-7]8|[8HXhx(])(?:{HEX_BYTE}|[ -\[\]-~])")
ESCAPED_RUN = re.compile(rf"(?:{HEX_BYTE}|\\(?![xu])[\x00-\x7f]|[ -\[\]-~])*")
PERCENT_ONE, ESCAPED_ONE = (re.compile(r.pattern[:-1]) for r in (PERCENT_RUN, ESCAPED_RUN))
ESCAPED = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|u00([0-9A-Fa-f]{2})|([\x00-\x7f]))")
SHORT = {"n": "\n", "r": "\r", "t": "\t", "0": "\0", "a": "\a", "b": "\b", "f": "\f", "v": "\v"}

# Layers are read in windows of about this many bytes, up to a place that is in no find and no encoded run. A run
# that is longer than MOST is cut there.
WINDOW, MOST, OVERLAP = 1 << 20, 64 << 20, 1 << 16
BREAK = re.compile(
    rb"(?:[^A-Za-z0-9+/_=\s\\-][ \t]*[A-Za-z0-9+/_-]{0,15}|\S[ \t]+[A-Za-z0-9+/_-]{1,15})\r?\n|[^\t\n\r\x20-\x7e]"
)
PIECE, STEP = 1 << 16, 1 << 14
ROWS_AT_ONCE = 256

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The matches of the base patterns, leftmost and non-overlapping per kind; matches that are too short are
    used up but not reported."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


class Layer:
    """A decoded text with, for stretches of its characters, where they come from in the original."""

    def __init__(self, text: str, starts: list[int], origins: list[tuple[int, int, bool]]):
        # Stretch k begins at character starts[k]; its origin is (start, end, exact): exact stretches map
        # character by character.
        self.text, self.starts, self.origins = text, starts, origins

    def original(self, start: int, end: int) -> tuple[int, int]:
        """The original span of characters start to end (exclusive, not empty)."""
        first, last = (bisect_right(self.starts, p) - 1 for p in (start, end - 1))
        a, b = self.origins[first], self.origins[last]
        return (
            a[0] + start - self.starts[first] if a[2] else a[0],
            b[0] + end - self.starts[last] if b[2] else b[1],
        )


def whole(text: str) -> Layer:
    return Layer(text, [0], [(0, len(text), True)])


def replaced(layer: Layer, found: list[tuple[int, int, str]]) -> Layer:
    """The layer with the spans found (in order) replaced by their decoded texts."""
    parts, starts, origins, length, at = [], [], [], 0, 0

    def add(piece: str, start: int, end: int, copied: bool) -> None:
        nonlocal length
        if not piece:
            return
        if copied:
            # A copied stretch keeps the origins of its parts.
            k = bisect_right(layer.starts, start) - 1
            while k < len(layer.starts) and layer.starts[k] < end:
                begin = max(start, layer.starts[k])
                origin = layer.origins[k]
                starts.append(length + begin - start)
                origins.append((origin[0] + begin - layer.starts[k], origin[1], True) if origin[2] else origin)
                k += 1
        else:
            starts.append(length)
            origins.append((*layer.original(start, end), False))
        parts.append(piece)
        length += len(piece)

    for start, end, piece in found:
        add(layer.text[at:start], at, start, True)
        add(piece, start, end, False)
        at = end
    add(layer.text[at:], at, len(layer.text), True)
    return Layer("".join(parts), starts or [0], origins or [(0, 0, False)])


def percent_pieces(text: str) -> list[tuple[int, int, str]]:
    """Each run of percent escapes; one piece per decoded character, while bytes that are not UTF-8 are left
    alone."""
    found = []
    for m in PERCENT.finditer(text):
        for good in UTF8.finditer(bytes.fromhex(m.group().replace("%", ""))):
            at = m.start() + 3 * good.start()
            for c in good.group().decode():
                size = 3 * len(c.encode())
                found.append((at, at + size, c))
                at += size
    return found


def unicode_pieces(text: str) -> list[tuple[int, int, str]]:
    found = []
    for run in UNICODE.finditer(text):
        for m in ONE_UNICODE.finditer(text, *run.span()):
            code = int(next(g for g in m.groups() if g), 16)
            if code < 0x110000 and not 0xD800 <= code < 0xE000:
                found.append((*m.span(), chr(code)))
            elif 0xDC00 <= code < 0xE000 and found and found[-1][1] == m.start() and len(text) > m.start() - 6 >= 0:
                high = ONE_UNICODE.fullmatch(text, m.start() - 6, m.start())
                if high and high.group(1) and 0xD800 <= (h := int(high.group(1), 16)) < 0xDC00:
                    found.append((high.start(), m.end(), chr(0x10000 + (h - 0xD800 << 10 | code - 0xDC00))))
    return found


def compressed(raw: bytes) -> bool:
    """Whether the bytes begin like gzip or zlib data."""
    return raw[:2] == b"\x1f\x8b" or (len(raw) > 2 and raw[0] & 0x8F == 8 and (raw[0] << 8 | raw[1]) % 31 == 0)


def unpacked(unpack, raw: bytes) -> Iterator[bytes]:
    """What a piece of compressed data gives, part by part; of a damaged piece, what is before the damage."""
    while raw and not unpack.eof:
        spare = unpack.copy()
        try:
            out = unpack.decompress(raw, PIECE)
        except zlib.error:
            for k in range(len(raw)):
                try:
                    yield spare.decompress(raw[k : k + 1])
                except zlib.error:
                    break
            raise
        raw = unpack.unconsumed_tail
        yield out


class Stream:
    """Bytes that come in pieces. `take` gets them window by window, and whether they are too many for one; what
    compressed data unfolds to goes to a stream of its own, all members of a file to the same."""

    def __init__(self, take: Callable[[bytes, bool], None], heads: frozenset = frozenset()):
        self.take, self.heads = take, heads
        self.buffer, self.begun, self.large, self.searched = bytearray(), False, False, WINDOW
        self.inner: Stream | None = None
        self.unpack, self.pending, self.alive = None, b"", True
        self.fed = self.used = 0  # compressed bytes: given before the pending ones, unfolded

    def feed(self, piece: bytes) -> None:
        self.buffer += piece
        if self.begun:
            self.unfold(piece)
        elif len(self.buffer) > WINDOW:
            self.large = True
            self.begin()
        while len(self.buffer) > WINDOW:
            # A window ends where no find and no encoded run can go on; a run of MOST bytes is cut, with an overlap.
            end = BREAK.search(self.buffer, self.searched)
            if end is None and len(self.buffer) <= MOST:
                self.searched = max(WINDOW, len(self.buffer) - 64)
                return
            at = end.end() if end else len(self.buffer)
            self.take(bytes(self.buffer[:at]), True)
            del self.buffer[: at if end else at - OVERLAP]
            self.searched = WINDOW

    def begin(self) -> None:
        # Data that unfold to themselves end here: each stream knows the beginnings of those around it.
        self.begun, head = True, hashlib.blake2b(self.buffer[: WINDOW + 1], digest_size=16).digest()
        if head in self.heads or not compressed(bytes(self.buffer[:3])):
            self.alive = False
            return
        self.inner = Stream(self.take, self.heads | {head})
        self.unfold(bytes(self.buffer))

    def unfold(self, piece: bytes) -> None:
        if not self.alive:
            return
        piece, self.pending, at = self.pending + piece, b"", 0
        while self.alive and at < len(piece):
            if self.unpack is None:
                while at < len(piece) and piece[at] == 0:  # padding between members
                    at += 1
                if len(piece) - at < 3:
                    break
                if not compressed(piece[at : at + 3]):
                    self.alive = False
                    return
                self.unpack = zlib.decompressobj(47)
            part = piece[at : at + STEP]
            try:
                for out in unpacked(self.unpack, part):
                    self.inner.feed(out)
            except zlib.error:
                self.alive = False
            at += len(part) - len(self.unpack.unused_data)
            self.used = self.fed + at
            if self.unpack.eof:
                self.unpack = None
        self.pending = piece[at:]
        self.fed += at

    def end(self) -> None:
        stream = self
        while stream:
            if not stream.begun:
                stream.begin()
            if stream.buffer:
                stream.take(bytes(stream.buffer), stream.large)
            stream = stream.inner


def readable(raw: bytes) -> str | None:
    """The bytes as text, with replacement characters for what is not UTF-8; None if nothing can be found in it."""
    return raw.decode("utf-8", "replace") if ASCII_RUN.search(raw) else None


def base64_bytes(run: str) -> Iterator[bytes]:
    """What a run may stand for, in either alphabet. Runs often carry a neighbour's letters, such as `=` or a word
    before a dash, so the parts between dashes and slashes are tried too."""
    body = run.rstrip("=")
    forms = {body}
    if "-" in body or "_" in body or "/" in body:
        forms |= {p for p in re.split(r"[-_/]", body) if len(p) >= 16}
    for form in forms:
        plain = form.replace("-", "+").replace("_", "/")
        if len(plain) % 4 == 1:
            plain = plain[:-1]
        yield base64.b64decode(plain + "=" * (-len(plain) % 4))


def base64_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """Runs of base64 letters. Lines of one length, and a last one that is shorter, are one run; a single line of
    another length before them is also tried together with them."""
    at = 0
    for m in WRAPPED.finditer(text):
        yield from ((*r.span(), r.group()) for r in BASE64.finditer(text, at, m.start()))
        at = m.end()
        lines = [r.span() for r in LINE.finditer(text, *m.span())]
        sizes = [b - a for a, b in lines] + [-1]
        first, before = 0, None
        while first < len(lines):
            last = first + 1
            while sizes[last] == sizes[first]:
                last += 1
            if 0 < sizes[last] < sizes[first] and sizes[last + 1] != sizes[last]:
                last += 1
            run = "".join(text[a:b] for a, b in lines[first:last])
            if len(run) >= 16:
                yield lines[first][0], lines[last - 1][1], run
                if before is not None:
                    yield before, lines[last - 1][1], text[before : lines[first - 1][1]] + run
            before = lines[first][0] if last == first + 1 else None
            first = last
    yield from ((*r.span(), r.group()) for r in BASE64.finditer(text, at))


def percent_byte(piece: str, plus: bool) -> bytes:
    return unquote_to_bytes(piece.replace("+", " ") if plus else piece)


def escaped_byte(piece: str, plus: bool) -> bytes:
    def one(m: re.Match) -> str:
        a, b, c = m.groups()
        return chr(int(a or b, 16)) if a or b else SHORT.get(c, c)

    return ESCAPED.sub(one, piece).encode("latin-1")


def nothing(raw: bytes, large: bool) -> None:
    pass


def read_escaped(text: str, at: int, run: re.Pattern, byte: Callable, plus: bool, take: Callable) -> int:
    """Unfold a run of escaped bytes piece by piece for as long as it gives something; the bytes that it used."""
    stream, step = Stream(nothing), 64
    stream.begun, stream.inner = True, Stream(take)
    while stream.alive and (piece := run.match(text, at, at + step)) and piece.end() > at:
        stream.unfold(byte(piece.group(), plus))
        at, step = piece.end(), min(2 * step, PIECE)
    stream.end()
    return stream.used


def streams(text: str) -> Iterator[tuple[int, int, Callable[[Callable], None]]]:
    """(start, end, what sends the bytes of this stretch to a `take`): runs of base64, and compressed data written
    with percent or backslash escapes for some or all of its bytes."""
    for begin, run, one, byte, mark in (
        (PERCENT_ZIP, PERCENT_RUN, PERCENT_ONE, percent_byte, "%"),
        (ESCAPED_ZIP, ESCAPED_RUN, ESCAPED_ONE, escaped_byte, "\\"),
    ):
        for m in begin.finditer(text) if mark in text else ():
            if not compressed(byte(m.group(), False) + b"?"):
                continue
            # A plus may stand for a space.
            for plus in (False, True) if mark == "%" else (False,):
                if used := read_escaped(text, m.start(), run, byte, plus, nothing):
                    end = m.end()
                    for letter in islice(one.finditer(text, m.start()), used):
                        end = letter.end()
                    yield m.start(), end, partial(read_escaped, text, m.start(), run, byte, plus)
    for start, end, letters in base64_runs(text):
        for raw in base64_bytes(letters):

            def send(take: Callable, raw: bytes = raw) -> None:
                stream = Stream(take)
                stream.feed(raw)
                stream.end()

            yield start, end, send


def decoded(layer: Layer) -> Iterator[Layer]:
    text = layer.text
    if "%" in text and (found := percent_pieces(text)):
        yield replaced(layer, found)
    if "\\" in text and (found := unicode_pieces(text)):
        yield replaced(layer, found)


def order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each in order. A layer that was seen before at the same place is not unwrapped
    again, so texts that unfold to themselves end."""
    text = text or ""
    base = sorted(base_spans(text), key=order)
    spans, seen = set(base), set()

    def new(layer: Layer) -> bool:
        if not layer.text:
            return False
        digest = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        mark = (digest, *layer.original(0, len(layer.text)))
        if mark in seen:
            return False
        seen.add(mark)
        spans.update((kind, *layer.original(a, b)) for kind, a, b in base_spans(layer.text))
        return True

    def follow(first: Layer) -> None:
        work = deque([first])
        while work:
            layer = work.popleft()
            work.extend(filter(new, decoded(layer)))
            for start, end, send in streams(layer.text):
                origin = (*layer.original(start, end), False)

                # The windows of a large layer are followed one by one, so that no more than one is kept.
                def take(raw: bytes, large: bool, origin: tuple = origin) -> None:
                    inner = readable(raw)
                    if inner and new(made := Layer(inner, [0], [origin])):
                        follow(made) if large else work.append(made)

                send(take)

    follow(whole(text))
    return base, sorted(spans, key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, the counts of base finds by kind, base_sha256, all spans, and how many of
    them only decoding showed. Offsets are code points of the original, ends exclusive. A null text is the empty
    one; repeated rows get equal answers. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                found = [scan(t) for t in part.column(1).to_pylist()]
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in KINDS]
                digests = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string())
                spans = pa.array([joined(every) for _, every in found], pa.string())
                hidden = pa.array([len(every) - len(set(base)) for base, every in found], pa.int64())
                columns = [part.column(0), *counts, digests, spans, hidden]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_hidden"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_hidden bigint"
    return map_arrow(rows, run, schema)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
