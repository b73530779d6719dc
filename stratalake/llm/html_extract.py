"""Main text of web pages by deducing the template of each host.

A page is a sequence of tokens: tags with the containers they stand in, and blocks of text. Tokens that occur
equally often as each other on every page of a host (equal occurrence vectors) form an equivalence class. The
class on the most pages that occurs once on each is the skeleton, if it keeps one order everywhere; another class
is nested in it if it keeps one order inside one gap of the skeleton on every page where it occurs. Text in a valid
class with tags is part of the template, as it never varies. What remains are the slots. The main slot is the innermost
container that has most of what varies on a host's pages, with their headlines; in it, names of elements and classes
only tell what stands beside the text. Occurrence vectors are kept as sums of page counts with random weights, so that a host of any
size takes one row per token."""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import map_arrow, staged

# Fewer distinct pages than this tell nothing about a template.
LEAST_PAGES_TEXT = 6
ROWS_AT_ONCE = 256

# Roles of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template canvas audio video select".split())
CONTAINERS = frozenset(
    "html head body main article section div nav header footer aside form ul ol dl table figure details dialog menu".split()
)
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption thead tbody tfoot blockquote pre address fieldset figcaption summary hr "
    "center option legend".split()
)
BOILERPLATE = frozenset("head nav header footer aside form menu dialog button label fieldset".split())
MAIN = frozenset(("main", "article"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Boilerplate inside a line of text: it ends with its block, whether or not it is closed.
INLINE = frozenset(("button", "label"))
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
# The elements for main text hold it if they have at least this part of the text that may be; else other slots do.
MAIN_SHARE = 1 / 3
# A container is the main slot of a host if it has this part of its pages' text that may be.
SLOT_SHARE = 0.6
# What holds the page or its main text is never beside it, whatever its names.
WHOLE = MAIN | {"html", "body"}
HINT_WORDS = (
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notification pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar widget"
).split()
HINT_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:_-]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""", re.DOTALL
)
ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
HINTS = frozenset(HINT_WORDS)
# Name parts that only say that something is a box, that speak of the layout around it, or that head a text.
BOXES = frozenset("area bar block box container div holder inner outer panel section wrap wrapper".split())
LAYOUT = frozenset("has no not with without".split())
HEADED = frozenset("article content entry page post story".split())
ENDS = {name: re.compile(rf"</{name}(?![A-Za-z0-9:_-])[^>]*>?", re.IGNORECASE) for name in RAW}
NEUTRAL, CONTENT, OUTSIDE = 0, 1, -1

def hint_of(name: str) -> str | None:
    """The hint word that a class or id is or ends with, boxes and numbers aside."""
    parts = re.findall(r"[a-z]+", name)
    if not LAYOUT.isdisjoint(parts):
        return None
    for words in (parts[-2:], parts[-1:]):
        if (word := "".join(words)) in HINTS:
            return word
    while len(parts) > 1 and parts[-1] in BOXES:
        parts.pop()
    word = parts[-1] if parts else None
    return word if word in HINTS else None


def hinted(attributes: str) -> tuple[str, frozenset[str]]:
    """(class, id and role as one string, the words in them that speak of something beside the main text)."""
    if not attributes.strip():
        return "", frozenset()
    found = [(k.lower(), v.strip("\"'").lower()) for k, v in ATTRIBUTE.findall(attributes)]
    if not found:
        return "", frozenset()
    # camelCase names are parted first, so that adBox and sideBar are seen.
    spelled = re.sub(r"([a-z])([A-Z])", r"\1-\2", attributes)
    names = [n for k, v in ATTRIBUTE.findall(spelled) if k.lower() != "role" for n in v.strip("\"'").lower().split()]
    words = {f"role {v}" for k, v in found if k == "role" and v in HINT_ROLES}
    for name in names:
        word = hint_of(name)
        if word and not (word == "header" and re.match("[a-z]*", name).group() in HEADED):
            words.add(word)
    return ";".join(f"{k}={' '.join(v.split())}" for k, v in sorted(found)), frozenset(words)


def key_of(token: str) -> int:
    value = xxhash.xxh64_intdigest(token.encode("utf-8", "replace"))
    return value - (1 << 64) if value >= 1 << 63 else value


@dataclass
class Block:
    """A block of text: its token's key, the state of its slot, whether it is all links, the containers around it (the
    keys of their paths), the form that it is in (-1 without one), and whether it is a headline."""

    text: str
    key: int
    state: int
    linked: bool
    within: tuple[int, ...]
    form: int
    headline: bool


class Page:
    """A page's tokens (key, state of the slot that follows, whether a tag) and blocks."""

    def __init__(self, source: str):
        self.tokens: list[tuple[int, int, bool]] = []
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, str, bool, bool]] = []  # name, label, beside the main text, main
        self.within: tuple[int, ...] = ()
        self.form, self.forms, self.block = -1, 0, ""
        self.had_main = False
        self.path, self.state = "", NEUTRAL
        self.parts: list[str] = []
        self.links, self.linked, self.block_beside = 0, True, False
        self.read(source)

    def read(self, source: str) -> None:
        at, end = 0, len(source)
        # Each search begins where the last tag or raw element ended, so nothing inside a script is taken for a tag.
        while m := TOKEN.search(source, at):
            if m.start() > at:
                self.text(source[at : m.start()])
            at = m.end()
            name = m.group(2)
            if name is None:
                continue
            name = name.lower()
            if m.group(1):
                self.close(name)
            else:
                at = self.open(name, m.group(3), source, at)
            if at >= end:
                break
        if at < end:
            self.text(source[at:])
        self.flush()
        self.settle_forms()

    def settle_forms(self) -> None:
        """A form that holds most of the page's text, in several blocks or in an element for main text, only wraps it. Any
        other is beside the main text."""
        mass = lambda blocks: sum(len(b.text) for b in blocks if b.state != OUTSIDE and not b.linked)
        total = mass(self.blocks)
        for form in {b.form for b in self.blocks} - {-1}:
            inside = [b for b in self.blocks if b.form == form]
            if 2 * mass(inside) < total or not any(b.state == CONTENT for b in inside) and len(inside) < 3:
                for b in inside:
                    b.state = OUTSIDE

    def text(self, raw: str) -> None:
        if raw.isspace():
            self.parts.append(" ")
        else:
            self.parts.append(raw)
            self.linked &= self.links > 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join(entities.unescape("".join(self.parts)).split())
            if text:
                state = OUTSIDE if self.block_beside else self.state
                key = key_of(f"={self.path}={text}")
                # A headline may well be a link; lists and runs of links are menus.
                linked = self.linked and self.block not in HEADINGS
                self.blocks.append(Block(text, key, state, linked, self.within, self.form, self.block == "h1"))
                self.tokens.append((key, state, False))
            self.parts = []
        self.linked = True

    def place(self) -> None:
        """The path and state after the stack has changed."""
        self.path = "/".join(label for _, label, _, _ in self.stack)
        # Containers inside the main text are parts of it, and no slots of their own.
        depth = next((k + 1 for k, (*_, main) in enumerate(self.stack) if main), len(self.stack))
        self.within = tuple(key_of("/".join(label for _, label, _, _ in self.stack[: k + 1])) for k in range(depth))
        beside = any(b for _, _, b, _ in self.stack)
        self.state = OUTSIDE if beside else CONTENT if any(m for *_, m in self.stack) else NEUTRAL

    def open(self, name: str, attributes: str, source: str, at: int) -> int:
        label, words = hinted(attributes)
        inside = any(m for *_, m in self.stack)
        if name in BLOCKS:
            self.end_inline()
        # Inside the main text only containers are named for what they are; headings and paragraphs for what they say.
        # A header there holds its headings.
        if inside:
            words = words - {"header"} if name in CONTAINERS else frozenset()
        beside = name not in WHOLE and bool(words)
        # An article in or after the main text that is named a comment is one.
        if name == "article" and (inside or self.had_main):
            beside = not COMMENTS.isdisjoint(words)
        self.had_main |= name in MAIN
        if name in RAW and not (name == "noscript" and inside):
            # Everything up to the end tag is the element's own; without one, all that follows a script or style is.
            if attributes.rstrip().endswith("/"):
                return at
            closing = ENDS[name].search(source, at)
            return closing.end() if closing else len(source) if name in ("script", "style", "textarea") else at
        if name == "br":
            self.parts.append(" ")
            return at
        if name in BLOCKS:
            self.flush()
            self.block = name
            self.block_beside = beside and name not in CONTAINERS
        elif name == "a":
            self.links += 1
        if name in CONTAINERS:
            # A form around the main text may only wrap it; that shows at the end of the page.
            wraps = name == "form" and not inside
            outside = beside or (name in BOILERPLATE and not wraps and not (name == "header" and inside))
            self.stack.append((name, f"{name}[{label}]" if label else name, outside, name in MAIN and not beside))
            if wraps and self.form < 0:
                self.form, self.forms = self.forms, self.forms + 1
            self.place()
        elif name in BOILERPLATE:
            self.flush()
            self.stack.append((name, name, True, False))
            self.place()
        if name in BLOCKS:
            self.tokens.append((key_of(f"<{self.path}<{name}[{label}]"), self.state, True))
        return at

    def end_inline(self) -> None:
        """A block ends the buttons and labels that were left open."""
        if self.stack and self.stack[-1][0] in INLINE:
            self.flush()
            while self.stack and self.stack[-1][0] in INLINE:
                self.stack.pop()
            self.place()

    def close(self, name: str) -> None:
        if name == "a":
            self.links = max(0, self.links - 1)
            return
        if name not in BLOCKS and name not in BOILERPLATE:
            return
        if name in BLOCKS:
            self.end_inline()
        self.flush()
        self.block, self.block_beside = "", False
        path = self.path
        if name in CONTAINERS or name in BOILERPLATE:
            depth = next((d for d in range(len(self.stack) - 1, -1, -1) if self.stack[d][0] == name), -1)
            # An end tag without its start is nothing; one that crosses others ends them too.
            if depth < 0:
                return
            del self.stack[depth:]
            if not any(n == "form" for n, *_ in self.stack):
                self.form = -1
            self.place()
        self.tokens.append((key_of(f">{path}>{name}"), self.state, True))


def masses(page: Page) -> dict[int, list[int]]:
    """For each container, and under 0 for the page: its depth, and the characters and headlines in it of text that may
    be main text."""
    out = {0: [-1, 0, 0]}
    for b in page.blocks:
        if b.state != OUTSIDE and not b.linked:
            for depth, path in enumerate((0, *dict.fromkeys(b.within)), -1):
                held = out.setdefault(path, [depth, 0, 0])
                held[1] += len(b.text)
                held[2] += b.headline
    return out


def main_text(source: str | None, fixed: set[int], slot: int | None = None) -> str:
    """The blocks of a page that are main text, one per line. `fixed`: keys of the template's texts; `slot`: the
    container that is the main slot of the page's host, if its template has one.

    On a page that has it only that container counts. There the elements for main text decide if they hold a good part
    of the text that may be; else all such text counts that is neither a mere link nor fixed."""
    page = Page(source or "")
    may = [b for b in page.blocks if b.state != OUTSIDE]
    if slot is not None:
        may = [b for b in may if slot in b.within] or may
    free = [b for b in may if b.state == CONTENT or not b.linked and b.key not in fixed]
    content = [b for b in may if b.state == CONTENT]
    mass = lambda blocks: sum(len(b.text) for b in blocks)
    chosen = content if content and mass(content) >= MAIN_SHARE * mass(free) else free
    return "\n".join(b.text for b in chosen)


def host_of(url: str) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def page_tokens(pages: DataFrame) -> DataFrame:
    """One row per distinct page of a host: host, digest, r1, r2 (random weights of the page), and per distinct token
    its key, count, first and last place, and kind. Copies tell nothing about what varies, pages without a host have
    no template in common, and pages without tokens follow none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                rows, within = [], []
                for source in part.column(4).to_pylist():
                    seen: dict[int, list[int]] = {}
                    page = Page(source or "")
                    within.append([{"path": k, "depth": d, "chars": c, "heads": h} for k, (d, c, h) in masses(page).items()])
                    for place, (key, _, is_tag) in enumerate(page.tokens):
                        if key in seen:
                            seen[key][0] += 1
                            seen[key][2] = place
                        else:
                            seen[key] = [1, place, place, is_tag]
                    rows.append([{"key": k, "n": v[0], "at": v[1], "last": v[2], "tag": v[3]} for k, v in seen.items()])
                fields = [("key", pa.int64()), ("n", pa.int64()), ("at", pa.int64()), ("last", pa.int64()), ("tag", pa.bool_())]
                kind = pa.list_(pa.struct(fields))
                path = pa.list_(pa.struct([(name, pa.int64()) for name in ("path", "depth", "chars", "heads")]))
                lists = [pa.array(rows, kind), pa.array(within, path)]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], *lists], ["host", "digest", "r1", "r2", "tokens", "within"])

    weight = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "digest"), F.lit(1 << 31))
    rows = pages.where("host <> ''").withColumn("digest", F.unhex(F.md5(F.coalesce("html", F.lit("")))))
    rows = rows.select("host", "digest", weight(1).alias("r1"), weight(2).alias("r2"), "html")
    token = "struct<key:bigint,n:bigint,at:bigint,last:bigint,tag:boolean>"
    path = "struct<path:bigint,depth:bigint,chars:bigint,heads:bigint>"
    rows = map_arrow(rows, run, f"host string, digest binary, r1 bigint, r2 bigint, tokens array<{token}>, within array<{path}>")
    return rows.where(F.size("tokens") > 0).dropDuplicates(["host", "digest"])


def places_of_classes(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """host, class, gap, bad: for each page and class of its host's plan that is on it, the gap of the skeleton that
    holds the class (-1 without one), and whether its tokens leave that gap or their order. Equal rows of a batch
    are one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, plan = None, []
        for batch in batches:
            found: dict[tuple[str, int, int, bool], None] = {}
            columns = [batch.column(k) for k in range(4)]
            for k, name in enumerate(columns[0].to_pylist()):
                if name != host:
                    host, plan = name, batch.column(4)[k].as_py()
                keys = columns[1][k].as_py()
                span = dict(zip(keys, zip(columns[2][k].as_py(), columns[3][k].as_py(), strict=True), strict=True))
                by_class: dict[int, list[tuple[int, int]]] = {}
                for t in plan:
                    if t["key"] in span:
                        by_class.setdefault(t["class"], []).append(span[t["key"]])
                # Class 0 is the skeleton; a class keeps the order of its tokens' mean places.
                skeleton = [a for a, _ in by_class.get(0, [])]
                for number, spans in by_class.items():
                    in_order = all(a[0] < b[0] and a[1] < b[1] for a, b in pairwise(spans))
                    if number == 0:
                        found[name, 0, 0, not in_order] = None
                        continue
                    ordered = sorted(skeleton)
                    first = bisect_right(ordered, min(a for a, _ in spans))
                    last = bisect_right(ordered, max(b for _, b in spans))
                    gap = first if skeleton else -1
                    found[name, number, gap, not in_order or first != last or not skeleton] = None
            rows_out = list(zip(*found, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_())
            arrays = [pa.array(c, kind) for c, kind in zip(rows_out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["host", "class", "gap", "bad"])

    pages = rows.join(plans, "host").select("host", "tokens.key", "tokens.at", "tokens.last", "plan")
    return map_arrow(pages, run, "host string, class bigint, gap bigint, bad boolean")


def templates(pages: DataFrame) -> DataFrame:
    """(host, fixed): for hosts with enough pages, the keys of the texts that belong to the template. Classes with
    tags on most pages count, so that some odd pages hide nothing: the one on the most pages whose tokens are there
    once is the skeleton. A text of it is fixed if the skeleton keeps its order on every page that has it; a text of
    another class, if that class keeps its order and lies in the same gap of the skeleton on every page that has it."""
    rows = staged(page_tokens(pages), "tokens")
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    hosts = staged(hosts.where(F.col("pages") >= LEAST_PAGES_TEXT), "hosts")
    each = rows.select("host", "r1", "r2", F.explode("tokens").alias("t"))
    # Sums stay below 2**63 for 2**32 occurrences of a token on one host.
    tokens = each.groupBy("host", F.col("t.key").alias("key")).agg(
        F.count(F.lit(1)).alias("found_on"),
        F.sum("t.n").alias("total"),
        F.sum(F.col("t.n") * F.col("r1")).alias("v1"),
        F.sum(F.col("t.n") * F.col("r2")).alias("v2"),
        F.sum("t.at").alias("at"),
        F.max("t.tag").alias("tag"),
    )
    # Most texts occur on one page and are no template; those on most pages are no more than twice a page's tokens.
    tokens = tokens.where(F.col("found_on") >= LEAST_PAGES_TEXT).join(hosts, "host").where(F.col("found_on") * 2 > F.col("pages"))
    classes = tokens.groupBy("host", "found_on", "total", "v1", "v2").agg(
        F.max("tag").alias("with_tag"), F.sort_array(F.collect_list(F.struct("at", "key", "tag"))).alias("members")
    )
    # Per host: classes by pages, those whose tokens are there once first.
    listed = F.struct((F.col("total") > F.col("found_on")).alias("repeats"), (-F.col("found_on")).alias("less"), "v1", "v2", "members")
    listed = classes.where("with_tag").groupBy("host").agg(F.sort_array(F.collect_list(listed)).alias("classes"))
    # A host whose classes all repeat has no skeleton, and so no template.
    listed = listed.where(~F.col("classes")[0]["repeats"])
    token = lambda m, i: F.struct(m["key"].alias("key"), m["tag"].alias("tag"), i.cast("bigint").alias("class"))
    plan = F.flatten(F.transform("classes", lambda c, i: F.transform(c["members"], lambda m: token(m, i))))
    plans = staged(listed.select("host", plan.alias("plan")), "plans")
    placed = places_of_classes(rows, plans).groupBy("host", "class").agg(
        F.max("bad").alias("bad"), F.min("gap").alias("low"), F.max("gap").alias("high")
    )
    good = placed.where("NOT bad AND low = high").groupBy("host").agg(F.collect_set("class").alias("good"))
    is_fixed = lambda t: ~t["tag"] & F.array_contains("good", t["class"])
    # Without an ordered skeleton there are no gaps.
    nested = plans.join(good.where(F.array_contains("good", F.lit(0).cast("bigint"))), "host")
    fixed = F.transform(F.filter("plan", is_fixed), lambda t: t["key"])
    fixed = nested.select("host", fixed.alias("fixed"))
    return staged(main_slots(rows, hosts, listed).join(fixed, "host", "left"), "templates")


def main_slots(rows: DataFrame, hosts: DataFrame, listed: DataFrame) -> DataFrame:
    """(host, slot): the main slot of each host with a skeleton: the innermost container on most of its pages that has
    a good part of all their text that may be main text, and all headlines."""
    each = rows.join(hosts, "host").select("host", "pages", F.explode("within").alias("w"))
    sums = each.groupBy("host", "pages", "w.path").agg(
        *(F.sum(f"w.{c}").alias(c) for c in ("chars", "heads")), F.max("w.depth").alias("depth"), F.count(F.lit(1)).alias("found_on")
    )
    total = sums.where("path = 0").select("host", F.col("chars").alias("all_chars"), F.col("heads").alias("all_heads"))
    good = sums.where("path <> 0 AND found_on * 2 > pages").join(total, "host")
    good = good.where((F.col("chars") >= SLOT_SHARE * F.col("all_chars")) & (F.col("heads") == F.col("all_heads")))
    best = good.groupBy("host").agg(F.max(F.struct("depth", "chars", "path")).alias("best"))
    return listed.select("host").join(best, "host", "left").select("host", F.col("best.path").alias("slot"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per page: main text in page order, a line per block, with character
    references decoded and white space inside a block made one space.

    A null or empty page has an empty text. Hosts with few pages, pages without a host, and pages that don't
    follow their host's template are read by their elements alone. Repeated pages get equal texts; extra columns
    play no part."""
    types = {"page_id": "bigint", "url": "string", "html": "string"}
    rows = pages.select(*[F.col(c).cast(kind).alias(c) for c, kind in types.items()])
    rows = rows.withColumn("host", host_of("url"))
    # The templates are a written table: Spark broadcasts it if it is small; else it merges, and splits hosts
    # with many pages.
    rows = rows.join(templates(rows), "host", "left").select("page_id", "url", "host", "html", "fixed", "slot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, fixed, slot = None, set(), None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = []
                for k, (name, source) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                    if name != host:
                        host = name
                        fixed, slot = set(part.column(4)[k].as_py() or ()), part.column(5)[k].as_py()
                    texts.append(main_text(source, fixed, slot))
                sizes = pa.array([len(t) for t in texts], pa.int64())
                columns = [*part.columns[:2], pa.array(texts, pa.string()), sizes]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return map_arrow(rows, run, "page_id bigint, url string, text string, n_chars bigint")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
