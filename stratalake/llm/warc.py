r"""Web archives: writing pages as WARC records, and reading archives whose payloads may hold anything.

Reading cuts files at the magic `WARC/1.`, wherever it stands; any minor version will do. Each piece that begins with a sound
record header is a candidate, and its length tells where its successor must start. Only what can be reached from
a file's start by these steps is a record: candidates point to their successors, and pointer jumping (each round
doubles the step) marks the chain from offset 0. Magic inside a payload starts a piece that nothing reachable
points to; its bytes belong to the record before it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.common import staged
from stratalake.session import work_dir

CRLF = "\r\n"
MAGIC = "WARC/1."
RECORDS_PER_FILE = 4000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32, null of null: 40 hex digits are 8 groups of 20 bits, each 4 letters."""
    digest = F.sha1(data)

    def letter(i: Column) -> Column:
        group = F.conv(digest.substr(F.floor(i / 4).cast("int") * 5 + 1, F.lit(5)), 16, 10).cast("int")
        value = F.floor(group / F.pow(F.lit(2), 15 - 5 * (i % 4))).cast("int") % 32
        return F.lit(BASE32).substr(value + 1, F.lit(1))

    return F.when(data.isNotNull(), F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(31)), letter)))


def urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:stratalake:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(">"))


def record_text(kind: str, page_id: Column, url: Column, size: Column, digest: Column, refers: Column | None = None) -> Column:
    """A record up to where its payload begins. The HTTP header tells the full payload's length also where the
    payload itself is left out."""
    status = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "
    http = F.concat(F.lit(status), size.cast("string"), F.lit(CRLF * 2))
    block = F.length(http) + (size if kind == "response" else F.lit(0))
    # White space and control characters can't stand in a header line; an address keeps its other characters.
    uri = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "%20")
    lines = [
        F.lit(f"WARC-Type: {kind}"),
        F.concat(F.lit("WARC-Record-ID: "), urn(page_id)),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.lit("WARC-Date: 2024-06-01T00:00:00Z"),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
    ]
    if refers is not None:
        lines += [
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            F.concat(F.lit("WARC-Refers-To: "), urn(refers)),
        ]
    lines += [
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    return F.concat(F.lit("WARC/1.1"), *[F.concat(F.lit(CRLF), x) for x in lines], F.lit(CRLF * 2), http)


def write_archives(pages: DataFrame, path: str) -> None:
    """Write one record per page. Of pages with equal payloads (a null one is empty) the one with the smallest
    page_id is a response with the payload (null ids come last; of equal ids, the smallest url), the others
    revisit it. No pages make no archives.

    Payloads are read where they lie: only pages whose payload occurs more than once take part in a join, and
    only its first occurrence carries the payload there. Spark's text writer ends each record with the two line
    ends that the format asks for."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("size", F.octet_length("html").cast("bigint"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    keys = staged(rows.groupBy("digest", "size", "page_id", "url").agg(F.count(F.lit(1)).alias("n")), "payloads")
    first = F.min(F.struct(F.isnull("page_id").alias("none"), "page_id", "url")).alias("first")
    groups = keys.groupBy("digest").agg(first, F.sum("n").alias("pages")).where("pages > 1")
    groups = staged(groups.selectExpr("digest", "first.page_id AS first_id", "first.url AS first_url"), "repeated")

    # `groups` is a written table: Spark broadcasts it if it is small, and merges otherwise.
    single = rows.join(groups, "digest", "left_anti").select("digest", "size", "page_id", "url", "html")
    is_first = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    firsts = rows.join(groups, "digest").where(is_first)
    firsts = firsts.groupBy("digest", "size", "page_id", "url").agg(F.first("html").alias("html"))
    response = record_text("response", F.col("page_id"), F.col("url"), F.col("size"), F.col("digest"))
    responses = single.unionByName(firsts).select(F.concat(response, F.col("html")).alias("value"))
    # Rows equal in page, url and payload are one key that occurs n times; the first key's first occurrence is
    # the response.
    again = keys.join(groups, "digest").withColumn("n", F.col("n") - is_first.cast("int"))
    again = again.withColumn("copy", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(1).cast("bigint"), F.col("n")))))
    revisit = record_text("revisit", F.col("page_id"), F.col("url"), F.col("size"), F.col("digest"), F.col("first_id"))
    records = responses.unionByName(again.select(revisit.alias("value")))
    records.write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """Every file cut at the magic: file, block (where the task's part of the file begins), value."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        F.monotonically_increasing_id().alias("line"),
    )


def header_field(header: Column, name: str) -> Column:
    return F.regexp_extract(header, rf"(?im)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """What each piece says of itself: bytes, and for a sound header its fields, where the record must end, and
    the payload's digest if the piece holds all of it."""
    value = F.col("value")
    header = F.substring_index(value, CRLF * 2, 1)
    df = pieces(spark, path).withColumn("header", header).withColumn("bytes", F.octet_length("value").cast("bigint"))
    length = header_field(F.col("header"), "Content-Length").try_cast("bigint")
    df = df.withColumn("head", F.octet_length("header").cast("bigint") + 4).withColumn("length", length)
    kind = header_field(F.col("header"), "WARC-Type")
    versioned = value.rlike(r"^[0-9]+\r\n")
    sound = versioned & (kind != "") & F.col("length").isNotNull() & (F.col("bytes") >= F.col("head"))
    df = df.withColumn("kind", F.when(sound, kind))
    block = F.expr("substring(cast(value AS binary), cast(head + 1 AS int), cast(length AS int))")
    complete = F.col("kind").isNotNull() & (F.col("bytes") >= F.col("head") + F.col("length"))
    df = df.withColumn("http", F.when(complete, block))
    return df.select(
        "file", "block", "line", "bytes", "head", "length", "kind",
        F.when(F.col("kind").isNotNull(), F.col("header")).alias("header"),
        *http_parts(F.col("http")),
    )


def http_parts(http: Column) -> list[Column]:
    """Payload bytes, digest, and the length that the HTTP header tells, of a record's block."""
    text = http.cast("string")
    inner = F.substring_index(text, CRLF * 2, 1)
    skip = F.octet_length(inner) + 4
    payload = F.substring(http, skip + 1, F.octet_length(http))
    return [
        (F.octet_length(http) - skip).cast("bigint").alias("payload_size"),
        base32_sha1(payload).alias("payload_sha1"),
        header_field(inner, "Content-Length").try_cast("bigint").alias("told_size"),
    ]


def with_offsets(found: DataFrame) -> DataFrame:
    """Where in its file each piece begins. Sizes are summed per block first, then within the block, so a window
    holds the pieces of one block or the blocks of one file."""
    step = F.col("bytes") + len(MAGIC)
    in_block = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = found.groupBy("file", "block").agg(F.sum(step).alias("size"))
    blocks = blocks.withColumn("before", F.coalesce(F.sum("size").over(in_file), F.lit(0))).drop("size")
    rows = found.withColumn("within", F.coalesce(F.sum(step).over(in_block), F.lit(0)))
    # The piece begins after the magic that it was cut at; the record begins with the magic.
    rows = rows.join(blocks, ["file", "block"])
    return rows.withColumn("at", F.col("before") + F.col("within") - len(MAGIC)).drop("before", "within")


def reachable(records: DataFrame) -> DataFrame:
    """The (file, at) of the candidates that the chain from offset 0 meets. `records`: file, at, next. Each
    round staged: every node's pointer jumps to its target's target, and what a marked node points to is
    marked."""
    nodes = staged(records.select("file", "at", "next", (F.col("at") == 0).alias("marked")), "chain")
    count = nodes.where("marked").count()
    while True:
        target = nodes.select("file", F.col("at").alias("next"), F.col("next").alias("after"))
        hit = nodes.where("marked").select("file", F.col("next").alias("at")).distinct().withColumn("hit", F.lit(True))
        nodes = nodes.join(target, ["file", "next"], "left").join(hit, ["file", "at"], "left")
        marked = (F.col("marked") | F.col("hit").isNotNull()).alias("marked")
        nodes = staged(nodes.select("file", "at", F.col("after").alias("next"), marked), "chain")
        before, count = count, nodes.where("marked").count()
        if count == before:
            return nodes.where("marked").select("file", "at")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, at (its offset), header, kind, payload_size, payload_sha1, told_size (the full
    length that the HTTP header tells). Damaged ends of files are no records; a missing or empty folder is an
    error of the reader or gives no rows."""
    found = staged(with_offsets(candidates(spark, path)), "pieces")
    good = found.where("kind IS NOT NULL").withColumn("next", F.col("at") + len(MAGIC) + F.col("head") + F.col("length") + 4)
    chain = staged(good.join(reachable(good), ["file", "at"]), "records")
    columns = ["file", "at", "header", "kind", "payload_size", "payload_sha1", "told_size"]
    whole = chain.where("payload_sha1 IS NOT NULL").select(*columns)
    broken = chain.where("payload_sha1 IS NULL").select("file", "at", "next", "head", "length", "header", "kind")
    if broken.isEmpty():
        return whole
    # Records cut by magic in their payload: put the bytes of their pieces together again. A piece belongs to the last
    # record at or before it.
    spans = with_owners(found, chain.select("file", "at"))
    cut = broken.selectExpr("file", "at AS owner", "next", "head", "length", "header AS of", "kind AS is")
    spans = spans.join(cut, ["file", "owner"]).where("at < next")
    # Lines are numbered by task; the same number within (file, block) names the same piece on a second read.
    rank = F.row_number().over(Window.partitionBy("file", "block").orderBy("line"))
    ranks = found.select("file", "block", "line").withColumn("rank", rank)
    spans = spans.join(ranks, ["file", "block", "line"])
    text = pieces(spark, path).withColumn("rank", rank).select("file", "block", "rank", "value")
    joined = spans.join(text, ["file", "block", "rank"])
    in_order = F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts")
    parts = joined.groupBy("file", "owner", "head", "length", "of", "is").agg(in_order)
    body = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
    http = F.expr("substring(cast(body AS binary), cast(head + 1 AS int), cast(length AS int))")
    parts = parts.withColumn("body", body).where("octet_length(body) >= head + length").withColumn("http", http)
    renamed = [F.col(a).alias(b) for a, b in {"file": "file", "owner": "at", "of": "header", "is": "kind"}.items()]
    parts = parts.select(*renamed, *http_parts(F.col("http")))
    return whole.unionByName(parts)


def with_owners(found: DataFrame, records: DataFrame) -> DataFrame:
    """file, block, line, at, owner: each piece with the offset of the last record at or before it (null before the
    first), as a running maximum: over the pieces of a block, and over the blocks of a file."""
    rows = found.select("file", "block", "line", "at").join(records.withColumn("record", F.col("at")), ["file", "at"], "left")
    in_block = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(F.max("record").alias("last"))
    blocks = blocks.withColumn("before", F.max("last").over(in_file)).drop("last")
    rows = rows.withColumn("here", F.max("record").over(in_block)).join(blocks, ["file", "block"])
    return rows.select("file", "block", "line", "at", F.coalesce("here", "before").alias("owner"))


def page_of(field: Column) -> Column:
    return F.regexp_extract(field, r"<urn:stratalake:page:(-?[0-9]+)>", 1).try_cast("bigint")


def page_records(records: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of records written by
    `write_archives`. A response's figures come from the payload that was read, a revisit's from its headers."""
    revisit = F.col("kind") == "revisit"
    told = F.regexp_replace(header_field(F.col("header"), "WARC-Payload-Digest"), "^sha1:", "")
    return records.where(F.col("kind").isin("response", "revisit")).select(
        page_of(header_field(F.col("header"), "WARC-Record-ID")).alias("page_id"),
        header_field(F.col("header"), "WARC-Target-URI").alias("url"),
        F.when(revisit, F.col("told_size")).otherwise(F.col("payload_size")).alias("payload_bytes"),
        F.when(revisit, told).otherwise(F.col("payload_sha1")).alias("payload_digest"),
        F.col("kind").alias("record_type"),
        page_of(header_field(F.col("header"), "WARC-Refers-To")).alias("refers_to"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    found = page_records(read_archives(spark, path))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
