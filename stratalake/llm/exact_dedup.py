"""Exact de-duplication against a persistent index of text digests.

The index holds one row per known text, in generations: tables that are bucketed and sorted by digest, one file per
bucket. A batch is first combined to one row per digest (on the map side, so a text with a third of all rows sends
one row per task), shuffled once into the index's buckets, and then anti-joined with one generation after the other by
sort-merge; the index is neither shuffled nor sorted. The digests that are new become a further generation, and many
generations are merged into one. A corpus is taken in batches by ranges of its ids, so that which row stays follows
from the index."""

from __future__ import annotations

import hashlib
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.common import BLANKS, fresh, staged
from stratalake.session import work_dir

# The least number of buckets, and how many texts a bucket is made for: some 80 MB.
BUCKETS, TEXTS_PER_BUCKET = 16, 1_000_000
# Parts of a corpus, by id, that go through the index one after the other.
BATCHES = 3
# Generations that are read one by one before they are merged.
GENERATIONS = 8
# The layout that this code reads and writes.
VERSION = 2


def text_digest(text: Column) -> Column:
    """SHA-256 in lowercase hex of the text with each run of white space made one space; null counts as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " "), 256)


class DigestIndex:
    """The digests of all texts taken so far, below one folder. Opening it anew, in any session, finds them again. The
    number of buckets is kept beside them and fixed when the index is first made; what is asked for later is ignored.
    An index of another version is an error."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark = spark
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self.path = self.files.makeQualified(folder).toString()
        about = f"{self.path}/about"
        if self._exists(about):
            version, self.buckets = spark.read.schema("version int, buckets int").parquet(about).first()
            if version != VERSION:
                raise ValueError(f"the index in {path} has version {version}, not {VERSION}")
        else:
            if self._exists(self.path) and self._names(self.path):
                raise ValueError(f"{path} holds something else than an index of version {VERSION}")
            self.buckets = max(1, int(buckets))
            spark.createDataFrame([(VERSION, self.buckets)], "version int, buckets int").coalesce(1).write.parquet(about)
        # The generations' files are sorted and one per bucket; Spark only counts on it if told to.
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _exists(self, path: str) -> bool:
        return self.files.exists(self._path(path))

    def _names(self, path: str) -> list[str]:
        return [f.getPath().getName() for f in self.files.listStatus(self._path(path))] if self._exists(path) else []

    def generations(self) -> list[int]:
        """The finished generations that no later one has taken in. One that was never finished has no mark."""
        names = [n for n in self._names(self.path) if n.startswith("generation=")]
        done = sorted(int(n[11:]) for n in names if self._exists(f"{self.path}/{n}/_SUCCESS"))
        merged = max((n for n in done if self._exists(f"{self.path}/merged={n}")), default=0)
        return [n for n in done if n >= merged]

    def _table(self, number: int) -> str:
        """A generation as a catalog table. The name is a digest of the whole path, and is checked."""
        place = f"{self.path}/generation={number}"
        name = f"digests_{hashlib.sha256(place.encode()).hexdigest()[:40]}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest STRING, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        about = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        if self._path(about["Location"]).toUri().getPath() != self._path(place).toUri().getPath() or int(about["Num Buckets"]) != self.buckets:
            raise ValueError(f"table {name} belongs to another index: {about['Location']}")
        return name

    def rows(self) -> DataFrame:
        """(digest, keep_id) of all known texts."""
        out = self.spark.createDataFrame([], "digest string, keep_id bigint")
        for n in self.generations():
            out = out.unionAll(self.spark.table(self._table(n)))
        return out

    def unseen(self, digests: DataFrame) -> DataFrame:
        """Those rows of `digests` (digest, ...) whose digest the index does not have: sort-merge anti-joins."""
        out = digests.repartition(self.buckets, "digest")
        for n in self.generations():
            out = out.join(self.spark.table(self._table(n)).hint("merge"), "digest", "left_anti")
        return out

    def _write(self, rows: DataFrame, merged: bool = False) -> None:
        """A further generation, with one sorted file per bucket; `merged`: it takes the place of all before it."""
        number = max([int(n.split("=")[1]) for n in self._names(self.path) if "=" in n], default=0) + 1
        if merged:
            # The mark counts once the generation is finished, and then at once.
            self.files.mkdirs(self._path(f"{self.path}/merged={number}"))
        rows.repartition(self.buckets, "digest").write.insertInto(self._table(number))
        mark = self._path(f"{self.path}/generation={number}/_SUCCESS")
        if not self.files.exists(mark):
            self.files.create(mark, True).close()

    def append(self, groups: DataFrame) -> None:
        """Add (digest, keep_id) rows, which must be new and one per digest. A repeat after a lost driver adds
        nothing, since the caller's anti-join finds them."""
        self._write(groups.select("digest", F.col("keep_id").cast("bigint")))
        old = self.generations()
        if len(old) > GENERATIONS:
            self._write(self.rows(), merged=True)
            for n in old:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(n)}")
                self.files.delete(self._path(f"{self.path}/generation={n}"), True)


def find_duplicates(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batches: int = 1
) -> DataFrame:
    """One row per row of `docs`: tag, the id, keep_id, group_size, kept, text_sha256; new texts go into the index.

    The rows are taken in `batches` ranges of their ids, null ids last, so of equal texts the row with the smallest id
    stays (of rows with the same id any one, fixed once staged). A text that the index has from before stays with
    the row known there: keep_id names it, and nothing of these rows is kept, unless their first row has that same id,
    so that a run repeated gives the same answer. group_size counts the rows of `docs`. A null text is the empty text;
    no rows give no rows. Extra columns play no part."""
    tagged = docs.select(
        F.monotonically_increasing_id().alias("tag"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        text_digest(F.col(text_col)).alias("digest"),
    )
    return _decide(staged(tagged, "digests"), index, batches)


def _decide(tagged: DataFrame, index: DigestIndex, batches: int) -> DataFrame:
    # Equal ranges of ids. Exact numbers: a range may pass 64 bits.
    least, most = tagged.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = max(1, -(-((most or 0) - (least or 0) + 1) // batches))
    batch = F.floor((F.col("doc_id").cast("decimal(20,0)") - F.lit(least or 0)) / F.lit(Decimal(width))).cast("int")
    batch = F.coalesce(batch, F.lit(batches))
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "tag"))
    groups = tagged.groupBy("digest", batch.alias("batch")).agg(first.alias("first"), F.count(F.lit(1)).alias("n"))
    groups = staged(groups.select("digest", "batch", "n", F.col("first.doc_id").alias("keep_id"), "first.tag", "first.none"), "groups")
    for number in range(batches + 1):
        part = groups.where(F.col("batch") == number)
        if not part.isEmpty():
            index.append(index.unseen(part))
    # All texts are in the index now; which row of each stays is read from it.
    known = index.rows().withColumnRenamed("keep_id", "known_id")
    first = F.min(F.struct("none", "keep_id", "tag")).alias("first")
    sums = groups.groupBy("digest").agg(F.sum("n").alias("group_size"), first)
    stays = F.when(F.col("known_id").eqNullSafe(F.col("first.keep_id")), F.col("first.tag")).alias("stays")
    answers = sums.join(known.hint("merge"), "digest").select("digest", "group_size", F.col("known_id").alias("keep_id"), stays)
    rows = tagged.join(answers, "digest")
    kept = F.coalesce(F.col("tag") == F.col("stays"), F.lit(False)).alias("kept")
    return rows.select("tag", "doc_id", "keep_id", "group_size", kept, F.col("digest").alias("text_sha256"))


def drop_duplicates(
    docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES
) -> DataFrame:
    """The rows of `docs` that stay, with their own columns; see `find_duplicates`. Without an index, a new one
    is made in the work folder."""
    tag, digest = fresh(docs, "tag"), fresh(docs, "digest")
    rows = docs.withColumn(digest, text_digest(F.col(text_col))).withColumn(tag, F.monotonically_increasing_id())
    rows = staged(rows, "tagged")
    index = index or new_index(docs.sparkSession, rows.count())
    doc_id = F.col(id_col).cast("bigint").alias("doc_id")
    narrow = rows.select(F.col(tag).alias("tag"), doc_id, F.col(digest).alias("digest"))
    gone = staged(_decide(narrow, index, batches).where(~F.col("kept")).select(F.col("tag").alias(tag)), "dropped")
    # The dropped tags are a written table: Spark broadcasts them if that file is small, and merges otherwise.
    return rows.join(gone, tag, "left_anti").select(*docs.columns)


def new_index(spark: SparkSession, texts: int = 0) -> DigestIndex:
    """An empty index in the work folder, made for so many texts."""
    return DigestIndex(spark, work_dir(spark, "index"), max(BUCKETS, -(-texts // TEXTS_PER_BUCKET)))


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_duplicates(docs, new_index(spark, docs.count()), batches=BATCHES)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
