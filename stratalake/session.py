"""Session set-up and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Removes a query's shuffle files when it has ended; off by default, which leaves them to the driver's garbage collection.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Work folders made for sessions that run in one process, by application id.
_local_folders: dict[str, str] = {}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with what these jobs rely on: adaptive execution (it merges small shuffle partitions,
    splits skewed join partitions and turns a sort-merge join into a broadcast one only after the small
    side's real size is known), Snappy Parquet, UTC, and streaming state on disk instead of in the heap.
    Cluster sizes stay with spark-submit; see README."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: `spark.checkpoint.dir`. Only a local[...] session, where driver
    and executors are one process, may fall back to a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="stratalake-")
    return _local_folders[app]


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for one run's intermediate tables; nothing is ever written there twice."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/stratalake/{app}/{label}-{uuid.uuid4().hex[:12]}"


def drop_work_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder that `work_dir` named, once its run is over; refuses any other folder."""
    if not path.startswith(f"{shared_dir(spark)}/stratalake/"):
        raise ValueError(f"not a work folder of this session: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that begin inside go as soon as each has ended. For writes to the shared folder:
    what reads their tables later needs no shuffle of theirs."""
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


def importable(df: DataFrame) -> DataFrame:
    """Let Python workers import this package where they see the driver's copy of it (one machine, or a shared
    disk) but were started elsewhere; other clusters install the package or get it by --py-files. Returns the
    frame."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return df
