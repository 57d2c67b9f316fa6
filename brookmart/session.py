"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that may be changed on a session somebody else created.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # a commit writes what a batch changed instead of the files of the whole store
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # no count of all rows, which costs a read per write; a cache that holds more than the 8 MB of a few hot blocks
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "32",
    # both sides of a join in state share one store per partition instead of four
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # a task that reads a file sorts what it reads before it sends it: small splits hold their rows in memory, however large the file
    "spark.sql.files.maxPartitionBytes": "16m",
    # a task writes into the buckets of a table or the parts of a feed side by side, without sorting by them
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def build_session(app: str = "brookmart", master: str | None = None, zone: str = "UTC", **conf) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_CONF, "spark.sql.session.timeZone": zone,
                "spark.python.unix.domain.socket.enabled": "true"}
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
INITIAL_PARTITIONS_PER_CORE = 16


def prepare(spark: SparkSession, zone: str = "UTC") -> SparkSession:
    """Apply the run-time settings to an existing session (labels need a pinned zone)."""
    for key, value in {**RUNTIME_CONF, "spark.sql.session.timeZone": zone}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    spark.conf.unset(INITIAL_PARTITIONS)
    return spark


def sort_in_memory(spark: SparkSession) -> None:
    """Until the next ``prepare``, exchanges of a batch begin with so many partitions per core where the session asks for fewer, and AQE joins
    the small ones: what a task sorts of a large table stays in its memory instead of going to disk a second time. Small tables pay for it.
    """
    least = INITIAL_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set(INITIAL_PARTITIONS, max(least, int(spark.conf.get("spark.sql.shuffle.partitions"))))


# Every partition of a state opens, commits and closes its stores in every batch, with rows or without.
STATE_PARTITIONS_PER_CORE = 2


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """A stream started in here keeps its state in a few partitions per core, or in fewer where the session asks for fewer.

    Its checkpoint fixes the number when the stream starts first.
    """
    key = "spark.sql.shuffle.partitions"
    asked = spark.conf.get(key)
    spark.conf.set(key, min(int(asked), STATE_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, asked)


# What the batches of a stream leave on disk.
STREAM_CONF = {
    # a batch's shuffles go when it has ended, not when the driver next collects its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    # a restart needs the last batch; changes of older ones go once a snapshot, taken every few batches, holds them
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "4",
    "spark.sql.streaming.stateStore.maintenanceInterval": "15s",
}


@contextmanager
def lean_batches(spark: SparkSession) -> Iterator[None]:
    """What is started or written in here keeps on disk what it still needs."""
    before = {key: spark.conf.get(key, None) for key in STREAM_CONF}
    for key, value in STREAM_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def forget_shuffles(spark: SparkSession) -> None:
    """Files of shuffles that no frame refers to any more go when the driver collects its garbage, which an idle driver puts off.

    A write's own shuffles are no part of ``STREAM_CONF``'s clean-up, which knows queries only.
    """
    spark._jvm.System.gc()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` if the cluster names one.

    Only where it is unset and everything runs on one machine (tests) a temporary folder stands in.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="brookmart-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root; nothing is created or deleted."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
