"""Session settings the package expects."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Join and window state on disk instead of in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Both sides of a stream join in one store a partition, not four; a stream that began otherwise goes on as it was.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # Rows in the state repeat much text: half the size of the defaults (lz4, blocks of 4 KB).
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    # A restart needs the last batch's state; more versions would keep all rows that ever were in it.
    "spark.sql.streaming.minBatchesToRetain": "2",
    # Rows carry more work than bytes here: keep all cores busy on small shuffles.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


#: Adaptive execution leaves at least so many tasks, and three a core: with about one a core, the last one doubles a stage's time.
MIN_PARTITIONS = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
LEAST_TASKS = 48


def prepare(spark: SparkSession) -> SparkSession:
    """Set what results depend on (the time zone) and adaptive execution."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set(MIN_PARTITIONS, str(max(LEAST_TASKS, 3 * spark.sparkContext.defaultParallelism)))
    return spark


#: Shuffle files go when an execution ends, not when the driver happens to collect garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written or started here gives its shuffle files back after the write, or after each batch of a stream.

    For frames that run once: one that runs again would make its shuffles anew.
    """
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def local_session(cores: int = 8, name: str = "seatledger", **settings: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark.

    A cluster sets its own partition number; AQE merges small partitions.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())
