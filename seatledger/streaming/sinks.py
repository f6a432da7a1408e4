"""Sinks for streams.

``append_stream`` is Spark's file sink: each row once, also after a restart.
``change_stream`` serves results that change (running totals, open windows): it
keeps every batch's changed rows, and ``latest`` reads the newest of each key.
Each batch writes its own folder and replaces it when the batch is run again.
``compact`` writes the newest rows of all batches so far as a snapshot; from then
on ``latest`` opens the snapshot and the batches after it only, so what it reads
follows the number of keys, not that of batches.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import shuffles_dropped

BATCH = "batch_id"


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start appending; without ``every`` it stops when all present input is done."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    with shuffles_dropped(df.sparkSession):  # a stream keeps the settings it was started with
        return timed(writer, every).start(path)


def change_stream(df: DataFrame, path: str, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    writer = df.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    with shuffles_dropped(df.sparkSession):
        return timed(writer, every).start()


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest version of each key; of the one row if ``keys`` is empty."""
    return _newest(spark, path, keys).drop(BATCH)


def compact(spark: SparkSession, path: str, keys: list[str]) -> int:
    """Write a snapshot of all batches so far; gives the number of the last of them.

    A snapshot counts once its line is in the list of snapshots, which is written
    last: one that fails half way is never read, and readers go on with the one
    before.  Batches are not removed; those up to the snapshot are no longer read.
    """
    upto, _ = _snapshot(spark, path)
    last = spark.read.parquet(path).agg(F.max(BATCH)).first()[0]
    if last is None or last <= upto:
        return upto
    folder = f"{path}-snapshots/{last}-{uuid.uuid4().hex}"
    # Batches may go on meanwhile: only those up to ``last`` belong to it.
    rows = _newest(spark, path, keys, last)
    rows.write.parquet(folder)
    spark.createDataFrame([(last, folder)], "upto long, folder string").coalesce(1).write.mode("append").parquet(f"{path}-snapshots/list")
    return last


def _newest(spark: SparkSession, path: str, keys: list[str], last: int | None = None) -> DataFrame:
    """The newest version of each key up to batch ``last``, with its batch."""
    upto, snapshot = _snapshot(spark, path)
    # A batch's number is its folder's: files of what the snapshot holds are ruled out by name and not opened.
    rows = spark.read.parquet(path).filter(F.col(BATCH) > upto)
    if last is not None:
        rows = rows.filter(F.col(BATCH) <= last)
    if snapshot is not None:
        rows = rows.unionByName(spark.read.parquet(snapshot))
    kept = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*kept), BATCH).alias("row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "row.*")


def _snapshot(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """The last snapshot: the last batch in it, and its folder."""
    try:
        listed = spark.read.schema("upto long, folder string").parquet(f"{path}-snapshots/list")
    except AnalysisException:  # none yet
        return -1, None
    row = listed.agg(F.max(F.struct("upto", "folder")).alias("last")).first()
    return (row.last.upto, row.last.folder) if row.last else (-1, None)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for a query that stops by itself; its failure is raised here."""
    query.awaitTermination()


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped behind the watermark, over the batches the query still reports."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def timed(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
