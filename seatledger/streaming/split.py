"""One stream into several outputs, in one pass and once per batch.

Each micro-batch is written as one folder, parted by where its rows belong.  A
batch that fails half way and is run again replaces its folder as a whole, so
after a restart no output has rows of it twice and none lacks them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .sinks import BATCH, timed

OUTPUT = "output"
ON_TIME, LATE = "on_time", "late"
DELAY_SECONDS = "delay_seconds"


def split_stream(
    df: DataFrame,
    output: Column | Callable[[DataFrame, int], DataFrame],
    path: str,
    checkpoint: str,
    *,
    every: str | None = None,
    written: Callable[[str, int], None] | None = None,
) -> StreamingQuery:
    """Write each row to the output that the column ``output`` names; the feed is read once.

    ``output`` may also be a function of a batch and its number that adds the
    column.  Null names the output ``__HIVE_DEFAULT_PARTITION__`` nothing reads, so give
    every row one.  ``written`` is called with the folder and number of a batch that is
    written, before the batch counts as done.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = output(batch, batch_id) if callable(output) else batch.withColumn(OUTPUT, output)
        folder = f"{path}/{BATCH}={batch_id}"
        tagged.write.mode("overwrite").partitionBy(OUTPUT).parquet(folder)
        if written is not None:
            written(folder, batch_id)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return timed(writer, every).start()


def read_output(spark: SparkSession, path: str, output: str) -> DataFrame:
    """All rows of one output, with the batch they came in."""
    return spark.read.parquet(path).filter(F.col(OUTPUT) == output).drop(OUTPUT)


def split_late(df: DataFrame, time: str, delay_seconds: int, path: str, checkpoint: str, *, every: str | None = None) -> StreamingQuery:
    """Rows in time, and rows that come behind the watermark with how far behind it they are.

    The watermark of a batch is the latest ``time`` of the batches before it less
    ``delay_seconds``, as Spark's own: a row at it or before is late.  The latest time
    of each batch is kept beside the outputs under the batch's number, so a batch
    that is run again finds the watermark it had.  It is read from the written batch,
    one column of it, so the batch itself is made once.  Rows without a time are never
    late.  The first batch has no watermark.
    """
    spark = df.sparkSession
    layout = T.StructType([df.schema[time]])

    def keep_latest(folder: str, batch_id: int) -> None:
        latest = spark.read.schema(layout).parquet(folder).agg(F.max(time).alias("latest"))
        latest.write.mode("overwrite").parquet(f"{path}-marks/{BATCH}={batch_id}")

    def mark(batch: DataFrame, batch_id: int) -> DataFrame:
        before = _latest_before(spark, path, batch_id) if batch_id else None
        behind = F.lit(None).cast("double")
        if before is not None:
            behind = F.lit(before - delay_seconds) - F.unix_micros(time) / F.lit(1e6)
        late = F.coalesce(behind >= 0, F.lit(False))
        return batch.withColumn(DELAY_SECONDS, F.when(late, behind)).withColumn(OUTPUT, F.when(late, LATE).otherwise(ON_TIME))

    return split_stream(df, mark, path, checkpoint, every=every, written=keep_latest)


def _latest_before(spark: SparkSession, path: str, batch_id: int) -> float | None:
    """The latest time, in seconds, of the batches before; a row per batch is kept."""
    marks = spark.read.schema(f"latest timestamp, {BATCH} long").parquet(f"{path}-marks")
    return marks.filter(F.col(BATCH) < batch_id).agg(F.max(F.unix_micros("latest") / 1e6)).first()[0]
