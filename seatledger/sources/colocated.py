"""Bookings and payments stored side by side: an order's rows lie in the same bucket of both tables.

The join of the stored tables then moves no rows: each task joins a bucket of one
with the same bucket of the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.correlate import correlate

ORDER = "order_id"
BUCKETS = 64


def store_by_order(rows: DataFrame, table: str, buckets: int = BUCKETS) -> None:
    """Rows as a catalog table in sorted buckets by order, one file each.

    Placed by order first, so each task writes whole buckets.  Choose as many
    buckets as make one of them fit a task: an order's rows stay together, so a
    very hot order makes its bucket long.  Where one holds a good part of all
    rows, join through ``correlate`` on unbucketed tables, which spreads it.
    """
    rows.repartition(buckets, ORDER).write.mode("overwrite").bucketBy(buckets, ORDER).sortBy(ORDER).saveAsTable(table)


def join_by_order(spark: SparkSession, bookings: str, payments: str, **options) -> DataFrame:
    """``correlate`` of two tables of ``store_by_order``, without moving rows.

    Both need the same number of buckets.
    """
    left, right = spark.read.table(bookings), spark.read.table(payments)
    return correlate(left, right.hint("merge"), slots=False, **options)
