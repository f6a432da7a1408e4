"""Reports kept up to date day by day.

Beside the stored fact stand small tables of sums per day.  New rows, late ones
too, name the days they touch; only those days are summed again, from the parts
of the fact that hold them.  Sums are added under the batch's number, and a list
of days, written last, says which batch has a day's newest sums: nothing is ever
changed in place, and a reader sees a batch's sums all together or not at all.  A
report over some days adds up at most one row per day and group and reads no
fact.  Distinct customers are kept as sketches, which merge over any days,
cities and categories.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import SUCCESS
from ..functions.times import days_before
from ..schemas import FACT_COLUMNS
from ..streaming.sinks import BATCH
from . import kpis

DAY = "booking_date"
#: log2 of a sketch's registers: a standard error of 1.04 / 2^(bits / 2), 1.6 % with 12.
SKETCH_BITS = 12
#: A file of the fact holds about so many rows.
ROWS_PER_FILE = 50_000


def _grains() -> dict[str, tuple[list[str], dict]]:
    return {
        "customers": (["customer_city", "customer_id"], kpis.weekly_sums()),
        "statuses": (
            ["event_category", "payment_status"],
            {
                "transaction_count": F.count("*"),
                "total_revenue": F.sum("total_amount"),
                "priced": F.count("total_amount"),
                "success": F.count_if(F.col("payment_status") == SUCCESS),
            },
        ),
        "sketches": (
            ["customer_city", "event_category"],
            {"sketch": F.hll_sketch_agg("customer_id", SKETCH_BITS)},
        ),
    }


def absorb(rows: DataFrame, home: str, batch_id: int) -> None:
    """Add fact rows as batch ``batch_id`` and bring the days they touch up to date.

    A batch that is run again replaces its folders, so this can be the function of
    a stream's ``foreachBatch``; batches come in the order of their numbers.
    """
    spark = rows.sparkSession
    folder = f"{home}/fact/{BATCH}={batch_id}"
    rows = rows.select(*FACT_COLUMNS).withColumn(DAY, F.to_date("booking_time"))
    sizes = dict(rows.groupBy(DAY).count().collect())  # as many as the calendar has days
    _in_files_of_days(rows, sizes).sortWithinPartitions(DAY).write.mode("overwrite").parquet(folder)
    refresh(spark, home, batch_id, list(sizes))


def _in_files_of_days(rows: DataFrame, sizes: dict[dt.date | None, int], rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Rows placed so that a file holds a range of days, and a day's rows are found without a folder per day.

    The rows of each day are counted already, so no wide row is read for a sample
    as a placement by range would.  A day too big for a file is dealt to several.
    """
    places, file, held = [], 0, 0
    for day in sorted(sizes, key=lambda day: (day is not None, day)):
        parts = -(-sizes[day] // rows_per_file)
        if held + sizes[day] > rows_per_file and held:
            file, held = file + 1, 0
        places.append((day, file, parts))
        if parts > 1:
            file += parts
        else:
            held += sizes[day]
    place = rows.sparkSession.createDataFrame(places, "__day date, __file int, __parts int")
    found = rows.join(F.broadcast(place), F.col(DAY).eqNullSafe(F.col("__day")), "left")
    draw = F.pmod(F.xxhash64("order_id", "payment_id", "seat_number"), F.col("__parts"))
    number = F.coalesce(F.col("__file") + draw, F.lit(0)).cast("int")
    return found.withColumn("__number", number).repartitionById(file + 1, "__number").drop("__day", "__file", "__parts", "__number")


def refresh(spark: SparkSession, home: str, batch_id: int, days: list[dt.date] | None = None) -> None:
    """Sum these days (all of them if None) again from the stored fact; other days stay as they are."""
    fact = spark.read.parquet(f"{home}/fact")
    if days is not None:
        fact = fact.filter(F.col(DAY).isin(days))
    for name, (keys, sums) in _grains().items():
        made = fact.groupBy(DAY, *keys).agg(*[measure.alias(column) for column, measure in sums.items()])
        made.sortWithinPartitions(DAY).write.mode("overwrite").parquet(f"{home}/{name}/{BATCH}={batch_id}")
    fact.select(DAY).distinct().write.mode("overwrite").parquet(f"{home}/days/{BATCH}={batch_id}")


def current(spark: SparkSession, home: str, name: str) -> DataFrame:
    """The newest sums of each day."""
    newest = spark.read.parquet(f"{home}/days").groupBy(DAY).agg(F.max(BATCH).alias(BATCH))
    return spark.read.parquet(f"{home}/{name}").join(newest, [DAY, BATCH]).drop(BATCH)


def weekly_kpis(spark: SparkSession, home: str, as_of: dt.datetime, days: int = 7, whole_ms: bool = True) -> DataFrame:
    """``kpis.weekly_kpis`` from the sums per day; ``as_of`` is a midnight."""
    _, sums = _grains()["customers"]
    pairs = _since(spark, home, "customers", as_of, days).groupBy("customer_city", "customer_id")
    return kpis.weekly_report(pairs.agg(*[F.sum(name).alias(name) for name in sums]), days, whole_ms)


def revenue_summary(spark: SparkSession, home: str, as_of: dt.datetime, days: int = 30) -> DataFrame:
    """``kpis.revenue_summary`` from the sums per day: a row per day and group is there already."""
    rows = _since(spark, home, "statuses", as_of, days)
    return rows.select(
        DAY,
        "event_category",
        "payment_status",
        "transaction_count",
        "total_revenue",
        F.try_divide("total_revenue", F.col("priced").cast("double")).alias("avg_transaction_value"),
        kpis.percent(F.col("success"), F.col("transaction_count")).alias("success_rate"),
    )


def unique_customers(spark: SparkSession, home: str, first: dt.date, last: dt.date, by: list[str] | None = None) -> DataFrame:
    """Distinct customers of the days from ``first`` to ``last``, by city or category or both, from the sketches.

    ``unique_customers`` is an estimate with a standard error of 1.6 %; small numbers
    (up to some hundreds) are all but exact.  For exact numbers count on the fact.
    """
    rows = current(spark, home, "sketches").filter(F.col(DAY).between(first, last))
    return rows.groupBy(*(by or [])).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_customers"))


def _since(spark: SparkSession, home: str, name: str, as_of: dt.datetime, days: int) -> DataFrame:
    if as_of.time() != dt.time():
        raise ValueError("reports from sums per day start at a midnight")
    return current(spark, home, name).filter(F.col(DAY) >= F.to_date(days_before(as_of, days)))
