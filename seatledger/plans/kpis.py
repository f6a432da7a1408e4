"""KPIs over the fact table.

The fact has seat grain, and the reports here count its rows, so an order of n
seats counts n times.  Pass ``payment_grain(fact)`` to count payments instead.
Double sums depend on the order of addition in their last digits; round when
comparing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import ALERT_NONE, FAILED, SUCCESS
from ..functions.times import days_before
from ..operators.bookings import whole_bookings

PERIOD_LABEL = "Last 7 Days"
MOBILE, WEBSITE = "Mobile App", "Website"
WEEKLY_INPUTS = [
    "booking_time",
    "customer_id",
    "customer_city",
    "event_category",
    "booking_platform",
    "payment_status",
    "total_amount",
    "alert_category",
    "processing_time_ms",
]


def count_if(test: Column) -> Column:
    """Rows where ``test`` holds; null over no rows at all, unlike ``count``."""
    return F.sum(F.when(test, 1).otherwise(0))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def last_days(fact: DataFrame, days: int, as_of=None) -> DataFrame:
    """Rows booked in the ``days`` before ``as_of``.

    The bound is a constant, so it reaches the Parquet scan; on a table with a
    ``booking_date`` partition column it prunes whole partitions too.
    """
    since = days_before(as_of, days)
    recent = F.col("booking_time") >= since
    if "booking_date" in fact.columns:
        recent = recent & (F.col("booking_date") >= F.to_date(since))
    return fact.filter(recent)


def revenue_summary(fact: DataFrame, as_of=None, days: int = 30) -> DataFrame:
    """Day, category and status: rows, revenue, average and success rate."""
    return (
        last_days(fact, days, as_of)
        .groupBy(F.to_date("booking_time").alias("booking_date"), "event_category", "payment_status")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("total_amount").alias("total_revenue"),
            F.avg("total_amount").alias("avg_transaction_value"),
            percent(count_if(F.col("payment_status") == SUCCESS), F.count("*")).alias("success_rate"),
        )
    )


def weekly_kpis(fact: DataFrame, as_of=None, days: int = 7, whole_ms: bool = True) -> DataFrame:
    """The one-row KPI report of the last ``days`` days; one row even over no data.

    One pass: rows are first summed per city and customer, which leaves at most
    one row per such pair.  Grouping sets then give one row per city (sums, for
    the totals and the best city) and one per customer (for their number).
    A tie for the best city goes to the first name.  ``whole_ms`` cuts the
    average processing time to a whole number.
    """
    pairs = (
        last_days(fact, days, as_of)
        .groupBy("customer_city", "customer_id")
        .agg(*[measure.alias(name) for name, measure in weekly_sums().items()])
    )
    return weekly_report(pairs, days, whole_ms)


def weekly_sums() -> dict[str, Column]:
    """What the KPI report adds up per city and customer; sums of these sums are sums again."""
    return {
        "n": F.count("*"),
        "revenue": F.sum("total_amount"),
        "priced": F.count("total_amount"),
        "success": count_if(F.col("payment_status") == SUCCESS),
        "music": _revenue_of("Music"),
        "cinema": _revenue_of("Cinema"),
        "sports": _revenue_of("Sports"),
        "mobile": count_if(F.col("booking_platform") == MOBILE),
        "website": count_if(F.col("booking_platform") == WEBSITE),
        "alerts": count_if(F.col("alert_category") != ALERT_NONE),
        "ms": F.sum("processing_time_ms"),
        "timed": F.count("processing_time_ms"),
    }


def weekly_report(pairs: DataFrame, days: int = 7, whole_ms: bool = True) -> DataFrame:
    """The KPI report from the ``weekly_sums`` of each city and customer."""
    sums = list(weekly_sums())
    city, customer = F.col("customer_city"), F.col("customer_id")
    groups = pairs.groupingSets([[city], [customer]], city, customer).agg(
        F.grouping("customer_id").alias("per_city"),
        *[F.sum(name).alias(name) for name in sums],
    )
    is_city = F.col("per_city") == 1
    total = {name: F.sum(F.when(is_city, F.col(name))) for name in sums}
    # Smallest (has no revenue, -revenue, name) is the best city; nameless ones are left out.
    best = F.min(
        F.when(
            is_city & city.isNotNull(),
            F.struct(F.col("revenue").isNull(), (-F.col("revenue")).alias("rank"), city.alias("name")),
        )
    )
    average_ms = F.try_divide(total["ms"].cast("double"), total["timed"].cast("double"))
    return groups.agg(
        F.lit(PERIOD_LABEL if days == 7 else f"Last {days} Days").alias("period"),
        F.coalesce(total["n"], F.lit(0)).alias("total_transactions"),
        total["revenue"].alias("total_revenue"),
        F.try_divide(total["revenue"], total["priced"].cast("double")).alias("avg_transaction_value"),
        F.count(F.when(~is_city, customer)).alias("unique_customers"),
        percent(total["success"], total["n"]).alias("success_rate_pct"),
        total["music"].alias("music_revenue"),
        total["cinema"].alias("cinema_revenue"),
        total["sports"].alias("sports_revenue"),
        total["mobile"].alias("mobile_bookings"),
        total["website"].alias("website_bookings"),
        best["name"].alias("top_city"),
        total["alerts"].alias("anomaly_count"),
        (average_ms.cast("int") if whole_ms else average_ms).alias("avg_processing_time_ms"),
    )


def top_city(fact: DataFrame) -> DataFrame:
    """The city with the highest revenue; ties go to the first name."""
    return (
        fact.filter(F.col("customer_city").isNotNull())
        .groupBy("customer_city")
        .agg(F.sum("total_amount").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_last(), "customer_city")
        .limit(1)
    )


def successful(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("payment_status") == SUCCESS)


def total_revenue(fact: DataFrame) -> DataFrame:
    return successful(fact).agg(F.sum("total_amount").alias("total_revenue"))


def success_count(fact: DataFrame) -> DataFrame:
    return successful(fact).agg(F.count("*").alias("successful_transactions"))


def revenue_by_city(fact: DataFrame) -> DataFrame:
    return (
        successful(fact)
        .groupBy("customer_city")
        .agg(F.sum("total_amount").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_last(), "customer_city")
    )


def conversion_rate(bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """Valid bookings with at least one successful payment of their order, in percent.

    Both sides are brought to one row per order first, so neither a busy order
    nor repeated payments multiply in the join.
    """
    attempts = whole_bookings(bookings).groupBy("order_id").agg(F.count("*").alias("bookings"))
    paid = successful(payments).select("order_id").distinct().withColumn("paid", F.lit(True))
    return (
        attempts.join(paid, "order_id", "left")
        .agg(
            F.coalesce(F.sum("bookings"), F.lit(0)).alias("booking_attempts"),
            F.coalesce(F.sum(F.when(F.col("paid"), F.col("bookings"))), F.lit(0)).alias("successful_bookings"),
        )
        .withColumn(
            "conversion_rate_pct", percent(F.col("successful_bookings"), F.col("booking_attempts"))
        )
    )


def payment_volume(payments: DataFrame) -> DataFrame:
    return payments.agg(
        F.count("*").alias("payment_attempts"),
        F.count(F.when(F.col("payment_status") == SUCCESS, 1)).alias("successful_payments"),
        F.count(F.when(F.col("payment_status") == FAILED, 1)).alias("failed_payments"),
    )


def booking_volume(bookings: DataFrame) -> DataFrame:
    return whole_bookings(bookings).agg(F.count("*").alias("total_bookings"))


def method_distribution(payments: DataFrame) -> DataFrame:
    """Payments per method with their share of all.

    The total is the sum over the few method rows, not a second pass over payments.
    """
    per_method = payments.groupBy("payment_method").agg(F.count("*").alias("payments"))
    everything = per_method.agg(F.sum("payments")).scalar()
    return per_method.withColumn("share_pct", percent(F.col("payments"), everything))


def failure_reasons(payments: DataFrame) -> DataFrame:
    return (
        payments.filter(F.col("payment_status") == FAILED)
        .groupBy("failure_reason")
        .agg(F.count("*").alias("failures"))
    )


def method_performance(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_method").agg(
        F.count("*").alias("payments"),
        percent(count_if(F.col("payment_status") == SUCCESS), F.count("*")).alias("success_rate"),
        F.avg("processing_time_ms").alias("avg_processing_time_ms"),
    )


def gateway_sla(payments: DataFrame) -> DataFrame:
    return payments.groupBy("payment_gateway").agg(
        F.count("*").alias("payments"),
        F.avg("processing_time_ms").alias("avg_processing_time_ms"),
        F.max("processing_time_ms").alias("max_processing_time_ms"),
        F.avg("retry_attempt").alias("avg_retry_attempt"),
        percent(count_if(F.col("payment_status") == SUCCESS), F.count("*")).alias("success_rate"),
    )


def day_of_week_volume(fact: DataFrame) -> DataFrame:
    return segment_by(fact, "booking_day_of_week")


def hourly_volume(fact: DataFrame) -> DataFrame:
    return segment_by(fact, "booking_hour")


def segment_by(fact: DataFrame, *columns: str) -> DataFrame:
    """Rows, revenue and average per value of any fact columns."""
    return fact.groupBy(*columns).agg(
        F.count("*").alias("transactions"),
        F.sum("total_amount").alias("revenue"),
        F.avg("total_amount").alias("avg_value"),
    )


def _revenue_of(word: str) -> Column:
    return F.sum(F.when(F.col("event_category").contains(word), F.col("total_amount")).otherwise(0.0))
