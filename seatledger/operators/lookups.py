"""Small fixed tables and joins to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.rules import FAILED

# Failure rate, shortest and longest processing time in ms, weight.
METHOD_PROFILES = [
    ("Credit Card", 0.02, 500, 1500, 0.40),
    ("Debit Card", 0.03, 400, 1200, 0.30),
    ("UPI", 0.01, 200, 800, 0.50),
    ("Net Banking", 0.04, 1000, 3000, 0.15),
    ("Wallet", 0.02, 150, 600, 0.35),
    ("PayPal", 0.03, 800, 2500, 0.10),
]
METHOD_COLUMNS = (
    "payment_method string, expected_failure_rate double, min_processing_ms int, "
    "max_processing_ms int, popularity_weight double"
)

# Lowest and highest base price, seat sections, hours, weight.
EVENT_PROFILES = [
    ("Concert", 200, 1500, ["VIP", "Gold", "Silver", "Bronze"], 2.5, 0.35),
    ("Play", 100, 800, ["Premium", "Standard", "Economy"], 2.0, 0.25),
    ("Movie", 150, 600, ["Recliner", "Premium", "Standard"], 2.5, 0.30),
    ("Sports", 300, 2000, ["VIP", "Premium", "Standard"], 3.0, 0.10),
]
EVENT_COLUMNS = (
    "event_type string, min_base_price int, max_base_price int, seat_sections array<string>, "
    "typical_duration_hours double, popularity_weight double"
)


def method_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(METHOD_PROFILES, METHOD_COLUMNS)


def event_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EVENT_PROFILES, EVENT_COLUMNS)


def with_method_profile(payments: DataFrame) -> DataFrame:
    """Add the profile of the payment method; null for unknown methods.

    Broadcast is safe at any scale: the profile table is the fixed list above.
    """
    return payments.join(F.broadcast(method_profiles(payments.sparkSession)), "payment_method", "left")


def with_event_profile(rows: DataFrame) -> DataFrame:
    """Add the profile of the event type; the table is the fixed list above."""
    return rows.join(F.broadcast(event_profiles(rows.sparkSession)), "event_type", "left")


def method_conformance(payments: DataFrame) -> DataFrame:
    """Per method: observed failures and processing times against the profile."""
    slow = F.col("processing_time_ms") > F.col("max_processing_ms")
    fast = F.col("processing_time_ms") < F.col("min_processing_ms")
    return (
        with_method_profile(payments)
        .groupBy("payment_method", "expected_failure_rate")
        .agg(
            F.count("*").alias("attempts"),
            F.sum(F.when(F.col("payment_status") == FAILED, 1).otherwise(0)).alias("failed"),
            F.sum(F.when(slow, 1).otherwise(0)).alias("above_range"),
            F.sum(F.when(fast, 1).otherwise(0)).alias("below_range"),
        )
        .withColumn("failure_rate", F.try_divide(F.col("failed"), F.col("attempts")))
    )


def section_conformance(seats: DataFrame) -> DataFrame:
    """Per event type and section: seats, and whether the section belongs to the type."""
    counted = seats.groupBy("event_type", "seat_section").agg(
        F.count("*").alias("seats"), F.sum("seat_price").alias("revenue")
    )
    known = F.coalesce(F.array_contains("seat_sections", F.col("seat_section")), F.lit(False))
    return with_event_profile(counted).select(
        "event_type", "seat_section", "seats", "revenue", known.alias("section_known")
    )


def price_conformance(seats: DataFrame, base_col: str) -> DataFrame:
    """Per event type: seats whose base price lies outside the type's range; null and unknown types lie in no range.

    Counted before the profiles are joined, so the range is looked up once per
    type and price, not per seat.
    """
    priced = seats.groupBy("event_type", F.col(base_col).alias("base")).agg(F.count("*").alias("n"))
    low, high = F.col("base") < F.col("min_base_price"), F.col("base") > F.col("max_base_price")
    return (
        with_event_profile(priced)
        .groupBy("event_type")
        .agg(
            F.sum("n").alias("seats"),
            F.sum(F.when(low, F.col("n")).otherwise(0)).alias("below_range"),
            F.sum(F.when(high, F.col("n")).otherwise(0)).alias("above_range"),
        )
    )


def popularity(rows: DataFrame, key: str, profiles: DataFrame) -> DataFrame:
    """Per kind of ``profiles``: rows, their share, and the share its weight gives it; kinds not seen count 0.

    Shares are of the rows with a known kind.
    """
    counted = rows.groupBy(key).agg(F.count("*").alias("n"))
    # From here on there is one row per kind of the fixed list.
    every = W.partitionBy(F.lit(1))
    found = profiles.select(key, "popularity_weight").join(counted, key, "left").fillna(0, ["n"])
    return found.select(
        key,
        "n",
        F.try_divide(F.col("n"), F.sum("n").over(every)).alias("share"),
        (F.col("popularity_weight") / F.sum("popularity_weight").over(every)).alias("expected_share"),
    )


def duration_conformance(bookings: DataFrame) -> DataFrame:
    """Per event type: bookings and those whose event does not last as long as is typical; unknown types have no typical length."""
    counted = bookings.groupBy("event_type", "event_duration_hours").agg(F.count("*").alias("n"))
    other = ~F.col("event_duration_hours").eqNullSafe(F.col("typical_duration_hours")) & F.col("typical_duration_hours").isNotNull()
    return (
        with_event_profile(counted)
        .groupBy("event_type")
        .agg(F.sum("n").alias("bookings"), F.sum(F.when(other, F.col("n")).otherwise(0)).alias("other_duration"))
    )
