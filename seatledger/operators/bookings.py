"""Booking events: validate, reject, flatten to one row per seat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import categorize_event, seat_tier
from ..functions.times import parse_event_time, weekday_name


PART = "message_part"


def booking_problems() -> list[tuple[str, Column]]:
    """Reject reasons of a booking event, in the order they are tested."""
    amount = F.col("booking_metadata.total_amount")
    return [
        ("missing order_id", F.col("order_id").isNull()),
        ("missing customer_id", F.col("customer.customer_id").isNull()),
        ("invalid booking_time", parse_event_time("booking_time").isNull()),
        ("total_amount not positive", ~_positive(amount)),
    ]


def validate_bookings(events: DataFrame, arrival: str = "arrival_time") -> DataFrame:
    """Valid bookings as flat columns, seats still nested.  Narrow: no shuffle."""
    time = parse_event_time("booking_time")
    valid = (
        F.col("order_id").isNotNull()
        & F.col("customer.customer_id").isNotNull()
        & time.isNotNull()
        & _positive(F.col("booking_metadata.total_amount"))
    )
    return events.filter(valid).select(
        "order_id",
        "booking_id",
        time.alias("booking_time"),
        *([PART] if PART in events.columns else []),
        "customer.customer_id",
        F.col("customer.name").alias("customer_name"),
        F.col("customer.email").alias("customer_email"),
        F.col("customer.phone").alias("customer_phone"),
        F.col("customer.city").alias("customer_city"),
        F.col("customer.age_group").alias("customer_age_group"),
        "event_details.event_id",
        "event_details.event_name",
        "event_details.event_type",
        "event_details.event_location",
        "event_details.event_venue",
        F.col("event_details.total_seats").alias("total_seats_booked"),
        "event_details.event_rating",
        "event_details.seats",
        F.col("booking_metadata.total_amount").alias("booking_amount"),
        F.col("booking_metadata.currency").alias("booking_currency"),
        "booking_metadata.booking_platform",
        F.col("booking_metadata.promo_code_applied").alias("promo_code"),
        weekday_name(time).alias("booking_day_of_week"),
        F.hour(time).alias("booking_hour"),
        F.col(arrival).alias("booking_enqueued_time"),
    )


def whole_bookings(bookings: DataFrame) -> DataFrame:
    """One row per booking: of one that comes in several messages, only the first.

    Every message carries the totals of the whole, so nothing is lost.  Events
    without a part are whole.
    """
    if PART not in bookings.columns:
        return bookings
    return bookings.filter(F.coalesce(PART, F.lit(0)) == 0)


def with_seats(bookings: DataFrame) -> DataFrame:
    """Drop bookings that hold no seats before rows are moved."""
    return bookings.filter(F.size("seats") > 0)


def flatten_seats(bookings: DataFrame) -> DataFrame:
    """One row per valid seat, with event category and seat tier.

    A booking with no seats (null or empty array) gives no row.
    """
    average = F.try_divide(F.col("booking_amount"), F.col("total_seats_booked").cast("double"))
    return (
        bookings.select("*", F.inline("seats"))
        .drop("seats", PART)
        .withColumnRenamed("price", "seat_price")
        .filter(F.col("seat_number").isNotNull() & _positive(F.col("seat_price")))
        .withColumns(
            {
                "event_category": categorize_event("event_type", "event_name"),
                "seat_tier": seat_tier("seat_price", average),
            }
        )
    )


def _positive(amount: Column) -> Column:
    """True or false, never null; NaN is not positive."""
    return F.coalesce((amount > 0) & ~F.isnan(amount), F.lit(False))
