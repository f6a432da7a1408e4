"""Events to fact rows; one function for tables and for streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bookings import flatten_seats, validate_bookings, with_seats
from ..operators.correlate import correlate, fact_columns, with_measures
from ..operators.payments import validate_payments

_DAY = "__day"


def booking_fact(booking_events: DataFrame, payment_events: DataFrame, *, by_day: bool = False, **join_options) -> DataFrame:
    """One row per seat and payment of the order within the join window.

    The join runs on whole bookings and seats are unpacked afterwards: both are
    inner steps, so the rows are the same, but the shuffle and, on streams, the
    join state hold each booking once instead of once per seat.

    ``by_day`` brings the rows of a booking day together, for a write by day.  The
    rebalance moves whole pairs too; adaptive execution splits a big day over many
    tasks and joins small days.
    """
    pairs = booking_pairs(booking_events, payment_events, **join_options)
    if by_day:
        pairs = pairs.withColumn(_DAY, F.to_date("booking_time")).hint("rebalance", _DAY)
    return fact_of_pairs(pairs)


def booking_pairs(booking_events: DataFrame, payment_events: DataFrame, **join_options) -> DataFrame:
    """Valid bookings with their payments, seats still nested: the fact before it is unpacked."""
    return correlate(with_seats(validate_bookings(booking_events)), validate_payments(payment_events), **join_options)


def fact_of_pairs(pairs: DataFrame) -> DataFrame:
    return fact_columns(flatten_seats(with_measures(pairs)))


def payment_grain(fact: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per payment instead of one per seat, with the payment's own columns.

    Seat columns are dropped; name the ``columns`` a report needs to move no
    others.  An order with several bookings keeps the one with the smallest
    values, so the choice does not depend on the run.
    """
    seat = {"seat_number", "seat_section", "seat_price", "seat_tier"}
    kept = columns or [c for c in fact.columns if c not in seat and c != "payment_id"]
    return (
        fact.groupBy("payment_id")
        .agg(F.min(F.struct(*kept)).alias("row"))
        .select("payment_id", "row.*")
    )
