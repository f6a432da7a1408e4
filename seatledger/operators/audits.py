"""Declared amounts against recomputed ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fees import seat_price, with_tax_and_fees

TOLERANCE = 0.01
AUDITED_FEES = ["gst_amount", "convenience_fee", "service_fee", "total_amount"]


def fee_audit(payments: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Per payment: which declared parts differ from the ones due on its base amount.

    A part missing on one side only counts as different.
    """
    due = with_tax_and_fees(payments, "base_amount", "due_")
    return due.withColumns(
        {f"{part}_differs": _differs(F.col(part), F.col(f"due_{part}"), tolerance) for part in AUDITED_FEES}
    ).select(*payments.columns, *[f"{part}_differs" for part in AUDITED_FEES])


def fee_audit_summary(payments: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Number of payments and of differing parts, per group."""
    audited = fee_audit(payments)
    return audited.groupBy(*(by or [])).agg(
        F.count("*").alias("payments"),
        *[F.sum(F.col(f"{part}_differs").cast("long")).alias(f"{part}_mismatches") for part in AUDITED_FEES],
    )


def array_totals(seats: str | Column) -> tuple[Column, Column]:
    """Number of seats and sum of their prices, from the array alone."""
    seats = F.col(seats) if isinstance(seats, str) else seats
    total = F.aggregate(
        seats, F.lit(0.0), lambda acc, seat: acc + F.coalesce(seat["price"], F.lit(0.0))
    )
    return F.size(seats), total


def booking_total_audit(events: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Per booking: declared totals against its seats.

    Large bookings may come as several messages, each with a part of the seats
    and the totals of the whole, so parts are added up per booking first.
    """
    count, total = array_totals("event_details.seats")
    per_booking = (
        events.select(
            "booking_id",
            F.col("booking_metadata.total_amount").alias("declared_amount"),
            F.col("event_details.total_seats").alias("declared_seats"),
            F.greatest(count, F.lit(0)).alias("seats"),
            F.coalesce(total, F.lit(0.0)).alias("amount"),
        )
        .groupBy("booking_id")
        .agg(
            F.max("declared_amount").alias("declared_amount"),
            F.max("declared_seats").alias("declared_seats"),
            F.sum("amount").alias("seat_amount"),
            F.sum("seats").alias("seat_count"),
        )
    )
    return per_booking.withColumns(
        {
            "amount_differs": _differs(F.col("declared_amount"), F.col("seat_amount"), tolerance),
            "seats_differ": ~F.col("declared_seats").eqNullSafe(F.col("seat_count")),
        }
    )


def with_derived_price(seats: DataFrame, base_col: str, section_col: str = "seat_section") -> DataFrame:
    return seats.withColumn("derived_price", seat_price(base_col, section_col))


def _differs(declared: Column, due: Column, tolerance: float) -> Column:
    both = F.abs(declared - due) > tolerance
    return F.coalesce(both, declared.isNull() != due.isNull())
