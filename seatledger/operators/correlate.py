"""Bring bookings and payments of an order together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import check_anomaly, transaction_category
from ..functions.times import seconds_between
from ..schemas import FACT_SCHEMA
from .intervals import Lanes, interval_join

TIME_COLUMNS = {
    "arrival": ("booking_enqueued_time", "payment_enqueued_time"),
    "event": ("booking_time", "payment_time"),
}


def correlate(
    bookings: DataFrame,
    payments: DataFrame,
    *,
    time_basis: str = "arrival",
    minutes: int = 10,
    minute_semantics: str = "elapsed",
    spread: int = 1,
    slots: bool = True,
    lanes: list[Lanes] | None = None,
) -> DataFrame:
    """Pair each booking with the payments of its order up to ``minutes`` later.

    ``time_basis`` compares arrival times or the times inside the events.
    ``minute_semantics="elapsed"`` measures the true gap; ``"boundary"`` counts
    the minute marks between both times, so a payment of the same minute counts
    even when it came slightly before the booking.  The linear bounds given with
    it only limit the join state; every boundary match lies within them.
    ``spread`` splits the messages of a busy order on streams, and without
    ``slots`` rows meet by order alone; ``lanes`` splits the busy orders it names
    only.  See :func:`interval_join`.
    """
    booked, paid = TIME_COLUMNS[time_basis]
    if minute_semantics == "elapsed":
        lower, upper, extra = 0, 60 * minutes, None
    elif minute_semantics == "boundary":
        lower, upper = -60, 60 * (minutes + 1)
        extra = (_minute(paid) - _minute(booked)).between(0, minutes)
    else:
        raise ValueError(f"unknown minute_semantics {minute_semantics!r}")
    return interval_join(
        bookings,
        payments,
        "order_id",
        booked,
        paid,
        lower=lower,
        upper=upper,
        extra=extra,
        spread=spread,
        slots=slots,
        lanes=lanes,
        lanes_by=["payment_id"],
        spread_by=[c for c in ("booking_id", "booking_enqueued_time", "seats") if c in bookings.columns],
    )


def with_measures(pairs: DataFrame) -> DataFrame:
    """Add the computed columns of a booking and payment pair.

    ``created_at`` is the later arrival of both, so a replay gives it again.
    """
    return pairs.withColumns(
        {
            "seconds_between_events": seconds_between("booking_time", "payment_time"),
            "fees_and_taxes": F.col("total_amount") - F.col("booking_amount"),
            "created_at": F.greatest("booking_enqueued_time", "payment_enqueued_time"),
        }
    ).withColumns(_alerts())


def fact_columns(rows: DataFrame) -> DataFrame:
    """Exactly the fact columns, by name and type; arrival times are left behind."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA.fields])


def _alerts():
    alert = check_anomaly("total_amount", "retry_attempt", "processing_time_ms", "seconds_between_events")
    return {
        "alert_category": alert,
        "transaction_category": transaction_category("payment_status", "total_amount", alert),
    }


def _minute(time: str):
    return F.floor(F.unix_seconds(time) / F.lit(60))
