"""Payment events: validate and flatten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import payment_type
from ..functions.times import parse_event_time


def payment_problems() -> list[tuple[str, Column]]:
    """Reject reasons of a payment event, in the order they are tested."""
    return [
        ("missing payment_id", F.col("payment_id").isNull()),
        ("missing order_id", F.col("order_id").isNull()),
        ("invalid payment_time", parse_event_time("payment_time").isNull()),
    ]


def validate_payments(events: DataFrame, arrival: str = "arrival_time") -> DataFrame:
    """Valid payments as flat columns.  The amount is not checked."""
    time = parse_event_time("payment_time")
    valid = F.col("payment_id").isNotNull() & F.col("order_id").isNotNull() & time.isNotNull()
    return events.filter(valid).select(
        "payment_id",
        "transaction_id",
        "order_id",
        time.alias("payment_time"),
        "amount.base_amount",
        "amount.gst_amount",
        "amount.convenience_fee",
        "amount.service_fee",
        "amount.total_amount",
        "amount.currency",
        "payment_method",
        "payment_provider",
        "payment_status",
        "failure_reason",
        payment_type("payment_method").alias("payment_type"),
        "processing_metadata.processing_time_ms",
        "processing_metadata.payment_gateway",
        "processing_metadata.retry_attempt",
        F.col(arrival).alias("payment_enqueued_time"),
    )
