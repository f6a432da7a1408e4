"""Explicit schemas; nothing in the package infers one."""

from __future__ import annotations

from pyspark.sql import types as T

SEAT_TYPE = T.StructType(
    [
        T.StructField("seat_number", T.StringType()),
        T.StructField("seat_section", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ]
)

BOOKING_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("booking_id", T.StringType()),
        T.StructField("booking_time", T.StringType()),
        T.StructField(
            "customer",
            T.StructType(
                [
                    T.StructField(name, T.StringType())
                    for name in ("customer_id", "name", "email", "phone", "city", "age_group")
                ]
            ),
        ),
        T.StructField(
            "event_details",
            T.StructType(
                [
                    T.StructField("event_id", T.StringType()),
                    T.StructField("event_name", T.StringType()),
                    T.StructField("event_type", T.StringType()),
                    T.StructField("event_location", T.StringType()),
                    T.StructField("event_venue", T.StringType()),
                    T.StructField("event_date", T.StringType()),
                    T.StructField("event_duration_hours", T.DoubleType()),
                    T.StructField("event_rating", T.DoubleType()),
                    T.StructField("seats", T.ArrayType(SEAT_TYPE)),
                    T.StructField("total_seats", T.IntegerType()),
                ]
            ),
        ),
        T.StructField(
            "booking_metadata",
            T.StructType(
                [
                    T.StructField("total_amount", T.DoubleType()),
                    T.StructField("currency", T.StringType()),
                    T.StructField("booking_platform", T.StringType()),
                    T.StructField("promo_code_applied", T.StringType()),
                    T.StructField("booking_channel", T.StringType()),
                ]
            ),
        ),
    ]
)

# Big bookings may come as several messages, each with the totals of the whole and a part number.
MESSAGE_SCHEMA = T.StructType([*BOOKING_SCHEMA.fields, T.StructField("message_part", T.IntegerType())])

PAYMENT_SCHEMA = T.StructType(
    [
        T.StructField("payment_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("payment_time", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("payment_provider", T.StringType()),
        T.StructField("payment_status", T.StringType()),
        T.StructField(
            "amount",
            T.StructType(
                [
                    T.StructField("base_amount", T.DoubleType()),
                    T.StructField("gst_amount", T.DoubleType()),
                    T.StructField("gst_rate", T.DoubleType()),
                    T.StructField("convenience_fee", T.DoubleType()),
                    T.StructField("service_fee", T.DoubleType()),
                    T.StructField("total_amount", T.DoubleType()),
                    T.StructField("currency", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "processing_metadata",
            T.StructType(
                [
                    T.StructField("processing_time_ms", T.IntegerType()),
                    T.StructField("payment_gateway", T.StringType()),
                    T.StructField("retry_attempt", T.IntegerType()),
                    T.StructField("3d_secure_enabled", T.BooleanType()),
                ]
            ),
        ),
        T.StructField("failure_reason", T.StringType()),
    ]
)

# One record of a keyed topic, as a Kafka source delivers it.
RECORD_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

_S, _I, _D, _TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()

# Column name, type, longest text allowed, null allowed.
FACT_LAYOUT = [
    ("order_id", _S, 50, False),
    ("booking_id", _S, 50, True),
    ("payment_id", _S, 50, True),
    ("transaction_id", _S, 50, True),
    ("booking_time", _TS, None, False),
    ("payment_time", _TS, None, True),
    ("booking_day_of_week", _S, 20, True),
    ("booking_hour", _I, None, True),
    ("customer_id", _S, 50, False),
    ("customer_name", _S, 200, True),
    ("customer_email", _S, 200, True),
    ("customer_phone", _S, 50, True),
    ("customer_city", _S, 100, True),
    ("customer_age_group", _S, 20, True),
    ("event_id", _S, 50, False),
    ("event_name", _S, 300, True),
    ("event_type", _S, 50, True),
    ("event_category", _S, 100, True),
    ("event_location", _S, 300, True),
    ("event_venue", _S, 200, True),
    ("event_rating", _D, None, True),
    ("seat_number", _S, 20, True),
    ("seat_section", _S, 50, True),
    ("seat_price", _D, None, True),
    ("seat_tier", _S, 50, True),
    ("total_seats_booked", _I, None, True),
    ("booking_amount", _D, None, True),
    ("booking_currency", _S, 10, True),
    ("booking_platform", _S, 50, True),
    ("promo_code", _S, 50, True),
    ("base_amount", _D, None, True),
    ("gst_amount", _D, None, True),
    ("convenience_fee", _D, None, True),
    ("service_fee", _D, None, True),
    ("total_amount", _D, None, True),
    ("currency", _S, 10, True),
    ("payment_method", _S, 100, True),
    ("payment_provider", _S, 100, True),
    ("payment_type", _S, 50, True),
    ("payment_status", _S, 20, True),
    ("failure_reason", _S, 500, True),
    ("processing_time_ms", _I, None, True),
    ("payment_gateway", _S, 100, True),
    ("retry_attempt", _I, None, True),
    ("seconds_between_events", _I, None, True),
    ("fees_and_taxes", _D, None, True),
    ("transaction_category", _S, 50, True),
    ("alert_category", _S, 50, True),
    ("created_at", _TS, None, False),
]

FACT_SCHEMA = T.StructType(
    [T.StructField(name, dtype, nullable) for name, dtype, _, nullable in FACT_LAYOUT]
)
FACT_COLUMNS = [name for name, _, _, _ in FACT_LAYOUT]
FACT_REQUIRED = [name for name, _, _, nullable in FACT_LAYOUT if not nullable]
FACT_TEXT_LIMITS = {name: limit for name, _, limit, _ in FACT_LAYOUT if limit}


def as_text(dtype: T.DataType) -> T.DataType:
    """The same shape with every scalar read as text.

    JSON producers are free to send ``850``, ``850.0`` or ``"850"``.  Reading
    scalars as text and casting afterwards keeps all three, where a typed JSON
    reader would null some of them.
    """
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(as_text(dtype.elementType))
    return T.StringType()
