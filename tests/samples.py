"""Hand-written events."""

import copy
import datetime as dt
import json

SF = "/root/testdata/sf0.001"

BOOKING = {
    "order_id": "order_1",
    "booking_id": "booking_1",
    "booking_time": "2026-09-12T18:30:10.000000Z",
    "customer": {
        "customer_id": "cust1",
        "name": "A",
        "email": "a@example.com",
        "phone": "1",
        "city": "Pune",
        "age_group": "18-25",
    },
    "event_details": {
        "event_id": "event001",
        "event_name": "Concert - x",
        "event_type": "Concert",
        "event_location": "Pune, India",
        "event_venue": "Hall",
        "event_date": "2026-10-01",
        "event_duration_hours": 2.5,
        "event_rating": 4.5,
        "seats": [
            {"seat_number": "V-1", "seat_section": "VIP", "price": 600},
            {"seat_number": "S-2", "seat_section": "Silver", "price": 250.0},
        ],
        "total_seats": 2,
    },
    "booking_metadata": {
        "total_amount": 850,
        "currency": "INR",
        "booking_platform": "Website",
        "promo_code_applied": None,
        "booking_channel": "Organic",
    },
}

PAYMENT = {
    "payment_id": "payment_1",
    "transaction_id": "TXN1",
    "order_id": "order_1",
    "payment_time": "2026-09-12T18:31:00.000000Z",
    "payment_method": "UPI",
    "payment_provider": "Paytm",
    "payment_status": "Success",
    "amount": {
        "base_amount": 850,
        "gst_amount": 153.0,
        "gst_rate": 0.18,
        "convenience_fee": 21.25,
        "service_fee": 15,
        "total_amount": 1039.25,
        "currency": "INR",
    },
    "processing_metadata": {
        "processing_time_ms": 400,
        "payment_gateway": "Gateway1",
        "retry_attempt": 1,
        "3d_secure_enabled": False,
    },
}

START = dt.datetime(2026, 9, 12, 18, 30, 10)


def changed(event, **fields):
    """A copy with fields replaced; ``a__b`` reaches into a struct."""
    event = copy.deepcopy(event)
    for path, value in fields.items():
        *parents, leaf = path.split("__")
        target = event
        for p in parents:
            target = target[p]
        target[leaf] = value
    return event


def records(spark, events, arrivals=None):
    """Events (or raw texts) as keyed records."""
    rows = []
    for i, e in enumerate(events):
        text = e if isinstance(e, str) else json.dumps(e)
        key = None if isinstance(e, str) else e.get("order_id")
        rows.append((key, text, arrivals[i] if arrivals else START))
    return spark.createDataFrame(rows, "key string, value string, timestamp timestamp")
