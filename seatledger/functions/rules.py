"""Business rules as native column expressions, and as SQL functions.

Each rule is described once, by a table of outcomes; the ``Column`` builder and
the SQL text are both made from that table.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# A category and the words that select it, first match wins.
# Words match anywhere in the name, also inside a longer word.
EVENT_WORDS = [
    ("Music Entertainment", ("music", "concert", "dj")),
    ("Theatre & Drama", ("theatre", "drama", "play")),
    ("Cinema & Films", ("movie", "film", "cinema")),
    ("Sports & Events", ("cricket", "football", "sports")),
]
EVENT_DEFAULT = "Standard"

# Payment type and its methods (case matters).
PAYMENT_TYPES = [
    ("Card Payment", ("Credit Card", "Debit Card")),
    ("Digital Payment", ("UPI", "Wallet", "Net Banking")),
    ("Online Payment", ("PayPal",)),
]
PAYMENT_MISSING = "Unknown"
PAYMENT_OTHER = "Other Payment"

# Seat price relative to the average price of its booking.
TIER_HIGH, TIER_LOW = 1.2, 0.8
TIER_PREMIUM, TIER_ECONOMY, TIER_STANDARD = "Premium Seat", "Economy Seat", "Standard Seat"

# Alert, measured input, comparison, bound; first match wins.
ALERTS = [
    ("Very Low Value", "payment_total", "<", 50),
    ("Very High Value", "payment_total", ">", 5000),
    ("Multiple Retries", "retry_attempt", ">", 2),
    ("Slow Processing", "processing_time", ">", 3000),
    ("Payment Delay", "time_diff", ">", 600),
]
ALERT_NONE = "Normal"

# Status texts and the outcome names built on them.
SUCCESS, FAILED = "Success", "Failed"
HIGH_VALUE_OVER = 500


def categorize_event(event_type, event_name) -> Column:
    """Event category from the event name; ``event_type`` has no influence."""
    name = F.lower(F.coalesce(_col(event_name), F.lit("")))
    out = None
    for category, words in EVENT_WORDS:
        hit = F.lit(False)
        for word in words:
            hit = hit | name.contains(word)
        out = F.when(hit, category) if out is None else out.when(hit, category)
    return out.otherwise(EVENT_DEFAULT)


def payment_type(method) -> Column:
    method = _col(method)
    out = F.when(method.isNull() | (method == ""), PAYMENT_MISSING)
    for kind, methods in PAYMENT_TYPES:
        out = out.when(method.isin(*methods), kind)
    return out.otherwise(PAYMENT_OTHER)


def seat_tier(price, average) -> Column:
    """Tier by price / average; a missing, zero or NaN input gives the standard tier."""
    price, average = _col(price).cast("double"), _col(average).cast("double")
    usable = ~(_falsy(price) | _falsy(average))
    ratio = F.try_divide(price, average)
    return (
        F.when(usable & ~F.isnan(ratio) & (ratio > TIER_HIGH), TIER_PREMIUM)
        .when(usable & ~F.isnan(ratio) & (ratio < TIER_LOW), TIER_ECONOMY)
        .otherwise(TIER_STANDARD)
    )


def check_anomaly(payment_total, retry_attempt, processing_time, time_diff) -> Column:
    """Alert of a payment.  Null counts as 0 and NaN matches no bound."""
    given = {
        "payment_total": payment_total,
        "retry_attempt": retry_attempt,
        "processing_time": processing_time,
        "time_diff": time_diff,
    }
    out = None
    for alert, name, sign, bound in ALERTS:
        value = F.coalesce(_col(given[name]).cast("double"), F.lit(0.0))
        hit = (value < bound) if sign == "<" else ((value > bound) & ~F.isnan(value))
        out = F.when(hit, alert) if out is None else out.when(hit, alert)
    return out.otherwise(ALERT_NONE)


def transaction_category(status, total, alert) -> Column:
    """A success counts as one only without an alert; the rest is failed or unknown."""
    status, total, alert = _col(status), _col(total), _col(alert)
    clean = (status == SUCCESS) & (alert == ALERT_NONE)
    return (
        F.when(clean & (total > HIGH_VALUE_OVER) & ~F.isnan(total), "High Value Success")
        .when(clean, "Standard Success")
        .when(status == FAILED, "Failed Transaction")
        .otherwise("Unknown")
    )


def register_sql_rules(spark: SparkSession) -> None:
    """Offer the four rules to SQL users; Catalyst inlines them into the plan."""
    for signature, body in sql_rules().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}")


def sql_rules() -> dict[str, str]:
    """Signature and CASE body of each rule."""
    name = "lower(coalesce(event_name, ''))"
    event = "".join(
        " WHEN " + " OR ".join(f"contains({name}, '{w}')" for w in words) + f" THEN '{category}'"
        for category, words in EVENT_WORDS
    )
    kinds = "".join(
        f" WHEN payment_method IN ({', '.join(repr(m) for m in methods)}) THEN '{kind}'"
        for kind, methods in PAYMENT_TYPES
    )
    unusable = " OR ".join(f"{c} IS NULL OR {c} = 0 OR isnan({c})" for c in ("seat_price", "avg_price"))
    ratio = "try_divide(seat_price, avg_price)"
    alerts = "".join(
        f" WHEN coalesce({c}, 0) {sign} {bound}" + ("" if sign == "<" else f" AND NOT isnan({c})") + f" THEN '{alert}'"
        for alert, c, sign, bound in ALERTS
    )
    return {
        "CategorizeEvent(event_type STRING, event_name STRING)": f"CASE{event} ELSE '{EVENT_DEFAULT}' END",
        "GetPaymentType(payment_method STRING)": (
            f"CASE WHEN payment_method IS NULL OR payment_method = '' THEN '{PAYMENT_MISSING}'"
            f"{kinds} ELSE '{PAYMENT_OTHER}' END"
        ),
        "GetSeatTier(seat_price DOUBLE, avg_price DOUBLE)": (
            f"CASE WHEN {unusable} OR isnan({ratio}) THEN '{TIER_STANDARD}'"
            f" WHEN {ratio} > {TIER_HIGH}D THEN '{TIER_PREMIUM}'"
            f" WHEN {ratio} < {TIER_LOW}D THEN '{TIER_ECONOMY}' ELSE '{TIER_STANDARD}' END"
        ),
        "CheckAnomaly(payment_total DOUBLE, retry_attempt DOUBLE, processing_time DOUBLE, time_diff DOUBLE)": (
            f"CASE{alerts} ELSE '{ALERT_NONE}' END"
        ),
    }


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _falsy(value: Column) -> Column:
    return value.isNull() | (value == 0) | F.isnan(value)
