"""Every branch and bound of the rules, as columns and as SQL functions."""

import pytest

from seatledger.functions import rules

NAN = float("nan")

EVENTS = [
    ("Music night", "Music Entertainment"),
    ("CONCERT - x", "Music Entertainment"),
    ("Movie - Adjustable console", "Music Entertainment"),  # holds "dj"
    ("Sports - Display matrix", "Theatre & Drama"),  # holds "play"
    ("Theatre", "Theatre & Drama"),
    ("Drama", "Theatre & Drama"),
    ("Movie - x", "Cinema & Films"),
    ("short film", "Cinema & Films"),
    ("Cinema", "Cinema & Films"),
    ("Cricket", "Sports & Events"),
    ("football", "Sports & Events"),
    ("Sports", "Sports & Events"),
    ("Gala", "Standard"),
    ("", "Standard"),
    (None, "Standard"),
]
METHODS = [
    ("Credit Card", "Card Payment"),
    ("Debit Card", "Card Payment"),
    ("UPI", "Digital Payment"),
    ("Wallet", "Digital Payment"),
    ("Net Banking", "Digital Payment"),
    ("PayPal", "Online Payment"),
    ("paypal", "Other Payment"),
    ("Cash", "Other Payment"),
    ("", "Unknown"),
    (None, "Unknown"),
]
TIERS = [
    (12.0, 10.0, "Standard Seat"),
    (12.01, 10.0, "Premium Seat"),
    (8.0, 10.0, "Standard Seat"),
    (7.99, 10.0, "Economy Seat"),
    (10.0, 0.0, "Standard Seat"),
    (0.0, 10.0, "Standard Seat"),
    (None, 10.0, "Standard Seat"),
    (10.0, None, "Standard Seat"),
    (NAN, 10.0, "Standard Seat"),
    (10.0, NAN, "Standard Seat"),
]
ALERTS = [
    (49.99, 1, 1, 1, "Very Low Value"),
    (50.0, 1, 1, 1, "Normal"),
    (5000.0, 1, 1, 1, "Normal"),
    (5000.01, 1, 1, 1, "Very High Value"),
    (None, 1, 1, 1, "Very Low Value"),
    (NAN, 1, 1, 1, "Normal"),
    (NAN, 3, 1, 1, "Multiple Retries"),
    (100.0, 2, 1, 1, "Normal"),
    (100.0, 3, 9999, 9999, "Multiple Retries"),
    (100.0, None, 3000, 1, "Normal"),
    (100.0, 1, 3001, 9999, "Slow Processing"),
    (100.0, 1, None, 600, "Normal"),
    (100.0, 1, 1, 601, "Payment Delay"),
    (100.0, 1, 1, None, "Normal"),
    (100.0, 1, 1, -5, "Normal"),
]


@pytest.fixture(scope="module")
def sql(spark):
    rules.register_sql_rules(spark)
    return spark


def both(sql, rows, schema, column, call, width):
    df = sql.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}, expected string")
    got = df.selectExpr("*", f"{call} AS from_sql").withColumn("from_column", column).orderBy("i").collect()
    for row in got:
        assert row.from_column == row.expected, row
        assert row.from_sql == row.expected, row


def test_categorize_event(sql):
    column = rules.categorize_event("kind", "name")
    rows = [("Movie", name, out) for name, out in EVENTS]
    both(sql, rows, "kind string, name string", column, "CategorizeEvent(kind, name)", 2)


def test_payment_type(sql):
    both(sql, METHODS, "m string", rules.payment_type("m"), "GetPaymentType(m)", 1)


def test_seat_tier(sql):
    both(sql, TIERS, "p double, a double", rules.seat_tier("p", "a"), "GetSeatTier(p, a)", 2)


def test_check_anomaly(sql):
    column = rules.check_anomaly("t", "r", "m", "s")
    both(sql, ALERTS, "t double, r int, m int, s int", column, "CheckAnomaly(t, r, m, s)", 4)


@pytest.mark.parametrize(
    "status, total, alert, expected",
    [
        ("Success", 500.01, "Normal", "High Value Success"),
        ("Success", 500.0, "Normal", "Standard Success"),
        ("Success", NAN, "Normal", "Standard Success"),
        ("Success", 900.0, "Slow Processing", "Unknown"),
        ("Failed", 900.0, "Normal", "Failed Transaction"),
        ("Failed", None, "Very Low Value", "Failed Transaction"),
        ("Pending", 900.0, "Normal", "Unknown"),
        ("success", 900.0, "Normal", "Unknown"),
        (None, 900.0, "Normal", "Unknown"),
    ],
)
def test_transaction_category(spark, status, total, alert, expected):
    df = spark.createDataFrame([(status, total, alert)], "s string, t double, a string")
    assert df.select(rules.transaction_category("s", "t", "a")).first()[0] == expected


def test_sql_functions_leave_no_call_in_the_plan(sql):
    df = sql.range(5).selectExpr("GetSeatTier(id, 2.0) AS tier")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "GetSeatTier" not in plan and "CASE WHEN" in plan
