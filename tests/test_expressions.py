"""Rounding, money text and time expressions."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from seatledger.functions import fees, numbers, times


def test_round_cents_equals_exact_rounding(spark):
    draw = random.Random(3)
    values = [n * 0.025 for n in range(0, 4000)]
    values += [draw.uniform(0, 10**draw.randint(0, 9)) for _ in range(4000)]
    values += [0.125, 0.375, 2.675, 25.025, 1.005, -25.025, -0.125, 0.0, 1e15]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for x, got in df.select("x", numbers.round_cents(F.col("x"))).collect():
        assert got == round(x, 2), x


def test_fixed_text_equals_exact_rounding(spark):
    draw = random.Random(4)
    values = [n / 20 for n in range(0, 2100)] + [draw.uniform(0, 100) for _ in range(3000)] + [96.35, 0.25, 0.05]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select("x", numbers.fixed_1(F.col("x")), numbers.fixed_0(F.col("x"))).collect()
    for x, one, none in got:
        assert one == str(Decimal(x).quantize(Decimal("0.1"), ROUND_HALF_UP)), x
        assert none == str(Decimal(x).quantize(Decimal("1"), ROUND_HALF_UP)), x


@pytest.mark.parametrize(
    "value, text",
    [
        (81857.97, "₹81,857.97"),
        (1500.5, "₹1,500.5"),
        (1234567.0, "₹12,34,567"),
        (-1234567.0, "₹-12,34,567"),
        (123456789.125, "₹12,34,56,789.13"),
        (999.0, "₹999"),
        (0.0, "₹0"),
        (0.005, "₹0.01"),
        (None, "₹0"),
    ],
)
def test_rupees(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(numbers.rupees(F.col("x"))).first()[0] == text


def test_zero_padded(spark):
    df = spark.createDataFrame([(42,), (999999,), (1234567,)], "n long")
    got = [r[0] for r in df.select(numbers.zero_padded("order_", F.col("n"), 6)).collect()]
    assert got == ["order_000042", "order_999999", "order_1234567"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-09-12T18:30:10.123456Z", dt.datetime(2026, 9, 12, 18, 30, 10, 123456)),
        ("2026-09-12T18:30:10Z", dt.datetime(2026, 9, 12, 18, 30, 10)),
        ("2026-09-12T18:30:10", dt.datetime(2026, 9, 12, 18, 30, 10)),
        ("2026-09-12 18:30:10.5", dt.datetime(2026, 9, 12, 18, 30, 10, 500000)),
        ("2026-09-12T18:30:10+05:30", dt.datetime(2026, 9, 12, 13, 0, 10)),
        ("2026-13-12T18:30:10Z", None),
        ("2026-09-12T25:30:10Z", None),
        ("2026", None),
        ("T18:30", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_event_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(F.date_format(times.parse_event_time("t"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    assert got == (expected and expected.strftime("%Y-%m-%d %H:%M:%S.%f"))


def test_time_parts(spark):
    df = spark.sql("SELECT TIMESTAMP '2026-09-12 18:30:10.9' AS a, TIMESTAMP '2026-09-12 18:30:11.1' AS b")
    row = df.select(
        times.seconds_between("a", "b"),
        times.weekday_name("a"),
        times.indian_datetime("a"),
        times.iso_utc("a"),
    ).first()
    assert tuple(row) == (1, "Saturday", "12/9/2026, 6:30:10 pm", "2026-09-12T18:30:10.900000Z")


@pytest.mark.parametrize("amount", [100.0, 799.0, 800.0, 801.0, 1001.0, 2469.0, 0.0])
def test_fees(spark, amount):
    fee = max(amount * 0.025, 20)
    gst = round(amount * 0.18, 2)
    row = fees.with_tax_and_fees(spark.createDataFrame([(amount,)], "a double"), "a").first()
    assert row.gst_amount == gst
    assert row.convenience_fee == round(fee, 2)
    assert row.service_fee == 15
    assert row.total_amount == round(amount + gst + fee + 15, 2)
    assert row.base_amount == amount and row.gst_rate == 0.18 and row.currency == "INR"


def test_fees_of_nothing(spark):
    row = fees.with_tax_and_fees(spark.createDataFrame([(None,)], "a double"), "a").first()
    assert row.total_amount is None and row.convenience_fee is None and row.gst_amount is None


def test_seat_price(spark):
    rows = [(333, "VIP", 666), (333, "Premium", 499), (333, "Bronze", 166), (333, "Box", 333), (333, None, 333)]
    df = spark.createDataFrame(rows, "base int, section string, expected long")
    for row in df.withColumn("got", fees.seat_price("base", "section")).collect():
        assert row.got == row.expected
