"""The interval join against all pairs compared one by one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from seatledger.operators.correlate import correlate
from seatledger.operators.intervals import interval_join

BASE = dt.datetime(2026, 1, 1)


def sides(spark, seed=1, n=400, span=20000, hot=0.33):
    draw = random.Random(seed)

    def rows(letter):
        out = []
        for i in range(n):
            key = "hot" if draw.random() < hot else draw.choice(["a", "b", "c", None])
            time = BASE + dt.timedelta(microseconds=draw.randrange(span * 1_000_000))
            # many times on slot and bound marks
            time = time.replace(microsecond=0) if draw.random() < 0.5 else time
            time = BASE + dt.timedelta(seconds=600 * draw.randrange(span // 600)) if draw.random() < 0.2 else time
            out.append((key, f"{letter}{i}", None if draw.random() < 0.02 else time))
        return out

    left, right = rows("l"), rows("r")
    l_df = spark.createDataFrame(left, "k string, l string, lt timestamp").repartition(4)
    r_df = spark.createDataFrame(right, "k string, r string, rt timestamp").repartition(4)
    return left, right, l_df, r_df


def brute(left, right, lower, upper):
    lo, up = dt.timedelta(seconds=lower), dt.timedelta(seconds=upper)
    return sorted(
        (lid, rid)
        for lk, lid, lt in left
        for rk, rid, rt in right
        if lk is not None and lk == rk and lt and rt and lo <= rt - lt <= up
    )


@pytest.mark.parametrize(
    "lower, upper, spread", [(0, 600, 1), (0, 600, 5), (-60, 660, 1), (0, 0, 1), (-900, -300, 1), (0, 7200, 3)]
)
def test_all_pairs_once(spark, lower, upper, spread):
    left, right, l_df, r_df = sides(spark)
    joined = interval_join(l_df, r_df, "k", "lt", "rt", lower=lower, upper=upper, spread=spread, spread_by=["l"])
    assert joined.columns == ["k", "l", "lt", "r", "rt"]
    assert sorted((r.l, r.r) for r in joined.collect()) == brute(left, right, lower, upper)


def test_times_before_1970(spark):
    left = spark.createDataFrame([("a", "l", dt.datetime(1969, 12, 31, 23, 59, 59, 500000))], "k string, l string, lt timestamp")
    right = spark.createDataFrame([("a", "r", dt.datetime(1970, 1, 1, 0, 9, 59))], "k string, r string, rt timestamp")
    assert interval_join(left, right, "k", "lt", "rt").count() == 1


def test_shared_names_are_refused(spark):
    df = spark.createDataFrame([("a", 1, BASE)], "k string, x int, t timestamp")
    with pytest.raises(ValueError):
        interval_join(df, df, "k", "t", "t")


def test_plan_joins_on_key_and_slot(spark):
    _, _, l_df, r_df = sides(spark, n=10)
    plan = interval_join(l_df, r_df.hint("merge"), "k", "lt", "rt")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [k" in plan and "__slot" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def pair(spark, booked, paid):
    text = "'2026-01-01 {}'"
    b = spark.sql(
        f"SELECT 'o' AS order_id, 'b' AS booking_id, TIMESTAMP {text.format(booked)} AS booking_enqueued_time,"
        " TIMESTAMP '2026-01-01 10:00:00' AS booking_time"
    )
    p = spark.sql(
        f"SELECT 'o' AS order_id, 'p' AS payment_id, TIMESTAMP {text.format(paid)} AS payment_enqueued_time,"
        " TIMESTAMP '2026-01-01 10:09:00' AS payment_time"
    )
    return b, p


@pytest.mark.parametrize(
    "booked, paid, elapsed, boundary",
    [
        ("00:00:59", "00:11:00", 0, 0),  # 601 s, 11 marks
        ("00:00:59", "00:10:59", 1, 1),
        ("00:00:01", "00:10:59", 0, 1),  # 658 s, 10 marks
        ("00:00:30", "00:00:10", 0, 1),  # same minute, payment first
        ("00:01:00", "00:00:59", 0, 0),
        ("00:59:59", "01:00:00", 1, 1),  # over a slot mark
        ("00:59:59", "01:09:59", 1, 1),
        ("00:59:59", "01:10:00", 0, 0),  # 601 s, 11 marks
    ],
)
def test_minute_semantics(spark, booked, paid, elapsed, boundary):
    b, p = pair(spark, booked, paid)
    assert correlate(b, p).count() == elapsed
    assert correlate(b, p, minute_semantics="boundary").count() == boundary
    assert correlate(b, p, time_basis="event").count() == 1
    assert correlate(b, p, time_basis="event", minutes=8).count() == 0


def test_hot_key_is_spread_over_slots(spark):
    """With one key for all rows, no join task may hold them all."""
    rows = 2000
    key = F.when(F.col("id") >= 0, "hot").alias("k")
    time = F.timestamp_seconds(F.col("id") * 100).alias("t")
    times = spark.range(rows).select(key, time)
    left, right = times.withColumnRenamed("t", "lt"), times.withColumnRenamed("t", "rt")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        joined = interval_join(left.hint("merge"), right, "k", "lt", "rt")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(setting)
    assert sum(sizes) == sum(min(7, rows - i) for i in range(rows))
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)
