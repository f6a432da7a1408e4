"""Lanes of hot keys: the same pairs, little more state, choices that change between runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seatledger.operators.intervals import Lanes, interval_join
from seatledger.schemas import MESSAGE_SCHEMA, PAYMENT_SCHEMA
from seatledger.sources.events import decode_booking_messages, decode_payments, encode_events
from seatledger.sources.replay import Replay
from seatledger.sources.workspace import workspace
from seatledger.streaming import jobs, lanes, sinks
from seatledger.streaming.replay import append_slice, sliced_feeds, sliced_records

BEGIN = int(dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc).timestamp())


def sides(spark):
    def rows(n, step, name):
        key = F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 8, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 5))
        time = F.when(F.col("id") % 41 != 0, F.timestamp_seconds(F.col("id") * step + BEGIN))
        return spark.range(n).select(key.alias("key"), time.alias(f"{name}_time"), F.col("id").alias(f"{name}_id"))

    return rows(1500, 37, "left"), rows(500, 111, "right")


@pytest.mark.parametrize(
    "entries",
    [
        [],
        [Lanes("hot", None, 5, 1)],
        [Lanes("hot", None, 1, 4)],
        [Lanes("hot", None, 3, 2), Lanes("hot", BEGIN + 20_000, 1, 7), Lanes("hot", BEGIN + 40_000, 1, 1), Lanes("k1", BEGIN + 9_000, 2, 1)],
    ],
    ids=["none", "left", "right", "changing"],
)
def test_same_pairs(spark, entries):
    left, right = sides(spark)
    join = dict(on="key", left_time="left_time", right_time="right_time", lower=-30, upper=600)
    expected = interval_join(left, right, **join).select("left_id", "right_id")
    got = interval_join(left, right, **join, lanes=entries, spread_by=["left_id"], lanes_by=["right_id"])
    assert set(got.columns) == {"key", "left_time", "left_id", "right_time", "right_id"}
    pairs = sorted(map(tuple, got.select("left_id", "right_id").collect()))
    assert len(pairs) > 1000 and pairs == sorted(map(tuple, expected.collect()))


def test_lanes_need_slots(spark):
    left, right = sides(spark)
    for wrong in ({"spread": 2}, {"slots": False}):
        with pytest.raises(ValueError):
            interval_join(left, right, "key", "left_time", "right_time", lanes=[], **wrong)


@pytest.mark.parametrize(
    "left, right, expected",
    [(0, 0, (1, 1)), (100, 0, (10, 1)), (100, 5, (5, 1)), (5, 100, (1, 5)), (100, 100, (1, 1)), (10**9, 0, (lanes.MOST_LANES, 1))],
)
def test_repeated_rows_are_bounded(left, right, expected):
    a, b = lanes._split(left, right, 10, 0.2)
    assert (a, b) == expected
    assert (a - 1) * right + (b - 1) * left <= 0.2 * (left + right)


def test_counts_and_choices(spark):
    home = workspace(spark, "counts")
    left, right = sides(spark)
    assert lanes.kept_lanes(spark, home) == [] and lanes.chosen(spark, home) == []
    for batch in range(3):
        part = left.filter(F.col("left_id") % 3 == batch)
        for _ in range(2):  # a batch that is run again counts once
            lanes.absorb_counts(part, "key", "left_time", lanes.LEFT, home, batch)
    lanes.absorb_counts(left.limit(0), "key", "left_time", lanes.LEFT, home, 3)
    lanes.absorb_counts(right.filter("right_id < 50"), "key", "right_time", lanes.RIGHT, home, 0)
    found = lanes.counted(spark, home, lanes.LEFT)
    exact = {r["key"]: r["count"] for r in left.filter("key is not null").groupBy("key").count().collect()}
    assert found.keys == exact and found.rows == sum(exact.values())
    # The first choice was made (empty): this one holds from a day after the last row.
    chosen = lanes.chosen(spark, home, rows_per_lane=300)
    assert chosen == [Lanes("hot", found.last + lanes.AHEAD, 4, 1)]
    assert lanes.chosen(spark, home, rows_per_lane=300) == chosen == lanes.kept_lanes(spark, home)
    # No longer hot enough for more than one lane: back to one, the earlier choice stays for its slots.
    assert [(e.left, e.right) for e in lanes.chosen(spark, home, rows_per_lane=10**6)] == [(4, 1), (1, 1)]


def hot(rows, number, every):
    return rows.withColumn("order_id", F.when(number % every == 0, "order_000000").otherwise(F.col("order_id")))


@pytest.fixture(scope="module")
def events(spark, sf):
    """A third of the bookings and a ninetieth of the payments name one order."""
    source = Replay(spark, sf)
    bookings = hot(source.nested_bookings(), F.substring("booking_id", 9, 20).cast("long"), 3)
    return bookings, hot(source.payments(), F.substring("order_id", 7, 20).cast("long"), 90)


def joined(spark, path, feeds, name, **options):
    query = sinks.append_stream(jobs.streaming_fact(*feeds, **options), f"{path}/{name}", f"{path}/{name}-checkpoint")
    sinks.run_to_end(query)
    return max((p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]), default=0)


def ids(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("order_id", "booking_id", "payment_id", "seat_number").collect()), key=repr)


def count_feeds(home, bookings, payments, batch):
    lanes.absorb_counts(bookings, "order_id", "arrival_time", lanes.LEFT, home, batch)
    lanes.absorb_counts(payments, "order_id", "arrival_time", lanes.RIGHT, home, batch)


def test_state_hardly_grows(spark, events):
    path = workspace(spark, "lanes")
    feeds = sliced_feeds(*events, path, slices=1)
    count_feeds(path, *events, 0)
    chosen = lanes.chosen(spark, path, rows_per_lane=50)
    assert [e.key for e in chosen] == ["order_000000"] and chosen[0].left >= 5
    plain = joined(spark, path, feeds, "plain")
    dealt = joined(spark, path, feeds, "dealt", lanes=chosen)
    spread = joined(spark, path, feeds, "spread", spread=chosen[0].left)
    assert 0 < plain <= dealt <= 1.2 * plain < spread
    assert ids(spark, f"{path}/plain") == ids(spark, f"{path}/dealt") and len(ids(spark, f"{path}/plain")) > 100


def test_restart_with_another_choice(spark, events):
    """The join starts without lanes, stops with rows in its state, and goes on with lanes."""
    path = workspace(spark, "lanes-restart")
    kinds = {"bookings": (MESSAGE_SCHEMA, decode_booking_messages), "payments": (PAYMENT_SCHEMA, decode_payments)}
    records = {name: encode_events(rows, kinds[name][0]) for name, rows in zip(kinds, events)}
    middle = records["bookings"].agg(F.percentile_approx(F.unix_seconds("timestamp"), 0.5).alias("t")).first()["t"]
    edges = [0, middle, middle + 30 * 86_400, 2**32]
    feeds = lambda: [decode(sliced_records(spark, f"{path}/{name}", 1)) for name, (_, decode) in kinds.items()]
    seen = []
    for step, (begin, end) in enumerate(zip(edges, edges[1:])):
        for name, rows in records.items():
            seconds = F.unix_seconds("timestamp")
            append_slice(rows.filter((seconds >= begin) & (seconds < end)), f"{path}/{name}", 1, begin)
        seen = lanes.chosen(spark, path, rows_per_lane=50)
        joined(spark, path, feeds(), "rows", lanes=seen)
        arrived = F.unix_seconds("arrival_time")
        count_feeds(path, *[rows.filter((arrived >= begin) & (arrived < end)) for rows in events], step)
    assert seen and all(e.since is not None for e in seen)
    for name, rows in records.items():  # moves the watermark past all
        append_slice(rows.limit(0), f"{path}/{name}", 1, 2**32)
    joined(spark, path, feeds(), "rows", lanes=seen)
    joined(spark, path, sliced_feeds(*events, f"{path}/whole", slices=1), "plain")
    assert ids(spark, f"{path}/rows") == ids(spark, f"{path}/plain")
