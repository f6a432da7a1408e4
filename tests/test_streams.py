"""Streams against their batch twins, in many files and any order."""

import datetime as dt
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from samples import BOOKING, PAYMENT, START, changed, records

from seatledger.plans.fact import booking_fact
from seatledger.plans.trends import windowed_revenue
from seatledger.registry import _fact_text
from seatledger.schemas import BOOKING_SCHEMA, MESSAGE_SCHEMA, PAYMENT_SCHEMA
from seatledger.sources.events import decode_booking_messages, decode_bookings, decode_payments, encode_events, read_records
from seatledger.sources.replay import Replay
from seatledger.sources.workspace import workspace
from seatledger.streaming import jobs, sinks
from seatledger.streaming.replay import append_slice, sliced_feeds


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def feeds(spark, sf):
    """One year of events as JSON files in arrival order, some to a file."""
    path = workspace(spark, "feeds")
    source = Replay(spark, sf)
    since = F.col("timestamp") >= "2000-08-01"
    made = {
        "bookings": encode_events(source.nested_bookings(), BOOKING_SCHEMA),
        "payments": encode_events(source.payments(), PAYMENT_SCHEMA),
    }
    for name, rows in made.items():
        rows.filter(since).repartitionByRange(6, "timestamp").sortWithinPartitions("timestamp").write.json(f"{path}/{name}")
    return path


def decoded(spark, path, stream=False, **options):
    return (
        decode_bookings(read_records(spark, f"{path}/bookings", stream=stream, **options)),
        decode_payments(read_records(spark, f"{path}/payments", stream=stream, **options)),
    )


@pytest.mark.parametrize(
    "options",
    [{}, {"time_basis": "event"}, {"minute_semantics": "boundary"}, {"spread": 4}, {"minutes": 3}],
    ids=["arrival", "event", "boundary", "spread", "minutes"],
)
def test_stream_equals_batch_in_one_go(spark, feeds, options):
    path = workspace(spark, "fact")
    rows = jobs.streaming_fact(*decoded(spark, feeds, stream=True), **options)
    sinks.run_to_end(sinks.append_stream(rows, f"{path}/data", f"{path}/checkpoint"))
    got = spark.read.parquet(f"{path}/data")
    expected = booking_fact(*decoded(spark, feeds), **options)
    assert got.count() > 100 and same(_fact_text(got), _fact_text(expected))


def test_sliced_feeds_keep_the_state_small(spark, sf):
    """One-minute watermark, several batches: nothing is lost and the state is a part of the input."""
    path, source = workspace(spark, "sliced"), Replay(spark, sf)
    rows = jobs.streaming_fact(*sliced_feeds(source.nested_bookings(), source.payments(), path))
    query = sinks.append_stream(rows, f"{path}/data", f"{path}/checkpoint")
    sinks.run_to_end(query)
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(state) >= 5 and sinks.late_rows(query) == 0
    assert max(state) < 0.5 * (source.booking_headers().count() + source.payments().count())
    got, expected = spark.read.parquet(f"{path}/data"), booking_fact(source.nested_bookings(), source.payments())
    assert same(_fact_text(got), _fact_text(expected))


def test_rows_behind_the_watermark_are_counted(spark, sf):
    """An early booking that comes with the last slice is late, whatever else comes in time."""
    path, source = workspace(spark, "late"), Replay(spark, sf)
    bookings, payments = sliced_feeds(source.nested_bookings(), source.payments(), path, slices=3)
    early = encode_events(source.nested_bookings().orderBy("arrival_time").limit(20), MESSAGE_SCHEMA)
    append_slice(early, f"{path}/bookings", 1, 0)
    append_slice(early.limit(0), f"{path}/payments", 1, 0)
    query = sinks.append_stream(jobs.streaming_fact(bookings, payments), f"{path}/data", f"{path}/checkpoint")
    sinks.run_to_end(query)
    assert sinks.late_rows(query) > 0
    expected = booking_fact(source.nested_bookings(), source.payments())
    assert same(_fact_text(spark.read.parquet(f"{path}/data")), _fact_text(expected))


def test_stream_equals_batch_file_by_file(spark, feeds):
    """Many batches with a wide enough watermark: nothing is lost, wherever a pair is split."""
    path = workspace(spark, "fact")
    feed = decoded(spark, feeds, stream=True, maxFilesPerTrigger=1)
    rows = jobs.streaming_fact(*feed, delay="400 days")
    query = sinks.append_stream(rows, f"{path}/data", f"{path}/checkpoint")
    sinks.run_to_end(query)
    assert query.lastProgress["batchId"] >= 5
    assert same(_fact_text(spark.read.parquet(f"{path}/data")), _fact_text(booking_fact(*decoded(spark, feeds))))


def one_by_one(spark, batches):
    """Write record files one after the other, running the query after each."""
    path = workspace(spark, "steps")

    def put(name, events, arrivals):
        rows = records(spark, events, arrivals) if events else records(spark, ["{}"], [START]).limit(0)
        rows.coalesce(1).write.mode("append").json(f"{path}/{name}")

    state = []
    for bookings, payments in batches:
        put("bookings", *bookings)
        put("payments", *payments)
        rows = jobs.streaming_fact(*decoded(spark, path, stream=True))
        query = sinks.append_stream(rows, f"{path}/data", f"{path}/checkpoint")
        sinks.run_to_end(query)
        state.append(sum(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress[-1:] if p["stateOperators"]))
    return spark.read.parquet(f"{path}/data"), state, sinks.late_rows(query)


def later(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_pairs_over_restarts_late_rows_and_state(spark):
    """The query is stopped and started again between files; its state goes on."""
    far = changed(BOOKING, order_id="order_far", booking_id="far")
    batches = [
        (([BOOKING], [later(0)]), ([], [])),
        (([], []), ([PAYMENT, changed(PAYMENT, payment_id="p_out")], [later(600), later(601)])),
        (([far], [later(90_000)]), ([changed(PAYMENT, payment_id="p_far", order_id="order_far")], [later(90_000)])),
        (([], []), ([changed(PAYMENT, payment_id="p_late")], [later(30)])),  # behind the watermark
    ]
    rows, state, late = one_by_one(spark, batches)
    found = sorted((r.payment_id, r.seat_number) for r in rows.collect())
    assert found == [("p_far", "S-2"), ("p_far", "V-1"), ("payment_1", "S-2"), ("payment_1", "V-1")]
    assert late == 1
    assert state[-1] <= 3  # only the far order's rows are still kept


def test_windows_after_the_join_close(spark, feeds):
    """A far row moves the watermark on; then every window is out, and only once."""
    path = workspace(spark, "closed")
    for name in ("bookings", "payments"):
        read_records(spark, f"{feeds}/{name}").coalesce(1).write.json(f"{path}/{name}")

    def run(length, slide, label):
        rows = jobs.windowed_after_join(*decoded(spark, path, stream=True), length, slide)
        query = sinks.append_stream(rows, f"{path}/{label}", f"{path}/{label}-checkpoint")
        sinks.run_to_end(query)

    shapes = [("10 minutes", None, "tumbling"), ("10 minutes", "5 minutes", "sliding")]
    for shape in shapes:
        run(*shape)
    for name, event in (("bookings", changed(BOOKING, order_id="x")), ("payments", changed(PAYMENT, order_id="y"))):
        records(spark, [event], [dt.datetime(2030, 1, 1)]).write.mode("append").json(f"{path}/{name}")
    from seatledger.operators.bookings import flatten_seats, validate_bookings, with_seats
    from seatledger.operators.correlate import correlate, with_measures
    from seatledger.operators.payments import validate_payments

    b, p = decoded(spark, feeds)
    pairs = correlate(with_seats(validate_bookings(b)), validate_payments(p))
    joined = flatten_seats(with_measures(pairs))
    for length, slide, label in shapes:
        run(length, slide, label)
        expected = windowed_revenue(joined, length, slide, "payment_enqueued_time")
        cents = {"revenue": F.round("revenue", 2)}
        assert same(spark.read.parquet(f"{path}/{label}").withColumns(cents), expected.withColumns(cents))


def test_running_success_over_files(spark, feeds):
    path = workspace(spark, "running")
    payments = decoded(spark, feeds, stream=True, maxFilesPerTrigger=1)[1]
    sinks.run_to_end(sinks.change_stream(jobs.running_success(payments), f"{path}/data", f"{path}/checkpoint"))
    batches = spark.read.parquet(f"{path}/data")
    assert batches.count() >= 5
    row = sinks.latest(spark, f"{path}/data", []).first()
    rows = decoded(spark, feeds)[1]
    assert tuple(row) == (rows.count(), rows.filter("payment_status = 'Success'").count())


def shuffle_files(spark):
    """Shuffle files this session holds on disk."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f.name for folder in folders for f in Path(folder).rglob("shuffle_*.data")}


def test_feeds_and_state_take_little_disk(spark, sf):
    """Feeds are staged as columns and packed, shuffles go after each batch, and old versions of the state are not kept."""
    path, source = workspace(spark, "disk"), Replay(spark, sf)
    before = shuffle_files(spark)
    feeds = sliced_feeds(source.nested_bookings(), source.payments(), path)
    for name, schema in (("bookings", MESSAGE_SCHEMA), ("payments", PAYMENT_SCHEMA)):
        assert spark.read.parquet(f"{path}/staged-{name}").columns == [*schema.fieldNames(), "arrival_time"]
        slices = [pq.read_metadata(f) for f in Path(f"{path}/{name}").rglob("*.parquet")]
        assert {m.row_group(0).column(0).compression for m in slices} == {"ZSTD"}
    query = sinks.append_stream(jobs.streaming_fact(*feeds), f"{path}/data", f"{path}/checkpoint")
    sinks.run_to_end(query)
    assert not shuffle_files(spark) - before
    assert spark.read.parquet(f"{path}/data").count() > 100
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    # One store a partition of the join, and the commits of the last batches only.
    stores = [f for f in Path(f"{path}/checkpoint/state/0/0").iterdir() if f.is_dir()]
    assert not [f for f in stores if "-key" in f.name]
    assert len([f for f in Path(f"{path}/checkpoint/commits").iterdir() if f.name.isdigit()]) <= 4
    state = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(state) > 0 and sinks.late_rows(query) == 0


def test_staged_events_give_the_records_of_the_events(spark):
    """Each slice's records are those of the events themselves, each once, and an event without a time is in none."""
    path = workspace(spark, "staged")
    odd = [BOOKING, changed(BOOKING, order_id=None), changed(BOOKING, event_details__seats=[]), changed(BOOKING, customer=None), BOOKING]
    paid = [changed(PAYMENT, payment_id=f"p{i}", amount=None if i == 3 else PAYMENT["amount"]) for i in range(9)]
    made = {}
    for name, given, decode in (("bookings", odd, decode_booking_messages), ("payments", paid, decode_payments)):
        untimed = records(spark, given[:1]).withColumn("timestamp", F.lit(None).cast("timestamp"))
        timed = records(spark, given, [later(1000.25 * i) for i in range(len(given))])
        made[name] = decode(timed.union(untimed))
    sliced_feeds(made["bookings"], made["payments"], path, slices=3)
    for name, schema, many in (("bookings", MESSAGE_SCHEMA, len(odd)), ("payments", PAYMENT_SCHEMA, len(paid))):
        fed = read_records(spark, f"{path}/{name}", "parquet").filter("value != '{}'").drop("file")
        assert fed.count() == many and same(fed, encode_events(made[name], schema).filter("timestamp is not null"))
    assert spark.read.parquet(f"{path}/staged-payments").columns == [*PAYMENT_SCHEMA.fieldNames(), "arrival_time"]


def test_a_slice_of_many_rows_is_read_by_several_tasks(spark):
    """Records are parsed by a task per file, which at 200,000 rows a file left most cores idle."""
    path = workspace(spark, "many")
    rows = spark.range(60_000).selectExpr("CAST(NULL AS string) AS key", "'{\"order_id\": \"x\"}' AS value", "timestamp_seconds(id) AS timestamp")
    sliced_feeds(decode_booking_messages(rows.limit(10)), decode_payments(rows), path, slices=1)
    fed = read_records(spark, f"{path}/payments", "parquet").filter("value != '{}'")
    assert fed.count() == 60_000 and len({f.parent.name for f in Path(f"{path}/payments").rglob("*.parquet")}) == 2
