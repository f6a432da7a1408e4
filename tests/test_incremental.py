"""Late rows, split outputs, snapshots, day partials, co-located tables, rescued JSON."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from samples import BOOKING, PAYMENT, START, changed, records

from seatledger.operators.bookings import validate_bookings, with_seats
from seatledger.operators.correlate import correlate
from seatledger.operators.payments import validate_payments
from seatledger.operators.quality import split_required
from seatledger.plans import kpis, partials
from seatledger.plans.fact import booking_fact
from seatledger.registry import _summary, _weekly
from seatledger.schemas import BOOKING_SCHEMA, PAYMENT_SCHEMA, RECORD_SCHEMA
from seatledger.sources import colocated, rescue, tables
from seatledger.sources.events import decode_bookings, decode_payments, encode_events
from seatledger.sources.replay import AS_OF, Replay
from seatledger.sources.workspace import workspace
from seatledger.streaming import jobs, sinks, split
from seatledger.streaming.replay import append_slices, sliced_feeds


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# --- watermarks -------------------------------------------------------------


def test_rejected_events_move_the_watermark(spark):
    """Filters that do not read the time, the join's on its key included, stay above the watermark."""
    path, last = workspace(spark, "moved"), dt.datetime(2030, 1, 1)
    records(spark, [BOOKING, "{}"], [START, last]).coalesce(1).write.json(f"{path}/bookings")
    records(spark, [PAYMENT, "no json"], [START, last]).coalesce(1).write.json(f"{path}/payments")
    bookings, payments = (
        decode(spark.readStream.schema(RECORD_SCHEMA).json(f"{path}/{name}"))
        for name, decode in (("bookings", decode_bookings), ("payments", decode_payments))
    )
    windows = jobs.windowed_after_join(bookings, payments)
    query = sinks.append_stream(windows, f"{path}/out", f"{path}/checkpoint")
    sinks.run_to_end(query)
    assert query.lastProgress["eventTime"]["watermark"].startswith("2029-12-31T23:59")
    assert spark.read.parquet(f"{path}/out").count() == 1


@pytest.mark.parametrize("slices", [2, 5])
def test_slices_hold_about_equal_rows_in_several_files(spark, sf, slices):
    path, source = workspace(spark, "slices"), Replay(spark, sf)
    sliced_feeds(source.booking_headers(), source.payments(), path, slices=slices, rows_per_file=100)
    files = spark.read.parquet(f"{path}/payments").filter("value <> '{}'").groupBy(F.input_file_name()).count()
    sizes = [r["count"] for r in files.collect()]
    assert sum(sizes) == source.payments().count() and len(sizes) >= 2 * slices
    assert max(sizes) < 4 * sum(sizes) / len(sizes)


# --- one stream, several outputs --------------------------------------------


def put(spark, path, rows):
    spark.createDataFrame(rows, "id long, at timestamp").coalesce(1).write.mode("append").parquet(path)


def at(seconds):
    return dt.datetime(2026, 1, 1) + dt.timedelta(seconds=seconds)


def test_late_rows_are_kept_with_their_delay(spark):
    path = workspace(spark, "late")

    def run():
        stream = spark.readStream.schema("id long, at timestamp").parquet(f"{path}/in")
        sinks.run_to_end(split.split_late(stream, "at", 60, f"{path}/out", f"{path}/checkpoint"))

    for rows in ([(1, at(0)), (2, at(1000))], [(3, at(940)), (4, at(941)), (5, None), (6, at(100))], [(7, at(5000))], [(8, at(4940))]):
        put(spark, f"{path}/in", rows)
        run()
    late = {r.id: r[split.DELAY_SECONDS] for r in split.read_output(spark, f"{path}/out", split.LATE).collect()}
    assert late == {3: 0.0, 6: 840.0, 8: 0.0}
    assert {r.id for r in split.read_output(spark, f"{path}/out", split.ON_TIME).collect()} == {1, 2, 4, 5, 7}


def test_a_batch_that_fails_half_way_is_written_once(spark):
    path, fails = workspace(spark, "failing"), {"left": 1}

    def output(batch, batch_id):
        if batch_id == 1 and fails["left"]:
            fails["left"] -= 1
            # Part of the batch is already written when the job dies.
            batch.limit(1).withColumn(split.OUTPUT, F.lit("fit")).write.partitionBy(split.OUTPUT).parquet(f"{path}/out/batch_id=1")
            raise RuntimeError("executor lost")
        return batch.withColumn(split.OUTPUT, F.when(F.col("id") % 2 == 0, "fit").otherwise("rejected"))

    def run():
        stream = spark.readStream.schema("id long, at timestamp").parquet(f"{path}/in")
        sinks.run_to_end(split.split_stream(stream, output, f"{path}/out", f"{path}/checkpoint"))

    put(spark, f"{path}/in", [(i, at(i)) for i in range(10)])
    run()
    put(spark, f"{path}/in", [(i, at(i)) for i in range(10, 20)])
    with pytest.raises(Exception):
        run()
    run()
    fit = [r.id for r in split.read_output(spark, f"{path}/out", "fit").collect()]
    bad = [r.id for r in split.read_output(spark, f"{path}/out", "rejected").collect()]
    assert sorted(fit) == list(range(0, 20, 2)) and sorted(bad) == list(range(1, 20, 2))


def test_snapshots_of_changing_results(spark):
    path = workspace(spark, "changes") + "/data"

    def batch(i, rows):
        spark.createDataFrame(rows, "k string, n long").write.parquet(f"{path}/batch_id={i}")

    def now():
        return {r.k: r.n for r in sinks.latest(spark, path, ["k"]).collect()}

    batch(0, [("a", 1), ("b", 1)])
    batch(1, [("a", 2)])
    assert now() == {"a": 2, "b": 1} and sinks.compact(spark, path, ["k"]) == 1 and now() == {"a": 2, "b": 1}
    assert sinks.compact(spark, path, ["k"]) == 1
    for i in range(2, 12):
        batch(i, [("b", i), (f"c{i}", i)])
    expected = {"a": 2, "b": 11, **{f"c{i}": i for i in range(2, 12)}}
    assert now() == expected and sinks.compact(spark, path, ["k"]) == 11 and now() == expected
    # Folders up to the snapshot are ruled out by name.
    text = plan(sinks.latest(spark, path, ["k"]))
    assert "PartitionFilters: [isnotnull(batch_id" in text and "> 11)" in text


# --- day partials -----------------------------------------------------------


@pytest.fixture(scope="module")
def fact(spark, sf):
    source = Replay(spark, sf)
    rows, _ = split_required(booking_fact(source.nested_bookings(), source.payments()))
    path = workspace(spark, "fact-rows")
    rows.filter("booking_time >= '2001-06-01'").write.parquet(path)
    return spark.read.parquet(path)


def test_partials_equal_the_rescan_after_late_rows_and_a_rerun(spark, fact):
    home = workspace(spark, "partials")
    late = F.pmod(F.xxhash64("order_id"), F.lit(4)) == 0
    partials.absorb(fact.filter(~late), home, 0)
    before = spark.read.parquet(f"{home}/days").count()
    partials.absorb(fact.filter(late & (F.col("booking_time") >= "2001-07-28")), home, 1)
    assert spark.read.parquet(f"{home}/days").count() - before <= 5
    partials.absorb(fact.filter(late & (F.col("booking_time") < "2001-07-28")), home, 2)
    partials.absorb(fact.filter(late & (F.col("booking_time") < "2001-07-28")), home, 2)
    partials.absorb(fact.limit(0), home, 3)
    for days in (7, 30):
        assert same(_weekly(partials.weekly_kpis(spark, home, AS_OF, days)), _weekly(kpis.weekly_kpis(fact, AS_OF, days)))
    found = partials.revenue_summary(spark, home, AS_OF)
    assert found.count() >= 10 and same(_summary(found), _summary(kpis.revenue_summary(fact, AS_OF)))
    read = partials.weekly_kpis(spark, home, AS_OF).inputFiles() + found.inputFiles()
    assert not [f for f in read if "/fact/" in f]
    with pytest.raises(ValueError):
        partials.weekly_kpis(spark, home, AS_OF + dt.timedelta(hours=1))


def test_sketches_merge_over_any_days(spark, fact):
    home = workspace(spark, "sketches")
    many = fact.limit(1).crossJoin(spark.range(40_000)).withColumn("customer_id", F.concat(F.lit("c"), F.col("id") % 30_000))
    moved = many.withColumn("booking_time", F.col("booking_time") + F.make_dt_interval((F.col("id") % 9).cast("int")))
    partials.absorb(moved, home, 0)
    days = [r[0] for r in spark.read.parquet(f"{home}/days").select(partials.DAY).orderBy(partials.DAY).collect()]
    for first, last in ((days[0], days[-1]), (days[2], days[4])):
        exact = moved.filter(F.to_date("booking_time").between(first, last)).select("customer_id").distinct().count()
        estimate = partials.unique_customers(spark, home, first, last).first()[0]
        assert abs(estimate - exact) < 0.05 * exact


# --- co-located storage -----------------------------------------------------


def test_colocated_join_moves_no_rows(spark, sf):
    tables.create_database(spark)
    source = Replay(spark, sf)
    bookings, payments = with_seats(validate_bookings(source.nested_bookings())), validate_payments(source.payments())
    colocated.store_by_order(bookings, "ticketing.b_plan", 4)
    colocated.store_by_order(payments, "ticketing.p_plan", 4)
    joined = colocated.join_by_order(spark, "ticketing.b_plan", "ticketing.p_plan")
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    columns = ["booking_id", "payment_id"]
    assert same(joined.select(*columns), correlate(bookings, payments).select(*columns))


# --- rescued JSON -----------------------------------------------------------


@pytest.mark.parametrize(
    "change, faults",
    [
        ({}, []),
        ({"event_details__total_seats": 2.0, "booking_metadata__total_amount": 850}, []),
        ({"event_details__total_seats": 2.5}, [("event_details.total_seats", "DECIMAL", "2.5")]),
        ({"customer": "x"}, [("customer", "STRING", '"x"')]),
        ({"customer": None, "order_id": 7}, [("order_id", "BIGINT", "7")]),
        ({"event_details__seats": {"a": 1}}, [("event_details.seats", "OBJECT", '{"a":1}')]),
        (
            {"event_details__seats": [{"seat_number": 1, "price": "y"}, 5, None], "unknown": 1},
            [("event_details.seats[].seat_number", "BIGINT", "1"), ("event_details.seats[].price", "STRING", '"y"'), ("event_details.seats[]", "BIGINT", "5")],
        ),
    ],
)
def test_faults_by_path(spark, change, faults):
    row = rescue.decode_rescued(records(spark, [changed(BOOKING, **change)]), BOOKING_SCHEMA).first()
    assert row[rescue.PROBLEM] is None and [tuple(f) for f in row[rescue.FAULTS]] == faults
    assert row.booking_id == "booking_1" and row.booking_metadata.currency == "INR"


def test_texts_that_are_no_events(spark):
    rows = rescue.decode_rescued(records(spark, ['{"order_id": "a"', "[1]", "5", "", "null", "{}"]), BOOKING_SCHEMA)
    assert [r[rescue.PROBLEM] for r in rows.collect()] == ["not json", "not an object", "not an object", "not json", "not an object", None]
    nulls = spark.createDataFrame([(None, None, None)], RECORD_SCHEMA).withColumn("extra", F.lit(1))
    assert rescue.decode_rescued(nulls, BOOKING_SCHEMA).first()[rescue.PROBLEM] == "not json"
    assert rescue.decode_rescued(nulls.limit(0), BOOKING_SCHEMA).count() == 0


def test_public_schema_has_no_part_number(spark):
    again = decode_bookings(encode_events(decode_bookings(records(spark, [BOOKING])), BOOKING_SCHEMA))
    assert "message_part" not in again.columns


# --- work done once ---------------------------------------------------------


def full_plan(spark, df):
    spark.conf.set("spark.sql.debug.maxToStringFields", "2000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_records_are_made_and_parsed_once(spark, sf):
    """A filter on decoded fields does not repeat the parsing, nor the writing of the text before it."""
    source = Replay(spark, sf)
    bookings = validate_bookings(decode_bookings(encode_events(source.booking_headers(), BOOKING_SCHEMA)))
    payments = validate_payments(decode_payments(encode_events(source.payments(), PAYMENT_SCHEMA)))
    for rows in (bookings, payments):
        text = full_plan(spark, rows)
        assert text.count("from_json(") == 1 and text.count("StructsToJsonEvaluator(") == 1


def test_a_record_is_looked_through_once(spark):
    """One parse into a tree, one look per field and per array, whatever is asked about them."""
    text = full_plan(spark, rescue.decode_rescued(records(spark, [BOOKING], [START]), BOOKING_SCHEMA))
    fields = sum(1 for _ in rescue._checks(BOOKING_SCHEMA, "$", ""))
    assert text.count("parseJson(") == 1
    assert text.count("try_variant_get(") <= fields + 10


def test_a_batch_with_late_rows_is_made_once(spark):
    path, made = workspace(spark, "made-once"), spark.sparkContext.accumulator(0)

    @F.udf("timestamp")
    def counted(time):
        made.add(1)
        return time

    put(spark, f"{path}/in", [(i, at(i)) for i in range(10)])
    stream = spark.readStream.schema("id long, at timestamp").parquet(f"{path}/in").withColumn("at", counted("at"))
    sinks.run_to_end(split.split_late(stream, "at", 60, f"{path}/out", f"{path}/checkpoint"))
    assert split.read_output(spark, f"{path}/out", split.ON_TIME).count() == 10
    assert made.value == 10


def test_files_of_a_slice_grow_with_its_rows(spark):
    path = workspace(spark, "slice-files")
    staged = spark.range(40).selectExpr("'k' AS key", "CAST(id AS string) AS value", "timestamp_seconds(id) AS timestamp", "IF(id < 35, 1, 2) AS slice")
    files = append_slices(staged, f"{path}/feed", rows_per_file=10)
    assert files == 4
    stored = spark.read.parquet(f"{path}/feed").filter("value <> '{}'")
    assert stored.count() == 40 and stored.select("file").distinct().count() == 4
    assert spark.read.parquet(f"{path}/feed").select(F.input_file_name()).distinct().count() == 2 * files


def test_a_slice_without_a_time_is_kept(spark):
    path = workspace(spark, "no-time")
    staged = spark.range(4).selectExpr("'k' AS key", "CAST(id AS string) AS value", "CAST(NULL AS timestamp) AS timestamp", "IF(id < 3, 1, NULL) AS slice")
    append_slices(staged, f"{path}/feed")
    assert spark.read.parquet(f"{path}/feed").filter("value <> '{}'").count() == 4


def test_files_hold_a_range_of_days_and_big_days_are_dealt(spark):
    days = spark.range(1000).selectExpr("CAST(id AS string) AS order_id", "'p' AS payment_id", "'s' AS seat_number", "IF(id < 500, DATE'2026-01-01', IF(id < 510, NULL, date_add(DATE'2026-01-02', CAST(id % 49 AS int)))) AS booking_date")
    sizes = dict(days.groupBy("booking_date").count().collect())
    files = partials._in_files_of_days(days, sizes, rows_per_file=100).withColumn("file", F.spark_partition_id())
    assert "RangePartitioning" not in plan(files) and files.drop("file").exceptAll(days).count() == 0 and files.count() == 1000
    held = files.groupBy("file").agg(F.count("*").alias("n"), F.min("booking_date").alias("first"), F.max("booking_date").alias("last")).collect()
    assert max(r.n for r in held) <= 150 and sum(str(r.first) == "2026-01-01" and r.first == r.last for r in held) == 5
    rest = sorted((r.first, r.last) for r in held if r.first and str(r.first) > "2026-01-01")
    assert len(rest) >= 5 and all(a[1] < b[0] for a, b in zip(rest, rest[1:]))


def test_stored_facts_move_whole_pairs(spark, sf):
    """Seats are unpacked after the last move of rows, whatever day they are stored under."""
    source = Replay(spark, sf)
    placed = booking_fact(source.nested_bookings(), source.payments(), by_day=True)
    lines = full_plan(spark, placed).splitlines()
    unpacked = next(i for i, line in enumerate(lines) if "Generate inline(seats" in line)
    assert not any("Exchange" in line for line in lines[:unpacked])
    assert any("REBALANCE_PARTITIONS_BY_COL" in line for line in lines[unpacked:])
    path = workspace(spark, "placed")
    tables.write_checked(placed, path, placed=True)
    plain = tables.tagged(booking_fact(source.seat_messages(), source.payments()))
    assert same(spark.read.parquet(path).select(*plain.columns), plain)
