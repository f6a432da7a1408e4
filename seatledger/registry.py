"""The registered queries: every operator over the stored tables.

Each takes ``(spark, folder of the tables)`` and returns a frame over the whole
tables.  Sums and averages of doubles are rounded, since their last digits
depend on the order of addition; times are given as text or epoch seconds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.fees import with_tax_and_fees
from .functions.rules import categorize_event, register_sql_rules
from .operators.audits import booking_total_audit, fee_audit_summary, with_derived_price
from .operators.bookings import PART, booking_problems, flatten_seats, validate_bookings, whole_bookings, with_seats
from .operators.correlate import fact_columns, with_measures
from .operators.intervals import interval_join
from .operators.lookups import (
    duration_conformance,
    event_profiles,
    method_conformance,
    method_profiles,
    popularity,
    price_conformance,
    section_conformance,
)
from .operators.payments import validate_payments
from .operators.quality import REASON, length_report, rejected, split_required, tag_rejects
from .plans import kpis, partials, report, trends
from .plans.fact import booking_fact, booking_pairs, fact_of_pairs, payment_grain
from .schemas import BOOKING_SCHEMA, FACT_SCHEMA, PAYMENT_SCHEMA
from .session import prepare
from .sources import colocated, events, replay, rescue, tables
from .sources.replay import AS_OF, Replay
from .sources.workspace import workspace
from .streaming import jobs, lanes, sinks, split
from .streaming import replay as stream_replay

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

SECONDS = "yyyy-MM-dd HH:mm:ss"
CLICK_WINDOW = 6 * 3600


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _QUERIES[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- inputs -----------------------------------------------------------------


def fact(spark, d, days: int | None = None, **options) -> DataFrame:
    """The fact; with ``days``, of the orders that matter to a report on so many days before ``AS_OF``."""
    source = Replay(spark, d, AS_OF - dt.timedelta(days=days) if days else None)
    return booking_fact(source.seat_messages(), source.payments(), **options)


def fact_by_day(spark, d) -> DataFrame:
    """The fact to be stored with all its columns: wide rows are joined and moved once per booking and unpacked last."""
    source = Replay(spark, d)
    return booking_fact(source.nested_bookings(), source.payments(), by_day=True)


def valid_bookings(spark, d) -> DataFrame:
    return validate_bookings(Replay(spark, d).booking_headers())


def valid_payments(spark, d) -> DataFrame:
    return validate_payments(Replay(spark, d).payments())


def valid_seats(spark, d) -> DataFrame:
    return flatten_seats(validate_bookings(Replay(spark, d).seat_messages()))


def rounded(df: DataFrame, **places: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


# --- validate, flatten, classify --------------------------------------------


@query
def validated_bookings(spark, d):
    return _booking_text(valid_bookings(spark, d))


@query
def rejected_bookings(spark, d):
    bookings = whole_bookings(Replay(spark, d).booking_headers())
    return rejected(bookings, booking_problems()).select("booking_id", REASON)


@query
def flattened_seats(spark, d):
    return _seat_columns(flatten_seats(validate_bookings(Replay(spark, d).nested_bookings())))


@query
def validated_payments(spark, d):
    return _payment_text(valid_payments(spark, d))


@query
def json_flattened_seats(spark, d):
    """Bookings to JSON records and back, then flattened."""
    records = events.encode_events(Replay(spark, d).nested_bookings(), BOOKING_SCHEMA)
    return _seat_columns(flatten_seats(validate_bookings(events.decode_bookings(records))))


@query
def json_validated_payments(spark, d):
    records = events.encode_events(Replay(spark, d).payments(), PAYMENT_SCHEMA)
    return _payment_text(validate_payments(events.decode_payments(records)))


@query
def json_rejects(spark, d):
    """Booking records damaged by their number: cut off, mistyped, not an object; what is wrong and what is kept."""
    headers = Replay(spark, d).booking_headers()
    records = events.encode_events(headers, BOOKING_SCHEMA, key="booking_id")
    kind = F.substring("key", 9, 20).cast("long") % 9
    text = F.col("value")
    damaged = (
        F.when(kind == 1, F.expr("substring(value, 1, length(value) - 1)"))
        .when(kind == 2, F.regexp_replace(text, '"total_amount":[^,}]*', '"total_amount":"many"'))
        .when(kind == 3, F.regexp_replace(text, '"event_details":\\{[^}]*\\}', '"event_details":"none"'))
        .when(kind == 4, F.regexp_replace(text, '"total_seats":[0-9]+', '"total_seats":2.5'))
        .when(kind == 5, F.regexp_replace(text, '"total_seats":[0-9]+', '"total_seats":3.0'))
        .when(kind == 6, F.concat(F.lit("["), text, F.lit("]")))
        .when(kind == 7, F.regexp_replace(text, '"event_details":\\{', '"event_details":{"seats":{"a":1},'))
        .when(kind == 8, F.regexp_replace(text, '"customer_id":"[^"]*"', '"customer_id":17'))
        .otherwise(text)
    )
    decoded = rescue.decode_rescued(records.withColumn("value", damaged), BOOKING_SCHEMA)
    return decoded.select(
        F.col("customer.customer_id").alias("customer_id"),
        F.unix_seconds("arrival_time").alias("arrival_epoch"),
        rescue.PROBLEM,
        F.array_join(F.transform(rescue.FAULTS, lambda f: F.concat_ws(" ", f["path"], f["found"], f["value"])), ", ").alias("faults"),
    )


@query
def event_category(spark, d):
    bookings = Replay(spark, d).booking_headers().select("booking_id", "event_details.*")
    return bookings.select(
        "booking_id", "event_name", categorize_event("event_type", "event_name").alias("event_category")
    )


@query
def payment_type(spark, d):
    return valid_payments(spark, d).select("payment_id", "payment_method", "payment_type")


@query
def seat_tier(spark, d):
    return valid_seats(spark, d).groupBy("seat_section", "seat_tier").agg(
        F.count("*").alias("seats"), F.sum("seat_price").alias("revenue")
    )


@query
def check_anomaly(spark, d):
    return fact(spark, d).groupBy("alert_category").agg(
        F.count("*").alias("n"),
        F.count_distinct("payment_id").alias("payments"),
        F.round(F.sum("total_amount"), 2).alias("revenue"),
    )


@query
def transaction_category(spark, d):
    return fact(spark, d).groupBy("payment_status", "alert_category", "transaction_category").agg(
        F.count("*").alias("n"), F.round(F.sum("total_amount"), 2).alias("revenue")
    )


@query
def sql_rules(spark, d):
    """The four rules as SQL functions, over the fact's own input columns."""
    register_sql_rules(spark)
    return spark.sql(
        """SELECT CategorizeEvent(event_type, event_name) AS event_category,
                  GetSeatTier(seat_price, try_divide(booking_amount, CAST(total_seats_booked AS DOUBLE))) AS seat_tier,
                  GetPaymentType(payment_method) AS payment_type,
                  CheckAnomaly(total_amount, retry_attempt, processing_time_ms, seconds_between_events)
                    AS alert_category,
                  count(*) AS n
           FROM {fact} GROUP BY 1, 2, 3, 4""",
        fact=fact(spark, d),
    )


# --- joins ------------------------------------------------------------------


@query
def booking_payment_join(spark, d):
    return _fact_text(fact(spark, d))


@query
def join_event_time(spark, d):
    return _pair_columns(fact(spark, d, time_basis="event"))


@query
def join_minute_boundary(spark, d):
    return _pair_columns(fact(spark, d, minute_semantics="boundary"))


@query
def events_click_purchase(spark, d):
    return _click_purchase(replay.table(spark, d, "events"))


# --- KPIs -------------------------------------------------------------------


@query
def revenue_summary(spark, d):
    return _summary(kpis.revenue_summary(fact(spark, d, 30), AS_OF))


@query
def weekly_kpis(spark, d):
    return _weekly(kpis.weekly_kpis(fact(spark, d, 7), AS_OF))


@query
def weekly_kpis_payment_grain(spark, d):
    recent = kpis.last_days(fact(spark, d, 7), 7, AS_OF)
    return _weekly(kpis.weekly_kpis(payment_grain(recent, kpis.WEEKLY_INPUTS), AS_OF))


@query
def stored_fact_weekly_kpis(spark, d):
    """The fact written by day, then the report on the days it needs."""
    path = workspace(spark, "fact")
    tables.write_checked(fact_by_day(spark, d), path, placed=True)
    return _weekly(kpis.weekly_kpis(tables.read_fact(spark, path), AS_OF))


@query
def partials_weekly_kpis(spark, d):
    """The report from sums per day, kept up to date over three batches whose rows share their days."""
    return _weekly(partials.weekly_kpis(spark, _partials(spark, d), AS_OF))


@query
def partials_revenue_summary(spark, d):
    return _summary(partials.revenue_summary(spark, _partials(spark, d), AS_OF))


@query
def partials_unique_customers(spark, d):
    """Customers per city over half a year from the sketches, held against the exact number."""
    home = _partials(spark, d)
    first, last = dt.date(2001, 1, 1), dt.date(2001, 6, 30)
    rows = spark.read.parquet(f"{home}/fact").filter(F.col(partials.DAY).between(first, last))
    exact = rows.groupBy("customer_city").agg(F.count_distinct("customer_id").alias("exact_customers"))
    found = partials.unique_customers(spark, home, first, last, ["customer_city"])
    off = F.abs(F.col("unique_customers") - F.col("exact_customers"))
    both = found.join(exact, "customer_city")
    return both.select("customer_city", "exact_customers", (off <= 0.08 * F.col("exact_customers")).alias("close"))


@query
def colocated_join(spark, d):
    """Bookings and payments stored in buckets by order, then joined bucket by bucket."""
    names = _colocated(spark, d)
    rows = colocated.join_by_order(spark, *names)
    return _fact_text(fact_columns(flatten_seats(with_measures(rows))))


@query
def stored_fact_rejects(spark, d):
    """What the write kept out of the stored fact."""
    path = workspace(spark, "fact")
    tables.write_checked(fact_by_day(spark, d), path, placed=True)
    return tables.read_rejects(spark, path).groupBy(REASON).agg(F.count("*").alias("n"))


@query
def fact_table_lifecycle(spark, d):
    """Create, append and read the catalog table and its view; the summary comes from the view."""
    home = workspace(spark, "lifecycle")
    name = "lifecycle_" + home.rsplit("-", 1)[-1]
    tables.create_database(spark)
    table, view = f"{tables.DATABASE}.{name}", f"{tables.DATABASE}.v_{name}"
    tables.recreate_fact_table(spark, table, home)
    good, _ = split_required(fact(spark, d, 30))
    tables.append_fact(good, table)
    tables.create_revenue_view(spark, view, table, AS_OF)
    return _summary(tables.run_sql(spark, f"SELECT * FROM {view}"))


@query
def revenue_view(spark, d):
    """The revenue summary as a SQL view."""
    fact(spark, d, 30).createOrReplaceTempView("seat_fact")
    tables.create_revenue_view(spark, "v_revenue_summary", "seat_fact", AS_OF, temporary=True)
    return _summary(tables.run_sql(spark, "SELECT * FROM v_revenue_summary"))


@query
def top_city(spark, d):
    return rounded(kpis.top_city(kpis.last_days(fact(spark, d, 7), 7, AS_OF)), revenue=2)


@query
def total_revenue_success(spark, d):
    return rounded(kpis.total_revenue(fact(spark, d)), total_revenue=2)


@query
def success_count(spark, d):
    return kpis.success_count(fact(spark, d))


@query
def revenue_by_city(spark, d):
    return rounded(kpis.revenue_by_city(fact(spark, d)), revenue=2)


@query
def conversion_rate(spark, d):
    source = Replay(spark, d)
    bookings, payments = validate_bookings(source.booking_headers()), validate_payments(source.payments())
    return rounded(kpis.conversion_rate(bookings, payments), conversion_rate_pct=4)


@query
def booking_volume(spark, d):
    return kpis.booking_volume(valid_bookings(spark, d))


@query
def payment_volume(spark, d):
    return kpis.payment_volume(valid_payments(spark, d))


@query
def method_distribution(spark, d):
    return rounded(kpis.method_distribution(valid_payments(spark, d)), share_pct=4)


@query
def failure_reasons(spark, d):
    return kpis.failure_reasons(valid_payments(spark, d))


@query
def method_performance(spark, d):
    return rounded(kpis.method_performance(valid_payments(spark, d)), success_rate=4, avg_processing_time_ms=4)


@query
def gateway_sla(spark, d):
    return rounded(
        kpis.gateway_sla(valid_payments(spark, d)), success_rate=4, avg_processing_time_ms=4, avg_retry_attempt=4
    )


@query
def day_of_week_volume(spark, d):
    return _segment(kpis.day_of_week_volume(fact(spark, d)))


@query
def hourly_volume(spark, d):
    return _segment(kpis.hourly_volume(fact(spark, d)))


@query
def segment_city(spark, d):
    return _segment(kpis.segment_by(fact(spark, d), "customer_city"))


@query
def segment_platform(spark, d):
    return _segment(kpis.segment_by(fact(spark, d), "booking_platform"))


@query
def segment_age_group(spark, d):
    return _segment(kpis.segment_by(fact(spark, d), "customer_age_group"))


@query
def segment_event_type(spark, d):
    return _segment(kpis.segment_by(fact(spark, d), "event_type", "event_category"))


@query
def method_conformance_report(spark, d):
    return rounded(method_conformance(valid_payments(spark, d)), failure_rate=6)


@query
def section_conformance_report(spark, d):
    return section_conformance(valid_seats(spark, d))


# --- windows and trends -----------------------------------------------------


@query
def tumbling_revenue(spark, d):
    return _window_epochs(trends.windowed_revenue(fact(spark, d), "10 minutes"))


@query
def sliding_revenue(spark, d):
    return _window_epochs(trends.windowed_revenue(fact(spark, d), "10 minutes", "5 minutes"))


@query
def revenue_trend(spark, d):
    out = _window_epochs(trends.revenue_trend(fact(spark, d), "1 day"))
    return rounded(out, previous_revenue=2, change=2, change_pct=2)


@query
def period_growth(spark, d):
    return rounded(
        trends.period_growth(fact(spark, d, 14), AS_OF), current_revenue=2, previous_revenue=2, growth_pct=4
    )


# --- quality ----------------------------------------------------------------


@query
def fee_breakdown(spark, d):
    fees = with_tax_and_fees(whole_bookings(valid_bookings(spark, d)), "booking_amount")
    return fees.select(
        "booking_id",
        "base_amount",
        "gst_amount",
        "gst_rate",
        "convenience_fee",
        "service_fee",
        "total_amount",
        "currency",
    )


@query
def fee_audit(spark, d):
    return fee_audit_summary(valid_payments(spark, d), ["payment_method"])


@query
def booking_totals_audit(spark, d):
    return booking_total_audit(Replay(spark, d).nested_bookings())


@query
def seat_price_derivation(spark, d):
    seats = with_derived_price(valid_seats(spark, d), "seat_price")
    return seats.select("booking_id", "seat_number", "seat_section", "seat_price", "derived_price")


@query
def fee_audit_faults(spark, d):
    """The fee audit over payments whose parts are changed by their number, beyond and within the tolerance."""
    n = F.substring("order_id", 7, 20).cast("long")
    kind = n % 6
    wrong = valid_payments(spark, d).withColumns(
        {
            "gst_amount": F.when(kind == 1, F.col("gst_amount") + 0.5).when(kind == 2, F.col("gst_amount") - 0.004).otherwise(F.col("gst_amount")),
            "convenience_fee": F.when(kind == 3, F.col("convenience_fee") - 1).otherwise(F.col("convenience_fee")),
            "service_fee": F.when(n % 31 == 0, F.lit(None)).when(kind == 4, 25.0).otherwise(F.col("service_fee")),
            "total_amount": F.when(kind == 5, F.col("total_amount") + 0.02).otherwise(F.col("total_amount")),
        }
    )
    return fee_audit_summary(wrong, ["payment_method"])


@query
def booking_totals_faults(spark, d):
    """The totals audit over bookings that declare a seat too many, another amount, or have lost their seats."""
    kind = F.substring("booking_id", 9, 20).cast("long") % 5
    details, money = F.col("event_details"), F.col("booking_metadata")
    amount = money["total_amount"]
    wrong = Replay(spark, d).nested_bookings().withColumns(
        {
            "event_details": F.when(kind == 1, details.withField("total_seats", details["total_seats"] + 1))
            .when(kind == 4, details.withField("seats", F.lit(None).cast("array<struct<seat_number string, seat_section string, price double>>")))
            .otherwise(details),
            "booking_metadata": F.when(kind == 2, money.withField("total_amount", amount + 0.5))
            .when(kind == 3, money.withField("total_amount", amount + 0.005))
            .otherwise(money),
        }
    )
    return rounded(booking_total_audit(wrong), declared_amount=3)


@query
def text_lengths_faults(spark, d):
    """The length report over a fact in which some texts are far too long and some just fit."""
    n = F.substring("order_id", 7, 20).cast("long")
    long = fact(spark, d).withColumns(
        {
            "customer_name": F.when(n % 7 == 0, F.repeat("customer_name", 100)).otherwise(F.col("customer_name")),
            "payment_gateway": F.when(n % 11 == 0, F.rpad("payment_gateway", 50, "x"))
            .when(n % 11 == 1, F.rpad("payment_gateway", 51, "x"))
            .otherwise(F.col("payment_gateway")),
            "customer_city": F.when(n % 13 == 0, F.lit(None)).when(n % 13 == 1, F.repeat("customer_city", 40)).otherwise(F.col("customer_city")),
        }
    )
    return length_report(long)


@query
def base_price_derivation(spark, d):
    """Seat prices from base prices with a fraction, in all known sections, an unknown one and none."""
    seats = with_derived_price(_base_prices(spark, d), "base_price")
    return seats.select("k", "line", "seat_section", "base_price", "derived_price")


@query
def base_price_report(spark, d):
    """Base prices against the range of the event type."""
    return price_conformance(_base_prices(spark, d), "base_price")


@query
def popularity_report(spark, d):
    """How often methods and event types occur against their weights."""
    source = Replay(spark, d)
    methods = popularity(valid_payments(spark, d), "payment_method", method_profiles(spark))
    kinds = popularity(source.booking_headers().select("event_details.event_type"), "event_type", event_profiles(spark))
    both = methods.withColumnRenamed("payment_method", "kind").union(kinds.withColumnRenamed("event_type", "kind"))
    return rounded(both, share=6, expected_share=6)


@query
def duration_report(spark, d):
    return duration_conformance(Replay(spark, d).booking_headers().select("event_details.event_type", "event_details.event_duration_hours"))


@query
def missing_required(spark, d):
    _, bad = split_required(fact(spark, d))
    return bad.groupBy(REASON).agg(F.count("*").alias("n"))


@query
def text_lengths(spark, d):
    return length_report(fact(spark, d))


# --- report -----------------------------------------------------------------


@query
def report_payload(spark, d):
    return _payload(spark, d).select("period", "generated_at", "metrics.*", "highlights.*")


@query
def report_metrics_long(spark, d):
    return report.metric_lines(_payload(spark, d))


@query
def category_ranking(spark, d):
    return rounded(report.category_ranking(kpis.weekly_kpis(fact(spark, d, 7), AS_OF)), revenue=2)


@query
def prompt_text(spark, d):
    return report.prompt_text(_payload(spark, d)).select("period", "prompt")


@query
def checked_outputs(spark, d):
    """Generated texts of eight kinds, one per order.

    Whole, without html, without subject, cut off; whole but with a number for a
    subject, an object for html, a number for a preheader, more text behind.
    """
    k = F.col("o_orderkey")
    kind = k % 8
    subject = F.when(kind != 2, F.concat(F.lit("Order "), k.cast("string"))).alias("subject")
    html = F.when(kind != 1, F.concat(F.lit("<p>"), "o_orderstatus", F.lit("</p>"))).alias("html")
    preheader = F.when(kind == 0, F.col("o_orderpriority")).alias("preheader")
    whole = F.to_json(F.struct(subject, preheader, html))
    text = (
        F.when(kind == 3, F.concat(F.lit("{"), whole))
        .when(kind == 4, F.to_json(F.struct(k.alias("subject"), html)))
        .when(kind == 5, F.to_json(F.struct(subject, F.struct(k.alias("x")).alias("html"))))
        .when(kind == 6, F.to_json(F.struct(subject, k.alias("preheader"), html)))
        .when(kind == 7, F.concat(whole, F.lit(" and more")))
        .otherwise(whole)
    )
    texts = replay.table(spark, d, "orders").select("o_orderkey", text.alias("text"))
    return report.checked_outputs(texts, "text").drop("text")


# --- streams ----------------------------------------------------------------


@query
def stream_booking_payment_join(spark, d):
    return _fact_text(_stream_fact(spark, d))


@query
def stream_tumbling_revenue(spark, d):
    return _stream_windows(spark, d, None)


@query
def stream_sliding_revenue(spark, d):
    return _stream_windows(spark, d, "5 minutes")


@query
def stream_windows_after_join(spark, d):
    """Join and tumbling windows of payment arrival in one streaming query, over several batches."""
    return _windows_after_join(spark, d, None)


@query
def stream_sliding_after_join(spark, d):
    return _windows_after_join(spark, d, "5 minutes")


@query
def stream_join_event_time(spark, d):
    """The join on the times inside the events, each topic with the watermark of its own clock."""
    path = workspace(spark, "event-time")
    rows = jobs.streaming_fact(*_feeds(spark, d, path), time_basis="event")
    sinks.run_to_end(sinks.append_stream(rows, f"{path}/fact", f"{path}/checkpoint"))
    return _pair_columns(spark.read.parquet(f"{path}/fact"))


@query
def stream_hot_order(spark, d):
    """A third of all bookings and a thirtieth of the payments name one order; its lanes come from sketches of the feeds."""
    path = workspace(spark, "hot-order")
    source, hot = Replay(spark, d), F.lit("order_000000")
    numbered = F.substring("booking_id", 9, 20).cast("long"), F.substring("order_id", 7, 20).cast("long")
    merged = [
        rows.withColumn("order_id", F.when(F.col("order_id").isNotNull() & (number % every == 0), hot).otherwise(F.col("order_id")))
        for rows, number, every in zip((source.nested_bookings(), source.payments()), numbered, (3, 30))
    ]
    feeds = stream_replay.sliced_feeds(*merged, path)
    for side, feed in zip((lanes.LEFT, lanes.RIGHT), feeds):
        def count(batch, batch_id, side=side):
            lanes.absorb_counts(batch, "order_id", "arrival_time", side, path, batch_id)

        counts = feed.writeStream.foreachBatch(count).option("checkpointLocation", f"{path}/counted-{side}")
        sinks.run_to_end(sinks.timed(counts, None).start())
    rows = jobs.streaming_fact(*feeds, lanes=lanes.chosen(spark, path, rows_per_lane=200))
    sinks.run_to_end(sinks.append_stream(rows, f"{path}/fact", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/fact").select("order_id", "booking_id", "payment_id", "seat_number", "seat_price")


@query
def stream_late_rows(spark, d):
    """Payments by year, one in 29 of them delivered a year late: rows in time and rows kept apart as late."""
    path = workspace(spark, "late-rows")
    records = events.encode_events(Replay(spark, d).payments(), PAYMENT_SCHEMA, key="payment_id")
    held_back = (F.substring_index(F.substring("key", 9, 20), "_", 1).cast("long") % 29 == 0).cast("int")
    records = records.withColumn("slice", F.year("timestamp") + held_back)
    records.write.partitionBy("slice").parquet(f"{path}/staged")
    staged = spark.read.parquet(f"{path}/staged")
    files = stream_replay.append_slices(staged, f"{path}/payments")
    payments = validate_payments(events.decode_payments(stream_replay.sliced_records(spark, f"{path}/payments", files)))
    sinks.run_to_end(split.split_late(payments, "payment_enqueued_time", 60, f"{path}/rows", f"{path}/checkpoint"))
    rows = spark.read.parquet(f"{path}/rows")
    return rows.groupBy(F.year("payment_enqueued_time").alias("arrival_year")).agg(
        F.count_if(F.col(split.OUTPUT) == split.ON_TIME).alias("on_time"),
        F.count_if(F.col(split.OUTPUT) == split.LATE).alias("late"),
        F.max(split.DELAY_SECONDS).cast("long").alias("longest_delay"),
    )


@query
def stream_checked_bookings(spark, d):
    """Fit bookings and rejects of one stream, read once and written under one batch number."""
    path = workspace(spark, "checked")
    bookings = stream_replay.booking_feed(Replay(spark, d).booking_headers(), f"{path}/bookings")
    marked = tag_rejects(whole_bookings(bookings), booking_problems())
    output = F.when(F.col(REASON).isNull(), "fit").otherwise("rejected")
    sinks.run_to_end(split.split_stream(marked, output, f"{path}/rows", f"{path}/checkpoint"))
    fit = split.read_output(spark, f"{path}/rows", "fit").select("booking_id", F.lit("fit").alias(REASON))
    return fit.union(split.read_output(spark, f"{path}/rows", "rejected").select("booking_id", REASON))


@query
def stream_running_success(spark, d):
    path = workspace(spark, "running-success")
    counts = jobs.running_success(stream_replay.payment_feed(Replay(spark, d).payments(), f"{path}/payments"))
    sinks.run_to_end(sinks.change_stream(counts, f"{path}/data", f"{path}/checkpoint"))
    return sinks.latest(spark, f"{path}/data", [])


@query
def stream_rejected_bookings(spark, d):
    """The dead letters of the booking stream."""
    path = workspace(spark, "rejected-bookings")
    bookings = stream_replay.booking_feed(Replay(spark, d).booking_headers(), f"{path}/bookings")
    bad = rejected(whole_bookings(bookings), booking_problems())
    sinks.run_to_end(sinks.append_stream(bad, f"{path}/data", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/data").select("booking_id", REASON)


@query
def stream_events_click_purchase(spark, d):
    path = workspace(spark, "click-purchase")
    pairs = _click_purchase(stream_replay.stream_table(spark, d, "events").withWatermark("ts", "1 minute"))
    sinks.run_to_end(sinks.append_stream(pairs, f"{path}/data", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/data")


# --- shapes -----------------------------------------------------------------


def _base_prices(spark, d) -> DataFrame:
    """A base price, event type and section per line item; one section is unknown, one missing, one event type unknown."""
    sections = ["VIP", "Premium", "Gold", "Recliner", "Standard", "Silver", "Economy", "Bronze", "Balcony"]
    kinds = F.array(*map(F.lit, ["Concert", "Play", "Movie", "Sports", "Fair"]))
    return replay.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("line"),
        F.try_element_at(F.array(*map(F.lit, sections)), (F.col("l_partkey") % 10 + 1).cast("int")).alias("seat_section"),
        F.element_at(kinds, (F.col("l_orderkey") % 5 + 1).cast("int")).alias("event_type"),
        (F.col("l_extendedprice") / 40).alias("base_price"),
    )


def _partials(spark, d) -> str:
    """The fact and its sums per day, from three batches; an order's rows come in one of them."""
    home = workspace(spark, "partials")
    source = Replay(spark, d)
    pairs = booking_pairs(source.nested_bookings(), source.payments())
    part = F.pmod(F.xxhash64("order_id"), F.lit(3)).cast("int")
    pairs.withColumn("part", part).write.partitionBy("part").parquet(f"{home}-staged")
    staged = spark.read.parquet(f"{home}-staged")
    for batch in range(3):
        rows, _ = split_required(fact_of_pairs(staged.filter(F.col("part") == batch).drop("part")))
        partials.absorb(rows, home, batch)
    return home


def _colocated(spark, d) -> tuple[str, str]:
    tables.create_database(spark)
    mark = workspace(spark, "colocated").rsplit("-", 1)[-1]
    names = (f"{tables.DATABASE}.bookings_{mark}", f"{tables.DATABASE}.payments_{mark}")
    source = Replay(spark, d)
    colocated.store_by_order(with_seats(validate_bookings(source.nested_bookings())), names[0], 16)
    colocated.store_by_order(validate_payments(source.payments()), names[1], 16)
    return names


def _stream_fact(spark, d) -> DataFrame:
    return tables.read_fact(spark, _stream_fact_path(spark, d))


def _stream_fact_path(spark, d) -> str:
    """Events as stored JSON records, joined as streams into a stored fact table.

    The feeds come in slices of arrival time, a batch each, so that the
    watermark moves and the join state stays a part of the input.
    """
    path = workspace(spark, "stream-fact")
    rows = tables.tagged(jobs.streaming_fact(*_feeds(spark, d, path)))
    sinks.run_to_end(sinks.append_stream(rows, f"{path}/fact", f"{path}/checkpoint", partition_by=[REASON]))
    return f"{path}/fact"


def _feeds(spark, d, path) -> tuple[DataFrame, DataFrame]:
    source = Replay(spark, d)
    return stream_replay.sliced_feeds(source.nested_bookings(), source.payments(), path)


def _stream_windows(spark, d, slide) -> DataFrame:
    """The stored fact as a stream, summed per window; the newest state of each window counts."""
    path = workspace(spark, "stream-windows")
    stored = _stream_fact_path(spark, d)
    layout = T.StructType([*FACT_SCHEMA.fields, T.StructField(REASON, T.StringType())])
    rows = spark.readStream.schema(layout).parquet(stored).filter(F.col(REASON) == tables.FIT)
    windows = trends.windowed_revenue(rows.withWatermark("booking_time", "1 minute"), "10 minutes", slide)
    sinks.run_to_end(sinks.change_stream(windows, f"{path}/windows", f"{path}/checkpoint"))
    return _window_epochs(sinks.latest(spark, f"{path}/windows", ["window_start", "window_end"]))


def _windows_after_join(spark, d, slide) -> DataFrame:
    path = workspace(spark, "windows-after-join")
    windows = jobs.windowed_after_join(*_feeds(spark, d, path), slide=slide)
    sinks.run_to_end(sinks.append_stream(windows, f"{path}/windows", f"{path}/checkpoint"))
    return _window_epochs(spark.read.parquet(f"{path}/windows"))


def _click_purchase(rows: DataFrame) -> DataFrame:
    clicks = rows.filter(F.col("event_type") == "click").select(
        "user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("click_time")
    )
    purchases = rows.filter(F.col("event_type") == "purchase").select(
        "user_id",
        F.col("event_id").alias("purchase_id"),
        F.col("ts").alias("purchase_time"),
        F.col("value").alias("purchase_value"),
    )
    pairs = interval_join(clicks, purchases, "user_id", "click_time", "purchase_time", upper=CLICK_WINDOW)
    return pairs.select(
        "user_id",
        "click_id",
        "purchase_id",
        (F.unix_micros("purchase_time") - F.unix_micros("click_time")).alias("gap_us"),
        F.round("purchase_value", 2).alias("purchase_value"),
    )


def _booking_text(bookings: DataFrame) -> DataFrame:
    return bookings.select(
        *[c for c in bookings.columns if c not in ("seats", "booking_time", "booking_enqueued_time", "event_rating", PART)],
        F.date_format("booking_time", SECONDS).alias("booking_time"),
        F.round("event_rating", 1).alias("event_rating"),
        F.unix_seconds("booking_enqueued_time").alias("arrival_epoch"),
    )


def _seat_columns(seats: DataFrame) -> DataFrame:
    return seats.select(
        "order_id",
        "booking_id",
        "customer_id",
        "customer_city",
        "event_category",
        "seat_number",
        "seat_section",
        "seat_price",
        "seat_tier",
        "total_seats_booked",
        "booking_amount",
        "booking_platform",
    )


def _payment_text(payments: DataFrame) -> DataFrame:
    money = ("base_amount", "gst_amount", "convenience_fee", "total_amount")
    return (
        rounded(payments, **{c: 2 for c in money})
        .withColumn("payment_time", F.date_format("payment_time", SECONDS))
        .withColumn("arrival_epoch", F.unix_seconds("payment_enqueued_time"))
        .drop("payment_enqueued_time")
    )


def _fact_text(rows: DataFrame) -> DataFrame:
    money = ("base_amount", "gst_amount", "convenience_fee", "total_amount", "fees_and_taxes")
    times = ("booking_time", "payment_time", "created_at")
    return rounded(rows, event_rating=1, **{c: 2 for c in money}).withColumns(
        {c: F.date_format(c, SECONDS) for c in times}
    )


def _pair_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "order_id", "payment_id", "seat_number", "seat_section", "seat_price", "seconds_between_events", "alert_category"
    )


def _summary(rows: DataFrame) -> DataFrame:
    return rounded(rows, total_revenue=2, avg_transaction_value=4, success_rate=4)


def _weekly(row: DataFrame) -> DataFrame:
    money = ("total_revenue", "music_revenue", "cinema_revenue", "sports_revenue")
    return rounded(row, avg_transaction_value=4, success_rate_pct=4, **{c: 2 for c in money})


def _segment(rows: DataFrame) -> DataFrame:
    return rounded(rows, revenue=2, avg_value=4)


def _window_epochs(rows: DataFrame) -> DataFrame:
    return rounded(rows, revenue=2).withColumns(
        {c: F.unix_seconds(c) for c in ("window_start", "window_end")}
    )


def _payload(spark, d) -> DataFrame:
    return report.report_payload(kpis.weekly_kpis(fact(spark, d, 7), AS_OF), AS_OF)
