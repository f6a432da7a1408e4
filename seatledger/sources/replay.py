"""Booking and payment events replayed from stored orders.

The rules are plain arithmetic on the order tables (see FIXTURES.md): the same
tables always give the same events, without a clock or random numbers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import zero_padded
from ..functions.times import iso_utc

AS_OF = dt.datetime(2001, 8, 1)
# FIXTURES.md gives these numbers; the fee rules under test have their own.
GST_RATE, CONVENIENCE_RATE, CONVENIENCE_MIN, SERVICE_FEE, FEE_CURRENCY = 0.18, 0.025, 20.0, 15.0, "INR"
MAX_SEATS = 1000

# Fixed values.
AGE_GROUPS = ["18-25", "26-35", "36-50", "50+"]
METHODS = ["Credit Card", "Debit Card", "UPI", "Net Banking", "Wallet", "PayPal"]
PROVIDERS = ["Razorpay", "PayU", "PhonePe", "HDFC Bank", "Paytm", "PayPal"]
FAILURES = [
    "No cover on the account",
    "Issuer said no",
    "Gateway did not answer",
    "Details do not match",
    "Over the day's limit",
    "Extra check failed",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table; times without a zone are taken as UTC."""
    return utc_times(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def utc_times(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def seat_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One seat per line item."""
    price = F.when(F.col("l_linenumber") == 7, 0.0).otherwise(2.0 * F.floor(F.col("l_extendedprice") / 400))
    number = F.when(
        F.col("l_partkey") % 50 != 0,
        F.concat("l_returnflag", F.lit("-"), (F.col("l_partkey") % 100 + 1).cast("string")),
    )
    section = (
        F.when(F.col("l_returnflag") == "A", "VIP").when(F.col("l_returnflag") == "R", "Premium").otherwise("Standard")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        number.alias("seat_number"),
        section.alias("seat_section"),
        price.cast("double").alias("price"),
    )


def seat_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("k").agg(
        F.sum("price").alias("seat_sum"), F.count("*").cast("int").alias("seat_count")
    )


def orders_with_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Orders, each with its seat totals (null without lines).

    One row per order on both sides, so no order is heavier than another.  The
    totals are unique by order: where none of them is read, the optimizer drops
    this join and the line items with it.
    """
    slim = orders.select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    return slim.join(seat_totals(lines), "k", "left").withColumn("booked", _booked())


class Replay:
    """Events replayed from the tables in a folder; each table is opened once.

    ``since`` leaves out orders that cannot have events from then on: a booking
    is less than a day after its order date.  The bound reaches the scan of the
    orders, and only line items of the orders left are moved.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, since: dt.datetime | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.lines = seat_lines(spark, sf_dir)
        orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
        if since is not None:
            first = since - dt.timedelta(days=1)
            orders = orders.filter(F.col("o_orderdate") >= F.expr(f"TIMESTAMP_NTZ '{first:%Y-%m-%d %H:%M:%S}'"))
            wanted = orders.select(F.col("o_orderkey").alias("k"))
            self.lines = self.lines.join(wanted, "k", "left_semi")
        self.orders = orders_with_totals(utc_times(orders), self.lines)

    def payments(self) -> DataFrame:
        return payments_of(self.orders)

    def booking_headers(self) -> DataFrame:
        """One booking event per order, without its seats: for reports on whole bookings."""
        return bookings_of(self._with_customers(), _no_seats(), F.lit(0))

    def seat_messages(self) -> DataFrame:
        """One booking event per line item, holding its seat and the order's totals.

        Seat reports unpack the seats at once, so collecting them into arrays
        first would only add a shuffle.  A very big order stays spread over
        tasks: the join is an inner merge, whose big partitions adaptive
        execution can split.  The messages have no part number; count bookings
        on ``booking_headers`` or ``nested_bookings``.
        """
        rows = self._with_customers().join(self.lines.hint("merge"), "k")
        return bookings_of(rows, F.array(_seat()), F.lit(None))

    def nested_bookings(self, max_seats: int = MAX_SEATS) -> DataFrame:
        """One booking event per order with all its seats in an array.

        Orders above ``max_seats`` come as several messages with part numbers
        from 0, each with the totals of the whole order.  Lines are dealt to the
        parts by lot, so an array holds ``max_seats`` on average and does not
        grow with the order; a part may be empty.  Reports on bookings count
        part 0 (``whole_bookings``), so they do not depend on ``max_seats``.
        Lines get their lot at the scan, the table of big orders tells into how
        many parts they go, and they are moved by order and part.  That table is
        put behind a shuffle of its own, so adaptive execution sees its true
        size and may broadcast it only then.
        """
        # The scan's partitions are the same on a retry, so seeded numbers repeat.
        lines = self.lines.withColumn("draw", F.floor(F.rand(seed=17) * 2**31).cast("long"))
        parts = F.ceil(F.col("seat_count") / max_seats).alias("parts")
        big = seat_totals(self.lines).select("k", parts).filter(F.col("parts") > 1).hint("rebalance")
        part = (F.col("draw") % F.coalesce("parts", F.lit(1))).cast("int")
        dealt = lines.join(big, "k", "left").withColumn("part", part)
        arrays = (
            dealt.repartition("k", "part")
            .groupBy("k", "part")
            .agg(F.sort_array(F.collect_list(_seat())).alias("seats"))
        )
        last = F.greatest(F.ceil(F.coalesce("seat_count", F.lit(0)) / max_seats), F.lit(1)).cast("int") - 1
        headers = self._with_customers().withColumn("part", F.explode(F.sequence(F.lit(0), last)))
        return bookings_of(headers.join(arrays, ["k", "part"], "left"), F.col("seats"), F.col("part"))

    def _with_customers(self) -> DataFrame:
        """Orders with the customer's city.

        Customers grow with the data and are merged, not broadcast.  The rows
        are then placed by customer, so a later join by order moves both its
        sides itself, which adaptive skew handling needs.
        """
        customers = table(self.spark, self.sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_nationkey"
        )
        nations = table(self.spark, self.sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return self.orders.join(customers.join(nations, "c_nationkey").hint("merge"), "o_custkey")


def bookings_of(rows: DataFrame, seats: Column, part: Column) -> DataFrame:
    """Order rows (with totals and city) to booking events."""
    k, cust = F.col("k"), F.col("o_custkey")
    kind = F.when(k % 4 == 0, "Concert").when(k % 4 == 1, "Play").when(k % 4 == 2, "Movie").otherwise("Sports")
    name = (
        F.when(k % 211 == 0, F.lit(None))
        .when(k % 20 == 2, "Movie - Adjustable console")
        .when(k % 20 == 3, "Sports - Display matrix")
        .when(k % 20 == 7, "Gala - Open evening")
        .otherwise(F.concat(kind, F.lit(" - "), F.col("o_orderpriority")))
    )
    platform = F.when(k % 3 == 0, "Mobile App").when(k % 3 == 1, "Website").otherwise("Kiosk")
    promo = F.when(k % 3 == 1, "WEEKEND10").when(k % 3 == 2, "STUDENT20")
    person = cust.cast("string")
    return rows.select(
        F.when(k % 107 != 0, order_id(k)).alias("order_id"),
        zero_padded("booking_", k, 6).alias("booking_id"),
        F.when(k % 101 == 0, "not a time").otherwise(iso_utc("booked")).alias("booking_time"),
        part.cast("int").alias("message_part"),
        F.struct(
            F.when(cust % 103 != 0, F.concat(F.lit("cust"), person)).alias("customer_id"),
            F.concat(F.lit("Name "), person).alias("name"),
            F.concat(F.lit("cust"), person, F.lit("@example.com")).alias("email"),
            F.concat(F.lit("+91-"), person).alias("phone"),
            F.col("n_name").alias("city"),
            _pick(AGE_GROUPS, cust % 4).alias("age_group"),
        ).alias("customer"),
        F.struct(
            F.when(k % 223 != 0, zero_padded("event", k % 50 + 1, 3)).alias("event_id"),
            name.alias("event_name"),
            kind.alias("event_type"),
            F.lit("India").alias("event_location"),
            F.lit("Venue").alias("event_venue"),
            F.date_format(F.date_add("o_orderdate", 30), "yyyy-MM-dd").alias("event_date"),
            F.lit(2.5).alias("event_duration_hours"),
            (F.lit(4.0) + (k % 11) / 10).alias("event_rating"),
            seats.alias("seats"),
            F.coalesce("seat_count", F.lit(0)).alias("total_seats"),
        ).alias("event_details"),
        F.struct(
            F.when(k % 97 == 0, 0.0).otherwise(F.col("seat_sum")).alias("total_amount"),
            F.lit("INR").alias("currency"),
            platform.alias("booking_platform"),
            promo.alias("promo_code_applied"),
            F.lit("Organic").alias("booking_channel"),
        ).alias("booking_metadata"),
        _later(F.col("booked"), k % 30).alias("arrival_time"),
    )


def payments_of(orders: DataFrame) -> DataFrame:
    """Order rows (with totals) to their one or two payment attempts; some orders have none."""
    k, a = F.col("k"), F.col("a")
    attempts = F.when(k % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = orders.filter(k % 13 != 0).select("*", F.explode(attempts).alias("a"))
    base = (
        F.when(k % 241 == 0, F.col("seat_sum") * 10)
        .when(k % 5 == 0, 2.0 * F.floor(F.col("o_totalprice") / 400))
        .otherwise(F.col("seat_sum"))
    )
    gst = F.round(F.col("base") * GST_RATE, 2)
    fee = F.greatest(F.col("base") * CONVENIENCE_RATE, F.lit(CONVENIENCE_MIN))
    paid = _later(F.col("booked"), (k * 37) % 780 + 120 * a)
    failed = (k + a) % 25 == 0
    method = F.when(k % 199 == 0, F.lit(None)).when(k % 193 == 0, "Cash").otherwise(_pick(METHODS, k % 6))
    status = F.when(failed, "Failed").when(k % 251 == 0, "Pending").otherwise("Success")
    rows = rows.withColumn("base", base.cast("double")).withColumn("paid", paid)
    return rows.select(
        F.concat(zero_padded("payment_", k, 6), F.lit("_"), a.cast("string")).alias("payment_id"),
        zero_padded("TXN", 2 * k + a, 8).alias("transaction_id"),
        order_id(k).alias("order_id"),
        iso_utc("paid").alias("payment_time"),
        method.alias("payment_method"),
        _pick(PROVIDERS, k % 6).alias("payment_provider"),
        status.alias("payment_status"),
        F.struct(
            F.col("base").alias("base_amount"),
            gst.alias("gst_amount"),
            F.lit(GST_RATE).alias("gst_rate"),
            fee.alias("convenience_fee"),
            F.lit(SERVICE_FEE).alias("service_fee"),
            F.when(k % 157 != 0, F.round(F.col("base") + gst + fee + SERVICE_FEE, 2)).alias("total_amount"),
            F.lit(FEE_CURRENCY).alias("currency"),
        ).alias("amount"),
        F.struct(
            F.when(k % 151 != 0, 150 + (k * 13) % 3200).cast("int").alias("processing_time_ms"),
            F.concat(F.lit("Gateway"), (k % 3 + 1).cast("string")).alias("payment_gateway"),
            (k % 4 + 1).cast("int").alias("retry_attempt"),
            F.coalesce(method.isin("Credit Card", "Debit Card"), F.lit(False)).alias("3d_secure_enabled"),
        ).alias("processing_metadata"),
        F.when(failed, _pick(FAILURES, k % 6)).alias("failure_reason"),
        _later(F.col("paid"), k % 45).alias("arrival_time"),
    )


def order_id(k: Column) -> Column:
    return zero_padded("order_", k, 6)


def _booked() -> Column:
    return _later(F.col("o_orderdate"), (F.col("k") * 7919) % 86400)


def _later(time: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(time) + seconds)


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def _seat() -> Column:
    return F.struct("seat_number", "seat_section", "price")


def _no_seats() -> Column:
    return F.lit(None).cast("array<struct<seat_number string, seat_section string, price double>>")
