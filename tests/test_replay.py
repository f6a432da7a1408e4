"""Events derived from the order tables: big orders stay bounded and whole."""

import duckdb
import pytest
from pyspark.sql import functions as F

from seatledger.functions.fees import with_tax_and_fees
from seatledger.operators.audits import booking_total_audit
from seatledger.operators.bookings import booking_problems, whole_bookings
from seatledger.operators.payments import validate_payments
from seatledger.operators.quality import REASON, rejected
from seatledger.plans import kpis
from seatledger.operators.bookings import flatten_seats, validate_bookings
from seatledger.plans.fact import booking_fact
from seatledger.registry import _fact_text, _seat_columns, queries
from seatledger.schemas import FACT_COLUMNS
from seatledger.sources.replay import Replay


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, sf):
    """The tables with a third of all lines in one order and a third of orders with one customer."""
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    moved = {
        "lineitem": "CASE WHEN l_suppkey % 3 = 0 THEN 1002 ELSE l_orderkey END AS l_orderkey",
        "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey",
        "events": "CASE WHEN event_id % 3 = 0 THEN 5 ELSE user_id END AS user_id",
    }
    for name in ("lineitem", "orders", "events", "customer", "nation"):
        columns = f"* REPLACE ({moved[name]})" if name in moved else "*"
        con.execute(f"COPY (SELECT {columns} FROM '{sf}/{name}.parquet') TO '{out}/{name}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize("max_seats", [1, 3, 1000])
def test_nested_bookings_hold_all_seats(spark, skewed, max_seats):
    source = Replay(spark, skewed)
    nested = source.nested_bookings(max_seats)
    flat = _seat_columns(flatten_seats(validate_bookings(source.seat_messages())))
    assert same(_seat_columns(flatten_seats(validate_bookings(nested))), flat)


@pytest.mark.parametrize("max_seats", [1, 2])
def test_booking_reports_do_not_depend_on_the_message_size(spark, sf, max_seats):
    source = Replay(spark, sf)
    one, many = source.nested_bookings(), source.nested_bookings(max_seats)
    assert many.count() > one.count()
    for report in (
        lambda b: kpis.booking_volume(validate_bookings(b)),
        lambda b: kpis.conversion_rate(validate_bookings(b), validate_payments(source.payments())),
        lambda b: rejected(whole_bookings(b), booking_problems()).select("booking_id", REASON),
        lambda b: with_tax_and_fees(whole_bookings(validate_bookings(b)), "booking_amount").drop("seats"),
        lambda b: booking_total_audit(b),
    ):
        assert same(report(one), report(many))


def test_arrays_are_bounded(spark, skewed):
    sizes = Replay(spark, skewed).nested_bookings(50).select(
        "booking_id", F.size("event_details.seats").alias("n"), F.col("event_details.total_seats").alias("all")
    )
    hot = sizes.filter("all > 1000").agg(F.count("*"), F.sum("n"), F.max("n"), F.max("all")).first()
    assert hot[0] > 20 and hot[1] == hot[3] and hot[2] < 150


def test_fact_is_the_same_from_arrays_and_from_messages(spark, sf):
    source = Replay(spark, sf)
    from_arrays = booking_fact(source.nested_bookings(), source.payments())
    from_messages = booking_fact(source.seat_messages(), source.payments())
    assert from_arrays.columns == FACT_COLUMNS
    assert same(_fact_text(from_arrays), _fact_text(from_messages))


@pytest.mark.parametrize(
    "name", ["booking_payment_join", "weekly_kpis", "events_click_purchase", "flattened_seats", "booking_totals_audit"]
)
def test_skewed_tables_agree_with_sql(spark, skewed, name):
    import compare

    from seatledger.oracles import oracle_sql

    con = compare.connect(skewed)
    assert compare.difference(queries()[name](spark, skewed), con, oracle_sql()[name]) is None


def test_valid_and_rejected_make_all(spark, sf):
    known = queries()
    valid, bad = (known[n](spark, sf).count() for n in ("validated_bookings", "rejected_bookings"))
    assert valid + bad == spark.read.parquet(f"{sf}/orders.parquet").count()


def test_category_sums_stay_below_the_total(spark, sf):
    row = queries()["weekly_kpis"](spark, sf).first()
    assert row.music_revenue + row.cinema_revenue + row.sports_revenue <= row.total_revenue + 0.01
    assert row.mobile_bookings + row.website_bookings <= row.total_transactions
