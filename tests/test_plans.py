"""What the plans must and must not hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seatledger.plans import kpis, trends
from seatledger.plans.fact import payment_grain
from seatledger.registry import queries
from seatledger.schemas import FACT_SCHEMA

AS_OF = dt.datetime(2001, 8, 1)
STREAMS = {n for n in queries() if n.startswith("stream_")} | {"stored_fact_weekly_kpis", "stored_fact_rejects", "fact_table_lifecycle"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, *given):
    """Fact rows from dicts; other columns are null."""
    fields = [f.name for f in FACT_SCHEMA.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FACT_SCHEMA.fields)
    return spark.createDataFrame([tuple(g.get(c) for c in fields) for g in given], schema)


@pytest.mark.parametrize("name", sorted(set(queries()) - STREAMS))
def test_no_pair_joins_and_no_python(spark, sf, name):
    text = plan(queries()[name](spark, sf))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval", "MapInPandas"):
        assert word not in text


def test_narrow_scan(spark, sf):
    """A KPI over few columns reads few columns, and no seat or money column it does not need."""
    text = queries()["failure_reasons"](spark, sf)._jdf.queryExecution().executedPlan().treeString()
    assert "o_orderpriority" not in text and "l_returnflag" not in text and "o_custkey" not in text


@pytest.mark.parametrize("name", ["revenue_summary", "weekly_kpis", "top_city", "period_growth", "revenue_view", "prompt_text"])
def test_dated_reports_bound_the_scan(spark, sf, name):
    scans = [x for x in plan(queries()[name](spark, sf)).splitlines() if "FileScan" in x and "o_orderdate" in x]
    assert scans and all("GreaterThanOrEqual(o_orderdate" in x for x in scans)


@pytest.mark.parametrize(
    "name",
    "payment_type payment_volume failure_reasons method_performance gateway_sla method_conformance_report"
    " method_distribution event_category".split(),
)
def test_no_line_items_where_no_amount_is_read(spark, sf, name):
    assert "lineitem" not in plan(queries()[name](spark, sf))


def test_weekly_over_nothing_is_one_row(spark):
    row = kpis.weekly_kpis(rows(spark), AS_OF).first()
    assert row.period == "Last 7 Days" and row.total_transactions == 0 and row.unique_customers == 0
    assert row.total_revenue is None and row.success_rate_pct is None and row.top_city is None
    assert row.mobile_bookings is None and row.avg_processing_time_ms is None


def test_weekly_details(spark):
    day = AS_OF - dt.timedelta(days=7)
    base = {"booking_time": day, "payment_status": "Success", "alert_category": "Normal", "event_category": "Standard"}
    fact = rows(
        spark,
        base | {"customer_id": "a", "customer_city": "Pune", "total_amount": 10.0, "processing_time_ms": 1},
        base | {"customer_id": "a", "customer_city": "Agra", "total_amount": 10.0, "processing_time_ms": 2},
        base | {"customer_id": None, "customer_city": None, "total_amount": 99.0, "processing_time_ms": 2},
        base | {"customer_id": "b", "customer_city": "Zzz", "total_amount": None, "alert_category": None},
        base | {"customer_id": "c", "customer_city": "Old", "booking_time": day - dt.timedelta(seconds=1)},
    )
    row = kpis.weekly_kpis(fact, AS_OF).first()
    assert (row.total_transactions, row.total_revenue, row.unique_customers) == (4, 119.0, 2)
    assert row.top_city == "Agra"  # tie with Pune; the row without a city is left out
    assert row.avg_transaction_value == pytest.approx(119 / 3)
    assert row.avg_processing_time_ms == 1  # 5 / 3 cut
    assert row.anomaly_count == 0 and row.success_rate_pct == 100.0
    assert kpis.weekly_kpis(fact, AS_OF, whole_ms=False).first().avg_processing_time_ms == pytest.approx(5 / 3)
    assert kpis.top_city(fact.filter("customer_city <> 'Zzz'")).first().customer_city == "Agra"


def test_weekly_reads_the_fact_once(spark, sf):
    text = plan(kpis.weekly_kpis(rows(spark), AS_OF))
    assert text.count("LocalTableScan") + text.count("Scan ExistingRDD") <= 1 and "Subquery" not in text


def test_growth(spark):
    def at(days, amount):
        return {"booking_time": AS_OF - dt.timedelta(days=days), "total_amount": amount}

    row = trends.period_growth(rows(spark, at(1, 30.0), at(7, 30.0), at(8, 40.0), at(14, 10.0), at(15, 99.0)), AS_OF).first()
    assert (row.current_revenue, row.previous_revenue, row.growth_pct) == (60.0, 50.0, 20.0)
    row = trends.period_growth(rows(spark, at(1, 30.0)), AS_OF).first()
    assert (row.previous_revenue, row.growth_pct) == (0.0, None)


def test_windows(spark):
    def at(minute, amount):
        return {"booking_time": dt.datetime(2001, 8, 1, 0, minute), "total_amount": amount}

    fact = rows(spark, at(1, 1.0), at(9, 2.0), at(10, 4.0))
    assert [r.revenue for r in trends.windowed_revenue(fact).orderBy("window_start").collect()] == [3.0, 4.0]
    sliding = trends.windowed_revenue(fact, "10 minutes", "5 minutes").orderBy("window_start").collect()
    assert [r.revenue for r in sliding] == [1.0, 3.0, 6.0, 4.0]
    trend = trends.revenue_trend(fact, "10 minutes").orderBy("window_start").collect()
    assert [(r.previous_revenue, r.change) for r in trend] == [(None, None), (3.0, 1.0)]


def test_payment_grain(spark):
    base = {"payment_id": "p", "order_id": "o", "total_amount": 5.0}
    fact = rows(spark, base | {"seat_number": "1"}, base | {"seat_number": "2"}, base | {"payment_id": "q"})
    once = payment_grain(fact)
    assert once.count() == 2 and once.agg(F.sum("total_amount")).first()[0] == 10.0
    assert "seat_number" not in once.columns


def test_conversion_counts_each_booking_once(spark):
    bookings = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "order_id string")
    payments = spark.createDataFrame(
        [("a", "Failed"), ("a", "Success"), ("a", "Success"), ("b", "Failed"), ("z", "Success")],
        "order_id string, payment_status string",
    )
    assert tuple(kpis.conversion_rate(bookings, payments).first()) == (4, 2, 50.0)
