"""Fact table, view and stored layout."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from seatledger.operators.quality import REASON, split_required
from seatledger.plans import kpis
from seatledger.registry import fact, queries
from seatledger.schemas import FACT_COLUMNS
from seatledger.sources import tables
from seatledger.sources.events import by_order
from seatledger.sources.workspace import workspace

AS_OF = dt.datetime(2001, 8, 1)


@pytest.fixture(scope="module")
def stored(spark, sf):
    """The table, created twice over to show that it can be."""
    tables.create_database(spark)
    tables.create_database(spark)
    good, _ = split_required(fact(spark, sf))
    for _ in range(2):
        tables.recreate_fact_table(spark)
    # columns in another order: they are matched by name
    tables.append_fact(good.select(*reversed(FACT_COLUMNS)))
    return good


def test_table_holds_the_rows(spark, stored):
    kept = tables.read_fact(spark, "ticketing.bookings_fact")
    assert kept.columns == [*FACT_COLUMNS, "booking_date"]
    kept = kept.select(*FACT_COLUMNS)
    assert kept.exceptAll(stored).count() == 0 and stored.exceptAll(kept).count() == 0
    assert kept.filter(F.col("event_id").isNull()).count() == 0


def test_reports_open_recent_days_only(spark, stored):
    recent = kpis.last_days(tables.read_fact(spark, "ticketing.bookings_fact"), 7, AS_OF)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(booking_date" in plan and "PushedFilters: [IsNotNull(booking_time)" in plan
    assert recent.exceptAll(recent.filter(F.col("booking_time") >= "2001-07-25")).count() == 0


def test_view(spark, stored):
    for _ in range(2):
        tables.create_revenue_view(spark, as_of=AS_OF)
    view = tables.run_sql(spark, "SELECT * FROM ticketing.v_revenue_summary")
    expected = kpis.revenue_summary(tables.read_fact(spark, "ticketing.bookings_fact"), AS_OF)
    places = {"total_revenue": F.round("total_revenue", 2), "avg_transaction_value": F.round("avg_transaction_value", 4),
              "success_rate": F.round("success_rate", 4)}
    a, b = view.withColumns(places), expected.withColumns(places)
    assert a.columns == b.columns and a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert "PartitionFilters: [isnotnull(booking_date" in view._jdf.queryExecution().executedPlan().toString()
    tables.create_revenue_view(spark)
    assert spark.read.table("ticketing.v_revenue_summary").count() == 0  # nothing in the last 30 days


def test_sql_with_values(spark, stored):
    df = tables.run_sql(
        spark, "SELECT count(*) AS n FROM ticketing.bookings_fact WHERE payment_status = :status", status="Failed"
    )
    assert df.first().n == stored.filter("payment_status = 'Failed'").count()


def test_checked_write(spark, sf):
    path = workspace(spark, "checked")
    rows = fact(spark, sf)
    tables.write_checked(rows, path)
    good, bad = tables.read_fact(spark, path), tables.read_rejects(spark, path)
    assert bad.count() > 0 and good.count() + bad.count() == rows.count()
    assert good.filter("event_id IS NULL").count() == 0 and REASON not in good.columns


def test_writes_refuse_rows_without_a_required_value(spark, sf, stored):
    rows = fact(spark, sf)
    assert rows.filter("event_id IS NULL").count() > 0
    with pytest.raises(Exception, match="event_id must not be null"):
        tables.write_fact(rows, workspace(spark, "refused"))
    with pytest.raises(Exception, match="event_id must not be null"):
        tables.append_fact(rows)


def test_names_are_checked():
    with pytest.raises(ValueError):
        tables._name("a; DROP TABLE b")


def test_workspace_needs_a_shared_folder_on_a_cluster(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://somewhere"
            getConf = staticmethod(lambda: Cluster.conf)

    with pytest.raises(RuntimeError):
        workspace(Cluster, "x")
    assert workspace(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_by_order_places_an_order_together(spark, sf):
    placed = by_order(queries()["payment_type"](spark, sf).withColumn("order_id", F.substring("payment_id", 1, 14)), 4)
    placed = placed.withColumn("place", F.spark_partition_id())
    per_order = placed.groupBy("order_id").agg(F.count_distinct("place").alias("places"))
    assert per_order.filter("places > 1").count() == 0
