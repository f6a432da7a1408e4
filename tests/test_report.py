"""The report payload."""

import datetime as dt
import json

import pytest

from seatledger.plans import report

AS_OF = dt.datetime(2026, 9, 12, 18, 30, 10)
SCHEMA = """period string, total_transactions long, total_revenue double, avg_transaction_value double,
unique_customers long, success_rate_pct double, music_revenue double, cinema_revenue double, sports_revenue double,
mobile_bookings long, website_bookings long, top_city string, anomaly_count long, avg_processing_time_ms int"""
WEEK = ("Last 7 Days", 52, 81857.97, 1574.192, 40, 96.35, 100.0, 50000.5, 100.0, 20, 30, "Pune", 3, 812)


def payload(spark, row):
    return report.report_payload(spark.createDataFrame([row], SCHEMA), AS_OF)


def test_golden_payload(spark):
    row = payload(spark, WEEK).first().asDict(recursive=True)
    assert row == {
        "period": "Last 7 Days",
        "generated_at": "12/9/2026, 6:30:10 pm",
        "metrics": {
            "total_revenue": "₹81,857.97",
            "total_transactions": 52,
            "avg_transaction_value": "₹1,574.19",
            "unique_customers": 40,
            "success_rate_pct": "96.3%",  # the stored 96.35 lies below the tie
            "top_city": "Pune",
            "anomalies": 3,
            "avg_processing_time_ms": 812,
        },
        "highlights": {"top_category": "Cinema (₹50,000.5)", "top_platform": "Website (60%)"},
    }


def test_empty_week(spark):
    row = payload(spark, (None, 0) + (None,) * 12).first().asDict(recursive=True)
    assert row["period"] == "Last 7 Days"
    assert row["metrics"]["total_revenue"] == "₹0" and row["metrics"]["success_rate_pct"] == "0.0%"
    assert row["metrics"]["top_city"] is None
    assert row["highlights"] == {"top_category": "Music (₹0)", "top_platform": "Mobile App (NaN%)"}


@pytest.mark.parametrize(
    "music, cinema, sports, expected",
    [(5.0, 5.0, 5.0, "Music"), (1.0, 5.0, 5.0, "Cinema"), (1.0, 2.0, 5.0, "Sports"), (None, -1.0, None, "Music")],
)
def test_ties(spark, music, cinema, sports, expected):
    row = list(WEEK)
    row[6:9] = music, cinema, sports
    df = spark.createDataFrame([tuple(row)], SCHEMA)
    assert report.report_payload(df, AS_OF).first().highlights.top_category.startswith(expected)
    assert report.category_ranking(df).first().category == expected


def test_mobile_wins_a_tie(spark):
    row = list(WEEK)
    row[9:11] = 1, 1
    assert payload(spark, tuple(row)).first().highlights.top_platform == "Mobile App (50%)"


def test_metric_lines(spark):
    lines = report.metric_lines(payload(spark, WEEK)).orderBy("line").collect()
    assert [r.metric for r in lines] == [label for label, _ in report.METRIC_LINES]
    assert lines[0].value == "₹81,857.97" and lines[5].value == "Pune" and len(lines) == 8


def test_prompt_holds_the_payload(spark):
    row = report.prompt_text(payload(spark, (None, 0) + (None,) * 12)).first()
    assert json.loads(row.payload_json)["metrics"]["top_city"] is None
    assert row.payload_json.startswith('{\n  "period": "Last 7 Days",\n') and row.payload_json in row.prompt
    assert "12/9/2026, 6:30:10 pm" in row.prompt and "{payload}" not in row.prompt


def test_checked_outputs(spark):
    texts = [
        ('{"subject": "s", "html": "<p>"}', True),
        ('{"subject": "s", "html": "<p>", "preheader": "x"}', True),
        ('{"subject": "s"}', False),
        ('{"html": "<p>", "subject": null}', False),
        ("```json", False),
        (None, False),
        ('{"subject": 5, "html": {"x": 1}}', False),
        ('{"subject": "a", "html": "b", "preheader": 7}', False),
        ('{"subject": "a", "html": "b"} and more', False),
        ('{"subject": "a", "html": "b"}, {}', False),
    ]
    df = spark.createDataFrame(texts, "text string, expected boolean")
    for row in report.checked_outputs(df, "text").collect():
        assert row.accepted == row.expected, row
