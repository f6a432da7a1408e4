"""Every registered query against its SQL oracle on the smallest tables."""

import compare
import pytest
from samples import SF

from seatledger import oracles, registry

ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(registry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, name):
    assert compare.difference(registry.queries()[name](spark, SF), con, ORACLES[name]) is None


@pytest.mark.parametrize(
    "name, columns",
    [
        ("fee_audit_faults", ["gst_amount_mismatches", "convenience_fee_mismatches", "service_fee_mismatches", "total_amount_mismatches"]),
        ("text_lengths_faults", ["too_long"]),
        ("base_price_report", ["below_range", "above_range"]),
        ("duration_report", ["other_duration"]),
    ],
)
def test_faults_are_found(con, name, columns):
    """The other engine's result, which the queries equal, has faults of every kind and rows without."""
    for column in columns:
        ((found, rows),) = con.sql(f"SELECT sum({column}), count(*) FROM ({ORACLES[name]})").fetchall()
        assert found > 0 and rows > 1


def test_both_kinds_of_wrong_totals_are_found(con):
    rows = dict(con.sql(f"SELECT amount_differs::INT * 2 + seats_differ::INT, count(*) FROM ({ORACLES['booking_totals_faults']}) GROUP BY 1").fetchall())
    assert set(rows) == {0, 1, 2, 3} and min(rows.values()) > 50
