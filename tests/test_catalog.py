"""Every registered query against its SQL on the sample tables."""

import checks
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return checks.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, name):
    checks.compare(QUERIES[name](spark, FOLDER), connection, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_flagship(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["date", "geo_tension_index", "total_events", "dominant_category"]
    assert frame.count() > 0
