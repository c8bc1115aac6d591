"""Every registered query against its DuckDB oracle at sf0.01, and the
driver entry point on sf0.001."""

import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck

from tests.conftest import SF01

from tierflow.plans.registry import QUERIES
import tierflow_oracle

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(tierflow_oracle.SQL) == set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF01, con)
    assert r["values_match"], r


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["session_id", "user_id", "page", "event_type", "event_date_key", "events_count"]
