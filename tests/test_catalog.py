"""Every catalogue query against its SQL twin, on whole tables."""

import pytest
from compare import differences, duck

from __spark_entry__ import entry, oracle_sql, queries
from dispatchlake.plans.catalog import QUERIES as CATALOGUE

ORACLE = oracle_sql()
QUERIES = {n: q for n, q in queries().items() if n in ORACLE}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_twin():
    assert set(CATALOGUE) <= set(ORACLE) <= set(queries())


def test_entry_gives_daily_fulfillment(spark):
    df = entry(spark)
    assert df.columns[0] == "event_date" and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []
