"""Every query with a SQL twin gives the same rows in both engines."""

import pytest
from oracle_check import compare, connect

from panelcast.plans import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    verdict, _ = compare(con, catalog.QUERIES[name](spark, sf_dir), catalog.ORACLES[name])
    assert verdict == "ok"


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 6
    assert set(e.oracle_sql()) <= set(e.queries())
