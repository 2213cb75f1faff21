"""Every registered query that has SQL gives the rows DuckDB gives; the others run."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from plumbline.plans.catalog import ORACLE, QUERIES
from tools.check import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf, con, name):
    assert compare(con, QUERIES[name](spark, sf).toPandas(), ORACLE[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0


def test_names():
    assert set(ORACLE) <= set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())
