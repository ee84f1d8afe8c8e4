"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from opspark.plans import catalogue
from tests.conftest import SF
from tools.check import compare, database

QUERIES, ORACLES = catalogue.QUERIES, catalogue.ORACLES


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        cur = con.execute(ORACLES[name])
        cols = [d[0] for d in cur.description]
        assert compare(df.columns, rows, cols, cur.fetchall()) is None
    else:
        assert rows


def test_entry_is_lazy_and_stable(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["sensor_id", "window_start", "window_end"]
    assert df.count() > 0


def test_names_and_oracles():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())
