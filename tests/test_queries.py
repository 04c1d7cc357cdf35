"""Every registered query against its SQL at the smallest scale."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    if name in ORACLES:
        assert difference(spark, db, SF, QUERIES[name], ORACLES[name]) is None
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_names_and_entry(spark):
    assert set(ORACLES) <= set(QUERIES)
    assert entry_module.entry(spark).count() == 183
