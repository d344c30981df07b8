"""Every registered query of the library beside its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference
from registry.oracle import ORACLE
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= queries().items() and ORACLE.items() <= oracle_sql().items()
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, duck, name):
    rows = QUERIES[name](spark, sf).toPandas()
    assert difference(rows, duck.execute(ORACLE[name]).df()) is None
