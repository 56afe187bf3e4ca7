"""Every bound query against its SQL on the smallest tables, and the driver's contract."""

import os

import pytest

from __spark_entry__ import SMOKE_FOLDER, entry, oracle_sql, queries
from bindings import BINDINGS
from tests.oracle_check import difference, duck

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_FOLDER)


@pytest.mark.parametrize("name", sorted(BINDINGS))
def test_query_equals_its_sql(spark, con, name):
    df = queries()[name](spark, SMOKE_FOLDER)
    if name in oracle_sql():
        assert difference(df, con, oracle_sql()[name]) is None
    else:
        assert df.count() > 0


def test_every_query_has_sql():
    assert set(BINDINGS) <= set(queries()) and set(BINDINGS) <= set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["fact", "item", "value", "low", "high", "verdict"] and df.count() > 10
