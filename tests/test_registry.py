"""Every registered query against its SQL on the smallest generated tables."""

import os

import pytest

import __spark_entry__ as contract
from ambertill.registered import ORACLES, QUERIES
from conftest import plan_of
from oracle_check import canonical, connection

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")


@pytest.fixture(scope="module")
def tables():
    return connection(FOLDER)


def test_entry(spark):
    assert contract.entry(spark).count() == 25


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, tables, name):
    df = contract.queries()[name](spark, FOLDER)
    expected = tables.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    # Built-in expressions only: nothing leaves the JVM.
    assert not any(w in plan_of(df) for w in ("ArrowEval", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "PythonUDF"))
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(expected.fetchall(), columns)
