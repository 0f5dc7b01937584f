"""Every query of the core beside its SQL over the small tables."""

import os

import pytest

from corpusloom.plans.registry import CORE
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", [n for n, (_, sql) in CORE.items() if sql])
def test_same_as_sql(spark, con, name):
    run, sql = CORE[name]
    got, want = compare(spark, con, FOLDER, run, sql)
    assert got == want


@pytest.mark.parametrize("name", [n for n, (_, sql) in CORE.items() if not sql])
def test_runs(spark, name):
    assert CORE[name][0](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
