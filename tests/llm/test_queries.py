"""Queries of the operators for training data beside their SQL over the small tables."""

import os

import pytest

from corpusloom.llm.queries import QUERIES
from tests.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_same_as_sql(spark, con, name):
    run, sql = QUERIES[name]
    got, want = compare(spark, con, FOLDER, run, sql)
    assert got == want
