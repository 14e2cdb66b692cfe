"""Every registered query against its SQL twin, on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_names():
    assert set(ORACLE) <= set(QUERIES)
    corpus = {name for name in QUERIES if re.match(r"op\d+_|pipeline$", name)}  # checked by tests of their own
    assert set(QUERIES) - set(ORACLE) - corpus == {"score_model"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
