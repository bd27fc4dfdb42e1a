"""Registered queries beside their SQL, and that they are registered."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect
from tillcast.llm.oracle import ORACLE_SQL
from tillcast.llm.queries import QUERIES

from conftest_llm import SF


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF, name, QUERIES[name], ORACLE_SQL[name]) is None
