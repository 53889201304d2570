"""Every registered query against its SQL at the smallest scale."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import SMALL, entry, oracle_sql, queries  # noqa: E402
from tools.check import compare, connect, without_sql  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="supplied tables are missing")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    problem, _, _ = compare(spark, con, SMALL, queries()[name], oracle_sql().get(name))
    assert problem is None, problem


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_queries_without_sql_are_listed():
    assert [name for name in queries() if name not in oracle_sql() and not without_sql(name)] == []


def test_oracles_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
