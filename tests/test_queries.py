"""Every registered query against its SQL twin, and the driver contract."""

import inspect

import pytest

import __spark_entry__ as entry_point
from checks import compare

entry_point.checks.load()
QUERIES, SQL = dict(entry_point.QUERIES), dict(entry_point.SQL)


@pytest.fixture(scope="module")
def con(small):
    return compare.connect(small)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, con, name):
    df = QUERIES[name](spark, small)
    ours = df.toPandas()
    rel = con.sql(SQL[name])
    assert compare.difference(ours, rel.df()) is None
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: compare.SAME_KIND.get(k) for c, k in compare.spark_kinds(df).items()} == kinds


def test_entry(spark, small):
    df = entry_point.entry(spark)
    assert df.columns == ["task_id", "completions", "mean_reward", "best_advantage"]
    assert df.count() > 0


def test_entry_is_lazy():
    assert "collect(" not in inspect.getsource(entry_point)
