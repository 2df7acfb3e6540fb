"""Every checked query: a Spark function, and SQL giving the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.fixtures import CTES, SPARK, table, with_ctes
from patchloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
SQL_VIEWS: dict[str, str] = dict(CTES)


class Inputs:
    """Attribute access to the given tables and the shapes derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in SPARK:
            return SPARK[name](self.spark, self.sf_dir)
        return table(self.spark, self.sf_dir, name)


def view(name: str, sql: str) -> None:
    """Name a piece of SQL that several comparisons share."""
    SQL_VIEWS[name] = sql


def query(sql: str | None = None, *, recursive: bool = False):
    """Register ``fn(inputs) -> DataFrame`` with its SQL twin."""

    def add(fn):
        key = fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Inputs(tune(spark), sf_dir))

        QUERIES[key] = run
        if sql is not None:
            SQL[key] = with_ctes(sql, SQL_VIEWS, recursive)
        return fn

    return add
