"""Where queries register themselves with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from screenloom.plans.fixtures import fixture, with_fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of fixtures: its parameter names are the fixtures that it takes."""

    def register(f):
        names = f.__code__.co_varnames[: f.__code__.co_argcount]

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*[fixture(spark, sf_dir, n) for n in names])

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_fixtures(sql)
        return f

    return register
