"""Named queries: a callable over the supplied tables and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyfield.session import configure, load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The supplied tables as attributes: ``t.orders``, ``t.lineitem``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load(self.spark, self.base, name)


def query(name: str, sql: str | None = None):
    """Register ``build(t: Tables) -> DataFrame`` under ``name`` with its oracle."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, base: str) -> DataFrame:
            return build(Tables(configure(spark), base))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
