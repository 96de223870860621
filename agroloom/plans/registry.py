"""Named queries over the given tables, each with SQL for the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of :class:`Tables` under its name."""

    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Tables(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = with_views(sql)
        return build

    return register
