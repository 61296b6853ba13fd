"""One place where a query key, its Spark plan and its check SQL meet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tramline.bindings import with_bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, root)`` under ``key``.

    ``sql`` may name any derived relation of ``tramline.bindings``; the needed
    CTEs are put in front of it.
    """

    def add(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_bindings(sql)
        return fn

    return add
