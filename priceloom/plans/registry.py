"""Where queries register themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from priceloom.views import PREFIX, Relations

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, prefix: bool = True):
    """Register ``f(relations)`` under ``name``; ``sql`` follows the relations' definitions unless ``prefix`` is off."""

    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Relations(spark, sf_dir))
        if sql:
            SQL[name] = (PREFIX + sql if prefix else sql).strip()
        return f

    return add
