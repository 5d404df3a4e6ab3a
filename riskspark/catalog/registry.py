"""Registration of queries: a name, a function of the loan tables, and SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskspark.catalog.inputs import Inputs, sql_with_inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register `fn(inputs)`; `sql` may use the loan tables named in `uses`."""
    def register(fn: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            SQL[name] = sql_with_inputs(sql, uses.split())
        return fn
    return register
