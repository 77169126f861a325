"""Registration of queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from workload.views import all_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

#: What queries that read the intervals twice need of them.
DAY_PIN = {"active_intervals": ("employee_key", "manager_employee_key", "department", "from_date", "to_date")}


def query(name: str, sql: str | None = None, pin: Mapping[str, tuple[str, ...]] | None = None):
    """Registers a function of (tables, spark, sf_dir); ``sql`` is the equivalent for the checking database.

    ``pin`` names tables that the query reads more than once, and their columns that it needs; they are computed once
    and stored.
    """

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            t = all_tables(spark, sf_dir)
            for table, columns in (pin or {}).items():
                t.pin(table, columns)
            return fn(t, spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register
