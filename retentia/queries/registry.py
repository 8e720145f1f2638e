"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retentia.plans.churn_base import BASE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, on_base: bool = True):
    """Register a query. `sql` continues the snapshot's WITH list unless `on_base` is off.

    A statement starting with SELECT is appended as the main query; one starting with a name
    adds further common table expressions.
    """

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            text = sql.strip()
            if on_base:
                joint = "\n" if text[:6].upper() == "SELECT" else ",\n"
                text = BASE_SQL + joint + text
            ORACLES[name] = text
        return fn

    return register
