"""Registered queries: name, Spark callable, and the SQL that must agree.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is SQL
over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function as ``name``, with its SQL where there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql.strip()
        return function

    return register
