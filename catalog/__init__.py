"""The registered queries: each operator on the given tables, with its plain SQL.

A module per theme; ``QUERIES`` and ``SQL`` collect what they register.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that must agree."""

    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            SQL[query.__name__] = sql
        return query

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    return df.select(
        *(
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        )
    )
