"""Named queries and, where SQL can say the same, their check text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if check is not None:
            CHECKS[function.__name__] = check
        return function

    return register


def ids_text(ids: Column | str) -> Column:
    """An id array as text, so that results compare by value."""
    return F.array_join(F.col(ids) if isinstance(ids, str) else ids, ",")


def rounded(value: Column | str) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, 6)
