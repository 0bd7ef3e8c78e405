"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    """A column from a name, or the column itself."""
    return F.col(value) if isinstance(value, str) else value


def computed_once(result: Callable[..., Column], *values: Column) -> Column:
    """``result(*values)`` with each value computed once a row, however often it is used.

    Spark computes an expression again for each of its uses in a branch or a lambda.
    """
    names = [f"v{number}" for number in range(len(values))]
    row = F.struct(*(value.alias(name) for value, name in zip(values, names)))
    return F.get(F.transform(F.array(row), lambda r: result(*(r[name] for name in names))), F.lit(0))


def last_match(text: Column, pattern: str, group: int) -> Column:
    """The last match of ``pattern`` in ``text``; null when there is none."""
    return F.try_element_at(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(-1)
    )
