"""All registered queries and their check texts."""

from abacist.queries import (  # noqa: F401  (imported for registration)
    generating,
    scoring,
    storage,
    table_operators,
    texts,
    training,
)
from abacist.queries.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
