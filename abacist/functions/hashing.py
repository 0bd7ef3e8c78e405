"""Deterministic draws: same result under retries and any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abacist.constants import DEFAULT_SEED
from abacist.functions.columns import ColumnLike, as_column

HASH_RANGE = 1 << 32


def hash32(key: ColumnLike, salt: ColumnLike | None = None, seed: int = DEFAULT_SEED) -> Column:
    """A uniform number in [0, 2**32) from a key, a salt and a seed.

    A null key counts as empty, so that no row is lost in an order by it.
    """
    salt = F.lit("") if salt is None else as_column(salt)
    known = F.coalesce(as_column(key).cast("string"), F.lit(""))
    text = F.concat(known, F.lit("|"), salt.cast("string"), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
