"""Joins and group statistics that hold when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Checked size up to which a lookup table is broadcast.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20
LOOKUP_SALTS = 16


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[f"_key_{key}"])
    return condition


def with_group_stats(
    rows: DataFrame, keys: Sequence[str], stats: Mapping[str, Column]
) -> DataFrame:
    """Every row with the aggregates of its group.

    A window over the key would sort a whole group in one task. Here the
    aggregates come from a group-by (combined before its shuffle) and are joined
    back; they are unique, so adaptive execution can split the rows of a large
    group among tasks.
    """
    keys = list(keys)
    grouped = rows.groupBy(*keys).agg(*(c.alias(n) for n, c in stats.items()))
    grouped = grouped.withColumnsRenamed({key: f"_key_{key}" for key in keys})
    return rows.join(grouped, _same_key(rows, grouped, keys)).drop(*(f"_key_{key}" for key in keys))


def fits_broadcast(
    table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether a table is small; reads at most ``max_rows + 1`` rows of it."""
    row_bytes = F.octet_length(F.to_json(F.struct("*")))
    size = (
        table.limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row_bytes), F.lit(0)).alias("bytes"))
        .first()
    )
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = LOOKUP_SALTS,
) -> DataFrame:
    """Join rows to a lookup table whose key is unique.

    Few distinct keys meet many rows here, so a shuffle on the key alone would
    load single tasks. A table of checked size is broadcast; a larger one is
    repeated per salt and both sides are shuffled on key and salt, where
    adaptive skew handling can split further.
    """
    on = list(on)
    if fits_broadcast(table, max_rows, max_bytes):
        return rows.join(F.broadcast(table), on, how)
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(F.struct("*")), F.lit(salts)))
    salted_table = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted_table = salted_table.withColumn("_salt", F.col("_salt").cast("bigint"))
    return salted_rows.join(salted_table, [*on, "_salt"], how).drop("_salt")


def last_by_key(rows: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The row with the largest ``sequence`` of every key.

    Two phases: keys and sequence numbers alone are aggregated, by hash, and the
    winners pick their rows, as the built side of a hash join. Whole rows are
    neither aggregated nor sorted, and rows of a key that many have are split
    among tasks. ``sequence`` has to be unique within a key; a null one counts as
    smaller than all others. ``rows`` is computed twice.
    """
    keys = list(keys)
    winners = rows.groupBy(*keys).agg(F.max(sequence).alias("_last"))
    winners = winners.withColumnsRenamed({key: f"_key_{key}" for key in keys}).hint("shuffle_hash")
    same = _same_key(rows, winners, keys) & rows[sequence].eqNullSafe(winners["_last"])
    return rows.join(winners, same, "left_semi").select(*rows.columns)


def rows_to_do(rows: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not in ``done``, compared as text."""
    known = done.select(F.col(key).cast("string").alias("_done")).distinct()
    return rows.join(known, F.col(key).cast("string") == F.col("_done"), "left_anti")
