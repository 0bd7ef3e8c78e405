"""Seeded order, samples, resume positions and epoch slices.

The order is that of a hash of the id, which stays the same for any
partitioning; ``rand()`` would not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abacist.constants import DEFAULT_SEED, EVALUATION_SAMPLE
from abacist.functions.hashing import hash32
from abacist.session import shared_folder

# The hash range is cut into this many slices to find a position in the order,
# which also bounds the table of slice sizes that is broadcast.
_SLICE_BITS = 16

# Rows that first_rows() takes from one sort.
SORTED_ROWS = 10_000


def _with_order(rows: DataFrame, id_column: str, seed: int) -> DataFrame:
    return rows.withColumn("_order", hash32(id_column, seed=seed))


def _with_slices(rows: DataFrame, id_column: str, seed: int) -> DataFrame:
    """Adds the hash slice of a row and which positions of the order it covers
    (``_from`` up to, not including, ``_until``)."""
    ordered = _with_order(rows, id_column, seed).withColumn(
        "_slice", F.shiftright("_order", 32 - _SLICE_BITS)
    )
    counts = ordered.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    # at most 2**_SLICE_BITS rows, so one task adds them up
    until = F.sum("_rows").over(W.orderBy("_slice"))
    ranges = counts.select(
        "_slice", (until - F.col("_rows")).alias("_from"), until.alias("_until")
    )
    return ordered.join(F.broadcast(ranges), "_slice")


def _with_position(sliced: DataFrame, id_column: str) -> DataFrame:
    """Adds ``_position`` in the order, from 0; numbers every slice on its own."""
    within = F.row_number().over(W.partitionBy("_slice").orderBy("_order", id_column))
    return sliced.withColumn("_position", F.col("_from") + within - 1)


_HELPERS = ("_order", "_slice", "_from", "_until", "_position")


def seeded_shuffle(rows: DataFrame, id_column: str = "id", seed: int = DEFAULT_SEED) -> DataFrame:
    """All rows in a random order given by the seed."""
    return _with_order(rows, id_column, seed).orderBy("_order", id_column).drop("_order")


def seeded_sample(
    rows: DataFrame,
    n: int = EVALUATION_SAMPLE,
    id_column: str = "id",
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """``min(n, count)`` rows without replacement, in the seeded order.

    Slices that cannot hold one of them go before anything is sorted, so no task
    keeps more than its share, whatever ``n`` is.
    """
    sliced = _with_slices(rows, id_column, seed)
    whole = sliced.where(F.col("_until") <= n)
    cut = sliced.where((F.col("_from") < n) & (F.col("_until") > n))
    part = _with_position(cut, id_column).where(F.col("_position") < n)
    both = whole.unionByName(part.drop("_position"))
    return both.orderBy("_order", id_column).drop(*_HELPERS)


def with_places(rows: DataFrame, *order: str) -> DataFrame:
    """Rows with their ``_place``, from 0, in the order of some columns; nulls come first.

    The rows are sorted over all tasks and written so, once, to the shared folder;
    the sizes of the parts, a row each, tell where every part begins. No task
    numbers more than its part.
    """
    spark, path = rows.sparkSession, shared_folder(rows.sparkSession, "ordered")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # the part's number and, in the low 33 bits, the place in the part
    dealt.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    ordered = spark.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    ahead = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    begins = sizes.select("_part", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_begin"))
    place = F.col("_begin") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.join(F.broadcast(begins), "_part").withColumn("_place", place).drop("_at", "_part", "_begin")


def first_rows(rows: DataFrame, n: int | None, sequence: str) -> DataFrame:
    """The first ``n`` rows by an explicit sequence column; all without ``n``.

    Up to ``SORTED_ROWS`` rows come out of a sort that keeps so many per task. For
    more, the values of that column alone are put in order, the value at the cut
    is read, and rows are taken by comparing with it, wherever they are. Of rows
    that share the value at the cut, any are taken.
    """
    if not n:
        return rows
    if n <= SORTED_ROWS:
        return rows.orderBy(sequence).limit(n)
    value = F.col(sequence)
    placed = with_places(rows.select(value.alias("_value")), "_value")
    cut = placed.where(F.col("_place") == n - 1).select("_value").first()
    if cut is None:  # there are fewer rows
        return rows
    same = value.isNull() if cut[0] is None else value == F.lit(cut[0])
    before = F.lit(False) if cut[0] is None else value.isNull() | (value < F.lit(cut[0]))
    begin = placed.where(F.col("_value").eqNullSafe(F.lit(cut[0]))).agg(F.min("_place")).first()[0]
    return rows.where(before).unionByName(rows.where(same).limit(n - begin))


def skip_shuffled(
    rows: DataFrame, done: int, id_column: str = "id", seed: int = DEFAULT_SEED
) -> DataFrame:
    """The seeded order without its first ``done`` rows.

    ``offset`` would pass all rows through one task. Here only the one slice of
    the hash range that ``done`` falls into is numbered.
    """
    sliced = _with_slices(rows, id_column, seed)
    whole = sliced.where(F.col("_from") >= done)
    cut = sliced.where((F.col("_from") < done) & (F.col("_until") > done))
    part = _with_position(cut, id_column).where(F.col("_position") >= done)
    both = whole.unionByName(part.drop("_position"))
    return both.orderBy("_order", id_column).drop(*_HELPERS)


def epoch_slices(
    rows: DataFrame,
    epochs: int,
    max_steps: int,
    max_samples: int | None = None,
    drop_boundary: bool = True,
    id_column: str = "id",
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Rows of every epoch, taken one after the other from one seeded order.

    Adds ``epoch`` and ``step``. With ``drop_boundary`` the row after each
    epoch is passed over, as when a loop reads one row too many before it stops.
    Only slices with some of those ``epochs * (steps + 1)`` rows are numbered,
    each on its own.
    """
    steps = min(max_steps, max_samples) if max_samples else max_steps
    block = steps + 1 if drop_boundary else steps
    needed = epochs * block
    sliced = _with_slices(rows, id_column, seed).where(F.col("_from") < needed)
    numbered = _with_position(sliced, id_column).where(F.col("_position") < needed)
    return (
        numbered.withColumn("epoch", F.floor(F.col("_position") / block).cast("int"))
        .withColumn("step", F.pmod(F.col("_position"), F.lit(block)).cast("int"))
        .where(F.col("step") < steps)
        .drop(*_HELPERS)
    )


def preview_rows(rows: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The first ``n`` rows for display."""
    return rows.orderBy(order).limit(n)
