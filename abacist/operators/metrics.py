"""Completeness counts, step metrics and epoch averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abacist.constants import TRAILING_STEPS
from abacist.functions.text import is_blank
from abacist.operators.ordering import with_places

# Rows per span of trailing().
ROWS_PER_SPAN = 100_000


def row_count(rows: DataFrame) -> DataFrame:
    """One row with the number of rows."""
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


def completeness(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and, per text column, the number of blank and filled values."""
    counts = [F.count(F.lit(1)).alias("n_rows")]
    for column in columns:
        counts.append(F.count_if(is_blank(column)).alias(f"blank_{column}"))
        counts.append(F.count_if(~is_blank(column)).alias(f"filled_{column}"))
    return rows.agg(*counts)


def epoch_averages(
    steps: DataFrame, metrics: Sequence[str], epoch: str = "epoch"
) -> DataFrame:
    """Average of every metric per epoch, 0 without values, and the step count."""
    return steps.groupBy(epoch).agg(
        *(F.coalesce(F.avg(m), F.lit(0.0)).alias(f"avg_{m}") for m in metrics),
        F.count(F.lit(1)).alias("steps"),
    )


def trailing(
    steps: DataFrame,
    metrics: Sequence[str],
    run: str = "epoch",
    step: str = "step",
    width: int = TRAILING_STEPS,
    statistic: str = "avg",
    rows_per_span: int = ROWS_PER_SPAN,
) -> DataFrame:
    """Average (or sum) of the last ``width`` rows of a run, per row.

    Adds ``trailing_<metric>``. Rows are ordered by run and step over all tasks and
    written so, once; the sizes of the parts give every row its place in the whole
    order. Spans of ``rows_per_span`` places are windowed apart, each with the
    ``width - 1`` rows before it: the rows before a row in its run are among
    those. So no task has more than a span, however long or dense a run is.
    ``(run, step)`` has to be unique; a null step comes first.
    """
    if statistic not in ("avg", "sum"):
        raise ValueError(f"statistic must be 'avg' or 'sum', not {statistic!r}")
    function, back = getattr(F, statistic), width - 1
    placed = with_places(steps, run, step)
    own = F.call_function("div", F.col("_place"), F.lit(rows_per_span))
    # a row is also looked back at by the rows of the next places
    last = F.call_function("div", F.col("_place") + back, F.lit(rows_per_span))
    copied = placed.withColumn("_span", F.explode(F.sequence(own, last)))
    frame = W.partitionBy("_span", run).orderBy("_place").rowsBetween(-back, 0)
    done = copied.withColumns({f"trailing_{m}": function(m).over(frame) for m in metrics})
    return done.where(F.col("_span") == own).drop("_place", "_span")
