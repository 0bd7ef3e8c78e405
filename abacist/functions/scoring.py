"""Rewards, clipped loss and score formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abacist.constants import (
    ADVANTAGE_EPSILON,
    ANSWER_MARKER,
    CLIP_EPSILON,
    KL_COEFFICIENT,
    NUMBER_TOLERANCE,
    REWARD_CORRECT,
    REWARD_FORMAT,
    SCORE_FULL_MARKS,
    STEP_WORDS,
    WORK_POINTS_SOLO,
    WORK_POINTS_TEAM,
)
from abacist.functions.columns import ColumnLike, as_column
from abacist.functions.text import (
    answer_value,
    has_marker,
    parse_number,
    strip,
)


def numbers_agree(left: Column, right: Column) -> Column:
    """Whether two doubles agree within the tolerance; false with a null."""
    return F.coalesce(F.abs(left - right) < NUMBER_TOLERANCE, F.lit(False))


def reward(
    response: ColumnLike,
    truth: ColumnLike,
    correct: float = REWARD_CORRECT,
    form: float = REWARD_FORMAT,
    fraction_truth: bool = False,
    marker: str = ANSWER_MARKER,
    step_words: tuple[str, ...] = STEP_WORDS,
) -> Column:
    """Rule reward of a response.

    ``correct`` for a number within the tolerance of the truth, half of
    ``form`` for a step word and half for an answer marker. With
    ``fraction_truth`` a truth such as ``1/2`` is read as a fraction before
    looking for its last number.
    """
    response, truth = as_column(response), as_column(truth)
    wanted = answer_value(truth, marker)
    if fraction_truth:
        wanted = F.coalesce(parse_number(strip(truth)), wanted)
    given = answer_value(response, marker)

    def points(condition: Column, value: float) -> Column:
        return F.when(F.coalesce(condition, F.lit(False)), F.lit(value)).otherwise(0.0)

    return (
        points(numbers_agree(given, wanted), correct)
        + points(response.rlike("|".join(step_words)), form / 2)
        + points(has_marker(response, marker), form / 2)
    )


def relative_advantage(value: Column, size: Column, mean: Column, deviation: Column) -> Column:
    """``(value - mean) / deviation``; 0 for single or constant groups."""
    flat = (size <= 1) | (deviation < ADVANTAGE_EPSILON)
    return F.when(flat, F.lit(0.0)).otherwise((value - mean) / deviation)


def is_active(advantage: ColumnLike, log_probs: ColumnLike) -> Column:
    """Whether a rollout contributes to the loss."""
    tokens = F.coalesce(F.size(as_column(log_probs)), F.lit(0))
    return (F.abs(as_column(advantage)) >= ADVANTAGE_EPSILON) & (tokens > 0)


def shared_length(current: ColumnLike, old: ColumnLike) -> Column:
    """Length of the shorter of two vectors."""
    return F.least(F.size(as_column(current)), F.size(as_column(old)))


def _vector_mean(vector: Column) -> Column:
    total = F.aggregate(vector, F.lit(0.0), lambda done, x: done + x)
    return F.try_divide(total, F.size(vector))


def _cut(current: ColumnLike, old: ColumnLike) -> tuple[Column, Column]:
    length = shared_length(current, old)
    return tuple(F.slice(as_column(v), 1, length) for v in (current, old))


def kl_estimate(current: ColumnLike, old: ColumnLike) -> Column:
    """Mean of old minus current log-probabilities over the shared length."""
    cur, prev = _cut(current, old)
    return _vector_mean(F.zip_with(cur, prev, lambda c, o: o - c))


def clipped_ratio(ratio: Column, clip: float) -> Column:
    """The ratio within ``1 - clip`` and ``1 + clip``."""
    return F.greatest(F.least(ratio, F.lit(1 + clip)), F.lit(1 - clip))


def token_loss(
    current: ColumnLike,
    old: ColumnLike,
    advantages: ColumnLike,
    clip: float = CLIP_EPSILON,
    kl_coefficient: float = KL_COEFFICIENT,
) -> Column:
    """Clipped loss of equally long vectors with one advantage per token."""
    triples = F.arrays_zip(
        as_column(current).alias("c"),
        as_column(old).alias("o"),
        as_column(advantages).alias("a"),
    )

    def objective(t: Column) -> Column:
        ratio = F.exp(t["c"] - t["o"])
        return F.least(ratio * t["a"], clipped_ratio(ratio, clip) * t["a"])

    return -_vector_mean(F.transform(triples, objective)) + kl_coefficient * (
        kl_estimate(current, old)
    )


def scaled_group_loss(total: ColumnLike, active: ColumnLike, accumulation: int) -> Column:
    """Group loss as passed to one of ``accumulation`` gradient steps."""
    return F.try_divide(as_column(total), as_column(active) * accumulation)


def per_active(total: ColumnLike, active: ColumnLike) -> Column:
    """A group total per active rollout."""
    return F.try_divide(as_column(total), as_column(active))


def entry_score(accuracy: ColumnLike, finished: ColumnLike, team: bool = False) -> Column:
    """Accuracy marks plus work points, capped at full marks."""
    points = WORK_POINTS_TEAM if team else WORK_POINTS_SOLO
    return F.least(
        as_column(accuracy) * SCORE_FULL_MARKS + as_column(finished) * points,
        F.lit(SCORE_FULL_MARKS),
    )
