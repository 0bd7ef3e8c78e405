"""Scoring of sampled responses: reward, group-relative advantage, loss."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abacist.constants import ADVANTAGE_EPSILON, CLIP_EPSILON, KL_COEFFICIENT
from abacist.functions.scoring import (
    clipped_ratio,
    is_active,
    per_active,
    relative_advantage,
    reward,
    scaled_group_loss,
    shared_length,
)
from abacist.operators.keyed import with_group_stats

KEYS = ("id", "rollout")
VECTORS = ("current_log_probs", "old_log_probs")


def scored(rollouts: DataFrame, **options) -> DataFrame:
    """Adds ``reward``; map-only."""
    return rollouts.withColumn("reward", reward("response", "answer", **options))


def group_rewards(rewards: DataFrame) -> DataFrame:
    """Size, mean and population standard deviation of the rewards per id."""
    return rewards.groupBy("id").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.avg("reward").alias("reward_mean"),
        F.stddev_pop("reward").alias("reward_std"),
    )


def with_advantages(
    rewards: DataFrame, keep: Sequence[str] = (), score_once: bool = True
) -> DataFrame:
    """``id, rollout, reward`` with ``advantage``: the reward relative to its
    group of rollouts.

    With ``score_once`` the three narrow columns are shuffled by their key
    before they are used for both the statistics and the rows, so that responses
    are read and scored a single time; turn it off for rewards that are stored
    already. Columns to ``keep`` travel along; wide ones are better joined
    afterwards.
    """
    narrow = rewards.select(*KEYS, "reward", *keep)
    if score_once:
        narrow = narrow.repartition(*KEYS)
    stats = {
        "_size": F.count(F.lit(1)),
        "_mean": F.avg("reward"),
        "_std": F.stddev_pop("reward"),
    }
    joined = with_group_stats(narrow, ["id"], stats)
    advantage = relative_advantage(F.col("reward"), F.col("_size"), F.col("_mean"), F.col("_std"))
    return joined.withColumn("advantage", advantage).drop(*stats)


def active_rollouts(rows: DataFrame, log_probs: str = "old_log_probs") -> DataFrame:
    """Rollouts that contribute to the loss."""
    return rows.where(is_active("advantage", log_probs))


def with_log_probs(rewards: DataFrame, log_probs: DataFrame) -> DataFrame:
    """Rewards joined to the log-probability vectors of the same rollout.

    The key is unique, so no task gets more than its share; response texts
    should be dropped before.
    """
    return rewards.join(log_probs, list(KEYS))


def _token_ratios(rows: DataFrame) -> DataFrame:
    """One row per token that both vectors have, at least one per rollout.

    Adds ``at`` (null without a token), ``ratio``, ``gap`` (old minus current),
    ``weight`` (one over the number of tokens) and ``is_item`` (whether there are
    old log-probabilities). Long vectors are summed much
    faster as rows in generated code than with array functions.
    """
    length = F.coalesce(shared_length("current_log_probs", "old_log_probs"), F.lit(0))
    cut = [F.slice(F.col(v), 1, F.col("_length")) for v in VECTORS]
    tokens = F.arrays_zip(cut[0].alias("current"), cut[1].alias("old"))
    return (
        rows.withColumn("_length", length)
        .withColumn("_tokens", tokens)
        .select(
            *(c for c in rows.columns if c not in VECTORS),
            F.try_divide(F.lit(1.0), F.col("_length")).alias("weight"),
            (F.coalesce(F.size("old_log_probs"), F.lit(0)) > 0).alias("is_item"),
            F.posexplode_outer("_tokens").alias("at", "_token"),
        )
        .withColumns(
            {
                "ratio": F.exp(F.col("_token.current") - F.col("_token.old")),
                "gap": F.col("_token.old") - F.col("_token.current"),
            }
        )
        .drop("_token")
    )


def rollout_losses(
    rows: DataFrame, clip: float = CLIP_EPSILON, kl_coefficient: float = KL_COEFFICIENT
) -> DataFrame:
    """``id, rollout, advantage, loss, kl`` of the items of a step: rollouts with an
    advantage and old log-probabilities.

    Loss and KL are null without shared tokens; such an item counts only for the
    divisor of the step. The sums over tokens are combined before the shuffle;
    after a join on the same key there is none.
    """
    counted = active_rollouts(rows)
    tokens = _token_ratios(counted.select(*KEYS, "advantage", *VECTORS))
    ratio, advantage = F.col("ratio"), F.col("advantage")
    objective = F.least(ratio * advantage, clipped_ratio(ratio, clip) * advantage)
    return (
        tokens.groupBy(*KEYS, "advantage")
        .agg(F.avg(objective).alias("_objective"), F.avg("gap").alias("kl"))
        .select(
            *KEYS,
            "advantage",
            (kl_coefficient * F.col("kl") - F.col("_objective")).alias("loss"),
            "kl",
        )
    )


def group_losses(losses: DataFrame) -> DataFrame:
    """Sums of loss and KL per id, and how many rollouts they are of
    (``n_active``) out of how many items (``n_items``); ids without any are left out."""
    groups = losses.groupBy("id").agg(
        F.sum("loss").alias("total_loss"),
        F.sum("kl").alias("total_kl"),
        F.count("loss").alias("n_active"),
        F.count(F.lit(1)).alias("n_items"),
    )
    return groups.where("n_active > 0")


def with_step_losses(groups: DataFrame, accumulation: int = 2) -> DataFrame:
    """Adds the loss of a gradient step, per item, and the averages per active rollout."""
    return groups.withColumns(
        {
            "scaled_loss": scaled_group_loss("total_loss", "n_items", accumulation),
            "loss": per_active("total_loss", "n_active"),
            "kl": per_active("total_kl", "n_active"),
        }
    )


def group_objectives(
    rollouts: DataFrame,
    log_probs: DataFrame | None = None,
    clip: float = CLIP_EPSILON,
    kl_coefficient: float = KL_COEFFICIENT,
    **reward_options,
) -> DataFrame:
    """From rollouts to the loss sums of every id, without row-level statistics.

    The advantage depends on the reward alone, and a reward has only a few
    values (correct or not, steps or not, marker or not). So tokens are first
    summed per (id, reward), combined before the shuffle, and advantages are
    worked out on at most that many rows per id. A clipped objective is linear
    in the advantage on either side of zero: A times the mean of
    ``min(ratio, 1 + clip)`` above, of ``max(ratio, 1 - clip)`` below. Both are
    summed.
    """
    slim = scored(rollouts, **reward_options).select(
        *KEYS, "reward", *(VECTORS if log_probs is None else ())
    )
    if log_probs is not None:
        slim = with_log_probs(slim, log_probs.select(*KEYS, *VECTORS))
    ratio, weight = F.col("ratio"), F.col("weight")
    per_reward = (
        _token_ratios(slim)
        .groupBy("id", "reward")
        .agg(
            F.count_if(F.coalesce(F.col("at"), F.lit(0)) == 0).alias("_rows"),
            F.count_if(F.col("at") == 0).alias("_active"),
            F.count_if((F.coalesce(F.col("at"), F.lit(0)) == 0) & F.col("is_item")).alias("_items"),
            F.sum(F.least(ratio, F.lit(1 + clip)) * weight).alias("_low"),
            F.sum(F.greatest(ratio, F.lit(1 - clip)) * weight).alias("_high"),
            F.sum(F.col("gap") * weight).alias("_kl"),
        )
    )
    # one row per distinct reward of an id, eight at most
    group = W.partitionBy("id")
    size = F.sum("_rows").over(group)
    with_mean = per_reward.withColumn("_size", size).withColumn(
        "_mean", F.sum(F.col("reward") * F.col("_rows")).over(group) / F.col("_size")
    )
    deviation = F.col("reward") - F.col("_mean")
    with_std = with_mean.withColumn(
        "_std",
        F.sqrt(F.sum(F.col("_rows") * deviation * deviation).over(group) / F.col("_size")),
    )
    advantage = relative_advantage(
        F.col("reward"), F.col("_size"), F.col("_mean"), F.col("_std")
    )
    objective = F.col("_advantage") * F.when(F.col("_advantage") >= 0, F.col("_low")).otherwise(
        F.col("_high")
    )
    return (
        with_std.withColumn("_advantage", advantage)
        .where((F.abs("_advantage") >= ADVANTAGE_EPSILON) & (F.col("_items") > 0))
        .groupBy("id")
        .agg(
            F.sum(kl_coefficient * F.col("_kl") - objective).alias("total_loss"),
            F.sum("_kl").alias("total_kl"),
            F.sum("_active").alias("n_active"),
            F.sum("_items").alias("n_items"),
        )
        .where("n_active > 0")
    )
