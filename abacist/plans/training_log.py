"""Metrics of scored rollouts along the steps of a training run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.operators.metrics import epoch_averages


def step_losses(slices: DataFrame, groups: DataFrame) -> DataFrame:
    """``epoch, step, id, loss, kl`` of every step; null for steps without any
    active rollout.

    ``slices`` come from :func:`~abacist.operators.ordering.epoch_slices`,
    ``groups`` from :func:`~abacist.plans.rollouts.with_step_losses`.
    """
    return slices.select("id", "epoch", "step").join(
        groups.select("id", "loss", "kl"), "id", "left"
    )


def step_rewards(slices: DataFrame, rewards: DataFrame, group_size: int) -> DataFrame:
    """``epoch, step, id, rollout, reward`` with ``position``, the number of the
    rollout within its epoch."""
    return (
        slices.select("id", "epoch", "step")
        .join(rewards.select("id", "rollout", "reward"), "id")
        .withColumn("position", F.col("step") * group_size + F.col("rollout"))
    )


def epoch_summary(losses: DataFrame, rewards: DataFrame) -> DataFrame:
    """Averages of loss and KL over active steps and of the reward over all
    rollouts, and the number of steps, per epoch."""
    by_loss = epoch_averages(losses, ["loss", "kl"])
    by_reward = epoch_averages(rewards, ["reward"]).select("epoch", "avg_reward")
    return by_loss.join(by_reward, "epoch", "left").fillna(0.0, ["avg_reward"])
