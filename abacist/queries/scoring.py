"""Rewards, advantages, losses, accuracy and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.fixtures import (
    MODELS,
    log_probs,
    model_responses,
    problems,
    rollouts,
    with_views,
)
from abacist.functions.display import percent_text
from abacist.functions.scoring import token_loss
from abacist.operators.metrics import trailing
from abacist.operators.ordering import epoch_slices
from abacist.plans import evaluation, training_log
from abacist.plans import rollouts as scoring
from abacist.queries import sql
from abacist.queries.registry import query, rounded
from abacist.sources.submission import submission

_SCORED = f"SELECT id, rollout, {sql.reward('response', 'answer')} AS reward FROM rollouts"
_ADVANTAGES = """
SELECT *, CASE WHEN n <= 1 OR std < 1e-6 THEN 0 ELSE (reward - mean) / std END AS advantage
FROM (SELECT *, count(*) OVER g AS n, avg(reward) OVER g AS mean, stddev_pop(reward) OVER g AS std
      FROM scored WINDOW g AS (PARTITION BY id))"""


@query(
    with_views(
        "SELECT id, rollout, round(reward, 6) AS reward FROM scored", "rollouts", scored=_SCORED
    )
)
def rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored(rollouts(spark, sf_dir)).select(
        "id", "rollout", rounded("reward").alias("reward")
    )


@query(
    with_views(
        """
SELECT id, count(*) AS group_size, round(avg(reward), 6) AS reward_mean,
       round(stddev_pop(reward), 6) AS reward_std
FROM scored GROUP BY id""",
        "rollouts",
        scored=_SCORED,
    )
)
def group_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.group_rewards(scoring.scored(rollouts(spark, sf_dir))).select(
        "id",
        "group_size",
        rounded("reward_mean").alias("reward_mean"),
        rounded("reward_std").alias("reward_std"),
    )


def _slim_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored(rollouts(spark, sf_dir)).select("id", "rollout", "reward")


@query(
    with_views(
        "SELECT id, rollout, round(reward, 6) AS reward, round(advantage, 6) AS advantage FROM weighed",
        "rollouts",
        scored=_SCORED,
        weighed=_ADVANTAGES,
    )
)
def advantages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.with_advantages(_slim_rewards(spark, sf_dir)).select(
        "id",
        "rollout",
        rounded("reward").alias("reward"),
        rounded("advantage").alias("advantage"),
    )


@query(
    with_views(
        "SELECT id, rollout, adv AS advantage FROM log_probs WHERE abs(adv) >= 1e-6 AND len(old) > 0",
        "log_probs",
    )
)
def active_rollouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_probs(spark, sf_dir).withColumnRenamed("adv", "advantage")
    return scoring.active_rollouts(rows).select("id", "rollout", "advantage")


@query(
    with_views(
        """
SELECT id, rollout, round(s.reward, 6) AS reward, round(list_sum(l.cur), 6) AS current_total,
       round(list_sum(l.old), 6) AS old_total
FROM scored s JOIN log_probs l USING (id, rollout)""",
        "rollouts",
        "log_probs",
        scored=_SCORED,
    )
)
def rewards_with_log_probs(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = scoring.with_log_probs(_slim_rewards(spark, sf_dir), log_probs(spark, sf_dir))

    def total(name: str):
        added = F.aggregate(name, F.lit(0.0), lambda done, x: done + x)
        return rounded(F.when(F.size(name) > 0, added))

    return joined.select(
        "id",
        "rollout",
        rounded("reward").alias("reward"),
        total("current_log_probs").alias("current_total"),
        total("old_log_probs").alias("old_total"),
    )


_LOSS, _KL = sql.loss_terms("cur", "old", "adv")
_LOSSES = f"""
SELECT id, rollout, {_LOSS} AS loss, {_KL} AS kl FROM log_probs
WHERE abs(adv) >= 1e-6 AND len(old) > 0"""


@query(
    with_views(
        "SELECT id, rollout, round(loss, 6) AS loss, round(kl, 6) AS kl FROM losses",
        "log_probs",
        losses=_LOSSES,
    )
)
def rollout_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_probs(spark, sf_dir).withColumnRenamed("adv", "advantage")
    return scoring.rollout_losses(rows).select(
        "id", "rollout", rounded("loss").alias("loss"), rounded("kl").alias("kl")
    )


@query(
    with_views(
        """
SELECT id, rollout, round(-list_avg(list_transform(z, lambda t: least(exp(t[1] - t[2]) * t[3],
       greatest(least(exp(t[1] - t[2]), 1.2::DOUBLE), 0.8::DOUBLE) * t[3])))
       + 0.04::DOUBLE * list_avg(list_transform(z, lambda t: t[2] - t[1])), 6) AS loss
FROM (SELECT id, rollout, list_zip(cur[1:n], old[1:n],
             list_transform(range(1, n + 1), lambda j: adv * j)) AS z
      FROM (SELECT *, least(len(cur), len(old)) AS n FROM log_probs))""",
        "log_probs",
    )
)
def token_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rollout; one without shared tokens has no loss."""
    length = F.least(F.size("current_log_probs"), F.size("old_log_probs"))
    rows = log_probs(spark, sf_dir).withColumn("_n", length)
    places = F.slice(F.sequence(F.lit(0), F.col("_n")), F.lit(2), F.col("_n"))
    weights = F.transform(places, lambda j: F.col("adv") * j)
    vectors = [F.slice(F.col(v), 1, F.col("_n")) for v in ("current_log_probs", "old_log_probs")]
    return rows.select("id", "rollout", rounded(token_loss(*vectors, weights)).alias("loss"))


@query(
    with_views(
        """
SELECT id, round(sum(loss), 6) AS total_loss, round(sum(kl), 6) AS total_kl, count(loss) AS n_active,
       count(*) AS n_items, round(sum(loss) / (count(*) * 2), 6) AS scaled_loss,
       round(sum(loss) / count(loss), 6) AS loss, round(sum(kl) / count(kl), 6) AS kl
FROM losses GROUP BY id HAVING count(loss) > 0""",
        "log_probs",
        losses=_LOSSES,
    )
)
def group_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = log_probs(spark, sf_dir).withColumnRenamed("adv", "advantage")
    groups = scoring.group_losses(scoring.rollout_losses(rows))
    return _rounded_all(scoring.with_step_losses(groups))


def _rounded_all(rows: DataFrame) -> DataFrame:
    return rows.select(
        *(rounded(n).alias(n) if kind == "double" else F.col(n) for n, kind in rows.dtypes)
    )


_CHAIN_LOSS, _CHAIN_KL = sql.loss_terms("cur", "old", "advantage")
_CHAIN = with_views(
    f"""
SELECT id, round(sum(loss), 6) AS total_loss, round(sum(kl), 6) AS total_kl,
       count(loss) AS n_active, count(*) AS n_items
FROM (SELECT id, {_CHAIN_LOSS} AS loss, {_CHAIN_KL} AS kl
      FROM weighed JOIN log_probs USING (id, rollout)
      WHERE abs(advantage) >= 1e-6 AND len(old) > 0)
GROUP BY id HAVING count(loss) > 0""",
    "rollouts",
    "log_probs",
    scored=_SCORED,
    weighed=_ADVANTAGES,
)


@query(_CHAIN)
def group_objectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = log_probs(spark, sf_dir).select(
        "id", "rollout", "current_log_probs", "old_log_probs"
    )
    return _rounded_all(scoring.group_objectives(rollouts(spark, sf_dir), vectors))


@query(_CHAIN)
def rollout_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sums with an advantage and a loss per rollout on the way."""
    vectors = log_probs(spark, sf_dir).select(
        "id", "rollout", "current_log_probs", "old_log_probs"
    )
    weighed = scoring.with_advantages(_slim_rewards(spark, sf_dir))
    losses = scoring.rollout_losses(
        scoring.with_log_probs(weighed.where("abs(advantage) >= 1e-6"), vectors)
    )
    return _rounded_all(scoring.group_losses(losses))


_SLICED = f"""
SELECT id, CAST(position // 251 AS INTEGER) AS epoch, CAST(position % 251 AS INTEGER) AS step
FROM (SELECT id, row_number() OVER (ORDER BY {sql.hash32('id')}, id) - 1 AS position FROM problems)
WHERE position < 753 AND position % 251 < 250"""
_STEP_LOSSES = f"""
SELECT s.epoch, s.step, g.loss, g.kl FROM sliced s LEFT JOIN (
    SELECT id, sum(loss) / count(*) AS loss, sum(kl) / count(*) AS kl
    FROM (SELECT id, {_CHAIN_LOSS} AS loss, {_CHAIN_KL} AS kl
          FROM weighed JOIN log_probs USING (id, rollout)
          WHERE abs(advantage) >= 1e-6 AND least(len(cur), len(old)) > 0)
    GROUP BY id) g USING (id)"""
_RUN = {"scored": _SCORED, "weighed": _ADVANTAGES, "sliced": _SLICED, "step_losses": _STEP_LOSSES}


def _run_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Losses and rewards of three epochs of 250 steps with four rollouts each."""
    slices = epoch_slices(problems(spark, sf_dir).select("id"), epochs=3, max_steps=250)
    vectors = log_probs(spark, sf_dir)
    groups = scoring.with_step_losses(scoring.group_objectives(rollouts(spark, sf_dir), vectors))
    rewards_of_steps = training_log.step_rewards(slices, _slim_rewards(spark, sf_dir), 4)
    return training_log.step_losses(slices, groups), rewards_of_steps


@query(
    with_views(
        """
SELECT l.epoch, round(coalesce(avg(loss), 0), 6) AS avg_loss, round(coalesce(avg(kl), 0), 6) AS avg_kl,
       count(*) AS steps, round((SELECT avg(reward) FROM sliced s JOIN scored USING (id)
                          WHERE s.epoch = l.epoch), 6) AS avg_reward
FROM step_losses l GROUP BY l.epoch""",
        "problems",
        "rollouts",
        "log_probs",
        **_RUN,
    )
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_all(training_log.epoch_summary(*_run_log(spark, sf_dir)))


@query(
    with_views(
        """
SELECT epoch, step, round(avg(loss) OVER last_steps, 6) AS trailing_loss,
       round(avg(kl) OVER last_steps, 6) AS trailing_kl
FROM step_losses WHERE loss IS NOT NULL
WINDOW last_steps AS (PARTITION BY epoch ORDER BY step ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
        "problems",
        "rollouts",
        "log_probs",
        **_RUN,
    )
)
def run_trailing_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only steps with active rollouts are listed, as in a progress display."""
    losses, _ = _run_log(spark, sf_dir)
    active = losses.where("loss is not null").drop("id")
    return _rounded_all(trailing(active, ["loss", "kl"]).drop("loss", "kl"))


@query(
    with_views(
        """
SELECT epoch, position, round(avg(reward) OVER (PARTITION BY epoch ORDER BY position
       ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS trailing_reward
FROM (SELECT s.epoch, CAST(s.step * 4 + r.rollout AS INTEGER) AS position, r.reward
      FROM sliced s JOIN scored r USING (id))""",
        "problems",
        "rollouts",
        "log_probs",
        **_RUN,
    )
)
def run_trailing_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rewards_of_steps = _run_log(spark, sf_dir)
    last = trailing(
        rewards_of_steps.select("epoch", "position", "reward"), ["reward"], step="position"
    )
    return _rounded_all(last.drop("reward"))


# --- evaluation --------------------------------------------------------------------

_PREDICTIONS = f"""
SELECT id, model, variant, {sql.extract('response')} AS extracted,
       coalesce(nullif({sql.extract('response')}, ''), '0') AS prediction
FROM responses"""
_COMPARED = """
SELECT p.*, q.answer AS truth FROM predictions p JOIN problems q USING (id)"""
_ACCURACY = f"""
SELECT model, variant, count(*) FILTER (WHERE prediction = truth) AS n_correct, count(*) AS n_rows,
       avg(CASE WHEN prediction = truth THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy,
       avg(CASE WHEN abs(({sql.number(sql.extract('prediction'))})
                 - ({sql.number(sql.extract('truth'))})) < 0.01
           THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS accuracy_close
FROM compared GROUP BY model, variant"""
_EVALUATION = {"predictions": _PREDICTIONS, "compared": _COMPARED, "accuracies": _ACCURACY}


def _evaluation_sql(body: str) -> str:
    return with_views(body, "responses", "problems", **_EVALUATION)


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.predictions(model_responses(spark, sf_dir)).drop("response")


def _accuracies(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = evaluation.with_truth(_predictions(spark, sf_dir), problems(spark, sf_dir))
    return evaluation.accuracy(compared, ["model", "variant"])


@query(_evaluation_sql("SELECT id, model, extracted, prediction FROM predictions"))
def filled_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(spark, sf_dir).drop("variant")


@query(
    _evaluation_sql(
        "SELECT model, count(*) FILTER (WHERE extracted = '') AS n_unparsed, count(*) AS n_rows "
        "FROM predictions GROUP BY model"
    )
)
def unparsed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.unparsed_counts(_predictions(spark, sf_dir), ["model"])


@query(_evaluation_sql("SELECT id, model, prediction, truth FROM compared"))
def predictions_with_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = evaluation.with_truth(_predictions(spark, sf_dir), problems(spark, sf_dir))
    return joined.select("id", "model", "prediction", "truth")


@query(
    _evaluation_sql(
        "SELECT model, variant, n_correct, n_rows, round(accuracy, 6) AS accuracy, "
        "round(accuracy_close, 6) AS accuracy_close FROM accuracies"
    )
)
def accuracy_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_all(_accuracies(spark, sf_dir))


@query(
    _evaluation_sql(
        """
SELECT CAST(row_number() OVER (ORDER BY accuracy DESC, variant) AS INTEGER) AS place, model,
       n_correct, n_rows, round(accuracy, 6) AS accuracy, round(accuracy - b, 6) AS gain,
       printf('%.2f%%', accuracy * 100) AS accuracy_text,
       concat(CASE WHEN accuracy > b THEN '+' ELSE '' END, printf('%.2f%%', (accuracy - b) * 100))
           AS gain_text
FROM (SELECT *, max(CASE WHEN model = 'base' THEN accuracy END) OVER () AS b FROM accuracies)"""
    )
)
def ranked_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query: responses to a ranked accuracy table."""
    placed = evaluation.ranked(_accuracies(spark, sf_dir)).transform(
        evaluation.with_gain, base="base"
    )
    return placed.select(
        "place",
        "model",
        "n_correct",
        "n_rows",
        rounded("accuracy").alias("accuracy"),
        rounded("gain").alias("gain"),
        percent_text("accuracy").alias("accuracy_text"),
        percent_text("gain", signed=True).alias("gain_text"),
    )


@query(
    _evaluation_sql(
        "SELECT model, round(accuracy, 6) AS accuracy FROM accuracies "
        "ORDER BY accuracies.accuracy DESC, variant LIMIT 1"
    )
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.best(_accuracies(spark, sf_dir)).select(
        "model", rounded("accuracy").alias("accuracy")
    )


@query(
    _evaluation_sql(
        """
SELECT model, priority FROM (
    SELECT DISTINCT model, CAST(list_position(['tuned', 'west', 'south', 'north', 'base'], model) AS BIGINT)
        AS priority FROM responses)
ORDER BY priority LIMIT 1"""
    )
)
def fallback_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = ["tuned", *reversed(MODELS)]
    return evaluation.first_available(model_responses(spark, sf_dir), priority)


@query(
    _evaluation_sql(
        """
SELECT CAST(id AS VARCHAR) AS id, prediction AS ret FROM predictions
WHERE model = (SELECT model FROM accuracies ORDER BY accuracy DESC, variant LIMIT 1)"""
    )
)
def best_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All predictions of the most accurate model, as a result file."""
    winner = evaluation.best(_accuracies(spark, sf_dir)).select("model")
    rows = _predictions(spark, sf_dir).where(F.col("model") == winner.scalar())
    return submission(rows)
