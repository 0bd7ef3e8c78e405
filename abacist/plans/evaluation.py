"""From responses to accuracy, ranking, best choice and result file."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abacist.constants import DEFAULT_SEED, EVALUATION_SAMPLE, FALLBACK_ANSWER
from abacist.functions.chat import (
    DEFAULT_PROMPT_TYPE,
    DEFAULT_PROMPTS,
    chat_text,
    messages,
    prompt_text,
)
from abacist.functions.scoring import numbers_agree
from abacist.functions.text import answer_value, extract_answer, strip
from abacist.operators.generation import batch_responses
from abacist.operators.keyed import lookup_join
from abacist.operators.ordering import seeded_sample
from abacist.operators.tables import fan_out, has_ground_truth
from abacist.sources.submission import submission

Load = Callable[[], Callable[[list[str]], list[str]]]


def predictions(responses: DataFrame, response: str = "response") -> DataFrame:
    """Responses with ``extracted`` and ``prediction``; a response without a
    number counts as the fallback answer."""
    extracted = responses.withColumn("extracted", extract_answer(response))
    filled = F.when(F.col("extracted") == "", F.lit(FALLBACK_ANSWER)).otherwise(
        F.col("extracted")
    )
    return extracted.withColumn("prediction", filled)


def unparsed_counts(extracted: DataFrame, by: Sequence[str]) -> DataFrame:
    """How many responses had no number, per group."""
    return extracted.groupBy(*by).agg(
        F.count_if(F.col("extracted") == "").alias("n_unparsed"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def with_truth(predicted: DataFrame, items: DataFrame) -> DataFrame:
    """Predictions joined to the answers of the items, which are unique by id.

    Adds ``truth``, ``exact`` (same text) and ``close`` (numbers within the
    tolerance). Answers are prepared once per item, before the join.
    """
    answers = items.select(
        "id",
        F.col("answer").alias("truth"),
        strip("answer").alias("_text"),
        answer_value("answer").alias("_value"),
    )
    exact = strip("prediction") == F.col("_text")
    close = numbers_agree(answer_value("prediction"), F.col("_value"))
    return (
        predicted.join(answers, "id")
        .withColumns({"exact": F.coalesce(exact, F.lit(False)), "close": close})
        .drop("_text", "_value")
    )


def accuracy(compared: DataFrame, by: Sequence[str]) -> DataFrame:
    """Share of exact and of close predictions per group."""
    share = {
        name: F.coalesce(F.avg(F.col(column).cast("double")), F.lit(0.0)).alias(name)
        for name, column in (("accuracy", "exact"), ("accuracy_close", "close"))
    }
    return compared.groupBy(*by).agg(
        F.count_if("exact").alias("n_correct"),
        F.count(F.lit(1)).alias("n_rows"),
        *share.values(),
    )


def ranked(accuracies: DataFrame, order: str = "variant") -> DataFrame:
    """Groups by accuracy, best first; ``order`` decides ties.

    The table has one row per model or prompt, so one task numbers it.
    """
    place = W.orderBy(F.desc("accuracy"), order)
    return accuracies.withColumn("place", F.row_number().over(place))


def with_gain(accuracies: DataFrame, base: str, name: str = "model") -> DataFrame:
    """Adds the accuracy difference to the base row; null without one."""
    base_accuracy = F.max(F.when(F.col(name) == base, F.col("accuracy"))).over(W.partitionBy())
    return accuracies.withColumn("gain", F.col("accuracy") - base_accuracy)


def best(accuracies: DataFrame, order: str = "variant") -> DataFrame:
    """The row with the highest accuracy, the first in ``order`` among equals."""
    return accuracies.orderBy(F.desc("accuracy"), order).limit(1)


def first_available(
    present: DataFrame, priority: Sequence[str], name: str = "model"
) -> DataFrame:
    """The first name of a priority list that occurs in ``present``."""
    names = F.array(*map(F.lit, priority))
    return (
        present.select(name)
        .distinct()
        .withColumn("priority", F.array_position(names, F.col(name)))
        .where(F.col("priority") > 0)
        .orderBy("priority")
        .limit(1)
    )


def only_available(
    rows: DataFrame, available: DataFrame | Sequence[str], name: str = "model"
) -> DataFrame:
    """Rows whose model exists: named in a list, or in a table of names."""
    if isinstance(available, DataFrame):
        return lookup_join(rows, available.select(name).distinct(), [name], "left_semi")
    return rows.where(F.col(name).isin(list(available)))


def variant_predictions(
    items: DataFrame,
    variants: Sequence[Mapping[str, str]],
    loaders: Mapping[str, Load],
    catalogue: Mapping[str, str] = DEFAULT_PROMPTS,
    batch_size: int = 16,
) -> DataFrame:
    """Predictions of every variant (``model`` and ``prompt_type``) for all items.

    Each model answers its own variants, since a task holds one model at a time;
    ``loaders`` gives them by name. Only the prompt and the keys pass through
    Python. The result depends on the models: write it before using it twice.
    """
    places = [{**variant, "place": str(n)} for n, variant in enumerate(variants)]
    parts = []
    for model in dict.fromkeys(variant["model"] for variant in variants):
        own = [variant for variant in places if variant["model"] == model]
        prompted = fan_out(items, own).select(
            "id",
            "model",
            "prompt_type",
            F.col("place").cast("int").alias("variant"),
            chat_text(
                messages(prompt_text("prompt_type", catalogue), "question"),
                generation_prompt=True,
            ).alias("prompt"),
        )
        answered = batch_responses(prompted, loaders[model], batch_size=batch_size)
        parts.append(predictions(answered.drop("prompt")).drop("response"))
    return reduce(DataFrame.unionByName, parts)


def variant_accuracy(predicted: DataFrame, items: DataFrame, base: str | None = None) -> DataFrame:
    """Ranked accuracy per variant, with the gain over the base model if named."""
    compared = with_truth(predicted, items)
    placed = ranked(accuracy(compared, ["model", "prompt_type", "variant"]))
    return placed if base is None else with_gain(placed, base)


def choose_and_submit(
    train: DataFrame,
    test: DataFrame,
    model_prompts: Mapping[str, str],
    loaders: Mapping[str, Load],
    prompt_types: Sequence[str],
    work_path: str,
    sample: int = EVALUATION_SAMPLE,
    seed: int = DEFAULT_SEED,
    catalogue: Mapping[str, str] = DEFAULT_PROMPTS,
    available: Sequence[str] | None = None,
    priority: Sequence[str] | None = None,
) -> tuple[str, str, DataFrame]:
    """Best model, best prompt type and their submission for ``test``.

    Models, each with its own prompt, are compared on a seeded sample of
    ``train``; the winner is then compared with itself under ``prompt_types``.
    Only models named in ``available`` take part, see
    :func:`~abacist.sources.selection.existing_names`. Without answers in
    ``train`` the first available model of ``priority`` (the last named one
    without a list) and the default prompt are taken. Predictions are written
    under ``work_path`` before they are compared.
    """
    spark = train.sparkSession
    if available is not None:
        model_prompts = {m: p for m, p in model_prompts.items() if m in available}
    if not model_prompts:
        raise ValueError("no model is available")
    if has_ground_truth(train):
        items = seeded_sample(train, sample, seed=seed)

        def winner(variants: list[dict[str, str]], name: str):
            variant_predictions(items, variants, loaders, catalogue).write.mode(
                "overwrite"
            ).parquet(f"{work_path}/{name}")
            predicted = spark.read.parquet(f"{work_path}/{name}")
            return best(variant_accuracy(predicted, items)).first()

        by_model = [{"model": m, "prompt_type": p} for m, p in model_prompts.items()]
        model = winner(by_model, "models")["model"]
        by_prompt = [{"model": model, "prompt_type": p} for p in prompt_types]
        prompt_type = winner(by_prompt, "prompts")["prompt_type"]
    else:
        order = [m for m in priority or () if m in model_prompts]
        model = (order or [*reversed(model_prompts)])[0]
        prompt_type = DEFAULT_PROMPT_TYPE
    chosen = [{"model": model, "prompt_type": prompt_type}]
    final = variant_predictions(test, chosen, loaders, catalogue)
    return model, prompt_type, submission(final)
