"""Token features and message pairs of the training sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abacist.constants import DEFAULT_SEED, IGNORED_LABEL, TURN_END, TURN_START
from abacist.functions.chat import (
    DEFAULT_INSTRUCTION,
    DEFAULT_PROMPTS,
    DEFAULT_STEP_REQUEST,
    chat_text,
    message,
    messages,
)
from abacist.functions.features import (
    Tokenizer,
    after_prefix,
    code_points,
    label_mask,
    ones,
    padded,
    truncated,
)
from abacist.functions.hashing import hash32
from abacist.functions.text import (
    extract_answer,
    marked_token,
    repaired_answer_lines,
    strip,
    with_answer_line,
)
from abacist.operators.keyed import with_group_stats
from abacist.operators.tables import optional, solution_text


# Lengths that share a batch, and rows that one task numbers.
LENGTHS_PER_BUCKET = 32
ROWS_PER_SLICE = 100_000


def _features(tokens: DataFrame, max_length: int, keep: Sequence[str]) -> DataFrame:
    """Features of rows with ``_ids`` and ``_prefix_length``: the prefix is
    masked in the labels, and all arrays are cut to ``max_length``."""
    labels = label_mask(F.col("_prefix_length"), after_prefix("_ids", "_prefix_length"))
    return tokens.select(
        *keep,
        truncated("_ids", max_length).alias("input_ids"),
        truncated(labels, max_length).alias("labels"),
        (F.col("_prefix_length") >= max_length).alias("fully_masked"),
    ).withColumn("attention_mask", ones("input_ids"))


def solution_features(
    solutions: DataFrame,
    max_length: int = 512,
    tokenizer: Tokenizer = code_points,
    instruction: str = DEFAULT_INSTRUCTION,
    step_request: str = DEFAULT_STEP_REQUEST,
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """Features of worked solutions: three segments, only the last one learnt.

    Every part is tokenized on its own. ``fully_masked`` marks rows whose prefix
    alone fills ``max_length``.
    """
    system = F.concat(
        optional(solutions, "instruction", instruction), F.lit(f" {step_request}")
    )
    solution = with_answer_line(solution_text(solutions), F.col("answer").cast("string"))
    start, end = tokenizer(F.lit(TURN_START)), tokenizer(F.lit(TURN_END))
    prefix = F.concat(
        start, tokenizer(system), end, start, tokenizer(F.col("question")), end, start
    )
    tokens = solutions.select(
        *keep, prefix.alias("_prefix"), F.concat(tokenizer(solution), end).alias("_target")
    ).select(
        *keep,
        F.concat("_prefix", "_target").alias("_ids"),
        F.size("_prefix").alias("_prefix_length"),
    )
    return _features(tokens, max_length, keep)


def answer_features(
    rows: DataFrame,
    max_length: int = 384,
    tokenizer: Tokenizer = code_points,
    instruction: str = DEFAULT_PROMPTS["standard"],
    keep: Sequence[str] = ("id",),
) -> DataFrame:
    """Features of plain question and answer rows in chat form.

    The conversation is tokenized as a whole; the mask covers as many ids as
    the opened prompt alone has.
    """
    system = optional(rows, "instruction", instruction)
    prompt = chat_text(messages(system, "question"), generation_prompt=True)
    whole = chat_text(messages(system, "question", "answer"))
    tokens = rows.select(
        *keep,
        tokenizer(whole).alias("_ids"),
        F.size(tokenizer(prompt)).alias("_prefix_length"),
    )
    return _features(tokens, max_length, keep)


def preference_pairs(
    preferences: DataFrame, system: str = DEFAULT_PROMPTS["sft"], keep: Sequence[str] = ()
) -> DataFrame:
    """``prompt``, ``chosen`` and ``rejected`` message lists with answer lines."""
    chosen = repaired_answer_lines("chosen", F.col("answer").cast("string"))
    rejected = repaired_answer_lines("rejected", marked_token("rejected"))
    return preferences.select(
        *keep,
        messages(F.lit(system), "question").alias("prompt"),
        F.array(message("assistant", chosen)).alias("chosen"),
        F.array(message("assistant", rejected)).alias("rejected"),
    )


def rollout_prompts(rows: DataFrame, system: str = DEFAULT_PROMPTS["grpo"]) -> DataFrame:
    """Rendered prompts that open the assistant's turn."""
    return rows.select(
        chat_text(messages(F.lit(system), "question"), generation_prompt=True).alias("prompt"),
        "question",
        F.col("answer").cast("string").alias("answer"),
        optional(rows, "id").alias("id"),
    )


def suffix_quality(solutions: DataFrame) -> DataFrame:
    """How many solutions read back as another answer after
    :func:`~abacist.functions.text.with_answer_line`."""
    answer = F.col("answer").cast("string")
    read_back = extract_answer(with_answer_line(solution_text(solutions), answer))
    return solutions.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(read_back != strip(answer)).alias("n_differs"),
    )


def assigned_batches(
    features: DataFrame,
    batch_size: int,
    id_column: str = "id",
    array: str = "input_ids",
    lengths_per_bucket: int = LENGTHS_PER_BUCKET,
    rows_per_slice: int = ROWS_PER_SLICE,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Adds ``bucket``, ``slice`` and ``batch``: rows of similar length in a seeded
    order, ``batch_size`` at a time.

    A bucket is numbered in slices of about ``rows_per_slice`` rows, given by a
    hash of the id, so that one length may have any number of rows. The last
    batch of a slice may be smaller. A null array counts as empty.
    """
    length = F.coalesce(F.size(array), F.lit(0))
    ordered = features.withColumn("bucket", F.ceil(length / lengths_per_bucket).cast("int"))
    ordered = ordered.withColumn("_order", hash32(id_column, seed=seed))
    # one row per bucket: no more than the longest array has lengths
    counts = ordered.groupBy("bucket").agg(F.count(F.lit(1)).alias("_rows"))
    slices = counts.select("bucket", F.ceil(F.col("_rows") / rows_per_slice).alias("_slices"))
    sliced = ordered.join(slices, "bucket").withColumn("slice", F.pmod("_order", "_slices").cast("int"))
    place = F.row_number().over(W.partitionBy("bucket", "slice").orderBy("_order", id_column))
    batch = F.floor((place - 1) / batch_size).cast("int")
    return sliced.withColumn("batch", batch).drop("_order", "_slices")


def pad_batches(
    features: DataFrame,
    batch: Sequence[str],
    fillers: dict[str, int] | None = None,
) -> DataFrame:
    """Arrays filled up on the right to the longest row of their batch.

    ``fillers`` gives the filler per array column; ids and masks are filled
    with 0 and labels with the ignored label unless stated otherwise.
    """
    if fillers is None:
        defaults = {"input_ids": 0, "attention_mask": 0, "labels": IGNORED_LABEL}
        fillers = {c: f for c, f in defaults.items() if c in features.columns}
    widest = {"_width": F.max(F.greatest(*map(F.size, fillers), F.lit(0)))}
    return (
        with_group_stats(features, batch, widest)
        .withColumns({c: padded(c, "_width", f) for c, f in fillers.items()})
        .withColumnRenamed("_width", "width")
    )
