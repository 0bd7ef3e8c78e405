"""Number substitution: new questions with new answers from solved ones.

Draws come from a hash of (id, copy, purpose), so results do not change with
retries or partitioning. Everything is map-only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.constants import DEFAULT_SEED, FACTOR_HIGH, FACTOR_LOW, SUBSTITUTED_NUMBERS
from abacist.functions.columns import ColumnLike, as_column, computed_once
from abacist.functions.hashing import HASH_RANGE, hash32
from abacist.functions.limbs import FACTOR_DIGITS, moved_digits, scaled_digits
from abacist.functions.text import (
    equation_holds,
    fold_digits,
    integer_strings,
    plain_integer,
    replace_numbers,
    stated_result,
    strip,
)
from abacist.operators.generation import failed, generated_pairs, solution_requests, succeeded
from abacist.operators.keyed import rows_to_do
from abacist.operators.ordering import first_rows
from abacist.operators.tables import (
    appended,
    copies,
    not_augmented,
    optional,
    preference_records,
    row_id,
    solution_records,
)
from abacist.session import shared_folder
from abacist.sources.selection import finished
from abacist.sources.versions import publish, versioned_table

# Numbers of up to so many digits are scaled in double precision, like those of a
# question of everyday numbers; longer ones digit by digit, without rounding.
WORD_DIGITS = 18

_FACTOR_STEPS = 2
_LOW_STEPS, _WIDTH_STEPS = round(FACTOR_LOW * _FACTOR_STEPS), round((FACTOR_HIGH - FACTOR_LOW) * _FACTOR_STEPS)


def substituted_value(value: Column, factor_draw: Column, sign_draw: Column) -> Column:
    """``value`` times a factor between the bounds, at least 1; moved by one
    when that would leave it as it is."""
    factor = F.lit(FACTOR_LOW) + F.lit(FACTOR_HIGH - FACTOR_LOW) * (
        factor_draw / F.lit(float(HASH_RANGE))
    )
    scaled = F.greatest(F.lit(1).cast("bigint"), F.floor(value * factor))
    moved = scaled + F.when(F.pmod(sign_draw, F.lit(2)) == 0, F.lit(-1)).otherwise(F.lit(1))
    return F.when(scaled == value, F.greatest(F.lit(1).cast("bigint"), moved)).otherwise(scaled)


def substituted_digits(digits: Column, factor_draw: Column, sign_draw: Column) -> Column:
    """A whole number of any length as text, substituted like :func:`substituted_value`."""

    def moved(scaled: Column, digits: Column) -> Column:
        sign = F.when(F.pmod(sign_draw, F.lit(2)) == 0, F.lit(-1)).otherwise(F.lit(1))
        return F.when(scaled == digits, moved_digits(digits, sign)).otherwise(scaled)

    def substituted(digits: Column) -> Column:
        value = digits.try_cast("bigint")
        short = computed_once(
            lambda value, draw: substituted_value(value, draw, sign_draw), value, factor_draw
        ).cast("string")
        numerator = F.lit(_LOW_STEPS * HASH_RANGE) + F.lit(_WIDTH_STEPS) * factor_draw
        scaled = scaled_digits(digits, numerator, F.lit(_FACTOR_STEPS * HASH_RANGE))
        long = computed_once(moved, scaled, digits)
        return F.when(F.length(digits) <= WORD_DIGITS, short).otherwise(long)

    return computed_once(substituted, digits)


def with_substitutions(
    rows: DataFrame, question: str = "question", seed: int = DEFAULT_SEED
) -> DataFrame:
    """Adds ``substitutions``: ``array<struct<old, new>>`` of digits for two numbers of
    the question, drawn by ``id`` and ``copy``.

    The second draw wins when both have the same value. A question of fewer than
    two numbers has none.
    """

    def draw(purpose: str) -> Column:
        return hash32("id", F.concat(F.col("copy").cast("string"), F.lit(f":{purpose}")), seed)

    def pair(at: str, number: int) -> Column:
        digits = F.get(F.col("_numbers"), F.col(at).cast("int"))
        new = substituted_digits(digits, draw(f"factor{number}"), draw(f"sign{number}"))
        return F.struct(digits.alias("old"), new.alias("new"))

    count = F.size("_numbers")
    count = F.when(count >= SUBSTITUTED_NUMBERS, count)
    drawn = (
        rows.withColumn("_numbers", F.transform(integer_strings(question), plain_integer))
        .withColumn("_at1", F.pmod(draw("position1"), count))
        .withColumn(
            "_at2", F.pmod(F.col("_at1") + 1 + F.pmod(draw("position2"), count - 1), count)
        )
        .withColumns({"_pair1": pair("_at1", 1), "_pair2": pair("_at2", 2)})
    )
    both = F.when(
        F.col("_pair1.old") == F.col("_pair2.old"), F.array("_pair2")
    ).otherwise(F.array("_pair1", "_pair2"))
    drawn_pairs = F.filter(both, lambda p: p["old"].isNotNull())
    return drawn.withColumn("substitutions", F.coalesce(drawn_pairs, F.array())).drop(
        "_numbers", "_at1", "_at2", "_pair1", "_pair2"
    )


def ratio_answer(answer: ColumnLike, substitutions: ColumnLike) -> Column:
    """The old answer scaled by the last substitution, at least 0, as digits.

    Null when the answer is no whole number or the substituted value was 0. If a
    number has more than 18 digits, the ratio is that of the first twelve digits
    of both values (of the longer one; as many places go from the other), and the
    answer is multiplied without rounding.
    """

    def scaled_answer(plain: Column, digits: Column, last: Column) -> Column:
        old, new = last["old"], last["new"]
        ratio = F.try_divide(new.cast("double"), old.cast("double"))
        short = (plain.try_cast("bigint") * ratio).try_cast("bigint")
        # null stays null: greatest() alone would skip it
        short = F.when(short.isNotNull(), F.greatest(F.lit(0).cast("bigint"), short)).cast("string")

        cut = F.greatest(F.length(old), F.length(new), F.lit(FACTOR_DIGITS)) - FACTOR_DIGITS
        head = lambda value: F.left(value, F.length(value) - cut).try_cast("bigint")
        long = computed_once(
            lambda scaled: F.when(plain.startswith("-") & scaled.isNotNull(), "0").otherwise(scaled),
            scaled_digits(digits, head(new), head(old)),
        )
        fits = F.greatest(F.length(digits), F.length(old), F.length(new)) <= WORD_DIGITS
        return F.when(fits, short).otherwise(long)

    def of_whole_number(plain: Column, last: Column) -> Column:
        plain = F.when(plain.rlike(r"\A[+-]?\d+\z"), plain)
        digits = F.regexp_replace(plain, r"\A[+-]?0*(?=\d)", "")
        return computed_once(scaled_answer, plain, digits, last)

    last = F.try_element_at(as_column(substitutions), F.lit(-1))
    return computed_once(of_whole_number, fold_digits(strip(answer)), last)


def augmented_copies(
    solutions: DataFrame,
    per_row: int = 2,
    seed: int = DEFAULT_SEED,
    whole_number: bool = False,
    check_equations: bool = False,
) -> DataFrame:
    """Copies of solved questions with other numbers.

    Rows that are copies already or have fewer than two numbers give none, and
    a copy without any answer is left out. ``check_equations`` adds
    ``equation_ok``: whether the stated equation is true for the new numbers.
    """
    eligible = not_augmented(solutions).where(
        F.size(integer_strings("question")) >= SUBSTITUTED_NUMBERS
    )
    replaced = (
        copies(eligible, per_row)
        .transform(with_substitutions, seed=seed)
        .withColumns(
            {
                "_question": replace_numbers("question", "substitutions", whole_number),
                "_cot": replace_numbers("cot", "substitutions", whole_number),
            }
        )
    )
    answer = F.coalesce(stated_result("_cot"), ratio_answer("answer", "substitutions"))
    # one row or none; a filter on the answer would be pushed below the
    # substitutions and have all of them computed twice
    answered = F.explode(F.array_compact(F.array(answer)))
    columns = [
        F.concat(F.col("id").cast("string"), F.lit("_aug"), F.col("copy")).alias("id"),
        F.col("_question").alias("question"),
        F.col("_answer").alias("answer"),
        F.col("_cot").alias("cot"),
        optional(solutions, "instruction", "").alias("instruction"),
        F.lit(True).alias("augmented"),
        F.col("id").cast("string").alias("original_id"),
    ]
    if check_equations:
        columns.append(equation_holds("_cot").alias("equation_ok"))
    return replaced.withColumn("_answer", answered).select(*columns)


def with_augmented_copies(solutions: DataFrame, per_row: int = 2, **options) -> DataFrame:
    """The solutions and their augmented copies in one table."""
    originals = solutions.withColumn("id", F.col("id").cast("string"))
    return appended(originals, augmented_copies(solutions, per_row, **options))


def augmentation_growth(combined: DataFrame) -> DataFrame:
    """Rows before, added and after."""
    is_copy = F.coalesce(F.col("augmented"), F.lit(False))
    return combined.agg(
        F.count_if(~is_copy).alias("n_before"),
        F.count_if(is_copy).alias("n_added"),
        F.count(F.lit(1)).alias("n_after"),
    )


def rejects_path(generated_path: str) -> str:
    """Where questions stay whose calls failed in the last run."""
    return f"{generated_path.rstrip('/')}-rejects"


def build_training_tables(
    spark: SparkSession,
    questions: DataFrame,
    load: Callable[[], Callable[[str, str], str]],
    generated_path: str,
    final_path: str,
    sequence: str = "id",
    max_samples: int | None = None,
    resume: bool = True,
    per_row: int = 2,
    **generation,
) -> tuple[DataFrame, DataFrame]:
    """Generate what is missing, append it, augment, write.

    Returns the final solutions and the preference pairs. Both come from one
    table of generated pairs, so a lost run never leaves one without the other.
    Answers are written once before they are used; what failed in this run goes
    to :func:`rejects_path` with its error.
    """
    rows = row_id(first_rows(questions, max_samples, sequence))
    if resume and finished(spark, generated_path):
        rows = rows_to_do(rows, spark.read.parquet(generated_path))
    answers = shared_folder(spark, "answers")
    generated_pairs(solution_requests(rows), load, **generation).write.parquet(answers)
    generated = spark.read.parquet(answers)
    generated.transform(failed).write.mode("overwrite").parquet(rejects_path(generated_path))
    generated.transform(succeeded).write.mode("append" if resume else "overwrite").parquet(
        generated_path
    )
    pairs = spark.read.parquet(generated_path)
    with_augmented_copies(solution_records(pairs), per_row).write.mode("overwrite").parquet(
        final_path
    )
    return spark.read.parquet(final_path), preference_records(pairs)


def publish_training_tables(
    spark: SparkSession,
    questions: DataFrame,
    load: Callable[[], Callable[[str, str], str]],
    root: str,
    sequence: str = "id",
    max_samples: int | None = None,
    resume: bool = True,
    per_row: int = 2,
    **generation,
) -> tuple[DataFrame, DataFrame]:
    """As :func:`build_training_tables`, with all tables below ``root`` changed in one step.

    ``generated``, ``final`` and ``rejects`` are tables of one version, see
    :mod:`abacist.sources.versions`: a run that is lost at any point leaves the
    version before it whole. Only new pairs are augmented and written, as copies
    do not depend on other rows; rejects are those of the last run.
    """
    rows = row_id(first_rows(questions, max_samples, sequence))
    before = versioned_table(spark, root, "generated") if resume else None
    if before is not None:
        rows = rows_to_do(rows, before)
    answers = shared_folder(spark, "answers")
    generated_pairs(solution_requests(rows), load, **generation).write.parquet(answers)
    generated = spark.read.parquet(answers)
    pairs = generated.transform(succeeded)
    tables = {
        "generated": pairs,
        "final": with_augmented_copies(solution_records(pairs), per_row),
        "rejects": generated.transform(failed),
    }
    publish(spark, root, tables, replaced=("rejects",) if resume else tuple(tables))
    return versioned_table(spark, root, "final"), preference_records(versioned_table(spark, root, "generated"))
