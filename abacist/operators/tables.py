"""Projections, fan-out and unions of the question, solution and pair tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.functions.chat import DEFAULT_INSTRUCTION, check_catalogue
from abacist.functions.text import is_blank
from abacist.operators.keyed import lookup_join

# Variants that fan_out() packs into one row.
BLOCK_VARIANTS = 1024


def optional(rows: DataFrame, column: str, default: str | None = None) -> Column:
    """A string column that may be missing or null."""
    found = F.col(column).cast("string") if column in rows.columns else F.lit(None).cast("string")
    return found if default is None else F.coalesce(found, F.lit(default))


def has_ground_truth(rows: DataFrame, column: str = "answer") -> bool:
    """Whether a table carries answers; reads the schema only."""
    return column in rows.columns


def column_types(rows: DataFrame) -> DataFrame:
    """Name and type of every column as a table."""
    return rows.sparkSession.createDataFrame(rows.dtypes, "column string, type string")


def solutions_from_preferences(
    preferences: DataFrame, instruction: str = DEFAULT_INSTRUCTION
) -> DataFrame:
    """Training solutions from the chosen side; blank ones are left out."""
    return preferences.where(~is_blank("chosen")).select(
        optional(preferences, "id", "").alias("id"),
        "question",
        F.col("answer").cast("string").alias("answer"),
        F.col("chosen").alias("cot"),
        optional(preferences, "instruction", instruction).alias("instruction"),
    )


def solution_text(rows: DataFrame) -> Column:
    """``cot``, or ``chosen`` where ``cot`` is missing or empty."""
    cot = F.nullif(optional(rows, "cot"), F.lit(""))
    return F.coalesce(cot, optional(rows, "chosen"), F.lit(""))


def not_augmented(rows: DataFrame) -> DataFrame:
    """Rows that are not copies of others."""
    if "augmented" not in rows.columns:
        return rows
    return rows.where(~F.coalesce(F.col("augmented"), F.lit(False)))


def fan_out(
    rows: DataFrame, variants: Sequence[Mapping[str, str]] | DataFrame, order: str = "variant"
) -> DataFrame:
    """Every row once per variant, with the variant's fields as columns.

    A list of variants (models, prompts) becomes an array literal that is
    exploded in place, without a join or a shuffle; ``order`` holds the position
    in the list. A table of variants of any length, with ``order`` as one of its
    columns, is packed into blocks of about a thousand: a row is repeated per
    block, meets it by a lookup and unpacks it, so that what is done is in
    proportion to the rows that come out.
    """
    if isinstance(variants, DataFrame):
        blocks = max(1, -(-variants.count() // BLOCK_VARIANTS))
        block = F.pmod(F.xxhash64(order), F.lit(blocks)).cast("int").alias("_block")
        packed = variants.groupBy(block).agg(F.collect_list(F.struct(*variants.columns)).alias("_variants"))
        asked = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        met = lookup_join(asked, packed, ["_block"], "inner")
        return met.select(*rows.columns, F.inline("_variants"))
    check_catalogue(variants)
    literal = F.array(
        *(
            F.struct(*(F.lit(value).alias(name) for name, value in variant.items()))
            for variant in variants
        )
    )
    return rows.select("*", F.posexplode(literal).alias(order, "_variant")).select(
        *rows.columns, order, "_variant.*"
    )


def copies(rows: DataFrame, count: int, index: str = "copy") -> DataFrame:
    """Every row ``count`` times, numbered from 0."""
    return rows.withColumn(index, F.explode(F.sequence(F.lit(0), F.lit(count - 1))))


def appended(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both tables; columns that one side lacks become null."""
    return first.unionByName(second, allowMissingColumns=True)


def solution_records(generated: DataFrame) -> DataFrame:
    """Training solutions of freshly generated pairs."""
    return generated.select(
        "id",
        "question",
        "answer",
        F.col("chosen").alias("cot"),
        optional(generated, "instruction", "").alias("instruction"),
        F.lit(False).alias("augmented"),
    )


def preference_records(generated: DataFrame) -> DataFrame:
    """Preference pairs of freshly generated pairs."""
    return generated.select("id", "question", "answer", "chosen", "rejected")


def paired_solutions(correct: DataFrame, wrong: DataFrame) -> DataFrame:
    """One row per id with both solutions; ids that lack one are left out."""
    return (
        correct.where(F.col("chosen").isNotNull())
        .join(wrong.where(F.col("rejected").isNotNull()).select("id", "rejected"), "id")
    )


def row_id(rows: DataFrame, id_column: str = "id", text: str = "question") -> DataFrame:
    """Ids as text; a missing one becomes a hash of the question, so it stays
    the same over restarts."""
    own = optional(rows, id_column)
    return rows.withColumn(id_column, F.coalesce(own, F.sha2(F.col(text), 256)))
