"""Whole numbers of any length as digits, in six-digit limbs of 64-bit numbers.

Steps hand digits on as text: in a lambda, Spark joins texts far faster than arrays.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abacist.functions.columns import computed_once

LIMB_DIGITS = 6
LIMB = 10**LIMB_DIGITS

# Multipliers and divisors have to be smaller: times a limb, they fit into 64 bits.
FACTOR_DIGITS = 12


def _limbs(digits: Column) -> Column:
    """Limbs of a number, the highest first."""

    def filled(digits: Column) -> Column:
        missing = F.pmod(-F.length(digits), F.lit(LIMB_DIGITS))
        return F.concat(F.repeat(F.lit("0"), missing), digits)

    def cut(filled: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(filled), F.lit(LIMB_DIGITS))
        return F.transform(
            starts, lambda start: F.substring(filled, start, F.lit(LIMB_DIGITS)).cast("bigint")
        )

    return computed_once(cut, computed_once(filled, digits))


def _padded(limb: Column) -> Column:
    return F.lpad(limb.cast("string"), LIMB_DIGITS, "0")


def _without_zeros(digits: Column) -> Column:
    return F.regexp_replace(digits, r"\A0+(?=\d)", "")


def _state(carry: Column, digits: Column) -> Column:
    return F.struct(carry.cast("bigint").alias("carry"), digits.alias("digits"))


def _times(digits: Column, factor: Column, more: Column) -> Column:
    """Digits of ``number * factor + more``, with leading zeros; ``more`` may be negative."""

    def step(state: Column, limb: Column) -> Column:
        value = limb * factor + state["carry"]
        low = F.pmod(value, F.lit(LIMB).cast("bigint"))
        return _state(
            F.call_function("div", value - low, F.lit(LIMB)), F.concat(_padded(low), state["digits"])
        )

    return F.aggregate(
        F.reverse(_limbs(digits)),
        _state(more, F.lit("")),
        step,
        lambda state: F.concat(state["carry"].cast("string"), state["digits"]),
    )


def _over(digits: Column, divisor: Column) -> Column:
    """Digits of the quotient, rounded down, with leading zeros."""

    def step(state: Column, limb: Column) -> Column:
        value = state["carry"] * LIMB + limb
        quotient = F.call_function("div", value, divisor)
        return _state(value % divisor, F.concat(state["digits"], _padded(quotient)))

    return F.aggregate(
        _limbs(digits), _state(F.lit(0), F.lit("")), step, lambda state: state["digits"]
    )


def scaled_digits(digits: Column, numerator: Column, divisor: Column) -> Column:
    """``digits * numerator / divisor``, rounded down, for digits of any length.

    Both others are positive bigints of at most twelve digits; a divisor of 0
    gives null.
    """

    def scaled(digits: Column, numerator: Column, divisor: Column) -> Column:
        quotient = _over(_times(digits, numerator, F.lit(0)), divisor)
        return F.when(divisor.isNotNull(), _without_zeros(quotient))

    divisor = F.nullif(divisor.cast("bigint"), F.lit(0).cast("bigint"))
    return computed_once(scaled, digits, numerator.cast("bigint"), divisor)


def moved_digits(digits: Column, by: Column) -> Column:
    """``digits + by`` for a positive number of any length and a small step."""
    return _without_zeros(_times(digits, F.lit(1).cast("bigint"), by))
