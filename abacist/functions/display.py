"""Numbers as text with a fixed count of decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abacist.functions.columns import ColumnLike, as_column

_HIGH_PART = float(1 << 26)


def fixed_decimals(value: ColumnLike, digits: int) -> Column:
    """A double with ``digits`` decimals, exact ties to the even digit.

    ``format_string`` rounds the shortest decimal form half up, which differs
    on values such as 0.25 or 0.15. Here the fraction is split into a high part
    whose product with ``10**digits`` is exact and a small rest, so that the
    comparison with one half is exact as well.
    """
    value = as_column(value).cast("double")
    size = F.abs(value)
    scale = 10**digits
    whole = F.floor(size)
    fraction = size - whole
    high = F.floor(fraction * _HIGH_PART) / F.lit(_HIGH_PART)
    rest = (fraction - high) * F.lit(float(scale))
    shifted = high * F.lit(float(scale))
    floor = F.floor(shifted)
    half = F.lit(0.5) - (shifted - floor)
    up = (rest > half) | ((rest == half) & (F.pmod(floor, F.lit(2)) == 1))
    units = whole * F.lit(scale) + floor + up.cast("bigint")
    sign = F.when(value < 0, "-").otherwise("")
    left = F.pmod(units, F.lit(scale))
    integer = ((units - left) / F.lit(scale)).cast("bigint").cast("string")
    if not digits:
        return F.concat(sign, integer)
    return F.concat(sign, integer, F.lit("."), F.lpad(left.cast("string"), digits, "0"))


def duration_text(seconds: ColumnLike) -> Column:
    """Seconds as ``12.3s``, ``4.5m`` or ``1.2h``."""
    seconds = as_column(seconds).cast("double")
    return (
        F.when(seconds < 60, F.concat(fixed_decimals(seconds, 1), F.lit("s")))
        .when(seconds < 3600, F.concat(fixed_decimals(seconds / 60, 1), F.lit("m")))
        .otherwise(F.concat(fixed_decimals(seconds / 3600, 1), F.lit("h")))
    )


def percent_text(share: ColumnLike, signed: bool = False) -> Column:
    """A share as percentage with two decimals; ``signed`` marks gains."""
    share = as_column(share)
    text = F.concat(fixed_decimals(share * 100, 2), F.lit("%"))
    if signed:
        text = F.concat(F.when(share > 0, "+").otherwise(""), text)
    return text
