"""Answer and number handling on solution texts.

All patterns carry ``(?U)`` so that ``\\d`` and ``\\s`` also cover full-width
digits and the ideographic space, which occur in the question banks.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from abacist.constants import (
    ANSWER_LABEL,
    ANSWER_MARKER,
    EQUATION_CLASSES,
    FALLBACK_ANSWER,
    INTEGER,
    NON_SPACE,
    SIGNED_NUMBER,
    SPACE,
    UNSIGNED_NUMBER,
)
from abacist.functions.columns import ColumnLike, as_column, last_match


def _decimal_digits() -> tuple[str, str]:
    """Every non-ASCII decimal digit and the ASCII digit it stands for."""
    digits = [
        chr(code)
        for code in range(0x80, sys.maxunicode + 1)
        if unicodedata.category(chr(code)) == "Nd"
    ]
    return "".join(digits), "".join(str(unicodedata.decimal(d)) for d in digits)


_DIGITS_FROM, _DIGITS_TO = _decimal_digits()


def fold_digits(text: ColumnLike) -> Column:
    """Decimal digits of any script as ASCII digits."""
    return F.translate(as_column(text), _DIGITS_FROM, _DIGITS_TO)


def strip(text: ColumnLike) -> Column:
    """Text without leading and trailing white space of any kind.

    The look-behind keeps long runs of blanks inside a text from being tried
    again from each of their positions.
    """
    return F.regexp_replace(
        as_column(text), rf"(?U)\A{SPACE}+|(?<!{SPACE}){SPACE}+\z", ""
    )


def is_blank(text: ColumnLike) -> Column:
    """True for null, empty and all-white-space text."""
    return F.coalesce(~as_column(text).rlike(f"(?U){NON_SPACE}"), F.lit(True))


def has_marker(text: ColumnLike, marker: str = ANSWER_MARKER) -> Column:
    """Whether the text holds an answer marker."""
    return as_column(text).rlike(marker)


def extract_answer(
    text: ColumnLike, which: str = "first", marker: str = ANSWER_MARKER
) -> Column:
    """The number behind the answer marker, else the last number, else ''.

    ``which="last"`` reads the last marker instead of the first, for texts that
    correct themselves.
    """
    text = as_column(text)
    pattern = f"(?U){marker}{SPACE}*({SIGNED_NUMBER})"
    if which == "first":
        marked = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    elif which == "last":
        marked = last_match(text, pattern, 1)
    else:
        raise ValueError(f"which must be 'first' or 'last', not {which!r}")
    anywhere = last_match(text, f"(?U)({SIGNED_NUMBER})", 1)
    return F.coalesce(marked, anywhere, F.lit(""))


def _to_double(text: Column) -> Column:
    """A number in the grammar of a decimal literal; anything else is null."""
    grammar = r"(?i)[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?(inf|infinity|nan)"
    plain = fold_digits(strip(text))
    return F.when(plain.rlike(rf"\A(?:{grammar})\z"), plain.try_cast("double"))


def answer_value(text: ColumnLike, marker: str = ANSWER_MARKER) -> Column:
    """The number :func:`extract_answer` finds, as double; null without one.

    What it finds is a plain decimal by its pattern, so none of the checks of
    :func:`parse_number` are needed.
    """
    return fold_digits(extract_answer(text, marker=marker)).try_cast("double")


def parse_number(text: ColumnLike) -> Column:
    """A decimal number or a fraction ``a/b`` as double.

    Null for empty text, division by zero, more than one slash, or no number.
    """
    text = as_column(text)
    parts = F.split(text, "/")
    numerator = _to_double(parts[0])
    denominator = _to_double(F.try_element_at(parts, F.lit(2)))
    return F.when(F.size(parts) == 1, numerator).when(
        F.size(parts) == 2, F.try_divide(numerator, denominator)
    )


def parse_integer(text: ColumnLike) -> Column:
    """A whole number as bigint; null for anything else."""
    plain = strip(text)
    return F.when(
        plain.rlike(r"(?U)\A[+-]?\d+\z"), fold_digits(plain).try_cast("bigint")
    )


def integer_strings(text: ColumnLike) -> Column:
    """All unsigned whole numbers of a text, as written."""
    return F.regexp_extract_all(as_column(text), F.lit(f"(?U)({INTEGER})"), F.lit(1))


def integers(text: ColumnLike) -> Column:
    """All unsigned whole numbers as ``array<struct<text, value>>``."""
    return F.transform(
        integer_strings(text),
        lambda t: F.struct(
            t.alias("text"), fold_digits(t).try_cast("bigint").alias("value")
        ),
    )


def plain_integer(digits: Column) -> Column:
    """A run of digits without leading zeros, in ASCII, of any length."""
    return F.regexp_replace(fold_digits(digits), r"\A0+(?=\d)", "")


def _equation(operator: str) -> str:
    gap = f"{SPACE}*"
    return f"(?U)({INTEGER}){gap}({operator}){gap}({INTEGER}){gap}={gap}({INTEGER})"


def stated_result(solution: ColumnLike, marker: str = ANSWER_MARKER) -> Column:
    """The result a solution states, as text of a whole number.

    It is the right-hand side of the last equation of the last equation class
    that occurs at all; without any equation, the number behind the marker.
    Nothing is recomputed: see :func:`equation_holds`.
    """
    solution = as_column(solution)
    stated = [
        last_match(solution, _equation(operator), 4)
        for _, operator in reversed(EQUATION_CLASSES)
    ]
    marked = F.nullif(
        F.regexp_extract(solution, f"(?U){marker}{SPACE}*({INTEGER})", 1), F.lit("")
    )
    return plain_integer(F.coalesce(*stated, marked))


def equation_holds(solution: ColumnLike) -> Column:
    """Whether the equation behind :func:`stated_result` is arithmetically true.

    Null when the solution states no equation.
    """
    solution = as_column(solution)
    checks = []
    for name, operator in reversed(EQUATION_CLASSES):
        pattern = _equation(operator)
        left, sign, right, result = (
            last_match(solution, pattern, group) for group in (1, 2, 3, 4)
        )
        a, b, c = (
            fold_digits(side).try_cast("decimal(38,0)") for side in (left, right, result)
        )
        if name == "multiply":
            holds = F.try_multiply(a, b) == c
        elif name == "divide":
            holds = (b != 0) & (F.try_multiply(b, c) == a)
        else:
            holds = F.when(sign == "+", F.try_add(a, b) == c).otherwise(
                F.try_subtract(a, b) == c
            )
        checks.append((result.isNotNull(), holds))
    verdict = F.when(*checks[0])
    for found, holds in checks[1:]:
        verdict = verdict.when(found, holds)
    return verdict


def replace_first(text: Column, old: Column, new: Column) -> Column:
    """``text`` with the first occurrence of ``old`` replaced."""
    at = F.instr(text, old)
    return F.when(
        at > 0,
        F.concat(
            F.substring(text, F.lit(1), at - 1),
            new,
            F.substring(text, at + F.char_length(old), F.char_length(text)),
        ),
    ).otherwise(text)


def replace_numbers(
    text: ColumnLike, pairs: ColumnLike, whole_number: bool = False
) -> Column:
    """Apply ``array<struct<old, new>>`` replacements one after the other.

    Each step replaces the first occurrence in the text as left by the step
    before, also inside a longer number; ``whole_number=True`` only matches
    numbers that stand alone.
    """

    def step(done: Column, pair: Column) -> Column:
        old, new = pair["old"].cast("string"), pair["new"].cast("string")
        if not whole_number:
            return replace_first(done, old, new)
        at = F.regexp_instr(done, F.concat(F.lit(r"(?<!\d)"), old, F.lit(r"(?!\d)")))
        return F.when(
            at > 0,
            F.concat(
                F.substring(done, F.lit(1), at - 1),
                new,
                F.substring(done, at + F.char_length(old), F.char_length(done)),
            ),
        ).otherwise(done)

    return F.aggregate(as_column(pairs), as_column(text), step)


def with_answer_line(
    solution: ColumnLike,
    answer: ColumnLike,
    marker: str = ANSWER_MARKER,
    label: str = ANSWER_LABEL,
) -> Column:
    """A solution that ends in its answer.

    Kept when a marker is present, when its last number already is the answer or
    when there is no answer; otherwise an answer line is added. A null solution
    counts as empty.
    """
    solution, answer = F.coalesce(as_column(solution), F.lit("")), as_column(answer)
    last_number = last_match(solution, f"(?U)({UNSIGNED_NUMBER})", 1)
    settled = (
        has_marker(solution, marker)
        | F.coalesce(last_number == strip(answer), F.lit(False))
        | answer.isNull()
    )
    return F.when(settled, solution).otherwise(
        F.concat(solution, F.lit("\n" + label), answer)
    )


def repaired_answer_lines(
    text: ColumnLike,
    answer: ColumnLike,
    marker: str = ANSWER_MARKER,
    label: str = ANSWER_LABEL,
) -> Column:
    """A text whose answer lines all carry ``answer``.

    Kept untouched when the first answer line is right already or when there is
    no answer; otherwise every answer line is rewritten, and one is added when
    there is none. A null text counts as empty.
    """
    text, answer = F.coalesce(as_column(text), F.lit("")), as_column(answer)
    body = strip(text)
    # (?d) keeps "\n" the only line end for "$"
    line = rf"(?dmU){marker}{SPACE}*[\S\s]*?{SPACE}*$"
    first_line = F.regexp_extract(body, line, 0)
    stated = strip(F.substring_index(F.substring_index(first_line, "：", -1), ":", -1))
    # "\" and "$" are special in a replacement text
    literal = F.regexp_replace(F.concat(F.lit(label), answer), r"([\\$])", r"\\$1")
    return (
        F.when(answer.isNull(), text)
        .when(~has_marker(body, marker), F.concat(body, F.lit("\n" + label), answer))
        .when(stated == strip(answer), text)
        .otherwise(F.regexp_replace(body, F.lit(line), literal))
    )


def marked_token(text: ColumnLike, marker: str = ANSWER_MARKER) -> Column:
    """The first token behind the marker, ``"0"`` without one."""
    token = F.regexp_extract(
        as_column(text), f"(?U){marker}{SPACE}*({NON_SPACE}+)", 1
    )
    return F.coalesce(F.nullif(token, F.lit("")), F.lit(FALLBACK_ANSWER))


def joined_text(value: ColumnLike) -> Column:
    """Text of a VARIANT that holds a string or an array of strings."""
    value = as_column(value)
    parts = F.try_variant_get(value, "$", "array<string>")
    is_array = F.schema_of_variant(value).startswith("ARRAY<")
    return F.when(is_array, F.array_join(parts, "")).otherwise(
        F.try_variant_get(value, "$", "string")
    )


def preview(text: ColumnLike, length: int) -> Column:
    """The first ``length`` characters for display."""
    return F.substring(as_column(text), 1, length)
