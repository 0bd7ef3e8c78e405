"""Chat formatting with a reversible template, in DataFrame functions only.

A conversation is written as ``### role: text</turn>`` and a line end per turn.
Where a text or a role holds a mark of the template, a first plain rendering does
not read back as its source; such conversations are rendered again with those
strings escaped, and read back again, until the two are identical. The first
line names the rendering, so that a reader needs nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.llm.lines import bound

PLAIN, ESCAPED = "#plain\n", "#escaped\n"
TURN, END = "### ", "</turn>\n"
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"), (": ", "\\c"))
"""Control strings and what stands for them; the backslash comes first."""

TRAINED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TURN), role, F.lit(": "), text, F.lit(END))


def rendered(turns: Column, escape: bool) -> Column:
    """The text of an array of ``role, text``."""
    code = escaped if escape else lambda value: value
    return F.concat(F.lit(ESCAPED if escape else PLAIN), F.array_join(F.transform(turns, lambda t: _turn(code(t["role"]), code(t["text"]))), ""))


def pieces(formatted: Column) -> Column:
    """The turns of a formatted conversation as they are written, without their end marks."""
    body = F.substring_index(formatted, "\n", 1)
    rest = F.substr(formatted, F.length(body) + 2)
    parts = F.split(rest, "</turn>\n?", -1)
    return F.slice(parts, 1, F.size(parts) - 1)


def parsed(formatted: Column) -> Column:
    """``role, text`` of every turn; deterministic: role up to the first colon, text up to the first end.

    A turn with another turn mark inside does not follow the grammar; it has no text.
    """
    code = F.startswith(formatted, F.lit(ESCAPED))

    def one(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(TURN) + 1)), ": ", 1)
        text = F.substr(piece, F.length(role) + len(TURN) + 3)
        text = F.when(~F.contains(F.substr(piece, F.lit(len(TURN) + 1)), F.lit("###")), text)
        plain = [F.when(code, unescaped(value)).otherwise(value) for value in (role, text)]
        return F.struct(plain[0].alias("role"), plain[1].alias("text"))

    return F.transform(pieces(formatted), one)


def loss_spans(formatted: Column) -> Column:
    """``turn, start, length``: the characters of each trained turn's text in its written turn, from 0."""

    def one(piece: Column, i: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(TURN) + 1)), ": ", 1)
        start = F.length(role) + len(TURN) + 2
        trained = role == TRAINED_ROLE
        return F.when(trained, F.struct(i.alias("turn"), start.alias("start"), (F.length(piece) - start).alias("length")))

    return F.filter(F.transform(pieces(formatted), one), lambda span: span.isNotNull())


def formatted_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss_spans`` from ``conv_id, turn, role, text`` rows.

    Null roles and texts count as empty, null turns come first; turns of equal
    number follow by role, then text. Repeated rows are repeated turns. Rows of a
    null ``conv_id`` form one conversation. Other columns are ignored, an empty
    table gives none. A conversation is one row, so it has to fit a row.
    """
    clean = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    told = clean.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    told = told.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))
    plain = bound(rendered(F.col("turns"), False), lambda text: F.when(parsed(text) == F.col("turns"), text))
    again = bound(rendered(F.col("turns"), True), lambda text: F.when(parsed(text) == F.col("turns"), text))
    failed = F.raise_error(F.lit("a conversation does not read back as its source")).cast("string")
    done = told.select("conv_id", F.coalesce(plain, again, failed).alias("formatted"))
    return done.withColumn("loss_spans", loss_spans(F.col("formatted")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    code = F.startswith(formatted, F.lit(ESCAPED))

    def of(parts: Column) -> Column:
        def one(span: Column) -> Column:
            text = F.substr(parts[span["turn"]], span["start"] + 1, span["length"])
            return F.when(code, unescaped(text)).otherwise(text)

        return F.array_join(F.transform(spans, one), "")

    return bound(pieces(formatted), of)
