"""Removal of repeated runs of lines by winnowing, in DataFrame functions only.

Every window of three lines selects the smallest of its line hashes, so a run of
three or more lines that occurs twice has a selected line in common. Selected
lines are joined to the first place that has the same line, and these matches are
extended line by line, first back to the start of the window, then on to its end.
Of places that a step leaves with the same lines the first one leads, so a place
that does not go on like its leader is matched with the first one that does. What
is matched to its end and does not lead is a later copy; such windows overlap to
the whole repeated run.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.llm.components import joined, saved

WINDOW = 3
"""Lines of a window: shorter repeated runs stay, unless words count too."""

WORDS = 25
"""Words that make a run of fewer lines count, where words do."""


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also inside array functions."""
    return F.transform(F.array(value), use)[0]


def _lines(text: Column | str) -> Column:
    return F.split(text, "\n", -1)


def _filled(lines: Column) -> Column:
    """Places of the lines that are not blank."""
    places = F.transform(lines, lambda line, i: F.when(F.length(F.trim(line)) > 0, i))
    return F.filter(places, lambda i: i.isNotNull())


def _places(lines: Column, window: int, words: int | None) -> Column:
    """For each line that is not blank its number, and ``near``: it and ``window - 1`` lines on both sides, null where none is."""

    def told(line: Column) -> Column:
        said = F.lit(0) if words is None else F.regexp_count(line, F.lit(r"\S+"))
        return F.struct(F.xxhash64(line).alias("h"), F.xxhash64(F.lit(window), line).alias("g"), said.alias("said"))

    def around(full: Column) -> Column:
        def one(_: Column, i: Column) -> Column:
            near = F.transform(F.sequence(i - (window - 1), i + (window - 1)), lambda j: F.get(full, j))
            return F.struct(i.alias("place"), near.alias("near"))

        return F.transform(full, one)

    trimmed = F.filter(F.transform(lines, lambda line: F.trim(line)), lambda line: F.length(line) > 0)
    return bound(F.transform(trimmed, told), around)


def _runs(window: int, words: int | None) -> Column:
    """The runs that select the line in the middle of ``near``: lines before it, and lines in all.

    Compared are all runs of ``window`` lines, and shorter ones of ``words`` words.
    A run whose first and whose last line can each go while ``words`` words stay
    is left out: the two shorter runs cover it and repeat wherever it does.
    """

    def line(offset: int, field: str) -> Column:
        return F.col("near")[window - 1 + offset][field]

    def selects(offsets: range) -> Column:
        chosen = F.lit(True)
        for k in offsets:  # of equal lines the first is selected
            chosen &= line(k, "h") > line(0, "h") if k < 0 else line(k, "h") >= line(0, "h")
        return chosen

    def counts(offsets: range) -> Column:
        if words is None:
            return F.lit(len(offsets) == window)
        said = [line(k, "said") for k in offsets]
        total = sum(said[1:], said[0])
        reaches = F.lit(True) if len(offsets) == window else total >= words
        if len(offsets) == 1:
            return reaches
        return reaches & ~((total - said[0] >= words) & (total - said[-1] >= words))

    found = []
    for size in range(1 if words is not None else window, window + 1):
        for before in range(size):
            offsets = range(-before, size - before)
            run = F.struct(F.lit(before).alias("before"), F.lit(size).alias("size"))
            found.append(F.when(selects(offsets) & counts(offsets), run))
    return F.filter(F.array(*found), lambda run: run.isNotNull())


def _key(id_column: str, text_column: str) -> list[Column]:
    return [F.col(id_column).alias("_id"), F.xxhash64(text_column).alias("_text_key")]


def _matched(places: DataFrame, keys: list[str]) -> DataFrame:
    """The places whose keys another place has too, with the first of them as ``leader``."""
    rank = F.struct(F.col("_id").isNull().alias("last"), "_id", "place")
    first = places.groupBy(*keys).agg(F.min(rank).alias("leader"), F.max(rank).alias("final")).where("leader <> final")
    return joined(places, first.select(*keys, "leader"), keys)


def repeated_runs(documents: DataFrame, window: int, words: int | None, id_column: str, text_column: str) -> DataFrame:
    """``_id, _text_key, _runs``: first lines and lengths of the runs that also occur earlier, by document."""
    places = documents.select(*_key(id_column, text_column), F.explode(_places(_lines(text_column), window, words)).alias("p"))
    places = places.select("_id", "_text_key", "p.*").withColumn("runs", _runs(window, words)).where(F.size("runs") > 0)
    own = F.col("near")[window - 1]
    sides = F.col("near.h").alias("hs"), F.col("near.g").alias("gs")
    places = saved(places.select("_id", "_text_key", "place", own["h"].alias("h"), own["g"].alias("g"), *sides, "runs"))
    kept = ["_id", "_text_key", "place", "leader", "before", "size", "hs", "gs"]
    matches = _matched(places, ["h", "g"]).withColumn("run", F.explode("runs")).select("*", "run.*").select(*kept)
    ended = []
    for size in range(1, window + 1):  # lines that are matched
        matches = saved(matches)
        ended.append(matches.where(F.col("size") == size).drop("hs", "gs"))
        if size == window:
            break
        following = window - 1 + F.when(F.col("before") >= size, -size).otherwise(size - F.col("before"))
        led = F.col("leader._id").alias("led_id"), F.col("leader.place").alias("led_place")
        longer = matches.where(F.col("size") > size).withColumns({"h": F.col("hs")[following], "g": F.col("gs")[following]})
        longer = longer.select(*(c for c in kept if c != "leader"), "h", "g", *led)
        matches = _matched(longer, ["led_id", "led_place", "before", "size", "h", "g"]).select(*kept)
    found = reduce(DataFrame.union, ended)
    later = found.where((F.col("place") != F.col("leader.place")) | ~F.col("_id").eqNullSafe(F.col("leader._id")))
    run = F.struct((F.col("place") - F.col("before")).alias("start"), "size")
    return later.groupBy("_id", "_text_key").agg(F.collect_set(run).alias("_runs"))


def _kept(text: Column, runs: Column) -> Column:
    """The text without the lines of those runs, and how many went."""

    def of(lines: Column, filled: Column) -> Column:
        covered = F.array_distinct(F.flatten(F.transform(runs, lambda r: F.sequence(r["start"], r["start"] + r["size"] - 1))))
        gone = F.transform(covered, lambda i: filled[i])
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        kept = F.array_join(F.transform(stay, lambda i: lines[i]), "\n")
        return F.struct(kept.alias("text"), F.size(gone).cast("long").alias("n_removed"))

    return bound(_lines(text), lambda lines: bound(_filled(lines), lambda filled: of(lines, filled)))


def without_repeated_lines(
    documents: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text", words: int | None = None
) -> DataFrame:
    """All rows and columns of ``documents``, their texts without repeated runs, plus ``n_lines, n_removed``.

    A line goes if it lies in a run of ``window`` lines that also starts earlier:
    in a document of smaller id, or further ahead in the same one. With ``words``,
    so does a line of a shorter run that has as many words or more. Lines are
    compared without spaces around them; blank lines do not count and stay. Runs
    are judged on the input, so a document may lose all its lines and stays as an
    empty text. Null texts stay null, null ids come last and rank as one; rows
    that share an id are one document, whose equal lines at equal places are the
    same lines, so repeated rows keep or lose the same. Columns named ``n_lines``
    or ``n_removed`` are replaced. An empty table gives none.
    """
    names = [c for c in documents.columns if c not in ("n_lines", "n_removed")]
    runs = repeated_runs(documents, window, words, id_column, text_column)
    runs = runs.select("_runs", F.col("_id").alias("_runs_id"), F.col("_text_key").alias("_runs_key"))
    row, text = F.struct(*names), F.col(f"_row.{text_column}")
    keyed = documents.select(row.alias("_row"), *_key(id_column, text_column))
    joined = keyed.join(runs, F.col("_id").eqNullSafe(F.col("_runs_id")) & (F.col("_text_key") == F.col("_runs_key")), "left")
    kept = F.when(F.col("_runs").isNotNull(), _kept(text, F.col("_runs")))
    n_lines = F.when(text.isNull(), F.lit(0)).otherwise(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    joined = joined.select("_row", kept.alias("_kept"), n_lines.cast("long").alias("n_lines"))
    columns = [F.coalesce("_kept.text", text).alias(c) if c == text_column else F.col(f"_row.{c}") for c in names]
    return joined.select(*columns, "n_lines", F.coalesce("_kept.n_removed", F.lit(0)).alias("n_removed"))
