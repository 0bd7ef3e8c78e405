"""Periodic runs of words: tiles for every octave of periods, solved apart and stitched.

A run of period q is a stretch where words q apart are equal; where they are,
``word[i] == word[i + q]``, is its matching stretch, q words shorter. For periods
of one octave, ``low <= q < 2 * low``, matching stretches of a run of four periods
have 3 * low places, so boundaries 2 * low apart meet all of them. From a boundary
two Z-functions tell how far every period of the octave matches ahead and behind,
as far as the next boundary. Those fragments of a run overlap, and a shuffle by
document and period joins them. A period that is a multiple of a smaller one
shows in the words after the boundary, and its fragments go at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from abacist.session import shared_folder

EXPONENT = 4
"""Periods that a run has at least."""

LEAST = 6
"""Words that a run has at least."""

TILE_WORDS = 512
"""Words between the first and the last boundary of a tile, if the octave's boundaries are nearer."""

SHORT = 8
"""Periods below are looked for at all places, to tell which boundaries may have a run."""

OUTPUT_BYTES = 8 << 20

RUN = "struct<start:bigint,length:bigint,period:bigint>"
SCANNED = "doc_id long, text_key long, n_words long, open boolean, text string, octave int, origin long, places binary, words binary"
FRAGMENT = "doc_id long, text_key long, period long, begin long, end long"


class Words:
    """The words of a text, between white space of ASCII, and their numbers."""

    def __init__(self, text: pa.Buffer | bytes) -> None:
        raw = np.frombuffer(text, np.uint8)
        black = (raw != 32) & ((raw < 9) | (raw > 13))
        edges = np.flatnonzero(np.diff(black.view(np.int8), prepend=0, append=0))
        self.lengths = edges[1::2] - edges[::2]
        self.data = raw[black]

    def __len__(self) -> int:
        return len(self.lengths)

    def numbers(self) -> np.ndarray:
        """One number per word, equal for equal words."""
        if not len(self):
            return np.zeros(0, np.int32)
        offsets = np.concatenate(([0], np.cumsum(self.lengths))).astype(np.int64)
        held = pa.Array.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(self.data)])
        return held.dictionary_encode().indices.to_numpy()

    def joined(self, keep: np.ndarray | None = None) -> bytes:
        """The words (or those kept) with one space between."""
        spaced = np.full(len(self.data) + len(self), 32, np.uint8)
        spaced[np.arange(len(self.data)) + np.repeat(np.arange(len(self)), self.lengths)] = self.data
        if keep is not None:
            spaced = spaced[np.repeat(keep, self.lengths + 1)]
        return spaced[:-1].tobytes()


def _short(numbers: np.ndarray, low: int) -> np.ndarray:
    """Which boundaries lie in a matching stretch of a run of a short period; all places are compared."""
    count = len(numbers)
    marks = np.zeros(count // (2 * low) + 2, np.int64)
    for period in range(low, min(2 * low, count // EXPONENT + 1)):
        same = numbers[:-period] == numbers[period:]
        edges = np.flatnonzero(np.diff(same.view(np.int8), prepend=0, append=0))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= max(LEAST - period, (EXPONENT - 1) * period)
        np.add.at(marks, -(-starts[long] // (2 * low)), 1)
        np.add.at(marks, (ends[long] - 1) // (2 * low) + 1, -1)
    return np.cumsum(marks) > 0


def _repeated(hashes: np.ndarray, low: int) -> np.ndarray:
    """At which boundaries the ``low`` words ahead, or those behind, stand again one period later."""
    blocks = -(-len(hashes) // (2 * low))
    table = np.zeros(blocks * 2 * low, np.uint64)
    table[: len(hashes)] = hashes
    table = table.reshape(blocks, 2 * low)
    hit = (table[:, low:] == table[:, :1]).any(1)
    hit[1:] |= (table[1:, :low] == table[:-1, low : low + 1]).any(1)
    return hit


def boundaries(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Octaves and those of their boundaries where some period of the octave may match.

    A matching stretch reaches ``low`` places ahead of a boundary or behind it, so
    the words there, here as one hash, have to stand again one period later.
    """
    octave, width, hashes = 0, 1, (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    while max(LEAST, EXPONENT << octave) <= len(numbers):
        low = 1 << octave
        if low < SHORT:
            hit = _short(numbers, low)
        else:
            while width < low:
                hashes = hashes[:-width] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[width:]
                width *= 2
            hit = _repeated(hashes, low)
        if hit.any():
            yield octave, np.flatnonzero(hit) * 2 * low
        octave += 1


def tiles(numbers: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Octave, first word's place, boundaries in the tile, and the tile's words."""
    for octave, at in boundaries(numbers):
        reach = 2 << octave
        part = at // max(reach, TILE_WORDS)
        for places in np.split(at, np.flatnonzero(np.diff(part)) + 1):
            origin = max(0, int(places[0]) - reach)
            yield octave, origin, (places - origin).astype(np.int32), numbers[origin : int(places[-1]) + 2 * reach].astype(np.int32)


def z_function(values: list[int], count: int) -> list[int]:
    """How many values from each of the first ``count`` places on are those of the beginning."""
    found, size, left, right = [0] * count, len(values), 0, 0
    for at in range(1, count):
        same = min(right - at, found[at - left]) if at < right else 0
        while at + same < size and values[same] == values[at + same]:
            same += 1
        if at + same > right:
            left, right = at, at + same
        found[at] = same
    return found


def _from_boundary(words: list[int], at: int, low: int) -> Iterator[tuple[int, int, int]]:
    """Period, begin and end of the matching stretches around one boundary that may belong to a run."""
    reach = 2 * low
    ahead, behind = words[at : at + 2 * reach], words[max(0, at - reach) : at][::-1]
    end = min(len(words), at + reach)
    periods = min(reach, len(ahead))
    forward = z_function(ahead, periods)
    back = None
    if behind:
        mixed = behind + [-1] + words[max(0, at - reach) : end][::-1]
        back = z_function(mixed, len(behind) + 1 + max(0, end - at - low) + 1)
    multiple = bytearray(reach)
    for period in range(1, low):
        same = forward[period] if period < periods else 0
        if same >= period and not multiple[period]:
            for more in range(2 * period, min(same + period, reach - 1) + 1, period):
                multiple[more] = 1
    for period in range(low, periods):
        if multiple[period]:
            continue
        after = min(forward[period], reach)
        before = back[len(behind) + 1 + end - at - period] if back and at + period <= end else 0
        if after >= reach or before >= reach or after + before >= (EXPONENT - 1) * period:
            yield period, at - before, at + after


def fragments(octave: int, places: list[int], words: list[int]) -> list[tuple[int, int, int]]:
    """Period, begin and end of matching stretches in a tile, those of neighbouring boundaries joined."""
    found: dict[int, list[list[int]]] = {}
    for at in places:
        for period, begin, end in _from_boundary(words, at, 1 << octave):
            held = found.setdefault(period, [])
            if held and begin <= held[-1][1]:
                held[-1][1] = max(end, held[-1][1])
            else:
                held.append([begin, end])
    return [(period, begin, end) for period, held in found.items() for begin, end in held]


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, with its words, and a row per tile that may hold a run."""
    names = [part.split()[0] for part in SCANNED.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

    for batch in batches:
        for name, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            words = Words(text.as_buffer() if text.is_valid else b"")
            is_open = False
            for octave, origin, places, own in tiles(words.numbers()):
                is_open = True
                held.append((name, key, None, None, None, octave, origin, places.tobytes(), own.tobytes()))
                size += own.nbytes + places.nbytes
                if size > OUTPUT_BYTES:
                    yield flush()
                    held, size = [], 0
            joined = words.joined()
            held.append((name, key, len(words), is_open, joined.decode(), None, None, None, None))
            size += len(joined)
            if size > OUTPUT_BYTES:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for name, key, octave, origin, places, words in zip(*(column.to_pylist() for column in batch.columns)):
            inside = fragments(octave, np.frombuffer(places, np.int32).tolist(), np.frombuffer(words, np.int32).tolist())
            found += [(name, key, period, origin + begin, origin + end) for period, begin, end in inside]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*found)) or [[]] * 5], ["doc_id", "text_key", "period", "begin", "end"])


def _stitched(found: DataFrame) -> DataFrame:
    """``doc_id, text_key, runs``: fragments of a document's period joined where they overlap."""
    order = W.partitionBy("doc_id", "text_key", "period").orderBy("begin", "end")
    reached = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    first = F.when(F.col("begin") <= reached, 0).otherwise(1)
    numbered = found.withColumn("part", first).withColumn("part", F.sum("part").over(order.rowsBetween(W.unboundedPreceding, 0)))
    whole = numbered.groupBy("doc_id", "text_key", "period", "part").agg(F.min("begin").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start") + F.col("period")
    runs = whole.select("doc_id", "text_key", "start", length.alias("length"), "period")
    runs = runs.where((F.col("length") >= LEAST) & (F.col("length") >= EXPONENT * F.col("period")))
    return runs.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))


def _collapse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, runs in zip(batch.column("text").cast(pa.binary()), batch.column("runs").to_pylist()):
            words = Words(text.as_buffer())
            covered = np.zeros(len(words) + 1, np.int64)
            for run in runs:
                covered[run["start"] + run["period"]] += 1
                covered[run["start"] + run["length"]] -= 1
            texts.append(words.joined(np.cumsum(covered[:-1]) == 0).decode())
        at = batch.schema.get_field_index("text")
        yield batch.set_column(at, "text", pa.array(texts, pa.string()))


def periodic_runs(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_words, runs, text`` of every row: its periodic runs, and its words without their repeats.

    Words are what white space of ASCII leaves. A run is a stretch of at least six
    words and four of its smallest period that no neighbouring word extends;
    ``runs`` has start, length and period of each, by start, then period. ``text``
    holds the words, one space between, without those that lie behind the first
    period of some run. A null or empty text has no words and an empty text. Rows
    that share an id, or have none, are judged each by its own text; equal rows get
    equal results. Other columns are left behind; an empty table gives none.
    """
    id_, text = F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    narrow = documents.select(id_, F.xxhash64(text).alias("text_key"), text)
    path = shared_folder(documents.sparkSession, "periods")
    narrow.mapInArrow(_scan, SCANNED).write.option("compression", "zstd").parquet(path)
    scanned = documents.sparkSession.read.schema(SCANNED).parquet(path)
    tiled = scanned.where("octave is not null").select("doc_id", "text_key", "octave", "origin", "places", "words")
    runs = _stitched(tiled.repartition("doc_id", "text_key", "octave", "origin").mapInArrow(_solve, FRAGMENT))
    runs = runs.select(F.col("doc_id").alias("runs_id"), F.col("text_key").alias("runs_key"), "runs")
    texts = scanned.where("octave is null").select("doc_id", "text_key", "n_words", "open", "text")
    none = F.array().cast(f"array<{RUN}>")
    same = F.col("doc_id").eqNullSafe(F.col("runs_id")) & (F.col("text_key") == F.col("runs_key"))
    joined = texts.where("open").join(runs, same, "left").select("doc_id", "n_words", F.coalesce("runs", none).alias("runs"), "text")
    collapsed = joined.mapInArrow(_collapse, joined.schema)
    return texts.where("not open").select("doc_id", "n_words", none.alias("runs"), "text").union(collapsed)


def longest(runs: Column | str) -> Column:
    """Of runs as :func:`periodic_runs` has them, the longest; of equally long ones the first, then that of least period."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q")))
    best = F.array_max(ranked)
    return F.struct((-best["s"]).alias("start"), best["n"].alias("length"), (-best["q"]).alias("period"))
