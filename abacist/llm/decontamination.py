"""Benchmark passages in documents, by a prefix-filtered set join.

A window of an item occurs in a document only if its rarest shingle does, at a
place from which the whole window fits. So each window joins by that one shingle
(the prefix that exact containment needs), and what passes the bounds is compared
word by word. Different windows are taken in blocks of bounded size, so every
task can hold a block, however large the benchmark is and however many items
share a window; a block goes when its pass over the documents is written. Which
items the found windows belong to is a join afterwards.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.components import joined, saved
from abacist.llm.suffixes import ranges

WINDOW = 13
SHINGLE = 5
SHARE = 20
"""A document is contaminated if at least one word in so many is hit."""

BLOCK_WINDOWS = 1 << 17
"""Different windows that one block holds, about."""

_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_TABLE = bytes(b if b in _WORD_BYTES else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes) -> list[bytes]:
    """Runs of digits, letters a to z in lower case, and all that is not ASCII."""
    return text.translate(_TABLE).split()


def item_windows(benchmark: DataFrame, window: int = WINDOW, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """``item_id, window``: every run of that many words of an item, or all its words if fewer."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                found = words(text.as_py() or b"")
                for at in range(0, max(1, len(found) - window + 1) if found else 0, 1 << 14):
                    last = min(at + (1 << 14), max(1, len(found) - window + 1))
                    parts = [b" ".join(found[i : i + window]) for i in range(at, last)]
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["item_id", "window"])

    narrow = benchmark.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return narrow.mapInArrow(run, "item_id long, window binary").distinct()


class Block:
    """Different windows of a block as word numbers, with their ids and shingles."""

    def __init__(self, windows: list[tuple[int, bytes]], shingle: int = SHINGLE) -> None:
        self.ids = np.array([name for name, _ in windows], np.int64)
        self.numbers: dict[bytes, int] = {}
        coded = [[self.numbers.setdefault(w, len(self.numbers) + 1) for w in bytes(window).split()] for _, window in windows]
        self.lengths = np.array([len(c) for c in coded], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.coded = np.concatenate([np.array(c, np.int32) for c in coded])
        self.widths = np.minimum(self.lengths, shingle)
        hashes, owners, offsets = [], [], []
        for width in np.unique(self.widths):
            mine = np.flatnonzero(self.widths == width)
            at = ranges(self.begins[mine], self.lengths[mine] - width + 1)
            hashes.append(shingles(self.coded, int(width))[at])
            owners.append(np.repeat(mine, self.lengths[mine] - width + 1))
            offsets.append(at - self.begins[owners[-1]])
        self.hashes, self.owners, self.offsets = (np.concatenate(x) for x in (hashes, owners, offsets))
        self.known = np.unique(self.hashes)

    def prefixed(self, counts: dict[int, int]) -> None:
        """Choose every window's rarest shingle, and of equally rare ones the first."""
        often = np.array([counts.get(int(i), 0) for i in range(len(self.known))], np.int64)[np.searchsorted(self.known, self.hashes)]
        order = np.lexsort((self.offsets, often, self.owners))
        first = order[np.concatenate(([True], np.diff(self.owners[order]) > 0))]
        first = first[np.argsort(self.hashes[first], kind="stable")]
        self.prefixes, self.prefix_begins = np.unique(self.hashes[first], return_index=True)
        self.prefix_sizes = np.diff(np.append(self.prefix_begins, len(first)))
        self.prefix_windows, self.prefix_offsets = self.owners[first], self.offsets[first]

    def numbered(self, text: bytes) -> np.ndarray:
        """Word numbers of a text, 0 for words that no window has."""
        found = words(text)
        return np.fromiter(map(self.numbers.get, found, repeat(0)), np.int32, len(found))

    def places(self, numbers: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where a wanted shingle starts, and which one; of known words only."""
        places, which = [], []
        unknown = np.concatenate(([0], np.cumsum(numbers == 0)))
        for width in np.unique(self.widths).tolist():
            if len(numbers) < width:
                continue
            at = np.flatnonzero(unknown[width:] == unknown[:-width])
            if len(at):
                hashes = shingles(numbers, width)[at]
                found = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                same = wanted[found] == hashes
                places.append(at[same])
                which.append(found[same])
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (places, which))

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of all hit words, and the ids of the windows that occur."""
        places, which = self.places(numbers, self.prefixes)
        if not len(places):
            return places, places
        sizes = self.prefix_sizes[which]
        entry = ranges(self.prefix_begins[which], sizes)
        window, start = self.prefix_windows[entry], np.repeat(places, sizes) - self.prefix_offsets[entry]
        length = self.lengths[window]
        fits = (start >= 0) & (start + length <= len(numbers))
        window, start, length = window[fits], start[fits], length[fits]
        for step in range(int(length.max()) if len(length) else 0):
            inside = step < length
            same = ~inside
            same[inside] = numbers[start[inside] + step] == self.coded[self.begins[window[inside]] + step]
            window, start, length = window[same], start[same], length[same]
        return np.unique(ranges(start, length)), self.ids[np.unique(window)]


def shingles(numbers: np.ndarray, width: int) -> np.ndarray:
    """Hash of the shingle at every place; shingles of different width differ."""
    found = np.full(max(len(numbers) - width + 1, 0), width, np.uint64)
    for step in range(width):
        found = (found ^ numbers[step : step + len(found)].astype(np.uint64)) * _MIX
        found ^= found >> np.uint64(29)
    return found


def _counted(documents: DataFrame, block) -> dict[int, int]:
    """In how many places of the corpus each of a block's shingles occurs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block.value
        total = np.zeros(len(held.known), np.int64)
        for batch in batches:
            for text in batch.column(1).cast(pa.binary()):
                if text.is_valid:
                    _, which = held.places(held.numbered(text.as_buffer().to_pybytes()), held.known)
                    total += np.bincount(which.astype(np.int64), minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found], pa.int64())], ["shingle", "n"])

    counts = documents.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {row.shingle: row.n for row in counts.toLocalIterator()}  # no more rows than the block has shingles


HITS = "doc_id long, key binary, block int, n_words long, hits array<int>, windows array<long>"


def _hit(documents: DataFrame, block, number: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block.value
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0), batch.column(1).cast(pa.binary())):
                body = text.as_buffer().to_pybytes() if text.is_valid else b""
                numbers = held.numbered(body)
                places, windows = held.hits(numbers)
                rows.append((doc.as_py(), xxhash.xxh3_128_digest(body), number, len(numbers), places, windows))
            kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            names = ("doc_id", "key", "block", "n_words", "hits", "windows")
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return documents.mapInArrow(run, HITS)


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text", block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """``doc_id, n_words, hits, items, contaminated`` of every row.

    ``hits`` are the places of the words inside occurrences of an item's windows,
    ``items`` the ids of items with occurring windows. A document is contaminated
    if it has a hit and at least one word in 20 is hit. Null and empty texts have
    no words; items without words have no windows; words of an item without an id
    are hit but name no item, and items that share an id count as one. Repeated
    rows stay repeated. Other columns are ignored; empty tables are fine.
    """
    context = documents.sparkSession.sparkContext
    narrow = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    pairs = saved(item_windows(benchmark, window))
    windows = saved(pairs.select("window").distinct().withColumn("window_id", F.monotonically_increasing_id()))
    blocks = max(1, -(-windows.count() // block_windows))
    parts = None
    for number in range(blocks):
        mine = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == number)
        block = Block([(row.window_id, row.window) for row in mine.toLocalIterator()] or [(-1, b"\xff")])  # no word of valid text
        held = context.broadcast(block)
        block.prefixed(_counted(narrow, held))
        held.destroy()
        held = context.broadcast(block)
        part = saved(_hit(narrow, held, number))
        held.destroy()
        parts = part if parts is None else parts.union(part)
    found = parts.select("doc_id", "key", "n_words", "hits") if blocks == 1 else _merged(parts)
    owners = joined(pairs.where("item_id is not null"), windows, ["window"]).select("item_id", "window_id")
    marks = parts.select("key", F.explode("windows").alias("window_id")).distinct()
    items = joined(marks, owners, ["window_id"]).groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    none = F.array().cast("array<long>")
    hit = joined(found.where(F.size("hits") > 0), items, ["key"], "left").withColumn("items", F.coalesce("items", none))
    result = found.where(F.size("hits") == 0).withColumn("items", none).unionByName(hit)
    share = F.size("hits") * F.lit(SHARE) >= F.col("n_words")
    return result.select("doc_id", "n_words", "hits", "items", ((F.size("hits") > 0) & share).alias("contaminated"))


def _merged(found: DataFrame) -> DataFrame:
    """Rows of all blocks as one; repeated rows have equal parts and are counted."""
    parts = found.groupBy("doc_id", "key", "block").agg(
        F.first("n_words").alias("n_words"), F.first("hits").alias("hits"), F.count("*").alias("copies")
    )
    rows = parts.groupBy("doc_id", "key").agg(
        F.max("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.max("copies").alias("copies"),
    )
    return rows.select("doc_id", "key", "n_words", "hits", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def without_contaminated(documents: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``documents`` that are not contaminated.

    Rows are matched by id: those that share an id with a contaminated row go
    with it, and all without an id go if one of them is contaminated.
    """
    bad = contamination(documents, benchmark, id_column=id_column, text_column=text_column).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("_bad_id")).distinct()
    return documents.join(bad, documents[id_column].eqNullSafe(bad["_bad_id"]), "left_anti")
