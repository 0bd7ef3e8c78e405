"""Documents packed into compressed chunks, and questions that chunks ask each other.

Several operators have to know whether something in a document also occurs
elsewhere. Texts then move once, zstd-packed (a third to a half of their size),
and are read from that one exchange by every pass. What is compared are short
keys: each chunk sends every distinct key once to the bucket the key belongs to,
the bucket judges all its keys, and its answers go back in the order sent. A key
that a third of all documents hold reaches its bucket once per chunk, as a few
bytes, so there is no group of its occurrences anywhere.

A chunk is named by its input partition and its place there. Answers are told by
their place in a question, so a task that is lost and run again has to build the
same chunks: rows are sorted within their partition first, since a shuffle hands
them over in another order each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20
"""Text bytes of a chunk, unless one document is longer."""

BUCKET_BYTES = 4 << 20
"""Text bytes whose keys a bucket judges, on average."""

LAST = np.iinfo(np.int64).max
"""Rank of a null id: it comes after all others."""

ANSWER_SCHEMA = "chunk long, bucket long, body binary"

_PACKED = pa.schema([("id", pa.int64()), ("text", pa.binary())])
_ZSTD = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))


class Chunk:
    """Some documents in order of id: their bytes one after the other."""

    def __init__(self, body: bytes) -> None:
        table = pa.ipc.open_stream(body).read_all().combine_chunks()
        self.ids = table.column("id").combine_chunks()
        texts = table.column("text").combine_chunks()
        self.ranks = pc.fill_null(self.ids, LAST).to_numpy(zero_copy_only=False)
        _, offsets, data = texts.buffers()
        self.offsets = np.frombuffer(offsets, np.int32)[texts.offset :][: len(texts) + 1].astype(np.int64)
        self.data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        self.lengths = np.diff(self.offsets)

    def __len__(self) -> int:
        return len(self.ids)

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def texts(self) -> Iterator[bytes]:
        return (self.text(row) for row in range(len(self)))


def pack(ids: pa.Array, texts: pa.Array) -> bytes:
    """A chunk's body; null texts become empty."""
    order = pc.array_sort_indices(ids)
    table = pa.table([ids.take(order), pc.fill_null(texts.take(order).cast(pa.binary()), b"")], schema=_PACKED)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _PACKED, options=_ZSTD) as writer:
        writer.write_table(table, max_chunksize=len(table) or None)
    return sink.getvalue().to_pybytes()


def _batches(ids: pa.Array, texts: pa.Array, limit: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, before = 0, 0
    while start < len(ids):
        end = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield ids.slice(start, end - start), texts.slice(start, end - start)
        start, before = end, int(sizes[end - 1])


def packed(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``chunk, body`` rows, dealt out by chunk; other columns are left behind."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name, held, size = (context.partitionId() if context else 0) << 32, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal name, held, size
            ids = pa.concat_arrays([i for i, _ in held])
            body = pack(ids, pa.concat_arrays([t for _, t in held]))
            name, held, size = name + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([name - 1], pa.int64()), pa.array([body], pa.binary())], ["chunk", "body"])

        for batch in batches:
            for ids, texts in _batches(batch.column(0), batch.column(1).cast(pa.binary()), chunk_bytes):
                more = pc.sum(pc.binary_length(texts)).as_py() or 0
                if held and size + more > chunk_bytes:
                    yield flush()
                held.append((ids, texts))
                size += more
        if held:
            yield flush()

    narrow = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return narrow.sortWithinPartitions("id", "text").mapInArrow(run, "chunk long, body binary").repartition("chunk")


def bucket_count(documents: DataFrame, text_column: str = "text", bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for these texts, from their measured size."""
    total = documents.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    return max(1, -(-total // bucket_bytes))


def asked(chunks: DataFrame, ask: Callable[[Chunk], Iterable[tuple[int, bytes]]]) -> DataFrame:
    """``chunk, bucket, body``: the questions of every chunk."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body in zip(batch.column("chunk"), batch.column("body")):
                found = list(ask(Chunk(body.as_buffer())))
                yield rows([(name.as_py(), bucket, question) for bucket, question in found])

    return chunks.mapInArrow(run, ANSWER_SCHEMA)


def rows(values: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*values)) or [[], [], []]
    kinds = (pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["chunk", "bucket", "body"])


def judged(questions: DataFrame, judge: Callable[[list[int], list[bytes], int], Iterable[tuple[int, int, bytes]]]) -> DataFrame:
    """``chunk, bucket, body``: what each bucket answers, given chunk names and questions."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        names = table.column("chunk").to_pylist()
        return pa.Table.from_batches([rows(list(judge(names, table.column("body").to_pylist(), key[0].as_py())))])

    return questions.groupBy("bucket").applyInArrow(run, ANSWER_SCHEMA)


def answered(chunks: DataFrame, answers: DataFrame, use: Callable[[int, Chunk, dict[int, list[bytes]]], pa.Table], schema: str) -> DataFrame:
    """Every chunk with the answers to it, by bucket."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[int, list[bytes]] = {}
        for bucket, body in zip(right.column("bucket").to_pylist(), right.column("body").to_pylist()):
            found.setdefault(bucket, []).append(body)
        name, body = left.column("chunk")[0].as_py(), left.column("body")[0].as_buffer()
        return use(name, Chunk(body), found)

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def by_bucket(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket with the places that have it, in order."""
    order = np.argsort(buckets, kind="stable")
    edges = np.flatnonzero(np.diff(buckets[order], prepend=-1))
    for places in np.split(order, edges[1:]) if len(order) else []:
        yield int(buckets[places[0]]), places


def first_places(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of every distinct key, in order of place, and for each place the number of its key."""
    if not len(keys[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        ranked = key[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    group = np.cumsum(new) - 1
    firsts = order[new]  # lexsort is stable
    by_place = np.argsort(firsts, kind="stable")
    number = np.empty(len(firsts), np.int64)
    number[by_place] = np.arange(len(firsts))
    found = np.empty(len(order), np.int64)
    found[order] = number[group]
    return firsts[by_place], found


def deltas(values: np.ndarray) -> bytes:
    """Packed 64-bit values, best when they rise slowly."""
    return pa.compress(np.diff(values.astype(np.int64), prepend=np.int64(0)).tobytes(), "zstd", asbytes=True)


def from_deltas(body: bytes, count: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(pa.decompress(body, count * 8, "zstd", asbytes=True), np.int64))


def pieces(*parts: bytes) -> bytes:
    """Parts behind their lengths."""
    return np.array([len(parts), *map(len, parts)], np.int64).tobytes() + b"".join(parts)


def split_pieces(body: bytes) -> list[bytes]:
    count = int(np.frombuffer(body, np.int64, 1)[0])
    ends = np.cumsum(np.frombuffer(body, np.int64, count, 8)) + 8 * (count + 1)
    starts = np.concatenate(([8 * (count + 1)], ends[:-1]))
    return [body[a:b] for a, b in zip(starts, ends)]
