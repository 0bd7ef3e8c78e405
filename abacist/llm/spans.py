"""Removal of repeated runs of sentences (substring dedup)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from abacist.llm import chunks as C

SPAN = 2
"""Sentences of a span, at least."""

WORDS = 25
"""Words of a span, at least; a span takes as many sentences as it needs."""

SENTENCE = regex.compile(rb"(?:[^.!?\n]|[.!?]+(?=[^\s.!?]))*+(?:[.!?]+|\n|\Z)\s*")
"""A sentence with its mark and the white space behind it; a line end also ends one."""

RESULT = "doc_id long, n_sentences long, n_removed long, text binary"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xC2B2AE3D27D4EB4F)


def sentences(text: bytes) -> list[bytes]:
    """All of the text, cut behind sentences."""
    return [part for part in SENTENCE.findall(text) if part]


class Spans:
    """Spans of a chunk in order: two hashes and the document of each, and the sentences.

    A span starts at every sentence from which enough sentences and words follow;
    ``at`` and ``last`` are its first and last sentence.
    """

    def __init__(self, chunk: C.Chunk, span: int, words: int) -> None:
        self.parts = [sentences(text) for text in chunk.texts()]
        counts = np.array([len(p) for p in self.parts], np.int64)
        digests = b"".join(xxhash.xxh3_128_digest(s.strip()) for part in self.parts for s in part)
        single = np.frombuffer(digests, np.uint64).reshape(-1, 2)
        said = np.cumsum([len(s.split()) for part in self.parts for s in part], dtype=np.int64)
        ends = np.cumsum(counts)
        self.begins = ends - counts
        at = np.arange(len(single))
        last = np.searchsorted(said, np.concatenate(([0], said[:-1])) + words) if len(said) else at
        last = np.maximum(last, at + span - 1)
        fits = last < np.repeat(ends, counts)
        self.at, self.last = at[fits], last[fits]
        self.row = np.repeat(np.arange(len(counts)), counts)[fits]
        high, low = np.zeros(len(self.at), np.uint64), np.zeros(len(self.at), np.uint64)
        for step in range(int((self.last - self.at).max(initial=-1)) + 1):
            some = np.flatnonzero(self.at + step <= self.last)
            sentence = single[self.at[some] + step]
            mixed = (high[some] ^ sentence[:, 0]) * _MIX
            high[some] = mixed ^ (mixed >> np.uint64(32))
            mixed = (low[some] ^ sentence[:, 1]) * _MIX2
            low[some] = mixed ^ (mixed >> np.uint64(29))
        self.high, self.low = high, (low >> np.uint64(32)).astype(np.uint32)
        self.firsts, self.number = C.first_places(self.high, self.low)


def _buckets(high: np.ndarray, buckets: int) -> np.ndarray:
    return (high % np.uint64(buckets)).astype(np.int64)


def _asked(span: int, words: int, buckets: int):
    def ask(chunk: C.Chunk) -> Iterator[tuple[int, bytes]]:
        found = Spans(chunk, span, words)
        high, low, rank = found.high[found.firsts], found.low[found.firsts], chunk.ranks[found.row[found.firsts]]
        for bucket, places in C.by_bucket(_buckets(high, buckets)):
            yield bucket, C.pieces(high[places].tobytes(), low[places].tobytes(), C.deltas(rank[places]))

    return ask


def _judge(names: list[int], bodies: list[bytes], bucket: int) -> Iterator[tuple[int, int, bytes]]:
    columns = []
    for body in bodies:
        high, low, rank = C.split_pieces(body)
        high = np.frombuffer(high, np.uint64)
        columns.append((high, np.frombuffer(low, np.uint32), C.from_deltas(rank, len(high))))
    high, low, rank = (np.concatenate(c) for c in zip(*columns))
    order = np.lexsort((rank, low, high))  # stable: of equal ranks the earlier chunk
    later = np.zeros(len(order), bool)
    later[1:] = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
    codes = np.empty(len(order), np.uint8)
    codes[order] = later
    for name, part in zip(names, np.split(codes, np.cumsum([len(c[0]) for c in columns])[:-1])):
        yield name, bucket, np.packbits(part).tobytes()


def _kept(span: int, words: int, buckets: int):
    def use(name: int, chunk: C.Chunk, answers: dict[int, list[bytes]]) -> pa.Table:
        found = Spans(chunk, span, words)
        later = np.zeros(len(found.firsts), bool)
        for bucket, places in C.by_bucket(_buckets(found.high[found.firsts], buckets)):
            later[places] = np.unpackbits(np.frombuffer(answers[bucket][0], np.uint8), count=len(places)).astype(bool)
        repeated = np.ones(len(found.at), bool)
        repeated[found.firsts] = False
        repeated |= later[found.number]
        edge = np.zeros(sum(map(len, found.parts)) + 1, np.int64)
        np.add.at(edge, found.at[repeated], 1)
        np.add.at(edge, found.last[repeated] + 1, -1)
        removed = np.cumsum(edge)[:-1] > 0
        texts, counts = [], []
        for begin, parts in zip(found.begins, found.parts):
            gone = removed[begin : begin + len(parts)]
            counts.append(int(gone.sum()))
            texts.append(b"".join(part for part, out in zip(parts, gone) if not out))
        n_sentences = pa.array([len(parts) for parts in found.parts], pa.int64())
        return pa.table(
            [chunk.ids, n_sentences, pa.array(counts, pa.int64()), pa.array(texts, pa.binary())],
            ["doc_id", "n_sentences", "n_removed", "text"],
        )

    return use


def without_repeated_spans(
    documents: DataFrame, span: int = SPAN, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_sentences, n_removed, text`` of every row; ``text`` is what stays.

    From every sentence on, the shortest run of at least ``span`` sentences and
    ``words`` words is hashed (96 bits). All but its first occurrence (smallest
    id, then place) are repeated, and every sentence that a repeated run covers
    goes, with the white space behind it. Sentences are compared without the
    white space around them; the number of words keeps short phrases that repeat
    by chance. Null texts count as empty,
    null ids come last, and rows that share an id are separate documents,
    by partition and then by text; of equal rows one stays. Documents of fewer
    sentences or words stay whole. Other columns are ignored; an empty table gives none.
    """
    buckets = C.bucket_count(documents, text_column)
    chunks = C.packed(documents, id_column, text_column)
    answers = C.judged(C.asked(chunks, _asked(span, words, buckets)), _judge)
    found = C.answered(chunks, answers, _kept(span, words, buckets), RESULT)
    return found.withColumn("text", found.text.cast("string"))
