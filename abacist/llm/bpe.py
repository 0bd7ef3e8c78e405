"""Encoding and decoding with a word-level byte-pair vocabulary.

White space never joins two tokens, so a text's ids are those of its words in
order. Every chunk sends its distinct words to their buckets, a bucket encodes
each distinct word once, and the ids go back to the places of the words.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.llm import chunks as C
from abacist.llm.suffixes import ranges

ENCODED = "doc_id long, ids array<int>"
DECODED = f"{ENCODED}, text string"

LEVEL = 6
"""zstd level of words and ids on their way."""


def _squeezed(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=LEVEL).compress(data, asbytes=True)


class Vocabulary:
    """A tokenizer file's content, opened once in each Python worker."""

    _open: dict[int, tuple] = {}

    def __init__(self, spark: SparkSession, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            self.content = spark.sparkContext.broadcast(file.read())

    def opened(self):
        """The tokenizer and its pieces by id."""
        content = self.content.value
        key = zlib.crc32(content.encode())
        if key not in self._open:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(content)
            tokenizer.no_padding()
            tokenizer.no_truncation()
            pieces = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]
            self._open[key] = tokenizer, np.array(pieces, object)
        return self._open[key]


class Words:
    """Distinct words of a chunk in order of first use, and their numbers by document."""

    def __init__(self, chunk: C.Chunk) -> None:
        numbers: dict[bytes, int] = {}
        self.by_row = [np.array([numbers.setdefault(w, len(numbers)) for w in text.split()], np.int32) for text in chunk.texts()]
        self.distinct = list(numbers)

    def buckets(self, count: int) -> Iterator[tuple[int, list[int]]]:
        """Places of a bucket's words, in order of the words, which packs best."""
        for bucket, places in C.by_bucket(np.array([zlib.crc32(word) for word in self.distinct], np.int64) % count):
            yield bucket, sorted(places.tolist(), key=self.distinct.__getitem__)


def _asked(buckets: int):
    def ask(chunk: C.Chunk) -> Iterator[tuple[int, bytes]]:
        words = Words(chunk)
        for bucket, places in words.buckets(buckets):
            body = b"\n".join(words.distinct[i] for i in places)
            yield bucket, C.pieces(np.int64(len(body)).tobytes(), _squeezed(body))

    return ask


def _encoded(vocabulary: Vocabulary):
    def judge(names: list[int], bodies: list[bytes], bucket: int) -> Iterator[tuple[int, int, bytes]]:
        tokenizer, _ = vocabulary.opened()
        asked, numbers = [], {}
        for body in bodies:
            size, words = C.split_pieces(body)
            words = pa.decompress(words, int(np.frombuffer(size, np.int64)[0]), "zstd", asbytes=True).split(b"\n")
            asked.append([numbers.setdefault(word, len(numbers)) for word in words])
        distinct, ids = [word.decode() for word in numbers], []
        for at in range(0, len(distinct), 4096):
            found = tokenizer.encode_batch_fast(distinct[at : at + 4096], add_special_tokens=False)
            ids += [np.array(x.ids, np.uint32) for x in found]
        for name, places in zip(names, asked):
            mine = [ids[i] for i in places]
            parts = (np.array([len(x) for x in mine], np.uint32), np.concatenate(mine))
            narrow = [part.astype(np.min_scalar_type(part.max(initial=0))) for part in parts]
            head = np.array([(len(part), part.itemsize) for part in narrow])
            yield name, bucket, C.pieces(head.tobytes(), *(_squeezed(part.tobytes()) for part in narrow))

    return judge


def _unpacked(head: tuple[int, int], body: bytes) -> np.ndarray:
    count, width = head
    return np.frombuffer(pa.decompress(body, count * width, "zstd", asbytes=True), f"<u{width}")


def _joined(buckets: int, vocabulary: Vocabulary | None):
    def use(name: int, chunk: C.Chunk, answers: dict[int, list[bytes]]) -> pa.Table:
        words = Words(chunk)
        starts, counts = np.zeros(len(words.distinct), np.int64), np.zeros(len(words.distinct), np.int64)
        flat, size = [np.zeros(0, np.uint32)], 0
        for bucket, places in words.buckets(buckets):
            head, each, ids = C.split_pieces(answers[bucket][0])
            head = np.frombuffer(head, np.int64).reshape(2, 2).tolist()
            counts[places] = _unpacked(head[0], each)
            starts[places] = size + np.cumsum(counts[places]) - counts[places]
            flat.append(_unpacked(head[1], ids))
            size += head[1][0]
        pool = np.concatenate(flat).astype(np.int32)
        rows = [pool[ranges(starts[row], counts[row])] for row in words.by_row]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        values = pa.array(np.concatenate(rows), pa.int32())
        table = pa.table([chunk.ids, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], ["doc_id", "ids"])
        if vocabulary is None:
            return table
        _, pieces = vocabulary.opened()
        return table.append_column("text", pa.array([_text(ids, pieces) for ids in rows], pa.string()))

    return use


def _text(ids: np.ndarray, pieces: np.ndarray) -> str:
    """The pieces of the ids in order: the join with the id-to-piece table."""
    return " ".join(pieces[ids])


def _coded(documents: DataFrame, path: str, id_column: str, text_column: str, decode: bool) -> DataFrame:
    vocabulary = Vocabulary(documents.sparkSession, path)
    buckets = C.bucket_count(documents, text_column)
    chunks = C.packed(documents, id_column, text_column)
    answers = C.judged(C.asked(chunks, _asked(buckets)), _encoded(vocabulary))
    return C.answered(chunks, answers, _joined(buckets, vocabulary if decode else None), DECODED if decode else ENCODED)


def encoded(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row: all token ids of the whole text, without special marks added.

    The ids equal those of the tokenizers library for the file at ``path``, which
    has to keep words apart at white space; special tokens written in a text are
    found as the library finds them. A null or blank text has no ids, repeated
    rows stay repeated, null ids stay null. Other columns are ignored; an empty
    table gives none.
    """
    return _coded(documents, path, id_column, text_column, decode=False)


def encoded_and_decoded(documents: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, ids, text``: as :func:`encoded`, with what :func:`decoded` makes of the ids, in one pass."""
    return _coded(documents, path, id_column, text_column, decode=True)


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: ids joined with the pieces of the file's vocabulary, special ones too.

    The id-to-piece table has as many rows as the vocabulary, so every task holds
    all of it. Null ids give a null text, no ids an empty one; an id outside the
    vocabulary has no piece and fails.
    """
    vocabulary = Vocabulary(rows.sparkSession, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, pieces = vocabulary.opened()
        for batch in batches:
            ids = batch.column(1)
            values, offsets = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            nulls = ids.is_null().to_numpy(zero_copy_only=False)
            texts = [None if null else _text(values[a:b], pieces) for a, b, null in zip(offsets[:-1], offsets[1:], nulls)]
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return rows.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, DECODED)
