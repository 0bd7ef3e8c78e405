"""Toxicity of documents by multiple-instance learning over their sentences.

Labels exist for whole documents only. Each sentence gets a logistic score from
its words, and a document's score is the noisy-or of its sentences: it is toxic
unless every sentence is harmless. Word weights are fitted to document labels
through that combination, so the sentences that carry a label can be told.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 10_000
"""Labelled documents that the model is fitted to, at most; chosen by a hash of their id."""

FEATURES = 1 << 20
"""Hashed words and beginnings of words."""

STEMS = (3, 4, 5, 6, 7)
"""Letters of the beginnings."""

ROUNDS = 120
RATE = 0.3
SPARSITY = 1e-4
"""Weight that a word needs to earn, so that words of single documents get none."""

_SAMPLE = pa.schema([("doc_id", pa.int64()), ("text", pa.binary()), ("toxic", pa.int32())])

RARE = 5
"""Words in fewer sampled documents are not learned."""

PRIOR = -7.0
"""Log-odds of a sentence before any word is known."""

_WORD_BYTES = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_TABLE = bytes(b if b in _WORD_BYTES else b + 32 if 65 <= b <= 90 else 10 if b in b".!?\n" else 32 for b in range(256))


def sentences(text: bytes) -> list[list[bytes]]:
    """Words in lower case of every sentence that has words."""
    return [words for part in text.translate(_TABLE).split(b"\n") if (words := part.split())]


def features(word: bytes) -> list[int]:
    """Numbers of a word: of itself, and of its beginnings, which its inflections share."""
    letters = word.decode(errors="replace")
    parts = [f"{size}|{letters[:size]}" for size in STEMS if len(letters) > size]
    return [zlib.crc32(part.encode()) % FEATURES for part in (f"|{letters}", *parts)]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float


class Reader:
    """Scores sentences; remembers the weights of words it has met, up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}

    def weight(self, word: bytes) -> float:
        if len(self.known) > 1_000_000:
            self.known.clear()
        found = self.known[word] = float(self.model.weights[features(word)].sum())
        return found

    def scores(self, text: bytes) -> np.ndarray:
        """One score per sentence."""
        get, weight, parts = self.known.get, self.weight, sentences(text)
        sums = [sum([x if (x := get(w)) is not None else weight(w) for w in words]) for words in parts]
        return 1 / (1 + np.exp(-np.clip(np.array(sums) + self.model.bias, -30, 30)))


def noisy_or(scores: np.ndarray) -> float:
    """Chance that one sentence at least is toxic; 0 without sentences."""
    return float(-np.expm1(np.log1p(-np.minimum(scores, 1 - 1e-12)).sum()))


def fitted(documents: Iterable[tuple[bytes, int]]) -> Model:
    """A model of these texts and labels. Without both labels it is the prior alone."""
    weights = np.zeros(FEATURES, np.float32)
    numbers: dict[bytes, int] = {}
    coded, sizes, labels = [], [], []
    for text, label in documents:
        if parts := sentences(text):
            coded.append(np.array([numbers.setdefault(w, len(numbers)) for words in parts for w in words], np.int32))
            sizes.append(np.array([len(words) for words in parts], np.int32))
            labels.append(float(label))
    if len(set(labels)) < 2:
        return Model(weights, PRIOR)
    word, counts = np.concatenate(coded), np.concatenate(sizes)
    starts = np.cumsum(counts) - counts
    lists = [features(w) for w in numbers]
    of_word, feature = np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.concatenate(lists)
    spread = np.zeros(FEATURES, np.int64)
    by_word = np.split(feature, np.flatnonzero(np.diff(of_word)) + 1)
    for found in coded:
        spread[np.unique(np.concatenate([by_word[w] for w in np.unique(found)]))] += 1
    common = spread[feature] >= RARE
    of_word, feature = of_word[common], feature[common]
    used, feature = np.unique(feature, return_inverse=True)
    sentence_counts = np.array([len(x) for x in sizes])
    heads = np.cumsum(sentence_counts) - sentence_counts
    labels = np.array(labels)
    owner = np.repeat(np.arange(len(labels)), sentence_counts)
    own, moved, bias, bias_moved = np.zeros(len(used)), np.full(len(used), 1e-8), PRIOR, 1e-8
    for _ in range(ROUNDS):  # full steps, scaled by past slopes
        each = np.bincount(of_word, weights=own[feature], minlength=len(lists))
        score = 1 / (1 + np.exp(-np.clip(np.add.reduceat(each[word], starts) + bias, -30, 30)))
        harmless = np.exp(np.add.reduceat(np.log1p(-np.minimum(score, 1 - 1e-12)), heads))
        share = np.where(labels == 1, -harmless / np.maximum(1 - harmless, 1e-9), 1.0)
        slope = score * share[owner] / len(labels)
        by_word = np.bincount(word, weights=np.repeat(slope, counts), minlength=len(lists))
        step = np.bincount(feature, weights=by_word[of_word], minlength=len(used))
        moved += step**2
        rate = RATE / np.sqrt(moved)
        own -= rate * step
        own = np.sign(own) * np.maximum(np.abs(own) - rate * SPARSITY, 0)
        total = slope.sum()
        bias_moved += total**2
        bias -= RATE * total / np.sqrt(bias_moved)
    weights[used] = own
    return Model(weights, float(bias))


def training_sample(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``sample`` documents with labels, the same in every run.

    A document with several labels is toxic if one says so; rows without a label
    are left out. Of documents that share an id one is taken.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.withColumn("rank", F.xxhash64("doc_id")).orderBy("rank", "doc_id").limit(sample).select("doc_id", "toxic")
    texts = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))


def fitted_to(sample: DataFrame) -> Model:
    """A model of ``doc_id, text, toxic`` rows, fitted in one task: the sample is bounded."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), _SAMPLE).sort_by("doc_id")
        texts = (text.as_buffer().to_pybytes() for text in table.column("text"))
        model = fitted(zip(texts, table.column("toxic").to_pylist()))
        used = np.flatnonzero(model.weights)
        parts = ([model.bias], [used.astype(np.int32).tobytes()], [model.weights[used].tobytes()])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts], ["bias", "used", "weights"])

    rows = sample.select("doc_id", F.col("text").cast("binary"), F.col("toxic").cast("int")).repartition(1)
    found = rows.mapInArrow(run, "bias double, used binary, weights binary").first()
    weights = np.zeros(FEATURES, np.float32)
    if found:
        weights[np.frombuffer(found.used, np.int32)] = np.frombuffer(found.weights, np.float32)
    return Model(weights, found.bias if found else PRIOR)


SCORED = "doc_id long, score double, offending array<struct<sentence:int,score:double>>"


def scored(documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """``doc_id, score, offending`` of every row; offending are sentences (numbered from 0) that score so much.

    Every text is read whole. Sentences end at full stops, marks and line ends;
    those without words are not numbered. Null, empty and wordless texts score 0.
    Repeated rows and null ids stay; other columns are ignored.
    """
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(held.value)
        for batch in batches:
            totals, found = [], []
            for text in batch.column(1).cast(pa.binary()):
                scores = reader.scores(text.as_buffer().to_pybytes() if text.is_valid else b"")
                totals.append(noisy_or(scores))
                found.append([{"sentence": int(i), "score": float(scores[i])} for i in np.flatnonzero(scores >= threshold)])
            kind = pa.list_(pa.struct([("sentence", pa.int32()), ("score", pa.float64())]))
            columns = [batch.column(0), pa.array(totals, pa.float64()), pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "offending"])

    narrow = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return narrow.mapInArrow(run, SCORED)


def held_out(id_column: str = "doc_id"):
    """True for the fifth of ids whose labels are never learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 5 == 0


def learned(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of labelled documents that are not held out."""
    return fitted_to(training_sample(documents, labels.where(~held_out()), sample))


def without_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` that score below the threshold, with their columns."""
    model = learned(documents, labels)
    names = documents.columns
    held = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, at = Reader(held.value), names.index("text")
        for batch in batches:
            texts = (text.as_buffer().to_pybytes() if text.is_valid else b"" for text in batch.column(at).cast(pa.binary()))
            keep = [noisy_or(reader.scores(text)) < threshold for text in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
