"""Near-duplicates by SimHash fingerprints and pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abacist.llm.components import components, saved

SHINGLE = 3
SEED = 42
DISTANCE = 2
BLOCKS = (11, 11, 11, 11, 10, 10)
"""Bits of the blocks; a pair within two bits shares four of the six, 42 bits or more."""

FULL = 64
"""Fingerprints of a block key that are compared with each other; beyond, see ``_links``."""

SLAB = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), SLAB):
        spans = zip(starts[at : at + SLAB], ends[at : at + SLAB])
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in spans], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(starts))
    return int(bits.view(">i8")[0])


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (long) of every row; a null text has no words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(text.as_buffer().to_pybytes() if text.is_valid else None) for text in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.int64())], ["doc_id", "fingerprint"])

    narrow = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fingerprint long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _block_keys(value: Column) -> Column:
    """The value without each choice of as many blocks as bits may differ."""
    edges = [sum(BLOCKS[:i]) for i in range(len(BLOCKS) + 1)]
    blocks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    masks = [(1 << 64) - 1 - sum(left_out) for left_out in combinations(blocks, DISTANCE)]
    return F.array(*[F.struct(F.lit(i).alias("choice"), value.bitwiseAND(F.lit(_signed(m))).alias("kept")) for i, m in enumerate(masks)])


def _links(values: DataFrame) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints within two bits of each other.

    Block keys of at most ``FULL`` fingerprints compare them all. Fingerprints in
    a fuller block go by the values one bit away: two within two bits share such
    a value, and all that share one are within two bits, so each value links its
    at most 65 fingerprints to the smallest of them.
    """
    keyed = values.select("fingerprint", F.explode(_block_keys(F.col("fingerprint"))).alias("key"))
    keyed = keyed.select("key.choice", "key.kept", "fingerprint").repartition("choice", "kept")
    sizes = keyed.groupBy("choice", "kept").agg(F.count("*").alias("size")).where("size > 1")
    sized = keyed.join(sizes, ["choice", "kept"])
    left, right = (sized.where(F.col("size") <= FULL).select("choice", "kept", F.col("fingerprint").alias(name)) for name in ("a", "b"))
    pairs = left.join(right, ["choice", "kept"]).where("a < b")
    near = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE).select("a", "b")
    return near.union(_through_neighbours(sized.where(F.col("size") > FULL).select("fingerprint").distinct()))


def _through_neighbours(values: DataFrame) -> DataFrame:
    bits = [_signed(1 << i) for i in range(64)]
    own = F.col("fingerprint")
    near = values.select(own, F.explode(F.array(own, *[own.bitwiseXOR(F.lit(b)) for b in bits])).alias("value"))
    groups = near.groupBy("value").agg(F.collect_set("fingerprint").alias("members")).where(F.size("members") > 1)
    return groups.select(F.explode("members").alias("a"), F.array_min("members").alias("b")).where("a <> b")


def near_groups(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Fingerprints within two bits of each other are linked; ``component_id`` is
    the smallest id that links reach, null if all ids there are null. Texts
    without words, null ones too, have fingerprint 0. Copies share a fingerprint
    and are counted once while links are sought. Repeated rows stay repeated,
    other columns are ignored, an empty table gives none.
    """
    found = saved(fingerprints(documents, id_column, text_column))
    distinct = saved(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    linked = components(_links(distinct.select("fingerprint")), "a", "b")
    labelled = distinct.join(linked, F.col("fingerprint") == F.col("node"), "left")
    labelled = labelled.select("fingerprint", "first", F.coalesce("component", "fingerprint").alias("label"))
    names = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    named = labelled.join(names, "label").select("fingerprint", "component_id")
    return found.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def without_near_copies(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``documents`` that stay: of each group those of the smallest id.

    Of rows that share that id one stays, any of them if they differ. Rows
    without an id are not compared and stay.
    """
    groups = near_groups(documents.where(F.col(id_column).isNotNull()), id_column, text_column)
    stay = groups.where("doc_id = component_id").select(F.col("doc_id").alias("_kept_id")).distinct()
    known = documents.join(stay, documents[id_column] == stay["_kept_id"], "left_semi").dropDuplicates([id_column])
    return known.union(documents.where(F.col(id_column).isNull()))
