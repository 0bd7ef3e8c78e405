"""Whitening of vectors along the leading components of their covariance.

Vectors become whole numbers first, so that sums are exact. Every task adds up
products of centred vectors, rows of the covariance are summed apart, one small
matrix is decomposed (see ``spectral.py``), and the components go out to all rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.components import saved
from abacist.llm.spectral import EPSILON, leading_components

STEP = 256
"""Whole numbers per unit of a vector's entries."""

COMPONENTS = 4

LIMIT = 2.0**62
"""Scaled entries have to be smaller, to be whole 64-bit numbers."""

WHITENED = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


@dataclass
class Whitening:
    """What rows need: a few vectors of the length of the embedding, whatever the number of rows."""

    count: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def __post_init__(self) -> None:
        self.mean = np.array([s / self.count for s in self.sums])
        self.real = self.values > len(self.sums) * EPSILON * self.trace

    def weights(self) -> np.ndarray:
        """Components over the roots of their eigenvalues; nothing where there is no variance."""
        roots = np.sqrt(np.where(self.real, self.values, 1.0))
        return np.where(self.real[:, None], self.vectors / roots[:, None], np.nan)


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", step: int = STEP) -> DataFrame:
    """``vec_id, x``: rows whose entries are all finite, as whole multiples of ``1/step``, rounded down.

    Rows without a vector, with an empty one, or with an entry that is null, not
    finite or 2^62 and more once scaled are left out.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("c"))
    fits = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * step) < LIMIT))
    rows = rows.where(F.coalesce(fits & (F.size("c") > 0), F.lit(False)))
    return rows.select("vec_id", F.transform("c", lambda c: F.floor(c * step)).alias("x"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _products(mean: np.ndarray):
    """Per task, the rows of the sum of centred products, from the diagonal on."""
    size = len(mean)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        rows = 0
        for batch in batches:
            centred = _matrix(batch.column(0), size) - mean
            total += centred.T @ centred
            rows += len(batch)
        if rows:
            held = pa.array([total[i, i:] for i in range(size)], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), held], ["place", "products"])

    return run


def _summed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One row of the covariance: the parts of all tasks, each as long as that row."""
    total = np.sum(table.column("products").to_pylist(), axis=0)
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([total], pa.list_(pa.float64()))], ["place", "products"])


def _components(count: int, components: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.sort_by("place").column("products").to_pylist()
        covariance = np.zeros((len(rows), len(rows)))
        for i, row in enumerate(rows):
            covariance[i, i:] = covariance[i:, i] = np.array(row) / count
        values, vectors = leading_components(covariance, min(components, len(rows)))
        trace = pa.array([float(np.trace(covariance))] * len(values), pa.float64())
        held = pa.array(list(vectors), pa.list_(pa.float64()))
        return pa.table([pa.array(range(1, len(values) + 1), pa.int32()), pa.array(values, pa.float64()), trace, held], ["component", "value", "trace", "vector"])

    return run


def _spread(model: Whitening):
    """Per task: number, means and centred products of the whitened vectors."""
    weights = model.weights()[model.real]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                whitened = (_matrix(batch.column(0), len(model.sums)) - model.mean) @ weights.T
                middle = whitened.mean(0)
                products = (whitened - middle).T @ (whitened - middle)
                row = [pa.array([v], k) for v, k in ((len(batch), pa.int64()), (middle, pa.list_(pa.float64())), (products.ravel(), pa.list_(pa.float64())))]
                yield pa.RecordBatch.from_arrays(row, ["count", "means", "products"])

    return run


def _identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest difference between the whitened vectors' covariance and the identity."""
    size = int(model.real.sum())
    if not size:
        return 0.0
    parts = distinct.mapInArrow(_spread(model), "count long, means array<double>, products array<double>")
    # sums of parts, so the middle of each is moved to that of all before it is multiplied
    parts = saved(parts)
    means = parts.select(F.posexplode("means").alias("i", "m"), "count").groupBy("i").agg(F.sum(F.col("m") * F.col("count")).alias("m"))
    middle = {row.i: row.m / model.count for row in means.collect()}  # one row a component
    between = F.array(*(F.lit(middle[i]) for i in range(size)))
    moved = parts.select("products", "count", F.zip_with("means", between, lambda a, b: a - b).alias("off"))
    pairs = F.flatten(F.transform("off", lambda a: F.transform("off", lambda b: a * b)))
    moved = moved.select("products", F.transform(pairs, lambda p: p * F.col("count")).alias("more"))
    total = F.posexplode(F.zip_with("products", "more", lambda a, b: a + b)).alias("i", "v")
    rows = moved.select(total).groupBy("i").agg(F.sum("v").alias("v")).collect()  # one row a pair of components
    covariance = np.array([row.v for row in sorted(rows)]).reshape(size, size) / model.count
    return float(np.abs(covariance - np.eye(size)).max())


def fitted(whole: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vec_id, x`` rows, each different vector counted once; None without vectors.

    All vectors have to have the same length. Sums are exact; the covariance is
    centred before it is multiplied, and divided by the number of vectors.
    """
    distinct = saved(whole.select("x").distinct())
    each = distinct.select(F.posexplode("x").alias("i", "value"))
    sums = each.groupBy("i").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("total"), F.count("*").alias("n")).collect()  # one row a dimension
    if not sums:
        return None
    sums.sort()
    count, totals = sums[0].n, [int(row.total) for row in sums]
    mean = np.array([t / count for t in totals])
    parts = distinct.mapInArrow(_products(mean), "place int, products array<double>")
    rows = parts.groupBy("place").applyInArrow(_summed, "place int, products array<double>")
    found = rows.groupBy().applyInArrow(_components(count, components), "component int, value double, trace double, vector array<double>")
    found = found.collect()  # as many rows as components
    found.sort()
    model = Whitening(count, totals, np.array([r.value for r in found]), np.array([r.vector for r in found]), found[0].trace)
    model.identity_error = _identity_error(distinct, model)
    return model


def _deviations(x: np.ndarray, model: Whitening) -> pa.Array:
    """Exact sums of squares of ``n * x - S``; null beyond 38 digits."""
    kind = pa.decimal128(38, 0)
    reach = model.count * max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0)))) + max(map(abs, model.sums))
    if reach * reach * len(model.sums) < 1 << 63:
        off = model.count * x - np.array(model.sums, np.int64)
        return pa.array((off * off).sum(1), pa.int64()).cast(kind)
    exact = [sum((model.count * v - s) ** 2 for v, s in zip(row, model.sums)) for row in x.tolist()]
    return pa.array([Decimal(v) if v < 10**38 else None for v in exact], kind)


def whitened(whole: DataFrame, model: Whitening) -> DataFrame:
    """One row per row of ``vec_id, x`` and component."""
    size, weights = len(model.sums), model.weights()
    numbers = len(weights)
    explained = [float(v) if model.trace > 0 else None for v in (model.values / model.trace if model.trace > 0 else model.values)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), size)
            places = pa.array(np.repeat(np.arange(len(x)), numbers))
            values = ((x - model.mean) @ weights.T).ravel()
            columns = [
                batch.column(0).take(places),
                pa.array(np.tile(np.arange(1, numbers + 1, dtype=np.int32), len(x)), pa.int32()),
                pa.array(np.full(len(places), model.count), pa.int64()),
                _deviations(x, model).take(places),
                pa.array(values, pa.float64(), mask=np.isnan(values)),
                pa.array(explained * len(x), pa.float64()),
                pa.array(np.full(len(places), model.identity_error), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return whole.select("vec_id", "x").mapInArrow(run, WHITENED)


def whitened_vectors(
    vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding", step: int = STEP
) -> DataFrame:
    """Every usable vector along the ``components`` directions of most variance, each with variance 1.

    Rows of :func:`whole_vectors` only. Vectors have the length that most of them
    have (the smaller of two as frequent ones); others are left out. Equal vectors
    count once in the fit and are all whitened; rows that share an id or have none
    are rows of their own. A shorter vector has as many components as entries. A
    component without variance is whitened to null, and nothing is explained where
    no component has any. Other columns are ignored; an empty table gives none.
    """
    whole = whole_vectors(vectors, id_column, vector_column, step)
    common = whole.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return whole.sparkSession.createDataFrame([], WHITENED)
    whole = whole.where(F.size("x") == common["size"])
    return whitened(whole, fitted(whole, components))
