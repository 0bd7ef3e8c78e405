"""Near-duplicate vectors: a navigable graph per shard, every shard asked by every vector."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.components import components, saved
from abacist.llm.hnsw import AUDIT, Graph

COSINE = 0.9
SHARD_VECTORS = 200_000
"""Different vectors that one graph indexes, about."""

SHARDS = 8
"""Graphs at least, so that a small table is built in parallel too."""

FOUND = "kind int, id long, other long, links long"


def _distinct(vectors: DataFrame) -> DataFrame:
    """``embedding, first, copies``: usable vectors, each once."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    return vectors.where(F.coalesce(usable, F.lit(False))).groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that squares neither overflow nor vanish."""
    held = column.combine_chunks()
    matrix = held.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(held), -1)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _graphs(cosine: float):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, sample: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table([pa.array([], k) for k in (pa.int32(), pa.int32(), pa.binary(), pa.binary())], ["size", "shard", "graph", "weights"])
        table, sample = table.sort_by("first"), sample.sort_by("first")
        asked = (sample.column("first").to_numpy(), _matrix(sample.column("embedding"))) if len(sample) else None
        graph = Graph(table.column("first").to_numpy(), _matrix(table.column("embedding")), cosine, asked)
        copies = dict(zip(table.column("first").to_pylist(), table.column("copies").to_pylist()))
        weights = np.array([copies[i] for i in graph.ids.tolist()], np.int64)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([graph.to_bytes()], pa.binary()), pa.array([weights.tobytes()], pa.binary())], ["size", "shard", "graph", "weights"])

    return run


class _Forest:
    """Links that connect what all links connect; the others are dropped as they come."""

    def __init__(self, size: int) -> None:
        self.root, self.links = np.arange(size), []

    def _find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = int(self.root[x])
        return x

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        apart = self.root[left] != self.root[right]
        if not apart.any():
            return
        for a, b in zip(left[apart].tolist(), right[apart].tolist()):
            x, y = self._find(a), self._find(b)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.links.append((a, b))
        while (above := self.root[self.root] != self.root).any():  # so that the next links compare roots
            self.root[above] = self.root[self.root[above]]


def _asked(cosine: float):
    """Links between a shard's graph and a block of vectors, counted for both ends of each."""

    def run(key: tuple[pa.Scalar, ...], graphs: pa.Table, queries: pa.Table) -> pa.Table:
        rows: list[tuple[int, int, int | None, int | None]] = []
        if len(graphs) and len(queries):
            graph = Graph.from_bytes(graphs.column("graph")[0].as_py())
            weights = np.frombuffer(graphs.column("weights")[0].as_py(), np.int64)
            own = key[1].as_py() == key[2].as_py()  # the shard asks itself: a link is found from its smaller end
            order = np.argsort(graph.ids) if own else None
            ids, copies = queries.column("first").to_numpy(), queries.column("copies").to_numpy()
            names = graph.ids if own else np.concatenate((graph.ids, ids))
            place = order[np.searchsorted(graph.ids, ids, sorter=order)] if own else len(graph.ids) + np.arange(len(ids))
            counts, forest = np.zeros(len(names), np.int64), _Forest(len(names))
            for at, node in graph.within(_matrix(queries.column("embedding")), cosine):
                if own:
                    first = ids[at] < graph.ids[node]
                    at, node = at[first], node[first]
                np.add.at(counts, place[at], weights[node])
                np.add.at(counts, node, copies[at])
                forest.add(place[at], node)
            rows = [(0, int(names[i]), None, int(counts[i])) for i in np.flatnonzero(counts)]
            rows += [(1, int(names[a]), int(names[b]), None) for a, b in forest.links]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 4, kinds)], ["kind", "id", "other", "links"])

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE, shard_vectors: int = SHARD_VECTORS, shards: int = SHARDS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vec_id, embedding``.

    Vectors of equal length whose cosine in double precision reaches ``cosine``
    are linked as far as the graphs find them (each graph audits its recall when
    it is built, on near copies planted among its own vectors and on about 1,024 of
    the whole table); none below is. A pair is looked for once, in the later shard
    of the two or from the smaller id within one, and counts for both. Equal
    vectors are searched once and all linked.
    A null, empty or zero vector, one with a null or non-finite component, or one
    without an id links with nothing and is its own component. Rows that share an
    id but differ share their links. Other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    distinct = saved(_distinct(rows).withColumn("size", F.size("embedding")))
    total = distinct.count()
    count = max(shards, -(-total // shard_vectors))
    placed = distinct.withColumn("shard", F.pmod(F.xxhash64("first"), F.lit(count)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    sample = distinct.where(F.pmod(F.xxhash64("first", F.lit("audit")), F.lit(max(total, 1))) < AUDIT).select("size", "embedding", "first", every.alias("shard"))
    dealt = placed.groupBy("size", "shard").cogroup(sample.groupBy("size", "shard"))
    graphs = saved(dealt.applyInArrow(_graphs(cosine), "size int, shard int, graph binary, weights binary"))
    later = F.explode(F.sequence("shard", F.lit(count - 1)))
    asked = placed.select("size", "embedding", "first", "copies", F.col("shard").alias("block"), later.alias("shard"))
    served = graphs.select("*", F.explode(F.sequence(F.lit(0), "shard")).alias("block"))
    keys = ("size", "shard", "block")
    found = saved(served.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_asked(cosine), FOUND))
    links = found.where("kind = 0").groupBy("id").agg(F.sum("links").alias("others"))
    joined = components(found.where("kind = 1"), "id", "other")
    named = distinct.join(links, F.col("first") == F.col("id"), "left").join(joined, F.col("first") == F.col("node"), "left")
    named = named.select("embedding", "copies", F.coalesce("others", F.lit(0)).alias("others"), F.coalesce("component", "first").alias("component"))
    result = rows.where("vec_id is not null").join(named, "embedding", "left").union(
        rows.where("vec_id is null").select("embedding", "vec_id", *[F.lit(None).cast("long").alias(c) for c in ("copies", "others", "component")])
    )
    component = F.coalesce("component", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.col("others"), F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
