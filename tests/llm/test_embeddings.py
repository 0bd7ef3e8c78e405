"""Vector dedup against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from abacist.llm import embeddings
from abacist.llm.components import joined
from abacist.llm.hnsw import RECALL, Graph

VECTORS = "vec_id long, embedding array<float>"


def clustered(seed, count=400, size=16):
    rng = np.random.default_rng(seed)
    found = rng.normal(size=(count, size))
    for i in range(0, count, 3):
        found[i] = found[i // 30 * 30] + rng.normal(size=size) * 0.12
    return found.astype(np.float32)


def pairs_of(graph, queries, cosine=0.9, beam=None):
    found = [(at, node) for at, node in graph.within(queries, cosine, beam)]
    return {(int(a), int(graph.ids[b])) for at, node in found for a, b in zip(at, node)}


def unit(vectors):
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def test_graph_recall():
    vectors = unit(clustered(1, 3000).astype(np.float64))
    graph = Graph.from_bytes(Graph(np.arange(3000) * 7, vectors, 0.9).to_bytes())
    found = {(a * 7, b) for a, b in pairs_of(graph, vectors, beam=32)}
    wanted = {(int(a) * 7, int(b) * 7) for a, b in zip(*np.nonzero(vectors @ vectors.T >= 0.9))}
    assert found <= wanted
    assert len(found) >= 0.95 * len(wanted)


def test_audit_without_links():
    """No two vectors of the shard are near, so only planted copies tell the recall."""
    rng = np.random.default_rng(5)
    vectors = unit(rng.normal(size=(5000, 32)))
    graph = Graph(np.arange(5000), vectors, 0.9, (np.arange(9000, 10000), unit(rng.normal(size=(1000, 32)))))
    assert (vectors @ vectors.T >= 0.9).sum() == 5000
    planted = graph._planted(np.arange(1000), 0.9)
    cosines = np.einsum("nd,nd->n", planted, graph.exact[:1000])
    assert cosines.min() >= 0.9 and cosines.max() <= 0.951
    queries = unit(vectors[:1000] + rng.normal(size=(1000, 32)) * 0.06)  # pairs: the other one is in another shard
    found = pairs_of(graph, queries)
    wanted = {(int(a), int(b)) for a, b in zip(*np.nonzero(queries @ vectors.T >= 0.9))}
    assert len(wanted) > 500 and found <= wanted and len(found) >= RECALL * len(wanted)


def test_audit_widens_the_beam():
    rng = np.random.default_rng(6)
    vectors = unit(rng.normal(size=(6000, 32)))
    graph = Graph(np.arange(6000), vectors, 0.9)
    for layer in graph.layers:  # a graph that is hard to walk
        layer.neighbours[:, 3:] = -1
    graph.layers[0].connect()
    before, queries = graph.beam, graph._planted(np.arange(0, 6000, 6), 0.9)
    graph._audit(0.9, None)
    found, wanted = graph.recall(queries, 0.9)
    assert graph.beam > before and wanted >= 1000 and found >= 0.95 * wanted


def test_full_beams_go_on_from_what_they_hold():
    rng = np.random.default_rng(7)
    vectors = unit(np.concatenate((rng.normal(size=(1, 16)) + rng.normal(size=(100, 16)) * 0.05, rng.normal(size=(7_900, 16)))))
    graph = Graph(np.arange(8_000), vectors, 0.9)
    wanted = (vectors[:100] @ vectors.T >= 0.9).sum()
    assert wanted >= 100 * 90 and len(pairs_of(graph, vectors[:100])) >= 0.99 * wanted


def test_links_count_on_both_ends(spark):
    """Whatever is found, the sum over links is the same from both ends."""
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(6000, 24))
    vectors[3000:] = vectors[:3000] + rng.normal(size=(3000, 24)) * 0.3
    rows = [(i, v.tolist()) for i, v in enumerate(vectors.astype(np.float32))]
    found = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(rows, VECTORS), shards=2).collect()}
    exact = unit(vectors.astype(np.float32).astype(np.float64))
    linked = exact @ exact.T >= 0.9
    wanted = linked.sum(1) - 1
    total = sum(r.n_links for r in found.values())
    assert total % 2 == 0 and RECALL * wanted.sum() <= total <= wanted.sum()
    for i in range(3000):  # pairs: both ends tell the same
        if wanted[i] == wanted[i + 3000] == 1 and linked[i, i + 3000]:
            assert found[i].n_links == found[i + 3000].n_links


def test_joins_on_a_hot_key_are_split(spark):
    """Half of all rows share a key: with low thresholds, adaptive execution deals them out."""
    low = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in low}
    for key, value in low.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("u"), F.col("id").alias("v"))
        found = joined(rows, rows.groupBy("u").agg(F.min("v").alias("m")), ["u"])
        assert found.count() == 60_000 and found.where("m > v").isEmpty()
        found.write.format("noop").mode("overwrite").save()
        execution = found._jdf.queryExecution()
        found.collect()
        assert "skew=true" in execution.executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_near_vectors(spark):
    vectors = clustered(2)
    rows = [(i, vectors[i].tolist()) for i in range(len(vectors))]
    found = {r.vec_id: r for r in embeddings.near_vectors(spark.createDataFrame(rows, VECTORS), shards=3).collect()}
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    root = list(range(len(rows)))
    for _ in range(len(rows)):
        new = [min(root[j] for j in np.flatnonzero(linked[i])) for i in range(len(rows))]
        if new == root:
            break
        root = new
    assert [found[i].n_links for i in range(len(rows))] == (linked.sum(1) - 1).tolist()
    assert [found[i].component_id for i in range(len(rows))] == root
    assert all(found[i].kept == (root[i] == i) for i in range(len(rows)))


def test_odd_vectors(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [float("inf"), 1.0])]
    rows += [(9, [1.0, 1.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]), (7, [2.0, 2.1]), (10, [1.0, 1.0, 0.0]), (None, [1.0, 1.0])]
    random.Random(3).shuffle(rows)
    table = spark.createDataFrame(rows, VECTORS).withColumns({"shard": F.lit("x"), "first": F.lit(1), "component": F.lit(2)})
    found = sorted((r.vec_id or 99, r.n_links, r.component_id or 99, r.kept) for r in embeddings.near_vectors(table).collect())
    alone = [(i, 0, i, True) for i in range(1, 7)]
    assert found == [*alone, (7, 3, 7, True), (8, 3, 7, False), (8, 3, 7, False), (9, 3, 7, False), (10, 0, 10, True), (99, 0, 99, True)]
    assert embeddings.near_vectors(table.limit(0)).count() == 0
