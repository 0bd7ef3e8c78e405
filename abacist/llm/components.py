"""Connected components by repeated star joins, without any group in one task."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.session import CHECKPOINT_SETTING


def saved(frame: DataFrame) -> DataFrame:
    """The rows, checkpointed where the session says."""
    context = frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(frame.sparkSession.conf.get(CHECKPOINT_SETTING, None) or _own_folder(context.master))
    return frame.checkpoint()


def _own_folder(master: str) -> str:
    if not master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    return tempfile.mkdtemp(prefix="abacist-")


def joined(rows: DataFrame, found: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Rows with what an aggregate found for their keys, which are not null.

    The aggregate lies as its keys were shuffled, and a join on those keys would
    take it as it lies: then adaptive execution cannot split the rows of a key that
    many have. Compared null-safe, both sides are shuffled for the join.
    """
    found = found.withColumnsRenamed({key: f"_found_{key}" for key in keys})
    same = F.lit(True)
    for key in keys:
        same = same & rows[key].eqNullSafe(found[f"_found_{key}"])
    return rows.join(found, same, how).drop(*(f"_found_{key}" for key in keys))


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, component`` of every linked node; a component is named by its smallest node.

    ``links`` may repeat and may link a node with itself; null ends count as no
    link. Each round joins every node's links to its smallest neighbour (larger
    neighbours, then smaller ones) and ends when no link changes. A node of very
    many links is aggregated before it is shuffled; its rows are only joined, see
    :func:`joined`, and adaptive execution splits them.
    """
    pairs = links.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v")
    pairs = saved(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        pairs = joined(both.where("v > u"), least, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        named = joined(pairs, least, ["u"])
        pairs = named.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v")))
        pairs = saved(pairs.distinct())
    return pairs.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").union(
        pairs.select("v").distinct().join(pairs.select(F.col("u").alias("v")), "v", "left_anti").select("v", F.col("v").alias("c"))
    )
