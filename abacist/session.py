"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
INITIAL_PARTITIONS_SETTING = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Shuffle partitions of a cluster before small ones are merged.
INITIAL_PARTITIONS = 8_000


def build_session(master: str | None = None, app_name: str = "abacist", **settings) -> SparkSession:
    """A session with the settings the operators rely on.

    Partition counts are left to adaptive execution unless given. It merges
    partitions but never adds any, so a cluster starts from many.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if not (master or "").startswith("local"):
        builder = builder.config(INITIAL_PARTITIONS_SETTING, INITIAL_PARTITIONS)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, empty path in the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local
    session, as in tests, may go without and gets a temporary one.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="abacist-")
    return f"{root.rstrip('/')}/abacist/{purpose}-{uuid.uuid4().hex}"
