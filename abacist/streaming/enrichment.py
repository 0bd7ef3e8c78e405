"""Resumable generation: new question files in, one table of pairs out.

What is done is known by keyed state: one entry per id and attempt, in the state
store, so a start reads neither the sink nor earlier questions. A question whose
calls failed is opened again: it goes to a folder that is a second source of the
stream, with the number of its next attempt, and the next start takes it up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from abacist.operators.generation import (
    failed,
    generated_pairs,
    solution_requests,
    succeeded,
)
from abacist.operators.keyed import last_by_key, rows_to_do
from abacist.operators.tables import preference_records, row_id, solution_records
from abacist.sources.selection import make_folder, path_exists

BATCH_COLUMN = "batch"
ATTEMPT_COLUMN = "attempt"

# State on disk, saved as changes: a batch costs what it adds, not what is known.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings while a query starts; it keeps them, the session does not."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def reopened_path(sink: str) -> str:
    """Where failed questions wait for the next start."""
    return f"{sink.rstrip('/')}-reopened"


def _write_batch(
    rows: DataFrame, sink: str, batch: int, load: Callable, generation: dict
) -> None:
    """Generate a batch of new questions; a batch that is run again replaces itself."""
    path = f"{sink}/{BATCH_COLUMN}={batch}"
    pairs = generated_pairs(solution_requests(rows), load, **generation)
    pairs.write.mode("overwrite").partitionBy("status").parquet(path)
    refused = f"{path}/status=failed"
    reopened = f"{reopened_path(sink)}/{BATCH_COLUMN}={batch}"
    if path_exists(rows.sparkSession, refused):
        again = rows.sparkSession.read.schema(rows.schema).parquet(refused)
        again = again.withColumn(ATTEMPT_COLUMN, F.col(ATTEMPT_COLUMN) + 1)
        again.write.mode("overwrite").parquet(reopened)


def enrich_new_questions(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    sink: str,
    checkpoint: str,
    load: Callable[[], Callable[[str, str], str]],
    files_per_batch: int | None = None,
    source_format: str = "parquet",
    **generation,
) -> StreamingQuery:
    """Start a query that generates pairs for all questions not taken up yet.

    Each batch of the files (Parquet or JSON lines) under ``source`` is reduced
    to ids the state does not know, enriched and written to its own
    ``batch=<n>`` folder of the sink. A batch that is run again after a crash
    starts from the state before it and overwrites its folder, so an id is never
    there twice. Questions whose calls failed are kept with their error and
    generated again by the next start. The query stops when all files present
    at its start are done; starting it again takes up new ones. ``checkpoint``,
    which holds the state, has to be in the shared folder.
    """

    def enrich(rows: DataFrame, batch: int) -> None:
        _write_batch(rows, sink, batch, load, generation)

    reopened = reopened_path(sink)
    make_folder(spark, reopened)
    stream = spark.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    fresh = row_id(stream.format(source_format).load(source)).withColumn(ATTEMPT_COLUMN, F.lit(0))
    again = spark.readStream.schema(fresh.schema).option("recursiveFileLookup", True).parquet(reopened)
    # never null, whichever source a batch has rows of: the state's key keeps its type
    attempt = F.coalesce(ATTEMPT_COLUMN, F.lit(0))
    both = fresh.unionByName(again).withColumn(ATTEMPT_COLUMN, attempt)
    new = both.dropDuplicates(["id", ATTEMPT_COLUMN])
    writer = new.writeStream.foreachBatch(enrich).option("checkpointLocation", checkpoint)
    with _settings(spark, STATE_SETTINGS):
        return writer.trigger(availableNow=True).start()


def _stored(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink)


def enriched_pairs(spark: SparkSession, sink: str) -> DataFrame:
    """All pairs generated so far."""
    return succeeded(_stored(spark, sink)).drop(BATCH_COLUMN, ATTEMPT_COLUMN)


def failed_questions(spark: SparkSession, sink: str) -> DataFrame:
    """Questions without a pair, one row per id: its last attempt."""
    stored = _stored(spark, sink)
    open_rows = rows_to_do(failed(stored), succeeded(stored))
    return last_by_key(open_rows, ["id"], ATTEMPT_COLUMN).drop(BATCH_COLUMN, ATTEMPT_COLUMN)


def enriched_solutions(spark: SparkSession, sink: str) -> DataFrame:
    """Training solutions generated so far."""
    return solution_records(enriched_pairs(spark, sink))


def enriched_preferences(spark: SparkSession, sink: str) -> DataFrame:
    """Preference pairs generated so far."""
    return preference_records(enriched_pairs(spark, sink))
