"""Model and generator calls on batches of rows.

The model stays outside: users pass ``load``, which is called once per Python
worker, when its first row arrives, and returns the function to call. Results depend on it, so write the output
before using it more than once. Spark may run a task again; turn speculation
off where calls cost money, and keep the last row per id when appending.

Calls are of the size the model wants; answers are handed on by the thousand, or
by time where calls are slow, so that neither many small frames nor a late one
hold the stream up.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import Future, ThreadPoolExecutor

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.constants import (
    CALL_INTERVAL_SECONDS,
    DEFAULT_SEED,
    GENERATION_TRIES,
    RETRY_WAIT_SECONDS,
)
from abacist.functions.chat import (
    DEFAULT_CORRECT_REQUEST,
    DEFAULT_WRONG_REQUEST,
    request_text,
)
from abacist.functions.hashing import hash32
from abacist.functions.workers import loaded
from abacist.operators.tables import copies

Generate = Callable[..., list[str]]

OUTPUT_ROWS = 5_000
"""Answered rows that are handed on at a time ..."""

OUTPUT_SECONDS = 30.0
"""... or those that are there after so long."""

CALL_TASKS = 16
"""Tasks that share a call rate, if nothing else is said."""

def flushed(
    rows: pa.RecordBatch,
    columns: Sequence[pa.Field],
    answers: Iterable[Sequence[tuple]],
    max_rows: int = OUTPUT_ROWS,
    max_seconds: float = OUTPUT_SECONDS,
    clock: Callable[[], float] = time.monotonic,
) -> Iterator[pa.RecordBatch]:
    """``rows`` with their answers as ``columns``, in few batches.

    ``answers`` brings those of the next rows, one call's at a time. A batch is
    handed on when ``max_rows`` are answered, when the first of them has waited
    ``max_seconds``, and at the end.
    """
    held: list[tuple] = []
    begin, since = 0, clock()
    for answered in answers:
        held.extend(answered)
        if len(held) >= max_rows or clock() - since >= max_seconds:
            yield _with_columns(rows.slice(begin, len(held)), columns, held)
            begin, held, since = begin + len(held), [], clock()
    if held:
        yield _with_columns(rows.slice(begin, len(held)), columns, held)


def _with_columns(rows: pa.RecordBatch, columns: Sequence[pa.Field], values: list[tuple]) -> pa.RecordBatch:
    added = [pa.array(column, field.type) for field, column in zip(columns, zip(*values))]
    return pa.RecordBatch.from_arrays([*rows.columns, *added], [*rows.schema.names, *(field.name for field in columns)])


def _by_length(rows: pa.RecordBatch, text: str) -> pa.RecordBatch:
    """Rows in order of the length of a text, so that a call gets rows alike."""
    lengths = pc.fill_null(pc.utf8_length(rows.column(text)), 0)
    return rows.take(pc.array_sort_indices(lengths))


class CallSlots:
    """The share of one task in a call rate that several tasks keep together.

    Time is cut into slots of ``interval`` seconds, the same for all tasks, and
    slot ``s`` belongs to task ``s % tasks``. So there is at most one call a slot,
    without a word between tasks. Threads of a task share its slots.
    """

    def __init__(
        self,
        interval: float,
        task: int = 0,
        tasks: int = 1,
        clock: Callable[[], float] = time.time,
        sleep: Callable[[float], None] = time.sleep,
    ) -> None:
        self._interval, self._task, self._tasks = interval, task % tasks, tasks
        self._clock, self._sleep, self._last, self._lock = clock, sleep, -1, threading.Lock()

    def wait(self) -> None:
        """Return when the next free slot of this task has begun."""
        if self._interval <= 0:
            return
        with self._lock:
            now = int(self._clock() / self._interval) + 1
            slot = now + (self._task - now) % self._tasks
            self._last = slot if self._last < 0 else max(slot, self._last + self._tasks)
            begin = self._last * self._interval
        while (left := begin - self._clock()) > 0:
            self._sleep(left)


def _in_order(call: Callable, rows: Iterable, open_calls: int) -> Iterator:
    """Results of ``call`` in the order of rows, with several calls open."""
    if open_calls == 1:
        yield from map(call, rows)
        return
    with ThreadPoolExecutor(open_calls) as pool:
        waiting: deque[Future] = deque()
        for row in rows:
            waiting.append(pool.submit(call, row))
            if len(waiting) >= 2 * open_calls:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()


def batch_responses(
    rows: DataFrame,
    load: Callable[[], Generate],
    prompt: str = "prompt",
    response: str = "response",
    seed: str | None = None,
    batch_size: int = 16,
    max_tasks: int | None = None,
    profile: ResourceProfile | None = None,
    output_rows: int = OUTPUT_ROWS,
    output_seconds: float = OUTPUT_SECONDS,
) -> DataFrame:
    """Rows with the stripped response to their prompt.

    Every batch has to bring one response per prompt; its prompts are of similar
    length, so that little is padded. ``max_tasks`` bounds how many tasks run a
    model at a time, ``profile`` says what each of them needs (a GPU, memory).
    ``load()`` returns ``generate(prompts)``, or ``generate(prompts, seeds)``
    when ``seed`` names a column. Only the prompt, the seed and the columns of
    ``rows`` pass through Python: select what is needed first. Rows come out
    after ``output_rows`` answers or ``output_seconds``.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField(response, T.StringType())])
    name = uuid.uuid4().hex
    if max_tasks is not None:
        rows = rows.repartition(max_tasks)

    added = [pa.field(response, pa.string())]

    def respond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows_in in batches:
            ordered = _by_length(rows_in, prompt)
            inputs = [ordered.column(column).to_pylist() for column in (prompt, seed) if column is not None]

            def answers() -> Iterator[list[tuple]]:
                for start in range(0, len(ordered), batch_size):
                    part = [values[start : start + batch_size] for values in inputs]
                    texts = loaded(name, load)(*part)
                    if len(texts) != len(part[0]):
                        raise ValueError(f"{len(texts)} responses to {len(part[0])} prompts")
                    yield [(text.strip(),) for text in texts]

            yield from flushed(ordered, added, answers(), output_rows, output_seconds)

    return rows.mapInArrow(respond, schema, profile=profile)


def sampled_responses(
    prompts: DataFrame,
    load: Callable[[], Generate],
    group_size: int,
    seed: int = DEFAULT_SEED,
    id_column: str = "id",
    batch_size: int = 16,
) -> DataFrame:
    """``group_size`` responses per prompt, numbered by ``rollout``.

    Every one has its own seed, derived from id and number.
    """
    grouped = copies(prompts, group_size, "rollout").withColumn(
        "seed", hash32(id_column, F.col("rollout"), seed)
    )
    return batch_responses(grouped, load, seed="seed", batch_size=batch_size)


def solution_requests(
    rows: DataFrame,
    correct_template: str = DEFAULT_CORRECT_REQUEST,
    wrong_template: str = DEFAULT_WRONG_REQUEST,
) -> DataFrame:
    """Rows with the request texts for a right and a wrong solution."""
    return rows.withColumns(
        {
            "correct_request": request_text(correct_template, "question", "answer"),
            "wrong_request": request_text(wrong_template, "question", "answer"),
        }
    )


def generated_pairs(
    rows: DataFrame,
    load: Callable[[], Callable[[str, str], str]],
    tries: int = GENERATION_TRIES,
    retry_wait: float = RETRY_WAIT_SECONDS,
    call_interval: float = CALL_INTERVAL_SECONDS,
    max_tasks: int | None = None,
    open_calls: int = 1,
    output_rows: int = OUTPUT_ROWS,
    output_seconds: float = OUTPUT_SECONDS,
) -> DataFrame:
    """A right (``chosen``) and a wrong (``rejected``) solution per row.

    ``rows`` come from :func:`solution_requests`; ``load()`` returns
    ``call(kind, request)`` with kind ``"correct"`` or ``"wrong"``. A failed call
    is tried again after ``retry_wait`` times its number of seconds. Adds
    ``status`` (``ok`` or ``failed``), ``attempts`` and ``error``; failed rows
    stay in the result.

    ``call_interval`` is the time between two calls of all tasks together, as
    :class:`CallSlots` deals them out; ``max_tasks`` is how many tasks call (16
    if there is an interval), and each may have ``open_calls`` waiting for
    answers, for which ``call`` has to be safe in threads.
    """
    name = uuid.uuid4().hex
    if max_tasks is None and call_interval > 0:
        max_tasks = CALL_TASKS
    if max_tasks is not None:
        rows = rows.repartition(max_tasks, "id")
    kept = [f for f in rows.schema.fields if f.name not in ("correct_request", "wrong_request")]
    schema = T.StructType(
        [
            *kept,
            T.StructField("chosen", T.StringType()),
            T.StructField("rejected", T.StringType()),
            T.StructField("status", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
            T.StructField("error", T.StringType()),
        ]
    )
    kept_names = [f.name for f in kept]
    kinds = {"chosen": pa.string(), "rejected": pa.string(), "status": pa.string(), "attempts": pa.int32(), "error": pa.string()}
    added = [pa.field(column, kind) for column, kind in kinds.items()]

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        slots = CallSlots(call_interval, context.partitionId() if context else 0, max_tasks or 1)

        def attempt(kind: str, request: str) -> tuple[str | None, int, str | None]:
            error, call = None, loaded(name, load)
            for number in range(1, tries + 1):
                slots.wait()
                try:
                    return call(kind, request).strip(), number, None
                except Exception as problem:  # any client error counts as a failed try
                    error = f"{type(problem).__name__}: {problem}"
                    if number < tries and retry_wait > 0:
                        time.sleep(retry_wait * number)
            return None, tries, error

        def pair(requests: tuple[str, str]) -> list[tuple]:
            chosen, attempts, error = attempt("correct", requests[0])
            if error is not None:
                return [(None, None, "failed", attempts, error)]
            rejected, more, error = attempt("wrong", requests[1])
            if error is not None:
                return [(None, None, "failed", attempts + more, error)]
            return [(chosen, rejected, "ok", attempts + more, None)]

        for batch in batches:
            if len(batch):
                loaded(name, load)  # before threads ask for it
            requests = zip(*(batch.column(c).to_pylist() for c in ("correct_request", "wrong_request")))
            answers = _in_order(pair, requests, open_calls)
            yield from flushed(batch.select(kept_names), added, answers, output_rows, output_seconds)

    return rows.mapInArrow(generate, schema)


def succeeded(generated: DataFrame) -> DataFrame:
    """Rows with both solutions."""
    return generated.where(F.col("status") == "ok").drop("status", "attempts", "error")


def failed(generated: DataFrame) -> DataFrame:
    """Rows for a reject table: why and after how many attempts they failed."""
    return generated.where(F.col("status") != "ok").drop("chosen", "rejected")
