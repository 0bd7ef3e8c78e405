"""Retries, rejects, restarts."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from abacist.operators import generation
from abacist.plans import evaluation
from abacist.plans.augmentation import build_training_tables, publish_training_tables, rejects_path
from abacist.session import shared_folder
from abacist.sources import versions
from abacist.streaming import enrichment

NO_WAIT = {"retry_wait": 0.0, "call_interval": 0.0}
SCHEMA = "id string, question string, answer string"


def questions(spark, numbers):
    return spark.createDataFrame([(str(n), f"q{n}", str(n)) for n in numbers], SCHEMA)


def loader(fail_first=0, refuse=None):
    def load():
        calls = {}

        def call(kind, request):
            calls[request] = calls.get(request, 0) + 1
            if refuse and refuse in request:
                raise ValueError("no")
            if calls[request] <= fail_first:
                raise TimeoutError("late")
            return f" {kind} {len(request)} "

        return call

    return load


def test_retries_and_rejects(spark):
    rows = generation.solution_requests(questions(spark, [1, 2]))
    done = generation.generated_pairs(rows, loader(fail_first=2), **NO_WAIT).collect()
    assert {(r.status, r.attempts) for r in done} == {("ok", 6)}
    assert all(r.chosen == r.chosen.strip() for r in done)
    mixed = generation.generated_pairs(rows, loader(refuse="q2"), max_tasks=2, **NO_WAIT)
    assert [r.id for r in generation.succeeded(mixed).collect()] == ["1"]
    [reject] = generation.failed(mixed).collect()
    assert (reject.id, reject.attempts, reject.error) == ("2", 3, "ValueError: no")


def test_request_text_is_filled_once(spark):
    rows = spark.createDataFrame([("{answer}", "7")], "question string, answer string")
    made = generation.solution_requests(rows, "{question}-{answer}", "x").first()
    assert made.correct_request == "{answer}-7" and made.wrong_request == "x"


def test_batches_keep_order_and_size(spark):
    def load():
        def generate(prompts):
            assert len(prompts) <= 4
            return [p + "!" for p in prompts]

        return generate

    rows = spark.range(30).select("id", F.concat(F.lit("p"), "id").alias("prompt")).coalesce(1)
    found = generation.batch_responses(rows, load, batch_size=4).collect()
    assert all(r.response == f"p{r.id}!" for r in found) and len(found) == 30


def test_sampled_groups_repeat(spark):
    def load():
        return lambda prompts, seeds: [str(s) for s in seeds]

    rows = spark.range(5).select("id", F.lit("p").alias("prompt"))
    one, two = (
        sorted(map(tuple, generation.sampled_responses(rows.repartition(n), load, 3).collect()))
        for n in (1, 4)
    )
    assert one == two and len(one) == 15 and len({r[-1] for r in one}) == 15


def test_build_resumes(spark):
    path = shared_folder(spark, "build")
    rows = questions(spark, range(6))
    paths = (f"{path}/generated", f"{path}/final")
    build_training_tables(spark, rows, loader(refuse="q3"), *paths, max_samples=5, **NO_WAIT)
    assert spark.read.parquet(paths[0]).count() == 4
    _, pairs = build_training_tables(spark, rows, loader(), *paths, **NO_WAIT)
    assert sorted(r.id for r in pairs.collect()) == [str(n) for n in range(6)]


def run_stream(spark, path, load):
    query = enrichment.enrich_new_questions(
        spark, f"{path}/in", SCHEMA, f"{path}/sink", f"{path}/checkpoint", load,
        files_per_batch=1, **NO_WAIT,
    )
    query.awaitTermination()


def test_stream_has_no_duplicates(spark):
    path = shared_folder(spark, "stream")
    for numbers in ([0, 1, 2], [2, 3, 3], [1, 4]):
        questions(spark, numbers).coalesce(1).write.mode("append").parquet(f"{path}/in")
    run_stream(spark, path, loader())
    run_stream(spark, path, loader())
    questions(spark, [4, 5]).coalesce(1).write.mode("append").parquet(f"{path}/in")
    run_stream(spark, path, loader())
    ids = sorted(r.id for r in enrichment.enriched_pairs(spark, f"{path}/sink").collect())
    assert ids == ["0", "1", "2", "3", "4", "5"]
    assert enrichment.enriched_solutions(spark, f"{path}/sink").where("augmented").count() == 0


def test_stream_goes_on_after_a_crash(spark):
    path = shared_folder(spark, "crash")
    for numbers in ([0, 1], [2, 3], [3, 4]):
        questions(spark, numbers).coalesce(1).write.mode("append").parquet(f"{path}/in")

    def crashing():
        def call(kind, request):
            # not an Exception: ends the task like a lost worker
            if "q2" in request:
                raise SystemExit("lost")
            return kind

        return call

    with pytest.raises(Exception):
        run_stream(spark, path, crashing)
    run_stream(spark, path, loader())
    ids = sorted(r.id for r in enrichment.enriched_pairs(spark, f"{path}/sink").collect())
    assert ids == ["0", "1", "2", "3", "4"]


def test_a_batch_run_twice_overwrites_itself(spark):
    sink = shared_folder(spark, "twice")
    rows = questions(spark, [1, 2]).withColumn("attempt", F.lit(0))
    for _ in range(2):
        enrichment._write_batch(rows, sink, 7, loader(refuse="q2"), NO_WAIT)
    assert [r.id for r in enrichment.enriched_pairs(spark, sink).collect()] == ["1"]
    [again] = spark.read.parquet(enrichment.reopened_path(sink)).collect()
    assert (again.id, again.question, again.attempt) == ("2", "q2", 1)


def test_failed_questions_are_opened_again(spark):
    path = shared_folder(spark, "retry")
    sink = f"{path}/sink"
    questions(spark, [1, 2]).write.parquet(f"{path}/in")
    for _ in range(2):
        run_stream(spark, path, loader(refuse="q2"))
        [left] = enrichment.failed_questions(spark, sink).collect()
        assert (left.id, left.error) == ("2", "ValueError: no")
    questions(spark, [2, 3]).write.mode("append").parquet(f"{path}/in")
    run_stream(spark, path, loader())
    assert enrichment.failed_questions(spark, sink).count() == 0
    run_stream(spark, path, loader())
    assert sorted(r.id for r in enrichment.enriched_pairs(spark, sink).collect()) == ["1", "2", "3"]


def test_a_start_reads_no_sink(spark):
    path = shared_folder(spark, "state")
    questions(spark, [1, 2]).write.parquet(f"{path}/in")
    run_stream(spark, path, loader())
    other = shared_folder(spark, "state")
    questions(spark, [2, 3]).write.mode("append").parquet(f"{path}/in")
    query = enrichment.enrich_new_questions(  # the sink of before is out of reach
        spark, f"{path}/in", SCHEMA, f"{other}/sink", f"{path}/checkpoint", loader(), **NO_WAIT
    )
    query.awaitTermination()
    assert [r.id for r in enrichment.enriched_pairs(spark, f"{other}/sink").collect()] == ["3"]


def test_answers_are_handed_on_by_rows_and_by_time():
    rows = pa.record_batch({"n": list(range(10))})
    times = iter([0.0, 1.0, 2.0, 40.0, 40.0, 41.0, 42.0, 42.0])
    answers = ([(f"a{n}",), (f"a{n + 1}",)] for n in range(0, 10, 2))
    text = [pa.field("text", pa.string())]
    frames = list(generation.flushed(rows, text, answers, 4, 30.0, lambda: next(times)))
    assert [len(f) for f in frames] == [4, 2, 4]  # by rows, by time, the rest
    assert [(r["n"], r["text"]) for f in frames for r in f.to_pylist()] == [(n, f"a{n}") for n in range(10)]
    single = ([(n,)] for n in range(10))
    assert [len(f) for f in generation.flushed(rows, [pa.field("v", pa.int64())], single, 100, 30.0)] == [10]


def test_calls_get_prompts_of_similar_length(spark):
    def load():
        return lambda prompts: [str(max(map(len, prompts)) - min(map(len, prompts))) for _ in prompts]

    prompt = F.repeat(F.lit("x"), (F.col("id") * 37 % 100 + 1).cast("int"))
    rows = spark.range(100).select("id", prompt.alias("prompt")).coalesce(1)
    found = generation.batch_responses(rows, load, batch_size=10).collect()
    assert len(found) == 100 and {r.response for r in found} == {"9"}


def test_tasks_share_one_call_rate():
    def waits(task):
        now = [1000.0 + task / 7]
        slots = generation.CallSlots(0.5, task, 4, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
        for _ in range(20):
            slots.wait()
            yield now[0]

    times = sorted(t for task in range(4) for t in waits(task))
    assert len(times) == 80 and all(b - a > 0.49 for a, b in zip(times, times[1:]))
    late = [100.0]
    slots = generation.CallSlots(1.0, 1, 2, lambda: late[0], lambda s: late.__setitem__(0, late[0] + s))
    slots.wait()
    late[0] += 50  # a slow call: no slots are saved up
    begun = []
    for _ in range(3):
        slots.wait()
        begun.append(late[0])
    assert [b - a for a, b in zip(begun, begun[1:])] == [2.0, 2.0]


def test_calls_a_second_over_four_tasks(spark, tmp_path):
    marks = str(tmp_path)

    def load():
        import os
        import time

        def call(kind, request):
            begun = time.time()
            time.sleep(0.3)  # longer than the interval: several calls are open
            with open(f"{marks}/{os.getpid()}", "a") as log:
                log.write(f"{begun}\n")
            return kind

        return call

    rows = generation.solution_requests(questions(spark, range(16)))
    options = {"call_interval": 0.1, "retry_wait": 0.0, "max_tasks": 4, "open_calls": 4}
    assert generation.generated_pairs(rows, load, **options).where("status = 'ok'").count() == 16
    begun = sorted(float(line) for log in tmp_path.iterdir() for line in log.read_text().split())
    assert len(begun) == 32 and len(list(tmp_path.iterdir())) > 1
    for first, later in zip(begun, begun[10:]):
        assert later - first > 0.85  # ten slots


def test_models_load_once_and_never_for_nothing(spark, tmp_path):
    marks = str(tmp_path)

    def load():
        import tempfile

        tempfile.mkstemp(dir=marks)
        return lambda prompts: [p + "!" for p in prompts]

    rows = spark.range(60).select("id", F.concat(F.lit("p"), "id").alias("prompt"))
    assert generation.batch_responses(rows.where("id < 0"), load).count() == 0
    assert not list(tmp_path.iterdir())
    assert generation.batch_responses(rows.repartition(12), load, batch_size=2).count() == 60
    assert 1 <= len(list(tmp_path.iterdir())) <= 4


def test_a_batch_with_too_few_responses_fails(spark):
    def load():
        return lambda prompts: prompts[1:] if len(prompts) > 1 else [*prompts, "more"]

    rows = spark.range(7).select("id", F.lit("p").alias("prompt")).coalesce(1)
    with pytest.raises(Exception, match="responses to"):
        generation.batch_responses(rows, load, batch_size=2).collect()


def test_rejects_are_kept_and_taken_up_again(spark):
    folder = shared_folder(spark, "rejects")
    paths = (f"{folder}/generated", f"{folder}/final")
    rows = questions(spark, [1, 2, 3])
    build_training_tables(spark, rows, loader(refuse="q2"), *paths, **NO_WAIT)
    [reject] = spark.read.parquet(rejects_path(paths[0])).collect()
    assert (reject.id, reject.error) == ("2", "ValueError: no")
    _, pairs = build_training_tables(spark, rows, loader(), *paths, **NO_WAIT)
    assert sorted(r.id for r in pairs.collect()) == ["1", "2", "3"]
    assert spark.read.parquet(rejects_path(paths[0])).count() == 0


def test_published_tables_change_together(spark, monkeypatch):
    root = shared_folder(spark, "versions")

    def told():
        names = ("generated", "final", "rejects")
        found = {n: versions.versioned_table(spark, root, n) for n in names}
        return {n: None if t is None else sorted(r.id for r in t.collect()) for n, t in found.items()}

    def run(numbers, refuse=None, **options):
        return publish_training_tables(spark, questions(spark, numbers), loader(refuse=refuse), root, per_row=0, **NO_WAIT, **options)

    write = versions._finish
    lost = lambda *_: (_ for _ in ()).throw(OSError("lost"))
    monkeypatch.setattr(versions, "_finish", lost)
    with pytest.raises(OSError, match="lost"):
        run([9])
    assert told() == {"generated": None, "final": None, "rejects": None}
    monkeypatch.setattr(versions, "_finish", write)
    run([1, 2, 3], refuse="q2")
    first = {"generated": ["1", "3"], "final": ["1", "3"], "rejects": ["2"]}
    assert told() == first
    monkeypatch.setattr(versions, "_finish", lost)
    with pytest.raises(OSError, match="lost"):
        run([1, 2, 3, 4])
    assert told() == first
    monkeypatch.setattr(versions, "_finish", write)
    final, pairs = run([1, 2, 3, 5])
    assert told() == {"generated": ["1", "2", "3", "5"], "final": ["1", "2", "3", "5"], "rejects": []}
    assert pairs.count() == final.count() == 4
    assert spark.read.parquet(f"{root}/version-2/generated").count() == 2
    assert versions.versioned_table(spark, root, "generated", "version-1").count() == 2
    run([7], resume=False)
    assert told() == {"generated": ["7"], "final": ["7"], "rejects": []}


@pytest.mark.parametrize("broken", ["a", "b", "c"])
def test_a_lost_write_leaves_the_version_before(spark, broken):
    root = shared_folder(spark, "versions")
    good = {n: spark.range(2).select("id") for n in "abc"}
    assert versions.publish(spark, root, good) == "version-1"
    bad = {n: spark.range(2, 5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error("lost").cast("long")).alias("id")) for n in broken}
    with pytest.raises(Exception, match="lost"):
        versions.publish(spark, root, {n: bad.get(n, spark.range(2, 5).select("id")) for n in "abc"})
    assert {n: versions.versioned_table(spark, root, n).count() for n in "abc"} == dict.fromkeys("abc", 2)
    assert versions.publish(spark, root, {"a": spark.range(2, 3)}, replaced=("c",)) == "version-2"
    assert [versions.versioned_table(spark, root, n) is None for n in "abc"] == [False, False, True]
    assert versions.versioned_table(spark, root, "a").count() == 3


def test_fallback_model_is_the_first_available(spark):
    def load():
        return lambda prompts: ["答案：1"] * len(prompts)

    items = spark.createDataFrame([("1", "q")], "id string, question string")
    prompts = {"base": "standard", "north": "sft", "south": "sft"}
    options = {"available": ["base", "north"], "priority": ["south", "base", "north"]}
    loaders = dict.fromkeys(prompts, load)
    folder = shared_folder(spark, "choice")
    model, _, result = evaluation.choose_and_submit(items, items, prompts, loaders, ["sft"], folder, **options)
    assert model == "base" and result.count() == 1
    model, *_ = evaluation.choose_and_submit(items, items, prompts, loaders, ["sft"], folder, available=["base", "north"])
    assert model == "north"
    with pytest.raises(ValueError):
        evaluation.choose_and_submit(items, items, prompts, loaders, ["sft"], folder, available=[])
