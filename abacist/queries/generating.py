"""Calls to a generator, here functions that answer from the request itself.

They are defined inside the queries so that they travel to the workers by
value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.fixtures import problems, with_views
from abacist.functions.chat import (
    DEFAULT_CORRECT_REQUEST,
    DEFAULT_PROMPTS,
    DEFAULT_WRONG_REQUEST,
)
from abacist.operators import generation
from abacist.plans import evaluation
from abacist.plans.augmentation import build_training_tables, publish_training_tables, rejects_path
from abacist.queries import sql
from abacist.queries.registry import query, rounded
from abacist.queries.training import COPIES, SUBSTITUTED
from abacist.session import shared_folder
from abacist.streaming import enrichment


def _echo_loader(fail_marker: str | None = None):
    """A client that repeats the request; fails on requests with the marker."""

    def load():
        def call(kind: str, request: str) -> str:
            if fail_marker and fail_marker in request:
                raise RuntimeError("refused")
            return f"{kind}\n{request}\n"

        return call

    return load


_NO_WAIT = {"retry_wait": 0.0, "call_interval": 0.0}


def _request(template: str) -> str:
    return (
        f"replace(replace({sql.quoted(template)}, '{{question}}', question), '{{answer}}', answer)"
    )


_PAIRS = f"""
SELECT CAST(id AS VARCHAR) AS id, question, answer,
       'correct' || chr(10) || {_request(DEFAULT_CORRECT_REQUEST)} AS chosen,
       'wrong' || chr(10) || {_request(DEFAULT_WRONG_REQUEST)} AS rejected
FROM problems"""


@query(
    with_views(
        "SELECT id, question || '=' || length(question) AS response FROM problems", "problems"
    )
)
def batch_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    def load():
        return lambda prompts: [f"{p}={len(p)} " for p in prompts]

    rows = problems(spark, sf_dir).select("id", F.col("question").alias("prompt"))
    return generation.batch_responses(rows, load).drop("prompt")


@query(
    with_views(
        f"""
SELECT id, r.i AS rollout, concat('答案：', {sql.hash32('id', 'r.i')} % 1000) AS response
FROM problems CROSS JOIN (VALUES (0), (1), (2), (3)) AS r(i)""",
        "problems",
    )
)
def sampled_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    def load():
        return lambda prompts, seeds: [f"答案：{s % 1000}" for s in seeds]

    rows = problems(spark, sf_dir).select("id", F.col("question").alias("prompt"))
    return generation.sampled_responses(rows, load, group_size=4).select(
        "id", "rollout", "response"
    )


@query(
    with_views(
        """
SELECT id, question, answer, CASE WHEN ok THEN chosen END AS chosen,
       CASE WHEN ok THEN rejected END AS rejected, CASE WHEN ok THEN 'ok' ELSE 'failed' END AS status,
       CAST(CASE WHEN ok THEN 2 ELSE 3 END AS INTEGER) AS attempts,
       CASE WHEN NOT ok THEN 'RuntimeError: refused' END AS error
FROM (SELECT *, NOT contains(chosen, '一卷长13米') AS ok FROM pairs)""",
        "problems",
        pairs=_PAIRS,
    )
)
def generated_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests about one length fail on every try and stay marked as failed."""
    rows = problems(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    return generation.generated_pairs(
        generation.solution_requests(rows), _echo_loader("一卷长13米"), **_NO_WAIT
    )


@query(with_views("SELECT id, question, answer, chosen, rejected FROM pairs", "problems", pairs=_PAIRS))
def resumed_training_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, the second one after a failure for some questions."""
    path = shared_folder(spark, "tables")
    rows = problems(spark, sf_dir)
    paths = (f"{path}/generated", f"{path}/final")
    build_training_tables(spark, rows, _echo_loader("一卷长13米"), *paths, **_NO_WAIT)
    _, pairs = build_training_tables(spark, rows, _echo_loader(), *paths, **_NO_WAIT)
    return pairs


_FINAL_TABLE = with_views(
    """
SELECT id, question, answer, chosen AS cot, '' AS instruction, false AS augmented, NULL::VARCHAR AS original_id FROM pairs
UNION ALL SELECT id, question, answer, cot, '' AS instruction, true AS augmented, original_id FROM copied
WHERE answer IS NOT NULL""",
    "problems",
    pairs=_PAIRS,
    eligible="SELECT id, question, answer, chosen AS cot FROM pairs",
    substituted=SUBSTITUTED,
    copied=COPIES,
)


@query(_FINAL_TABLE)
def final_training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of two runs: generated solutions and their augmented copies."""
    path = shared_folder(spark, "tables")
    rows = problems(spark, sf_dir)
    paths = (f"{path}/generated", f"{path}/final")
    build_training_tables(spark, rows, _echo_loader("一卷长13米"), *paths, **_NO_WAIT)
    final, _ = build_training_tables(spark, rows, _echo_loader(), *paths, **_NO_WAIT)
    return final


@query(_FINAL_TABLE)
def published_training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table from two versions; the second adds to the first what had failed."""
    root = shared_folder(spark, "versions")
    rows = problems(spark, sf_dir)
    publish_training_tables(spark, rows, _echo_loader("一卷长13米"), root, **_NO_WAIT)
    final, _ = publish_training_tables(spark, rows, _echo_loader(), root, **_NO_WAIT)
    return final


@query(
    with_views(
        """
SELECT id, question, answer, CAST(3 AS INTEGER) AS attempts, 'RuntimeError: refused' AS error
FROM pairs WHERE contains(chosen, '一卷长13米')""",
        "problems",
        pairs=_PAIRS,
    )
)
def rejected_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run could not answer, with the reason."""
    path = shared_folder(spark, "rejects")
    paths = (f"{path}/generated", f"{path}/final")
    build_training_tables(spark, problems(spark, sf_dir), _echo_loader("一卷长13米"), *paths, **_NO_WAIT)
    return spark.read.parquet(rejects_path(paths[0])).select("id", "question", "answer", "attempts", "error")


@query(with_views("SELECT id, question, answer, chosen, rejected FROM pairs", "problems", pairs=_PAIRS))
def streamed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question files taken up by two starts of the stream, with repeated ids."""
    path = shared_folder(spark, "stream")
    source, sink, checkpoint = (f"{path}/{name}" for name in ("questions", "sink", "checkpoint"))
    rows = problems(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    for part in (rows.where("length(answer) < 3"), rows):
        part.write.mode("append").parquet(source)
        enrichment.enrich_new_questions(
            spark, source, rows.schema, sink, checkpoint, _echo_loader(), **_NO_WAIT
        ).awaitTermination()
    return enrichment.enriched_preferences(spark, sink)


def _shop_loaders(models):
    """Models that work the question out; they forget what was sold for some
    lengths of the prompt, each model for its own."""

    def loader(rest: int):
        def load():
            import re

            def generate(prompts):
                texts = []
                for prompt in prompts:
                    numbers = re.search(r"进了(\d+)卷电缆，一卷长(\d+)米，施工用掉(\d+)米", prompt).groups()
                    boxes, weight, sold = map(int, numbers)
                    left = boxes * weight - (sold if len(prompt) % 4 > rest else 0)
                    texts.append(f"步骤：略\n答案：{left}")
                return texts

            return generate

        return load

    return {model: loader(n) for n, model in enumerate(models)}


def _shop_prediction(prompt: str, rest: str) -> str:
    return f"CAST(CASE WHEN length({prompt}) % 4 > {rest} THEN ans ELSE ab END AS VARCHAR)"


def _prompt(kind: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {sql.quoted(t)}" for k, t in DEFAULT_PROMPTS.items())
    turns = sql.chat(("system", f"CASE {kind} {cases} END"), ("user", "question"))
    return f"concat({turns}, '<|im_start|>assistant', chr(10))"


_SHOP_MODELS = {"base": "standard", "north": "zero_shot", "south": "sft", "west": "zero_shot_simple"}
_SHOP_VARIANTS = ", ".join(f"({n}, '{m}', '{p}')" for n, (m, p) in enumerate(_SHOP_MODELS.items()))
_SHOP_SQL = f"""
SELECT id, v.m AS model, v.p AS prompt_type, v.o AS variant, answer AS truth,
       {_shop_prediction(_prompt('v.p'), 'v.o')} AS prediction
FROM problems JOIN base USING (id) CROSS JOIN (VALUES {_SHOP_VARIANTS}) AS v(o, m, p)"""


@query(
    with_views(
        """
SELECT model, prompt_type, variant, CAST(row_number() OVER (ORDER BY hits DESC, variant) AS INTEGER)
       AS place, n_correct, n_rows, round(hits, 6) AS accuracy, round(hits - max(CASE WHEN model = 'base'
       THEN hits END) OVER (), 6) AS gain
FROM (SELECT model, prompt_type, variant, count(*) FILTER (WHERE prediction = truth) AS n_correct,
             count(*) AS n_rows, avg(CASE WHEN prediction = truth THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
             AS hits FROM shop GROUP BY ALL)""",
        "problems",
        shop=_SHOP_SQL,
    )
)
def evaluated_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All questions answered by every model with its own prompt, and ranked."""
    items = problems(spark, sf_dir)
    variants = [{"model": m, "prompt_type": p} for m, p in _SHOP_MODELS.items()]
    predicted = evaluation.variant_predictions(items, variants, _shop_loaders(_SHOP_MODELS))
    return evaluation.variant_accuracy(predicted, items, base="base").select(
        "model",
        "prompt_type",
        "variant",
        "place",
        "n_correct",
        "n_rows",
        rounded("accuracy").alias("accuracy"),
        rounded("gain").alias("gain"),
    )


_SAMPLE = f"SELECT * FROM problems ORDER BY {sql.hash32('id')}, id LIMIT 400"
_BEST_MODEL = """
SELECT model, variant AS rest FROM shop JOIN sample USING (id)
GROUP BY model, variant ORDER BY avg(CASE WHEN prediction = truth THEN 1 ELSE 0 END) DESC, variant
LIMIT 1"""
_BEST_PROMPT = f"""
SELECT kind FROM (SELECT v.o, v.p AS kind, answer AS truth, {_shop_prediction(_prompt('v.p'), 'rest')} AS prediction
    FROM sample JOIN base USING (id) CROSS JOIN best_model
    CROSS JOIN (VALUES (0, 'standard'), (1, 'zero_shot'), (2, 'few_shot')) AS v(o, p))
GROUP BY o, kind ORDER BY avg(CASE WHEN prediction = truth THEN 1 ELSE 0 END) DESC, o LIMIT 1"""


@query(
    with_views(
        f"""
SELECT CAST(id AS VARCHAR) AS id, {_shop_prediction(_prompt('kind'), 'rest')} AS ret
FROM problems JOIN base USING (id) CROSS JOIN best_model CROSS JOIN best_prompt""",
        "problems",
        shop=_SHOP_SQL,
        sample=_SAMPLE,
        best_model=_BEST_MODEL,
        best_prompt=_BEST_PROMPT,
    )
)
def chosen_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model and prompt chosen on the sample, then all questions answered."""
    items = problems(spark, sf_dir)
    *_, result = evaluation.choose_and_submit(
        items,
        items.drop("answer"),
        _SHOP_MODELS,
        _shop_loaders(_SHOP_MODELS),
        ["standard", "zero_shot", "few_shot"],
        shared_folder(spark, "evaluation"),
    )
    return result
