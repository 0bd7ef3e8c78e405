"""Projections, filters, joins, unions, counts, order and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.fixtures import (
    model_responses,
    preferences,
    problems,
    rollouts,
    table,
    with_views,
)
from abacist.functions.chat import (
    DEFAULT_INSTRUCTION,
    DEFAULT_PROMPTS,
    chat_text,
    messages,
    prompt_text,
)
from abacist.functions.hashing import hash32
from abacist.functions.text import integer_strings
from abacist.operators import keyed, metrics, ordering, tables
from abacist.plans.evaluation import only_available
from abacist.queries import sql
from abacist.queries.registry import query, rounded

_SOLUTIONS_SQL = f"""
SELECT CAST(id AS VARCHAR) AS id, question, answer, chosen AS cot,
       {sql.quoted(DEFAULT_INSTRUCTION)} AS instruction
FROM preferences WHERE NOT {sql.blank('chosen')}"""


@query(with_views(_SOLUTIONS_SQL, "preferences"))
def solutions_from_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.solutions_from_preferences(preferences(spark, sf_dir))


@query(
    with_views(
        """
SELECT id, coalesce(nullif(CASE WHEN id % 3 = 0 THEN '' WHEN id % 3 = 1 THEN question END, ''),
       chosen, '') AS solution
FROM preferences""",
        "preferences",
    )
)
def first_filled_solution(spark: SparkSession, sf_dir: str) -> DataFrame:
    cot = F.when(F.col("id") % 3 == 0, "").when(F.col("id") % 3 == 1, F.col("question"))
    rows = preferences(spark, sf_dir).withColumn("cot", cot)
    return rows.select("id", tables.solution_text(rows).alias("solution"))


@query(
    """
SELECT o_orderkey AS id, o_orderstatus = 'F' AS augmented FROM orders
WHERE NOT coalesce(CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus = 'F' END, false)"""
)
def rows_not_augmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.when(status != "P", status == "F").alias("augmented"),
    )
    return tables.not_augmented(rows).withColumn(
        "augmented", F.coalesce("augmented", F.lit(False))
    )


@query(
    rf"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{sql.INT}')) AS INTEGER) AS n_numbers
FROM documents WHERE len(regexp_extract_all(text, '{sql.INT}')) >= 2"""
)
def texts_with_two_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    count = F.size(integer_strings("text"))
    return (
        table(spark, sf_dir, "documents").where(count >= 2).select("doc_id", count.alias("n_numbers"))
    )


@query(
    with_views(
        """
SELECT id, question, answer, chosen AS cot, '' AS instruction, false AS augmented FROM preferences""",
        "preferences",
    )
)
def solution_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.solution_records(preferences(spark, sf_dir))


@query(
    with_views(
        "SELECT p.id, p.question, p.answer, p.chosen, p.rejected FROM preferences p "
        "WHERE p.chosen IS NOT NULL AND p.rejected IS NOT NULL",
        "preferences",
    )
)
def paired_solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = preferences(spark, sf_dir)
    pairs = tables.paired_solutions(
        rows.select("id", "question", "answer", "chosen"), rows.select("id", "rejected")
    )
    return tables.preference_records(pairs)


@query(
    """
SELECT o_orderkey AS id, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""
)
def rows_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice")
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return keyed.rows_to_do(todo, done)


_PROMPT_TYPES = ("standard", "zero_shot", "few_shot")


def _prompt_case(column: str, kinds: tuple[str, ...]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {sql.quoted(DEFAULT_PROMPTS[k])}" for k in kinds)
    return f"CASE {column} {cases} END"


def _prompt_sql(system: str) -> str:
    turns = sql.chat(("system", system), ("user", "question"))
    return f"concat({turns}, '<|im_start|>assistant', chr(10))"


@query(
    with_views(
        f"""
SELECT id, v.o AS variant, v.p AS prompt_type, {_prompt_sql(_prompt_case("v.p", _PROMPT_TYPES))} AS prompt
FROM problems CROSS JOIN (VALUES (0, 'standard'), (1, 'zero_shot'), (2, 'few_shot')) AS v(o, p)""",
        "problems",
    )
)
def prompts_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = [{"prompt_type": kind} for kind in _PROMPT_TYPES]
    return tables.fan_out(problems(spark, sf_dir), variants).select(
        "id", "variant", "prompt_type", _generation_prompt().alias("prompt")
    )


def _generation_prompt():
    return chat_text(messages(prompt_text("prompt_type"), "question"), generation_prompt=True)


_MODEL_PROMPTS = {"base": "standard", "north": "zero_shot", "south": "sft", "west": "zero_shot_simple"}


@query(
    with_views(
        f"""
SELECT id, v.o AS variant, v.m AS model, v.p AS prompt_type,
       {_prompt_sql(_prompt_case("v.p", tuple(_MODEL_PROMPTS.values())))} AS prompt
FROM problems CROSS JOIN (VALUES (0, 'base', 'standard'), (1, 'north', 'zero_shot'), (2, 'south', 'sft'),
    (3, 'west', 'zero_shot_simple')) AS v(o, m, p)""",
        "problems",
    )
)
def prompts_per_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = [{"model": m, "prompt_type": p} for m, p in _MODEL_PROMPTS.items()]
    return tables.fan_out(problems(spark, sf_dir), variants).select(
        "id", "variant", "model", "prompt_type", _generation_prompt().alias("prompt")
    )


@query(
    with_views(
        "SELECT id, model, variant, response FROM responses WHERE model IN "
        "(SELECT DISTINCT ['base', 'north', 'tuned'][CAST(l_linenumber % 3 + 1 AS INTEGER)] FROM lineitem)",
        "responses",
    )
)
def responses_of_available_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, ("base", "north", "tuned")))
    available = table(spark, sf_dir, "lineitem").select(
        F.get(names, F.col("l_linenumber") % 3).alias("model")
    )
    return only_available(model_responses(spark, sf_dir), available).select(
        "id", "model", "variant", "response"
    )


@query(
    with_views(
        "SELECT id, r.i AS copy, question FROM problems CROSS JOIN (VALUES (0), (1)) AS r(i)",
        "problems",
    )
)
def question_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.copies(problems(spark, sf_dir), 2).select("id", "copy", "question")


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS source, count(*) AS n_rows FROM {name}"
        for name in ("orders", "lineitem", "documents", "conversations")
    )
)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        metrics.row_count(table(spark, sf_dir, name)).select(F.lit(name).alias("source"), "n_rows")
        for name in ("orders", "lineitem", "documents", "conversations")
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


@query(
    with_views(
        f"""
SELECT count(*) AS n_rows,
       count(*) FILTER (WHERE {sql.blank('chosen')}) AS blank_chosen, count(*) FILTER (WHERE NOT {sql.blank('chosen')}) AS filled_chosen,
       count(*) FILTER (WHERE {sql.blank('rejected')}) AS blank_rejected,
       count(*) FILTER (WHERE NOT {sql.blank('rejected')}) AS filled_rejected
FROM preferences""",
        "preferences",
    )
)
def preference_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.completeness(preferences(spark, sf_dir), ["chosen", "rejected"])


@query(
    """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1"""
)
def last_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return keyed.last_by_key(rows, ["user_id"], "event_id")


@query(
    """
SELECT user_id AS epoch, round(coalesce(avg(CASE WHEN event_type <> 'error' THEN value END), 0), 6)
       AS avg_loss, round(coalesce(avg(value), 0), 6) AS avg_reward, count(*) AS steps
FROM events GROUP BY user_id"""
)
def epoch_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("epoch"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("loss"),
        F.col("value").alias("reward"),
    )
    return metrics.epoch_averages(steps, ["loss", "reward"]).select(
        "epoch",
        rounded("avg_loss").alias("avg_loss"),
        rounded("avg_reward").alias("avg_reward"),
        "steps",
    )


def _trailing_sql(statistic: str) -> str:
    return f"""
SELECT user_id, event_id, round({statistic}(value) OVER (PARTITION BY user_id ORDER BY event_id
       ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 6) AS trailing_value
FROM events WHERE event_type <> 'error'"""


def _trailing(spark: SparkSession, sf_dir: str, statistic: str) -> DataFrame:
    active = table(spark, sf_dir, "events").where("event_type <> 'error'")
    return metrics.trailing(
        active.select("user_id", "event_id", "value"),
        ["value"],
        run="user_id",
        step="event_id",
        statistic=statistic,
    ).select("user_id", "event_id", rounded("trailing_value").alias("trailing_value"))


@query(_trailing_sql("avg"))
def trailing_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trailing(spark, sf_dir, "avg")


@query(_trailing_sql("sum"))
def trailing_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trailing(spark, sf_dir, "sum")


@query(
    """
SELECT id FROM (SELECT o_orderkey AS id FROM orders ORDER BY o_orderkey LIMIT 300)
WHERE id NOT IN (SELECT l_orderkey FROM lineitem)"""
)
def first_rows_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    todo = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return keyed.rows_to_do(ordering.first_rows(todo, 300, "id"), done)


_HASH_ORDER = sql.hash32("id")


@query(
    with_views(
        f"SELECT id, question FROM problems ORDER BY {_HASH_ORDER}, id LIMIT 400", "problems"
    )
)
def evaluation_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.seeded_sample(problems(spark, sf_dir).select("id", "question"))


@query(with_views(f"SELECT id, question, {_HASH_ORDER} AS place FROM problems", "problems"))
def shuffled_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    shuffled = ordering.seeded_shuffle(problems(spark, sf_dir).select("id", "question"))
    return shuffled.withColumn("place", hash32("id"))


@query(
    with_views(
        f"SELECT id, question FROM problems ORDER BY {_HASH_ORDER}, id OFFSET 700", "problems"
    )
)
def resumed_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.skip_shuffled(problems(spark, sf_dir).select("id", "question"), 700)


@query(
    with_views(
        f"""
SELECT id, CAST(position // 251 AS INTEGER) AS epoch, CAST(position % 251 AS INTEGER) AS step
FROM (SELECT id, row_number() OVER (ORDER BY {_HASH_ORDER}, id) - 1 AS position FROM problems)
WHERE position < 753 AND position % 251 < 250""",
        "problems",
    )
)
def epoch_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.epoch_slices(problems(spark, sf_dir).select("id"), epochs=3, max_steps=250)


@query(
    with_views(
        """
SELECT id, question, answer, NULL AS rejected FROM problems
UNION ALL SELECT id, question, answer, rejected FROM preferences""",
        "problems",
        "preferences",
    )
)
def appended_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.appended(
        problems(spark, sf_dir), preferences(spark, sf_dir).drop("chosen")
    )


@query(
    with_views(
        """
SELECT id, rollout AS sequence, response FROM rollouts
QUALIFY row_number() OVER (PARTITION BY id ORDER BY rollout DESC) = 1""",
        "rollouts",
    )
)
def latest_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier and new outputs in one table; the last one of an id counts."""
    rows = rollouts(spark, sf_dir).select("id", F.col("rollout").alias("sequence"), "response")
    return keyed.last_by_key(rows, ["id"], "sequence")


_TYPES = {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderpriority": "string", "o_orderstatus": "string"}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", '{kind}' AS type, count({name}) AS n_filled FROM orders"
        for name, kind in _TYPES.items()
    )
)
def column_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type of every column, with how many of its values are there."""
    rows = table(spark, sf_dir, "orders").select(*_TYPES)
    counts = rows.agg(*(F.count(name).alias(name) for name in _TYPES))
    filled = counts.unpivot([], [*_TYPES], "column", "n_filled")
    return tables.column_types(rows).join(filled, "column")


@query(
    with_views(
        "SELECT 'train' AS name, count(*) AS n_rows, count(answer) AS n_answers FROM problems "
        "UNION ALL SELECT 'test', count(*), 0 FROM problems",
        "problems",
    )
)
def answers_where_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers are only counted in a table that has them."""
    found = None
    for name, rows in (("train", problems(spark, sf_dir)), ("test", problems(spark, sf_dir).drop("answer"))):
        answers = F.count("answer") if tables.has_ground_truth(rows) else F.lit(0).cast("bigint")
        one = rows.agg(F.count(F.lit(1)).alias("n_rows"), answers.alias("n_answers"))
        one = one.select(F.lit(name).alias("name"), "n_rows", "n_answers")
        found = one if found is None else found.unionByName(one)
    return found
