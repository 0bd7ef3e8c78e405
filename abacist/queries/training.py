"""Token features, padding, message pairs and augmentation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.constants import DEFAULT_SEED
from abacist.fixtures import preferences, problems, rollouts, spread_table, table, with_views
from abacist.functions import features
from abacist.functions.chat import DEFAULT_INSTRUCTION, DEFAULT_PROMPTS, DEFAULT_STEP_REQUEST
from abacist.operators import tables, training_rows
from abacist.plans import augmentation
from abacist.queries import sql
from abacist.queries.registry import ids_text, query


@query(f"SELECT conv_id, turn, {sql.ids_text(sql.code_points('text'))} AS ids FROM conversations")
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", ids_text(features.code_points("text")).alias("ids")
    )


def _features_sql(prefix: str, target: str, length: int, source: str, key: str = "id") -> str:
    return f"""
SELECT {key}, {sql.ids_text(f'list_concat(p, t)[1:{length}]')} AS input_ids,
       {sql.ids_text(f'list_transform(list_concat(p, t)[1:{length}], lambda x: 1)')} AS attention_mask,
       {sql.ids_text(f'list_concat(list_transform(p, lambda x: -100), t)[1:{length}]')} AS labels,
       len(p) >= {length} AS fully_masked
FROM (SELECT {key}, {sql.code_points(prefix)} AS p, {sql.code_points(target)} AS t FROM {source})"""


def _flat(rows: DataFrame) -> DataFrame:
    arrays = ("input_ids", "attention_mask", "labels")
    return rows.withColumns({name: ids_text(name) for name in arrays})


_PREFIX = f"""concat('<|im_start|>', {sql.quoted(DEFAULT_INSTRUCTION)}, ' ',
    {sql.quoted(DEFAULT_STEP_REQUEST)}, '<|im_end|>', chr(10), '<|im_start|>', question,
    '<|im_end|>', chr(10), '<|im_start|>')"""


@query(
    with_views(
        _features_sql(
            _PREFIX,
            f"concat({sql.answer_line('solution', 'answer')}, '<|im_end|>', chr(10))",
            128,
            "(SELECT id, question, answer, coalesce(chosen, '') AS solution FROM preferences)",
        ),
        "preferences",
    )
)
def solution_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(training_rows.solution_features(preferences(spark, sf_dir), max_length=128))


_CHAT_PREFIX = f"""concat({sql.chat(("system", sql.quoted(DEFAULT_PROMPTS["standard"])),
    ("user", "question"))}, '<|im_start|>assistant', chr(10))"""


@query(
    with_views(
        _features_sql(
            _CHAT_PREFIX, "concat(answer, '<|im_end|>', chr(10))", 112, "problems"
        ),
        "problems",
    )
)
def answer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(training_rows.answer_features(problems(spark, sf_dir), max_length=112))


@query(
    with_views(
        f"""
SELECT id, rollout, {sql.ids_text(sql.code_points("substr(concat(question, response), length(question) + 1)"))}
       AS tail,
       least(length(question) + length(response), 40) AS n_joined,
       greatest(least(length(question) + length(response), 40) - length(question), 0) AS n_response
FROM (SELECT p.id, r.rollout, p.question, r.response FROM problems p JOIN rollouts r USING (id))""",
        "problems",
        "rollouts",
    )
)
def response_tails(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = rollouts(spark, sf_dir).select("id", "rollout", "response")
    ids = (
        problems(spark, sf_dir)
        .join(responses, "id")
        .select(
            "id",
            "rollout",
            features.code_points("question").alias("prompt_ids"),
            features.code_points("response").alias("response_ids"),
        )
    )
    whole = F.concat("prompt_ids", "response_ids")
    joined = features.joined_ids("prompt_ids", "response_ids", 40)
    kept = features.kept_response_length("prompt_ids", "response_ids", 40)
    return ids.select(
        "id",
        "rollout",
        ids_text(features.after_prefix(whole, F.size("prompt_ids"))).alias("tail"),
        F.size(joined).cast("bigint").alias("n_joined"),
        kept.cast("bigint").alias("n_response"),
    )


@query(
    with_views(
        f"""
SELECT id, CAST(w AS INTEGER) AS width,
       {sql.ids_text('list_concat(ids, list_transform(range(w - len(ids)), lambda x: 0))')} AS input_ids,
       {sql.ids_text('''list_concat(list_transform(ids, lambda x: 1),
           list_transform(range(w - len(ids)), lambda x: 0))''')} AS attention_mask,
       {sql.ids_text('list_concat(ids, list_transform(range(w - len(ids)), lambda x: -100))')} AS labels
FROM (SELECT id, ids, max(len(ids)) OVER (PARTITION BY id // 8) AS w
      FROM (SELECT id, {sql.code_points("coalesce(chosen, '')")} AS ids FROM preferences))""",
        "preferences",
    )
)
def padded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        preferences(spark, sf_dir)
        .select("id", features.code_points(F.coalesce("chosen", F.lit(""))).alias("input_ids"))
        .withColumns(
            {
                "attention_mask": features.ones("input_ids"),
                "labels": F.col("input_ids"),
                "batch": F.floor(F.col("id") / 8),
            }
        )
    )
    return _flat(training_rows.pad_batches(rows, ["batch"])).drop("batch")


@query(
    with_views(
        f"""
SELECT id, bucket, CAST(0 AS INTEGER) AS slice, CAST((row_number() OVER (
         PARTITION BY bucket ORDER BY {sql.hash32('id')}, id) - 1) // 8 AS INTEGER) AS batch
FROM (SELECT id, CAST(ceil(length(coalesce(chosen, '')) / 32) AS INTEGER) AS bucket FROM preferences)""",
        "preferences",
    )
)
def assigned_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = preferences(spark, sf_dir).select(
        "id", features.code_points(F.coalesce("chosen", F.lit(""))).alias("input_ids")
    )
    return training_rows.assigned_batches(rows, 8).drop("input_ids")


@query(
    with_views(
        f"""
SELECT id, array_to_string(['system=' || {sql.quoted(DEFAULT_PROMPTS["sft"])}, 'user=' || question], '|')
       AS prompt, 'assistant=' || {sql.repaired("coalesce(chosen, '')", 'answer')} AS chosen,
       'assistant=' || {sql.repaired('rejected', sql.marked_token('rejected'))} AS rejected
FROM preferences""",
        "preferences",
    )
)
def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = preferences(spark, sf_dir)
    pairs = training_rows.preference_pairs(rows, keep=["id"])
    return flat_pairs(pairs)


def flat_pairs(pairs: DataFrame) -> DataFrame:
    def flat(name: str):
        turns = F.transform(name, lambda m: F.concat(m["role"], F.lit("="), m["content"]))
        return F.array_join(turns, "|")

    return pairs.withColumns({name: flat(name) for name in ("prompt", "chosen", "rejected")})


# --- augmentation ----------------------------------------------------------------


def _draw(purpose: str) -> str:
    return sql.hash32("id", f"copy, ':{purpose}'", DEFAULT_SEED)


def _new_value(value: str, number: int) -> str:
    scaled = f"""greatest(1, CAST(floor({value} * (0.5::DOUBLE + 1.5::DOUBLE *
        ({_draw(f'factor{number}')} / 4294967296.0::DOUBLE))) AS BIGINT))"""
    move = f"CASE WHEN {_draw(f'sign{number}')} % 2 = 0 THEN -1 ELSE 1 END"
    return f"CASE WHEN {scaled} = {value} THEN greatest(1, {scaled} + {move}) ELSE {scaled} END"


SUBSTITUTED = f"""
SELECT *, {_new_value('o1', 1)} AS n1, {_new_value('o2', 2)} AS n2
FROM (SELECT *, numbers[at1 + 1] AS o1, numbers[at2 + 1] AS o2
      FROM (SELECT *, (at1 + 1 + {_draw('position2')} % (len(numbers) - 1)) % len(numbers) AS at2
            FROM (SELECT *, {_draw('position1')} % len(numbers) AS at1
                  FROM (SELECT *, list_transform(regexp_extract_all(question, '{sql.INT}'),
                               lambda x: CAST(x AS BIGINT)) AS numbers
                        FROM eligible CROSS JOIN (VALUES (0), (1)) AS r(copy)))))"""

# one pair when both draws have the same value: the second one
_FIRST_NEW = "CASE WHEN o1 = o2 THEN n2 ELSE n1 END"


def _replaced(text: str) -> str:
    first = f"regexp_replace({text}, CAST(o1 AS VARCHAR), CAST({_FIRST_NEW} AS VARCHAR))"
    second = f"regexp_replace({first}, CAST(o2 AS VARCHAR), CAST(n2 AS VARCHAR))"
    return f"CASE WHEN o1 = o2 THEN {first} ELSE {second} END"


_ELIGIBLE_PROBLEMS = "SELECT id, question, answer FROM problems"
_RATIO = """CASE WHEN try_cast(answer AS BIGINT) IS NOT NULL AND o2 <> 0
    THEN greatest(0, CAST(trunc(CAST(answer AS BIGINT) * (n2::DOUBLE / o2)) AS BIGINT)) END"""


@query(
    with_views(
        f"""
SELECT id, copy, CASE WHEN o1 = o2 THEN concat(o2, '>', n2)
       ELSE concat(o1, '>', n1, ',', o2, '>', n2) END AS substitutions, {_RATIO} AS ratio_answer
FROM substituted""",
        "problems",
        eligible=_ELIGIBLE_PROBLEMS,
        substituted=SUBSTITUTED,
    )
)
def number_substitutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = augmentation.with_substitutions(tables.copies(problems(spark, sf_dir), 2))
    drawn = drawn.withColumn("ratio_answer", augmentation.ratio_answer("answer", "substitutions"))
    pairs = F.transform("substitutions", lambda p: F.concat(p["old"], F.lit(">"), p["new"]))
    return drawn.select(
        "id",
        "copy",
        F.array_join(pairs, ",").alias("substitutions"),
        F.col("ratio_answer").cast("bigint").alias("ratio_answer"),
    )


def _padded(column: str, width: int) -> str:
    return f"lpad(CAST({column} AS VARCHAR), {width}, '0')"


_LONG_NUMBERS = f"""
SELECT *, concat('仓库进货', a, '件，售出', b, '件') AS question, CASE WHEN id % 4 = 0 THEN a ELSE concat(CAST(customer % 9 + 1 AS VARCHAR),
         {_padded('id', 14)}, {_padded('customer', 15)}) END AS answer
FROM (SELECT o_orderkey AS id, o_custkey AS customer, concat(CAST(o_custkey % 9 + 1 AS VARCHAR), {_padded('o_orderkey', 9)}, {_padded('o_custkey', 10)}) AS a,
             concat(CAST(o_orderkey % 9 + 1 AS VARCHAR), {_padded('o_custkey', 9)}, {_padded('o_orderkey', 10)},
                    {_padded('o_custkey', 10)}, {_padded('o_orderkey', 10)}) AS b
      FROM orders)"""


def _long_scaled(digits: str, numerator: str, divisor: str) -> str:
    """SQL: digits of up to 40 places times a fraction, in two halves."""
    half, unit = 20, f"{10**20}::HUGEINT"
    high = f"coalesce(try_cast(left({digits}, greatest(length({digits}) - {half}, 0)) AS HUGEINT), 0::HUGEINT)"
    product = f"({high} * ({numerator})::HUGEINT)"
    rest = f"({product} % ({divisor})::HUGEINT * {unit} + right({digits}, {half})::HUGEINT * ({numerator})::HUGEINT) // ({divisor})::HUGEINT"
    upper = f"({product} // ({divisor})::HUGEINT + {rest} // {unit})"
    return f"ltrim(concat(CAST({upper} AS VARCHAR), lpad(CAST({rest} % {unit} AS VARCHAR), {half}, '0')), '0')"


@query(
    with_views(
        f"""
SELECT id, copy, concat(o1, '>', n1, ',', o2, '>', n2) AS substitutions, {_long_scaled('answer', 'left(n2, length(n2) - cut)', 'left(o2, length(o2) - cut)')} AS ratio_answer
FROM (SELECT *, greatest(length(n2), length(o2)) - 12 AS cut FROM drawn)""",
        long_numbers=_LONG_NUMBERS,
        drawn=f"""
SELECT *, {_long_scaled('o1', f"4294967296 + 3 * {_draw('factor1')}", "8589934592")} AS n1,
       {_long_scaled('o2', f"4294967296 + 3 * {_draw('factor2')}", "8589934592")} AS n2
FROM (SELECT *, CASE WHEN first = 0 THEN a ELSE b END AS o1, CASE WHEN first = 0 THEN b ELSE a END AS o2
      FROM (SELECT *, {_draw('position1')} % 2 AS first FROM long_numbers CROSS JOIN (VALUES (0), (1)) AS r(copy)))""",
    )
)
def long_number_substitutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of 20 and 40 digits, and answers of 20 and 30."""
    customer, order = F.col("o_custkey"), F.col("o_orderkey")

    def digits(first, *parts):
        return F.concat((first % 9 + 1).cast("string"), *(F.lpad(c.cast("string"), n, "0") for c, n in parts))

    short, long = digits(customer, (order, 9), (customer, 10)), digits(order, (customer, 9), (order, 10), (customer, 10), (order, 10))
    rows = spread_table(spark, sf_dir, "orders").select(
        order.alias("id"),
        F.concat(F.lit("仓库进货"), short, F.lit("件，售出"), long, F.lit("件")).alias("question"),
        F.when(order % 4 == 0, short).otherwise(digits(customer, (order, 14), (customer, 15))).alias("answer"),
    )
    drawn = augmentation.with_substitutions(tables.copies(rows, 2))
    drawn = drawn.withColumn("ratio_answer", augmentation.ratio_answer("answer", "substitutions"))
    pairs = F.transform("substitutions", lambda p: F.concat(p["old"], F.lit(">"), p["new"]))
    return drawn.select(
        "id",
        "copy",
        F.array_join(pairs, ",").alias("substitutions"),
        "ratio_answer",
    )


COPIES = f"""
SELECT concat(id, '_aug', copy) AS id, new_question AS question,
       coalesce({sql.stated('new_cot')}, CAST({_RATIO} AS VARCHAR)) AS answer,
       new_cot AS cot, {sql.quoted(DEFAULT_INSTRUCTION)} AS instruction, true AS augmented,
       CAST(id AS VARCHAR) AS original_id
FROM (SELECT *, {_replaced('question')} AS new_question, {_replaced('cot')} AS new_cot
      FROM substituted)"""
_ELIGIBLE_SOLUTIONS = f"""
SELECT id, question, answer, chosen AS cot FROM preferences WHERE NOT {sql.blank('chosen')}"""


@query(
    with_views(
        f"""
SELECT CAST(id AS VARCHAR) AS id, question, answer, cot, {sql.quoted(DEFAULT_INSTRUCTION)} AS instruction,
       NULL AS augmented, NULL AS original_id FROM eligible
UNION ALL SELECT * FROM copied WHERE answer IS NOT NULL""",
        "preferences",
        eligible=_ELIGIBLE_SOLUTIONS,
        substituted=SUBSTITUTED,
        copied=COPIES,
    )
)
def augmented_solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    solutions = tables.solutions_from_preferences(preferences(spark, sf_dir))
    return augmentation.with_augmented_copies(solutions)


@query(
    with_views(
        """
SELECT (SELECT count(*) FROM eligible) AS n_before,
       (SELECT count(*) FROM copied WHERE answer IS NOT NULL) AS n_added,
       (SELECT count(*) FROM eligible) + (SELECT count(*) FROM copied WHERE answer IS NOT NULL) AS n_after""",
        "preferences",
        eligible=_ELIGIBLE_SOLUTIONS,
        substituted=SUBSTITUTED,
        copied=COPIES,
    )
)
def augmentation_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return augmentation.augmentation_growth(augmented_solutions(spark, sf_dir))


@query(
    with_views(
        f"""
SELECT id, cot, {sql.holds('cot')} AS equation_ok FROM copied WHERE answer IS NOT NULL""",
        "preferences",
        eligible=_ELIGIBLE_SOLUTIONS,
        substituted=SUBSTITUTED,
        copied=COPIES,
    )
)
def augmented_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    solutions = tables.solutions_from_preferences(preferences(spark, sf_dir))
    return augmentation.augmented_copies(solutions, check_equations=True).select(
        "id", "cot", "equation_ok"
    )
