"""Text, number, prompt and display functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.fixtures import (
    preferences,
    problems,
    rollouts,
    spread_table,
    table,
    with_views,
)
from abacist.functions import chat, display, text
from abacist.functions.scoring import entry_score
from abacist.operators.training_rows import suffix_quality
from abacist.queries import sql
from abacist.queries.registry import query, rounded


@query(with_views(f"SELECT id, rollout, {sql.extract('response')} AS extracted FROM rollouts", "rollouts"))
def extracted_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollouts(spark, sf_dir).select(
        "id", "rollout", text.extract_answer("response").alias("extracted")
    )


@query(
    with_views(
        rf"""
SELECT id, coalesce(regexp_extract_all(chosen, '答案[：:]{sql.SP}*({sql.NUM})', 1)[-1],
       regexp_extract_all(chosen, '{sql.NUM}')[-1], '') AS extracted
FROM preferences""",
        "preferences",
    )
)
def last_marked_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences(spark, sf_dir).select(
        "id", text.extract_answer("chosen", which="last").alias("extracted")
    )


@query(f"SELECT doc_id, {sql.extract('text')} AS extracted FROM documents")
def document_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_table(spark, sf_dir, "documents").select(
        "doc_id", text.extract_answer("text").alias("extracted")
    )


_FRACTIONS = """
SELECT l_orderkey AS id, CASE l_linenumber % 5
    WHEN 0 THEN concat(l_partkey, '/', l_suppkey % 4)
    WHEN 1 THEN CAST(l_partkey - 50 AS VARCHAR)
    WHEN 2 THEN concat(l_suppkey, '/', l_partkey % 7, '/2')
    WHEN 3 THEN concat(l_suppkey, '.', l_linenumber)
    ELSE concat('x', l_partkey) END AS written
FROM lineitem"""


@query(
    with_views(
        f"SELECT id, written, round({sql.number('written')}, 6) AS value FROM fractions",
        fractions=_FRACTIONS,
    )
)
def parsed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    written = (
        F.when(line % 5 == 0, F.concat(part, F.lit("/"), supplier % 4))
        .when(line % 5 == 1, (part - 50).cast("string"))
        .when(line % 5 == 2, F.concat(supplier, F.lit("/"), part % 7, F.lit("/2")))
        .when(line % 5 == 3, F.concat(supplier, F.lit("."), line))
        .otherwise(F.concat(F.lit("x"), part))
    )
    return spread_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        written.alias("written"),
        rounded(text.parse_number(written)).alias("value"),
    )


@query(
    f"""
SELECT doc_id, {sql.strip("concat(chr(12288), ' ', text, chr(10), chr(9))")} AS stripped,
       {sql.blank("text")} AS blank
FROM documents"""
)
def stripped_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = F.concat(F.lit("　 "), "text", F.lit("\n\t"))
    return spread_table(spark, sf_dir, "documents").select(
        "doc_id", text.strip(framed).alias("stripped"), text.is_blank("text").alias("blank")
    )


@query(
    rf"""
SELECT doc_id, array_to_string(regexp_extract_all(text, '{sql.INT}'), ',') AS numbers,
       CAST(coalesce(list_sum(list_transform(regexp_extract_all(text, '{sql.INT}'),
            lambda x: try_cast(x AS BIGINT))), 0) AS BIGINT) AS total
FROM documents"""
)
def whole_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = text.integers("text")
    # one text with a total beyond bigint gets null and does not end the job
    total = F.aggregate(F.filter(found["value"], F.isnotnull), F.lit(0).cast("bigint"), F.try_add)
    return spread_table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(found["text"], ",").alias("numbers"), total.alias("total")
    )


@query(
    with_views(
        f"""
SELECT id, {sql.stated('chosen')} AS result, {sql.holds('chosen')} AS equation_ok
FROM preferences""",
        "preferences",
    )
)
def stated_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences(spark, sf_dir).select(
        "id",
        text.stated_result("chosen").alias("result"),
        text.equation_holds("chosen").alias("equation_ok"),
    )


@query(
    with_views(
        """
SELECT id, regexp_replace(regexp_replace(question, CAST(id % 90 + 10 AS VARCHAR), '1'), '1', '77')
    AS replaced
FROM problems""",
        "problems",
    )
)
def replaced_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = F.array(
        F.struct((F.col("id") % 90 + 10).alias("old"), F.lit(1).cast("bigint").alias("new")),
        F.struct(F.lit(1).cast("bigint").alias("old"), F.lit(77).cast("bigint").alias("new")),
    )
    return problems(spark, sf_dir).select(
        "id", text.replace_numbers("question", pairs).alias("replaced")
    )


@query(
    with_views(
        f"SELECT id, {sql.answer_line('chosen', 'answer')} AS solution FROM preferences",
        "preferences",
    )
)
def answer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences(spark, sf_dir).select(
        "id", text.with_answer_line("chosen", "answer").alias("solution")
    )


@query(
    with_views(
        f"""
SELECT count(*) AS n_rows,
       count(*) FILTER (
           WHERE {sql.extract(sql.answer_line("coalesce(chosen, '')", "answer"))} <> answer) AS n_differs
FROM preferences""",
        "preferences",
    )
)
def answer_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_quality(preferences(spark, sf_dir))


@query(
    with_views(
        f"""
SELECT id, {sql.repaired('chosen', 'answer')} AS chosen,
       {sql.marked_token('rejected')} AS rejected_answer,
       {sql.repaired('rejected', sql.marked_token('rejected'))} AS rejected
FROM preferences""",
        "preferences",
    )
)
def repaired_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = text.marked_token("rejected")
    return preferences(spark, sf_dir).select(
        "id",
        text.repaired_answer_lines("chosen", "answer").alias("chosen"),
        token.alias("rejected_answer"),
        text.repaired_answer_lines("rejected", token).alias("rejected"),
    )


@query("SELECT doc_id, replace(text, chr(10), '') AS joined FROM documents")
def joined_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the texts arrive as a plain string, half as an array of lines."""
    lines = F.when(
        F.col("doc_id") % 2 == 0, F.to_json(F.struct(F.split("text", "\n").alias("t")))
    ).otherwise(F.to_json(F.struct(F.replace(F.col("text"), F.lit("\n"), F.lit("")).alias("t"))))
    value = F.variant_get(F.parse_json(lines), "$.t", "variant")
    return spread_table(spark, sf_dir, "documents").select("doc_id", text.joined_text(value).alias("joined"))


@query(
    with_views(
        f"""
SELECT id, array_to_string([concat('system=', {sql.quoted(chat.DEFAULT_PROMPTS["zero_shot"])}),
       concat('user=', question), concat('assistant=', answer)], '|') AS turns
FROM problems""",
        "problems",
    )
)
def message_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.messages(chat.prompt_text(F.lit("zero_shot")), "question", "answer")
    flat = F.transform(turns, lambda m: F.concat(m["role"], F.lit("="), m["content"]))
    return problems(spark, sf_dir).select("id", F.array_join(flat, "|").alias("turns"))


@query(
    with_views(
        f"""
SELECT id, concat('<|im_start|>', {sql.quoted(chat.DEFAULT_INSTRUCTION)}, ' ',
       {sql.quoted(chat.DEFAULT_STEP_REQUEST)}, '<|im_end|>', chr(10), '<|im_start|>', question,
       '<|im_end|>', chr(10), '<|im_start|>') AS prefix
FROM problems""",
        "problems",
    )
)
def training_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = chat.training_segments(F.lit(chat.DEFAULT_INSTRUCTION), "question")
    return problems(spark, sf_dir).select("id", prefix.alias("prefix"))


@query(
    with_views(
        f"""
SELECT id, question, answer, concat({sql.chat(("system", sql.quoted(chat.DEFAULT_PROMPTS["grpo"])),
       ("user", "question"))}, '<|im_start|>assistant', chr(10)) AS prompt
FROM (SELECT CAST(id AS VARCHAR) AS id, question, answer FROM problems)""",
        "problems",
    )
)
def rollout_prompt_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abacist.operators.training_rows import rollout_prompts

    return rollout_prompts(problems(spark, sf_dir))


_PROMPT_TYPE = "['few_shot', 'unknown', 'sft', 'standard'][id % 4 + 1]"


@query(
    with_views(
        f"""
SELECT id, {_PROMPT_TYPE} AS prompt_type, CASE {_PROMPT_TYPE}
    WHEN 'few_shot' THEN {sql.quoted(chat.DEFAULT_PROMPTS["few_shot"])}
    WHEN 'sft' THEN {sql.quoted(chat.DEFAULT_PROMPTS["sft"])}
    WHEN 'standard' THEN {sql.quoted(chat.DEFAULT_PROMPTS["standard"])}
    ELSE {sql.quoted(chat.DEFAULT_PROMPTS["zero_shot"])} END AS system
FROM problems""",
        "problems",
    )
)
def prompt_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.array(*map(F.lit, ("few_shot", "unknown", "sft", "standard")))
    kind = F.get(kinds, (F.col("id") % 4).cast("int"))
    return problems(spark, sf_dir).select(
        "id", kind.alias("prompt_type"), chat.prompt_text(kind).alias("system")
    )


def _request_sql(template: str) -> str:
    return (
        f"replace(replace({sql.quoted(template)}, '{{question}}', question), '{{answer}}', answer)"
    )


@query(
    with_views(
        f"""
SELECT id, {_request_sql(chat.DEFAULT_CORRECT_REQUEST)} AS correct_request,
       {_request_sql(chat.DEFAULT_WRONG_REQUEST)} AS wrong_request
FROM problems""",
        "problems",
    )
)
def request_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abacist.operators.generation import solution_requests

    return solution_requests(problems(spark, sf_dir)).select(
        "id", "correct_request", "wrong_request"
    )


@query(f"SELECT doc_id, {sql.strip('text')} AS reply FROM documents")
def reply_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion bodies around every document, read back."""
    content = F.struct(F.struct(F.col("text").alias("content")).alias("message"))
    body = F.to_json(F.struct(F.array(content).alias("choices")))
    return spread_table(spark, sf_dir, "documents").select(
        "doc_id", chat.reply_content(body).alias("reply")
    )


@query(
    """
SELECT l_orderkey AS id, l_extendedprice / 8 AS seconds,
       CASE WHEN l_extendedprice / 8 < 60 THEN printf('%.1fs', l_extendedprice / 8)
            WHEN l_extendedprice / 8 < 3600 THEN printf('%.1fm', l_extendedprice / 8 / 60)
            ELSE printf('%.1fh', l_extendedprice / 8 / 3600) END AS duration
FROM lineitem"""
)
def duration_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.col("l_extendedprice") / 8
    return spread_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        seconds.alias("seconds"),
        display.duration_text(seconds).alias("duration"),
    )


@query(
    """
SELECT l_orderkey AS id, l_quantity / 800 AS share, printf('%.2f%%', l_quantity / 800 * 100) AS percent,
       concat(CASE WHEN l_discount - l_tax > 0 THEN '+' ELSE '' END,
              printf('%.2f%%', (l_discount - l_tax) * 100)) AS gain
FROM lineitem"""
)
def percent_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.col("l_quantity") / 800
    return spread_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        share.alias("share"),
        display.percent_text(share).alias("percent"),
        display.percent_text(F.col("l_discount") - F.col("l_tax"), signed=True).alias("gain"),
    )


@query(
    """
SELECT l_suppkey AS entry, round(least(a * 15 + n * 5, 15), 6) AS solo,
       round(least(a * 15 + n * 3, 15), 6) AS team
FROM (SELECT l_suppkey, avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS a,
             count(DISTINCT l_linestatus) AS n
      FROM lineitem GROUP BY l_suppkey)"""
)
def entry_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = (
        spread_table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("entry"))
        .agg(
            F.avg((F.col("l_returnflag") == "R").cast("double")).alias("accuracy"),
            F.count_distinct("l_linestatus").alias("finished"),
        )
    )
    return entries.select(
        "entry",
        rounded(entry_score("accuracy", "finished")).alias("solo"),
        rounded(entry_score("accuracy", "finished", team=True)).alias("team"),
    )


@query("SELECT doc_id, substr(text, 1, 80) AS preview FROM documents ORDER BY doc_id LIMIT 10")
def document_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    from abacist.operators.ordering import preview_rows

    return preview_rows(table(spark, sf_dir, "documents"), 10, "doc_id").select(
        "doc_id", text.preview("text", 80).alias("preview")
    )
