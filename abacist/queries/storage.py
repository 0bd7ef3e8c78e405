"""Readers, writers, input selection: what is written reads back the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.fixtures import model_responses, preferences, problems, table, with_views
from abacist.functions.chat import DEFAULT_INSTRUCTION, DEFAULT_PROMPTS
from abacist.operators import tables, training_rows
from abacist.operators.keyed import last_by_key
from abacist.plans.evaluation import predictions
from abacist.queries import sql
from abacist.queries.registry import query
from abacist.queries.training import flat_pairs
from abacist.schemas import RAW_PREFERENCE
from abacist.session import shared_folder
from abacist.sources import json_tables, selection, submission


@query(
    with_views(
        "SELECT CAST(id AS VARCHAR) AS id, question, answer, chosen, rejected FROM preferences",
        "preferences",
    )
)
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "json")
    json_tables.write_json_table(preferences(spark, sf_dir), path)
    rows = json_tables.read_json_table(spark, path, RAW_PREFERENCE, json_array=False)
    return rows.drop("instruction")


@query(
    with_views(
        f"""
SELECT CAST(id AS VARCHAR) AS id, model,
       coalesce(nullif({sql.extract('response')}, ''), '0') AS ret FROM responses""",
        "responses",
    )
)
def submission_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result file per model, read back with its name."""
    path = shared_folder(spark, "submission")
    rows = predictions(model_responses(spark, sf_dir))
    submission.write_submissions(rows, path, "model")
    back = spark.read.schema("id string, ret string, model string").option("header", True)
    return back.option("basePath", path).csv(path)


@query(with_views("SELECT id, question, answer FROM problems", "problems"))
def first_existing_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "inputs")
    json_tables.write_parquet_table(problems(spark, sf_dir), f"{path}/plain")
    return spark.read.parquet(selection.first_existing(spark, [f"{path}/merged", f"{path}/plain"]))


@query(
    with_views(
        f"""
SELECT CAST(id AS VARCHAR) AS id, question, answer, chosen AS cot,
       {sql.quoted(DEFAULT_INSTRUCTION)} AS instruction
FROM preferences WHERE NOT {sql.blank('chosen')}""",
        "preferences",
    )
)
def derived_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second call finds the table and does not derive it again."""
    path = shared_folder(spark, "derived")
    rows = preferences(spark, sf_dir)
    selection.derive_if_absent(spark, path, lambda: tables.solutions_from_preferences(rows))
    return selection.derive_if_absent(spark, path, lambda: rows.select("id").limit(0))


@query(with_views("SELECT id, question, answer FROM problems", "problems"))
def written_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write finds the output and leaves it."""
    path = shared_folder(spark, "output")
    rows = problems(spark, sf_dir)
    selection.write_if_absent(rows, path)
    selection.write_if_absent(rows.withColumn("answer", F.lit("changed")), path)
    return spark.read.parquet(path)


@query(
    with_views(
        "SELECT CAST(id AS VARCHAR) AS id, coalesce(chosen, question) AS cot FROM preferences",
        "preferences",
    )
)
def saved_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs appended in two saves, the second one repeating and adding ids."""
    path = shared_folder(spark, "parts")
    rows = preferences(spark, sf_dir).withColumn("id", F.col("id").cast("string"))
    first = rows.where("chosen is not null").select("id", F.col("chosen").alias("cot"), F.lit(1).alias("save"))
    json_tables.write_parquet_table(first, path, mode="append")
    second = rows.select("id", F.coalesce("chosen", "question").alias("cot"), F.lit(2).alias("save"))
    json_tables.write_parquet_table(second, path, mode="append")
    return last_by_key(spark.read.parquet(path), ["id"], "save").drop("save")


@query(
    """
SELECT concat('checkpoint-', o_orderkey) AS name, o_orderkey AS version FROM orders
WHERE o_orderstatus <> 'P' ORDER BY o_orderkey DESC LIMIT 1"""
)
def latest_complete_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("checkpoint-"), "o_orderkey").alias("name"),
        (F.col("o_orderstatus") != "P").alias("complete"),
    )
    return selection.latest_version(versions, "name", "complete").select("name", "version")


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
def nested_pairs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message lists written as nested Parquet and read back."""
    path = shared_folder(spark, "pairs")
    rows = preferences(spark, sf_dir)
    json_tables.write_parquet_table(training_rows.preference_pairs(rows, keep=["id"]), path)
    return flat_pairs(spark.read.parquet(path))


@query("SELECT o_orderkey AS id, o_totalprice FROM orders")
def fallback_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reviewed table is preferred; the given one is read where there is none."""
    candidates = [f"{sf_dir}/reviewed_orders.parquet", f"{sf_dir}/orders.parquet"]
    rows = spark.read.parquet(selection.first_existing(spark, candidates))
    return rows.select(F.col("o_orderkey").alias("id"), "o_totalprice")


@query(
    with_views(
        "SELECT CAST(id AS VARCHAR) AS id, question, answer, chosen, rejected FROM preferences",
        "preferences",
    )
)
def json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one JSON array each, of at most a thousand rows."""
    path = shared_folder(spark, "arrays")
    rows = preferences(spark, sf_dir)
    part = F.floor(F.col("id") / 1000).alias("part")
    arrays = rows.groupBy(part).agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value"))
    arrays.write.partitionBy("part").text(path)
    read = json_tables.read_json_table(spark, f"{path}/part=*", RAW_PREFERENCE)
    return read.drop("instruction")
