"""A corpus pipeline of five operators, from raw documents to token ids.

Stages that filter return the columns of ``documents``; ``n_chars`` follows the
text where a stage changes it. ``run`` writes every stage's rows and reads them
again, so that no stage computes its predecessors twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.llm import bpe, decontamination, lines, simhash, toxicity
from abacist.llm.queries import table, tokenizer_path
from abacist.session import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model scores as toxic go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later runs of repeated lines go, of three lines or 25 words; every document stays, if as an empty text."""
    found = lines.without_repeated_lines(docs, words=lines.WORDS).withColumn("n_chars", F.length("text").cast("long"))
    return found.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.without_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text they decode to."""
    found = bpe.encoded_and_decoded(docs, tokenizer_path())
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("text").alias("decoded"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

ORACLE_SQL = None
"""Toxicity is learned, so SQL cannot say it; tests compare with plain Python."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
