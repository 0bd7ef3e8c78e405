"""The two-column result file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.functions.columns import ColumnLike, as_column


def submission(predictions: DataFrame, prediction: ColumnLike = "prediction") -> DataFrame:
    """``id, ret`` of a prediction table."""
    return predictions.select(
        F.col("id").cast("string").alias("id"), as_column(prediction).alias("ret")
    )


def write_submissions(
    predictions: DataFrame, path: str, name: str, prediction: ColumnLike = "prediction"
) -> None:
    """The result files of all ``name`` values in one pass, a folder ``name=...`` each."""
    rows = predictions.select(
        F.col("id").cast("string").alias("id"), as_column(prediction).alias("ret"), name
    )
    writer = rows.write.mode("overwrite").partitionBy(name)
    writer.option("header", True).option("emptyValue", "").csv(path)


def write_submission(
    predictions: DataFrame,
    path: str,
    prediction: ColumnLike = "prediction",
    single_file: bool = False,
) -> None:
    """CSV with header ``id,ret``; numbers and plain ids are not quoted.

    One file per task; ``single_file`` is for a final file of known small size.
    """
    table = submission(predictions, prediction)
    if single_file:
        table = table.coalesce(1)
    (
        table.write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", "")
        .csv(path)
    )
