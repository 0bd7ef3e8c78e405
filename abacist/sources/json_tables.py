"""JSON tables whose text fields may be strings or arrays of strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.functions.text import joined_text
from abacist.schemas import CORRUPT_COLUMN
from abacist.session import shared_folder
from abacist.sources.json_arrays import json_array_records


def read_json_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    json_array: bool = True,
    keep_corrupt: bool = False,
) -> DataFrame:
    """A JSON file (one array) or a folder of JSON lines as a typed table.

    ``id`` and ``answer`` keep the text of the source, so ``4.50`` stays
    ``4.50``. Malformed records fill ``_corrupt_record``; they are part of the
    result with ``keep_corrupt`` and raise otherwise when they are read.

    A JSON array is cut into lines by many tasks, see :mod:`abacist.sources.json_arrays`;
    the lines lie in the shared folder and are what is read from then on.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    wanted = with_corrupt if keep_corrupt else schema
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN} if keep_corrupt else {"mode": "FAILFAST"}
    if json_array:
        array, path = path, shared_folder(spark, "json-lines")
        line = F.translate("text", "\n\r", "  ")  # white space: strings have none but escaped
        json_array_records(spark, array).select(line).write.text(path)
    raw = spark.read.schema(wanted).options(**options).json(path)
    return raw.select(
        *(
            joined_text(field.name).alias(field.name)
            if isinstance(field.dataType, T.VariantType)
            else F.col(field.name)
            for field in raw.schema.fields
        )
    )


def write_json_table(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines, UTF-8, one file per task; folders are created."""
    table.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_parquet_table(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet, also for nested message arrays; splittable and column-pruned."""
    table.write.mode(mode).parquet(path)
