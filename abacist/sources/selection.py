"""Which input to read and whether an output has to be written."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.functions.columns import ColumnLike, as_column
from abacist.functions.text import is_blank

VERSION_SUFFIX = r"-(\d+)$"


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system it names."""
    file_system, hadoop_path = _hadoop_path(spark, path)
    return file_system.exists(hadoop_path)


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder, with those it lies in, unless it is there."""
    file_system, hadoop_path = _hadoop_path(spark, path)
    file_system.mkdirs(hadoop_path)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end; a crashed write leaves no mark."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str:
    """The first candidate that exists, else the first one."""
    return next((c for c in candidates if path_exists(spark, c)), candidates[0])


def existing_names(
    spark: SparkSession, paths: Mapping[str, str | Iterable[str]]
) -> list[str]:
    """Names, in the given order, whose path or paths all exist."""
    kept = []
    for name, needed in paths.items():
        needed = [needed] if isinstance(needed, str) else needed
        if all(path_exists(spark, path) for path in needed):
            kept.append(name)
    return kept


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at a path; None if it holds no file."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def derive_if_absent(
    spark: SparkSession,
    path: str,
    derive: Callable[[], DataFrame],
    required_text: str = "cot",
) -> DataFrame:
    """The Parquet table at ``path``; derived and written when it is missing, half
    written, empty or without any non-blank ``required_text``.

    A finished table without that column is another table and never replaced.
    """
    if finished(spark, path):
        existing = _stored(spark, path)
        if existing is not None and required_text not in existing.columns:
            raise ValueError(f"{path} has no column {required_text!r}: {existing.columns}")
        if existing is not None and not existing.where(~is_blank(required_text)).limit(1).isEmpty():
            return existing
    derive().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_if_absent(table: DataFrame, path: str) -> None:
    """Write a Parquet table unless it was written to its end already."""
    if not finished(table.sparkSession, path):
        table.write.mode("overwrite").parquet(path)


def latest_version(
    versions: DataFrame, name: ColumnLike, complete: ColumnLike | None = None
) -> DataFrame:
    """The row with the largest numeric ``-<n>`` suffix.

    ``checkpoint-1000`` comes after ``checkpoint-900``. Rows without a suffix,
    or not ``complete``, do not count.
    """
    number = F.regexp_extract(as_column(name), VERSION_SUFFIX, 1).try_cast("bigint")
    kept = versions.where(number.isNotNull())
    if complete is not None:
        kept = kept.where(as_column(complete))
    return kept.withColumn("version", number).orderBy(F.desc("version")).limit(1)


def latest_version_path(
    spark: SparkSession, folder: str, state_file: str | None = None
) -> str | None:
    """The folder ``<name>-<n>`` with the largest ``n`` that has its state file."""
    if not path_exists(spark, folder):
        return None
    file_system, hadoop_path = _hadoop_path(spark, folder)
    best: tuple[int, str] | None = None
    for status in file_system.listStatus(hadoop_path):
        stem, dash, digits = status.getPath().getName().rpartition("-")
        if not (dash and digits.isdigit() and status.isDirectory()):
            continue
        path = status.getPath().toString()
        if state_file and not path_exists(spark, f"{path}/{state_file}"):
            continue
        if best is None or int(digits) > best[0]:
            best = (int(digits), path)
    return best[1] if best else None
