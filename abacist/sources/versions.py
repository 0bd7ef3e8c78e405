"""Several tables that change together.

A version is a folder ``version-<n>`` with what it adds to each table, and a
manifest that names all folders of all tables, older ones included. The manifest
is written last, and readers go by the newest version that has one written to its
end. So a run that ends between two writes changes nothing that is read, adding
rows writes those rows alone, and readers of an older version keep their files.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession

from abacist.sources.selection import latest_version_path

MANIFEST = "manifest"
_MANIFEST_SCHEMA = "table string, place int, folder string"


def manifest(spark: SparkSession, root: str, version: str | None = None) -> dict[str, list[str]]:
    """The folders of each table, below ``root``, oldest first; none without a finished version.

    ``version`` names one folder ``version-<n>`` instead of the newest.
    """
    path = f"{root}/{version}" if version else latest_version_path(spark, root, f"{MANIFEST}/_SUCCESS")
    if path is None:
        return {}
    found: dict[str, list[str]] = {}
    rows = spark.read.schema(_MANIFEST_SCHEMA).json(f"{path}/{MANIFEST}").collect()
    for row in sorted(rows, key=lambda row: (row.table, row.place)):
        found.setdefault(row.table, []).append(row.folder)
    return found


def versioned_table(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame | None:
    """A table as of the newest finished version, or the named one; None if it is not there."""
    folders = manifest(spark, root, version).get(name)
    return spark.read.parquet(*(f"{root}/{folder}" for folder in folders)) if folders else None


def publish(
    spark: SparkSession, root: str, tables: Mapping[str, DataFrame], replaced: Collection[str] = ()
) -> str:
    """Add the rows of ``tables`` as one new version and return its folder's name.

    Tables in ``replaced`` begin anew, others keep their rows; tables that are not
    named stay as they are. Rows of a table need the same columns in all versions.
    There is one writer at a time: what a crashed one left of this version is
    overwritten.
    """
    newest = latest_version_path(spark, root, f"{MANIFEST}/_SUCCESS")
    name = f"version-{int(newest.rpartition('-')[2]) + 1 if newest else 1}"
    folders = {table: [] if table in replaced else parts for table, parts in manifest(spark, root).items()}
    for table, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{root}/{name}/{table}")
        folders[table] = [*folders.get(table, []), f"{name}/{table}"]
    listed = [(table, place, folder) for table, parts in folders.items() for place, folder in enumerate(parts)]
    _finish(spark, f"{root}/{name}", listed)
    return name


def _finish(spark: SparkSession, path: str, listed: list[tuple[str, int, str]]) -> None:
    spark.createDataFrame(listed, _MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/{MANIFEST}")
