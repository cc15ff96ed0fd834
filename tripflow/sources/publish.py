"""Write, audit, publish: tables of a run stay apart until their checks have passed."""

from __future__ import annotations

import datetime as dt
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    place, system = _file_system(spark, path)
    return system.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    place, system = _file_system(spark, path)
    system.delete(place, True)


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; some file systems report a failure, others raise it."""
    place, system = _file_system(spark, source)
    try:
        moved, cause = system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(target)), None
    except Py4JJavaError as error:
        moved, cause = False, error
    if not moved:
        raise OSError(f"cannot move {source} to {target}") from cause


def new_run() -> str:
    """A name for a run; names sort by start."""
    return f"{dt.datetime.now(dt.UTC):%Y%m%dt%H%M%S%f}_{uuid.uuid4().hex[:8]}"


def run_folder(output: str, run: str) -> str:
    """Where a run writes. Readers of ``output`` skip names with an underscore."""
    return f"{output.rstrip('/')}/_runs/{run}"


def replace_folder(spark: SparkSession, new: str, target: str) -> None:
    """Put a folder where readers look. The old one is back if that fails."""
    old = f"{new}__replaced"
    had = folder_exists(spark, target)
    if had:
        _move(spark, target, old)
    try:
        _move(spark, new, target)
    except Exception:
        if had:
            _move(spark, old, target)
        raise
    if had:
        remove_folder(spark, old)


def publish_table(spark: SparkSession, new: str, name: str) -> None:
    """Give a checked catalog table the name its readers use.

    Two renames in the catalog, no file is touched: readers see all of the old
    table or all of the new one. Files of the old table stay for those that
    still read them. If the second rename fails, the first is undone.
    """
    old = f"{new}__replaced"
    had = spark.catalog.tableExists(name)
    if had:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    except Exception:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    if had:
        spark.sql(f"DROP TABLE {old}")


def remove_old_runs(spark: SparkSession, output: str, keep: int = 2) -> list[str]:
    """Remove the folders of all but the latest runs, with their tables' old files.

    For a quiet moment: not while a run writes, or a reader holds an old table.
    """
    place, system = _file_system(spark, f"{output.rstrip('/')}/_runs")
    if not system.exists(place):
        return []
    runs = sorted(status.getPath().toString() for status in system.listStatus(place))
    old = runs[: max(len(runs) - keep, 0)]
    for path in old:
        remove_folder(spark, path)
    return old
