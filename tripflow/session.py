"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

# Settings every job relies on. Partition counts are left to AQE on purpose:
# the initial count only bounds how far it can coalesce or split.
BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # Casts that do not fit and sums that overflow raise instead of giving NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    app_name: str = "tripflow",
    master: str | None = None,
    settings: dict[str, str] | None = None,
    hadoop: dict[str, str] | None = None,
) -> SparkSession:
    """Start or reuse a session.

    ``master`` stays unset under spark-submit, so the submitter decides.
    ``hadoop`` entries reach the file-system layer as ``spark.hadoop.*``; this
    is how object-store credentials and implementations are supplied.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    for key, value in (hadoop or {}).items():
        builder = builder.config(f"spark.hadoop.{key}", value)
    return builder.getOrCreate()


def pin_runtime_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session somebody else built."""
    for name in ("session.timeZone", "ansi.enabled", "adaptive.enabled"):
        key = f"spark.sql.{name}"
        spark.conf.set(key, BASE_SETTINGS[key])
    return spark


# Input per shuffle partition.
SHUFFLE_BYTES = 128 * 1024 * 1024
# The driver keeps a size per map task and partition, so their number has a limit;
# past it partitions grow (3 GB each at 100 TB) and sorts spill, but nothing is lost.
# A cluster whose driver holds more passes a larger ``at_most``.
MAX_SHUFFLE_PARTITIONS = 32_768

_SHUFFLE = "spark.sql.shuffle.partitions"
_OWN, _SIZED = "tripflow.shuffle.own", "tripflow.shuffle.sized"


def shuffle_partitions(
    input_bytes: int, at_least: int, at_most: int = MAX_SHUFFLE_PARTITIONS
) -> int:
    """Partitions of 128 MB for an input, ``at_most`` of them."""
    wanted = -(-input_bytes // SHUFFLE_BYTES)
    return max(at_least, min(wanted, at_most))


def size_shuffles(
    spark: SparkSession, input_bytes: int, at_most: int = MAX_SHUFFLE_PARTITIONS
) -> None:
    """Start shuffles of the next query with enough partitions; AQE merges small ones.

    AQE cannot split the partitions of an aggregate or a window, so the
    starting number has to fit the data. It is never below the session's own
    setting, and goes back to that for a small input: the setting found is
    remembered, unless it is the one made here the time before. A query is
    planned when it runs, so the setting must still hold then.
    """
    now = spark.conf.get(_SHUFFLE)
    if now != spark.conf.get(_SIZED, None):
        spark.conf.set(_OWN, now)
    spark.conf.set(_SHUFFLE, shuffle_partitions(input_bytes, int(spark.conf.get(_OWN)), at_most))
    spark.conf.set(_SIZED, spark.conf.get(_SHUFFLE))


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tripflow-")


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a single-machine session may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_root()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_root(spark)}/tripflow/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_dir(spark: SparkSession, label: str) -> Iterator[str]:
    """A path in the shared folder for a table that is needed only inside the block."""
    path = fresh_dir(spark, label)
    try:
        yield path
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def fresh_name(label: str) -> str:
    """A catalog name that no other run uses."""
    return f"{label}_{uuid.uuid4().hex}"
