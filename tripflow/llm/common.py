"""Shared steps: stored intermediate tables, row ids, distributed numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.session import fresh_dir, pin_runtime_settings, size_shuffles

# Whitespace of the text contracts: space and the controls from tab to return.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

BATCH_BYTES = 8 << 20
_PLACE_BITS = 33  # monotonically_increasing_id keeps the partition above these


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized_for(df: DataFrame) -> DataFrame:
    """Size the shuffles that follow by the files of a stored table, and return it.

    The sizes come with the listing: no column is read. Batches that go to
    Python are bounded by bytes, as ten thousand long texts are too many.
    """
    spark = df.sparkSession
    pin_runtime_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    found = df.metadataColumn("_metadata")
    files = df.select(found["file_path"].alias("path"), found["file_size"].alias("size")).distinct()
    size_shuffles(spark, files.agg(F.sum("size")).first()[0] or 0)
    return df


def with_row(df: DataFrame, name: str = "row") -> DataFrame:
    """Add an id per row, also where the table's own id is null or repeated.

    The id is the number of a row's file, files in the order of their paths, and
    the row's place in that file. It is the same in every scan, however Spark
    cuts files into tasks. ``df`` must read one stored table, filtered or
    projected at most; any other is an error.
    """
    file, place, number = f"{name}_file", f"{name}_place", f"{name}_number"
    found = df.metadataColumn("_metadata")
    # One row per file: no more than the listing of the table.
    files = df.select(found["file_path"].alias(file)).distinct()
    numbers = F.row_number().over(W.orderBy(file)).cast("long") - 1
    files = stored(files.withColumn(number, numbers), "files")
    placed = df.withColumns({file: found["file_path"], place: found["row_index"]})
    row = F.shiftleft(number, _PLACE_BITS) + F.col(place)
    return placed.join(F.broadcast(files), file).withColumn(name, row).drop(file, place, number)


def _by_range(df: DataFrame, order: list[str], label: str) -> DataFrame:
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    return stored(placed, label).withColumn("_part", F.shiftright("_place", _PLACE_BITS))


def _with_offsets(rows: DataFrame, total: Column) -> DataFrame:
    """Add what all earlier partitions hold. One row per partition is broadcast."""
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part")
        .agg(total.alias("_total"))
        .select("_part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    )
    return rows.join(F.broadcast(offsets), "_part")


def global_index(df: DataFrame, order: list[str], name: str, label: str = "index") -> DataFrame:
    """Number rows 0, 1, 2, ... in a total order, without a window in one task.

    Rows are range-partitioned, sorted and stored; a row's number is its place
    plus the count of all earlier partitions.
    """
    rows = _with_offsets(_by_range(df, order, label), F.count(F.lit(1)))
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return rows.select(*df.columns, (F.col("_offset") + place).alias(name))


def running_total(
    df: DataFrame, order: list[str], value: str, name: str, label: str = "running"
) -> DataFrame:
    """Sum of ``value`` over all rows that come earlier in a total order."""
    rows = _with_offsets(_by_range(df, order, label), F.sum(value))
    inside = W.partitionBy("_part").orderBy("_place").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0))
    return rows.select(*df.columns, start.alias(name))
