"""Places of rows within groups, in a given order, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROWS_PER_TASK = 250_000

_PLACE_BITS = 33  # monotonically_increasing_id keeps the partition above these


def number_within(
    df: DataFrame,
    group: str,
    order: Sequence[Column],
    name: str,
    scratch: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the place of each row in its group: 0, 1, 2, ... by ``order``, which must be total.

    The same as a window by ``group``, which sorts a whole group in one task.
    Here rows are cut into ranges of group and order, sorted and stored; a
    row's place is that inside its range plus what earlier ranges hold of its
    group. Those counts, one for each group of a range, are no more than ranges
    and groups together. ``df`` is read twice, so it should be a stored table;
    the sorted ranges are stored under ``scratch``, which the result reads.
    """
    spark, keys = df.sparkSession, [F.col(group), *order]
    ranges = max(1, -(-df.count() // rows_per_task))
    placed = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    placed.withColumn("_place", F.monotonically_increasing_id()).write.parquet(scratch)
    stored = spark.read.parquet(scratch).withColumn("_range", F.shiftright("_place", _PLACE_BITS))
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_range", group)
        .agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select("_range", F.col(group).alias("_group"), "_first", "_before")
    )
    same = (F.col(group).eqNullSafe(F.col("_group"))) & (stored["_range"] == offsets["_range"])
    place = F.col("_place") - F.col("_first") + F.col("_before")
    return stored.join(offsets, same).select(*df.columns, place.alias(name))
