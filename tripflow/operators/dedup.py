"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """Keep the first row of each key; NULLs sort last.

    Without ``order`` all other columns decide, so the survivor never depends
    on partitioning: rows that still tie are identical. Because only rank 1
    is kept, Spark also applies the limit before the shuffle, so each task sends
    at most one row per key and a hot key does not pile up in one reducer.
    """
    order = [c for c in df.columns if c not in set(keys)] if order is None else order
    if not order:
        return df.dropDuplicates(list(keys))
    window = Window.partitionBy(*keys).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )
