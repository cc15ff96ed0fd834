"""Joins of trips with small dimensions, and merges of aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def broadcast_if_small(
    dim: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Hint a broadcast only for a dimension measured to be small.

    The probe stops after ``max_rows`` + 1 rows and returns two numbers. A
    dimension past either bound comes back without a hint and is joined by
    shuffle, where AQE splits hot keys.
    """
    width = reduce(
        add,
        (F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in dim.columns),
    )
    rows, size = (
        dim.limit(max_rows + 1)
        .agg(F.count("*"), F.coalesce(F.sum(width.cast("long")), F.lit(0)))
        .first()
    )
    return F.broadcast(dim) if rows <= max_rows and size <= max_bytes else dim


def join_roles(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    roles: dict[str, str],
    columns: Sequence[str],
) -> DataFrame:
    """Inner join to the same dimension once per role.

    ``roles`` maps a role to the fact's foreign key. Dimension columns arrive
    as ``<role>_<column>``. Rows without a match in any role are dropped.
    """
    for role, foreign_key in roles.items():
        side = dim.select(
            F.col(key).alias(f"_{role}_key"),
            *(F.col(c).alias(f"{role}_{c}") for c in columns),
        )
        fact = fact.join(side, F.col(foreign_key) == F.col(f"_{role}_key")).drop(f"_{role}_key")
    return fact


def outer_merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with one copy of each key.

    NULL keys match nothing and both sides keep theirs. When the sides are
    aggregates over the same keys they are already partitioned by them and no
    further shuffle happens.
    """
    return left.join(right, on=list(keys), how="outer")


def keep_known(df: DataFrame, dim: DataFrame, on: Column) -> DataFrame:
    """Rows with a match in ``dim``, no dimension columns added.

    A semi join: a repeated dimension key cannot multiply rows.
    """
    return df.join(dim, on, "left_semi")


def without_parent(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Child key values that no parent row has, with their row counts.

    Keys are counted before the join, so a hot key is one row when it meets
    the parent. NULL keys refer to nothing and are not reported.
    """
    used = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(child_key)
        .agg(F.count("*").alias("row_count"))
    )
    known = parent.select(F.col(parent_key).alias("_parent_key"))
    return used.join(known, F.col(child_key) == F.col("_parent_key"), "left_anti")
