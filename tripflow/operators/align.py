"""Bringing differently shaped frames to one shape, and stacking them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.lower() for c in df.columns))


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Old name -> new name; names that are absent are ignored."""
    return df.withColumnsRenamed(names)


def tag(df: DataFrame, **constants) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def common_columns(*frames: DataFrame) -> list[str]:
    """Columns present in every frame, in the order of the first.

    Names are compared as Spark resolves them, without case.
    """
    others = [{c.lower() for c in f.columns} for f in frames[1:]]
    return [c for c in frames[0].columns if all(c.lower() in names for names in others)]


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name. Duplicates stay; column order cannot swap values."""
    return reduce(DataFrame.unionByName, frames)


def aligned_union(tagged: dict[str, DataFrame], tag_column: str = "service_type") -> DataFrame:
    """Stack frames on their common columns, each row tagged with its frame's key.

    The tag is a literal per branch, so a later filter on it removes whole
    branches before they are scanned.
    """
    columns = common_columns(*tagged.values())
    return union_all(
        *(tag(df.select(*columns), **{tag_column: key}) for key, df in tagged.items())
    )
