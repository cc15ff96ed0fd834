"""Relational tables over JDBC. Rows flow executor to database, never through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_INSERT = 100_000


def postgres_url(host: str, port: int | str, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def write_options(
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    rows_per_insert: int = ROWS_PER_INSERT,
    connections: int = 8,
) -> dict[str, str]:
    return {
        **(properties or {}),
        "url": url,
        "dbtable": table,
        "batchsize": str(rows_per_insert),
        "numPartitions": str(connections),
    }


def create_empty(df: DataFrame, options: dict[str, str]) -> None:
    """Create or replace the table with the frame's columns and no rows."""
    df.limit(0).write.format("jdbc").options(**options).mode("overwrite").save()


def append(df: DataFrame, options: dict[str, str]) -> None:
    """Insert in batches, one transaction per partition.

    ``numPartitions`` bounds the open connections. A task that fails rolls its
    partition back before the retry. An executor lost between its commit and
    its report can repeat a partition; rerun the load from ``create_empty`` or
    give the target a key where that matters. No extra index column is stored.
    """
    df.write.format("jdbc").options(**options).mode("append").save()


def replace_and_load(df: DataFrame, options: dict[str, str]) -> None:
    """Replace the table, then append every row."""
    create_empty(df, options)
    append(df, options)


def read(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split_on: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    connections: int = 8,
) -> DataFrame:
    """Read a table, in parallel ranges of ``split_on`` when one is named."""
    options = {**(properties or {}), "url": url, "dbtable": table}
    if split_on is not None:
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(connections),
        }
    return spark.read.format("jdbc").options(**options).load()
