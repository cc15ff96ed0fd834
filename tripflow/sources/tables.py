"""Catalog tables: external, plain, typed, and partitioned by date."""

from __future__ import annotations

import datetime as dt
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions import cast_columns
from tripflow.sources.publish import folder_exists

# Row counts lie in the table's folder, under a name that readers of tables skip.
_COUNTS = "_partition_rows"
_COUNTS_SCHEMA = "partition_id date, total_rows long, written long"


def create_external(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Table over files that stay where they are."""
    return spark.catalog.createTable(name, path=path, source=fmt, schema=schema, **options)


def create_external_view(
    spark: SparkSession,
    name: str,
    paths: list[str],
    fmt: str = "csv",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Several path globs under one name; a catalog table holds only one path."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return register_view(reader.load(paths), name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """Remove the catalog entry; the files of an external table survive."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def create_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    types: dict[str, T.DataType] | None = None,
) -> DataFrame:
    """Create or replace a table, optionally with declared column types."""
    out = df if types is None else cast_columns(df, types)
    writer = out.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def describe(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column descriptions; saved tables keep them as column comments."""
    for name, text in comments.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "comment": text})
    return df


def comment_on(spark: SparkSession, table: str, text: str) -> None:
    quoted = text.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{quoted}'")


def descriptions(spark: SparkSession, table: str) -> DataFrame:
    """Texts of a table and its columns: column_name (empty for the table), comment."""
    rows = [("", spark.catalog.getTable(table).description)]
    rows += [(c.name, c.description) for c in spark.catalog.listColumns(table)]
    return spark.createDataFrame(rows, "column_name string, comment string")


def in_date_range(ts: str, start: dt.date, end: dt.date) -> Column:
    """Both ends included.

    Written as a half-open range on the bare column: a date function around it
    would keep the filter from reaching the Parquet scan.
    """
    return (F.col(ts) >= midnight(start)) & (F.col(ts) < midnight(end + dt.timedelta(days=1)))


def midnight(day: dt.date) -> Column:
    return F.lit(f"{day.isoformat()} 00:00:00").cast(T.TimestampNTZType())


def partition_start(grain: str, day: dt.date) -> dt.date:
    return day if grain == "day" else day.replace(day=1)


@dataclass(frozen=True)
class DatedTable:
    """A table partitioned by the date, or first of the month, of a timestamp."""

    name: str
    ts: str
    date: str = "partition_date"
    grain: str = "day"
    cluster_by: tuple[str, ...] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).drop(self.date)

    def between(self, spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
        """Rows of a date range, both ends included.

        Spark does not derive the partition from the timestamp, so the range is
        stated on both: the first prunes folders, the second row groups.
        """
        low, high = partition_start(self.grain, start), partition_start(self.grain, end)
        return (
            spark.table(self.name)
            .filter(F.col(self.date).between(F.lit(low), F.lit(high)))
            .filter(in_date_range(self.ts, start, end))
            .drop(self.date)
        )

    def partition_counts(self, spark: SparkSession) -> DataFrame:
        """Rows per partition: table_name, partition_id, total_rows.

        Every write leaves the counts of the partitions it made beside the
        table, and the latest of each counts: no data file is opened, however
        many there are. A table that others wrote is counted from its footers.
        """
        log = f"{location(spark, self.name)}/{_COUNTS}"
        if folder_exists(spark, log):
            latest = F.max_by("total_rows", "written")
            counts = spark.read.schema(_COUNTS_SCHEMA).parquet(log)
            counts = counts.groupBy("partition_id").agg(latest.alias("total_rows"))
        else:
            counts = self._counted(spark.table(self.name))
        return counts.select(F.lit(self.name).alias("table_name"), "partition_id", "total_rows")

    def _counted(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.col(self.date).alias("partition_id")).agg(
            F.count("*").alias("total_rows")
        )

    def _record(self, spark: SparkSession, dates: list[dt.date | None] | None = None) -> None:
        """Note the rows of the partitions just written; only their footers are read."""
        rows = spark.table(self.name)
        if dates is not None:
            named = F.col(self.date).isin([d for d in dates if d is not None])
            rows = rows.filter(named | F.col(self.date).isNull() if None in dates else named)
        noted = self._counted(rows).withColumn("written", F.lit(time.time_ns()))
        log = f"{location(spark, self.name)}/{_COUNTS}"
        noted.coalesce(1).write.mode("append").parquet(log)

    def _dated(self, df: DataFrame) -> DataFrame:
        day = F.to_date(self.ts)
        return df.withColumn(self.date, day if self.grain == "day" else F.trunc(day, "month"))

    def replace_dates(self, df: DataFrame) -> list[dt.date | None]:
        """Load the dates that ``df`` holds, each in place of what the table has of it.

        A batch holds whole dates (months with ``grain="month"``); other dates
        stay as they are, so a load may be repeated, and batches may overlap.
        Returns the dates. ``df`` is read twice, once for its timestamps alone,
        so it should be a stored or external table.
        """
        spark = df.sparkSession
        # Columns go by place into a table: its own order, the date last.
        rows = self._dated(df).select(*spark.table(self.name).columns)
        touched = [r[0] for r in rows.select(self.date).distinct().collect()]
        if not touched:
            return []
        key = "spark.sql.sources.partitionOverwriteMode"
        before = spark.conf.get(key)
        spark.conf.set(key, "dynamic")
        try:
            rows = _laid_out(rows, self.date, self.cluster_by, self.ts)
            rows.write.mode("overwrite").insertInto(self.name)
        finally:
            spark.conf.set(key, before)
        self._record(spark, touched)
        return touched


def location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.filter("col_name = 'Location'").first().data_type.rstrip("/")


def _laid_out(df: DataFrame, date: str, cluster_by: tuple[str, ...], ts: str) -> DataFrame:
    """Rows in the files they are to be written to.

    Without cluster columns the rebalance hint groups a date's rows to keep the
    file count low, and lets AQE split a date that is too big for one task.
    With them rows are cut into ranges of date and cluster columns, so that the
    files of one date hold ranges of their own and readers skip whole files;
    the timestamp comes last, so that one busy date and key can be cut, too.
    Sorting inside a task gives the row groups of a file narrow ranges.
    """
    if cluster_by:
        return df.repartitionByRange(date, *cluster_by, ts).sortWithinPartitions(date, *cluster_by)
    return df.hint("rebalance", date).sortWithinPartitions(date)


def create_dated_table(
    df: DataFrame,
    name: str,
    ts: str,
    cluster_by: tuple[str, ...] = (),
    path: str | None = None,
    date: str = "partition_date",
    grain: str = "day",
    **options: str,
) -> DatedTable:
    """Write a table partitioned by date, optionally in ranges of the cluster columns.

    ``grain="month"`` suits tables whose days would be tiny files. Further
    options go to the file writer, e.g. page or row-group sizes.
    """
    if grain not in ("day", "month"):
        raise ValueError(f"unknown grain {grain!r}")
    table = DatedTable(name, ts, date, grain, cluster_by)
    rows = _laid_out(table._dated(df), date, cluster_by, ts)
    writer = rows.write.mode("overwrite").options(**options).partitionBy(date)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    table._record(df.sparkSession)
    return table
