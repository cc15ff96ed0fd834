"""File readers and writers. The path scheme decides the file system."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyarrow.fs import FileSystem
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions import cast_columns
from tripflow.schemas import ZONE_SCHEMA


def read_parquet(
    spark: SparkSession, *paths: str, schema: T.StructType | None = None
) -> DataFrame:
    """One or many files, folders or globs in a single scan."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def month_paths(
    base: str, service: str, years: Iterable[int], months: Iterable[int] = range(1, 13)
) -> list[str]:
    """Monthly files of a service, named ``<service>_tripdata_<year>-<month>``."""
    months = list(months)
    return [
        f"{base.rstrip('/')}/{service}_tripdata_{year}-{month:02d}.parquet"
        for year in years
        for month in months
    ]


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Path and schema of each Parquet file, of which only the footer is read.

    The schema is NULL on a file system that Arrow does not know.
    """
    for batch in batches:
        schemas = []
        for path in batch.column(0).to_pylist():
            try:
                system, place = FileSystem.from_uri(path)
                with system.open_input_file(place) as file:
                    fields = pq.read_schema(file)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                schemas.append(None)
            else:
                schemas.append(";".join(sorted(f"{f.name.lower()} {f.type}" for f in fields)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(schemas, pa.string())], names=["path", "schema"]
        )


def schema_groups(
    spark: SparkSession, paths: Iterable[str]
) -> list[tuple[bool, list[str]]]:
    """Files under the paths, grouped by the schema in their footers.

    With each group comes whether its files may lack columns of one another.

    One job looks at all files: Spark lists them, and tasks read the footers
    of those they are dealt. What reaches the driver are names and schemas, as
    with any listing. Files that only Spark can open are left to its own merge
    of footers, see ``_mergeable_runs``.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = listed.option("recursiveFileLookup", True).load(list(paths)).select("path")
    found = files.mapInArrow(_footers, "path string, schema string").orderBy("path")
    groups: dict[str, list[str]] = {}
    unknown = []
    for row in found.toLocalIterator():
        if row.schema is None:
            unknown.append(row.path)
        else:
            groups.setdefault(row.schema, []).append(row.path)
    for schema, run in _mergeable_runs(spark, unknown):
        groups.setdefault(schema, []).extend(run)
    return [(schema.startswith("merged "), files) for schema, files in groups.items()]


def _mergeable_runs(spark: SparkSession, paths: list[str]) -> list[tuple[str, list[str]]]:
    """Files in the order of their names, cut where types change: a schema and its files.

    Spark merges the footers of many files in one distributed job, on any file
    system it knows, and refuses if a column has two types. Files it merges are
    a group, whatever columns some of them lack; others are halved. A type that
    changes k times along the names takes about k log n such jobs, not n.
    """
    if not paths:
        return []
    try:
        merged = spark.read.option("mergeSchema", True).parquet(*paths).schema
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error) or len(paths) == 1:
            raise
        half = len(paths) // 2
        return _mergeable_runs(spark, paths[:half]) + _mergeable_runs(spark, paths[half:])
    fields = sorted(f"{f.name.lower()} {f.dataType.simpleString()}" for f in merged)
    return [("merged " + ";".join(fields), paths)]


def read_drifting_parquet(
    spark: SparkSession,
    paths: Iterable[str],
    types: dict[str, T.DataType],
    strict: bool = True,
) -> DataFrame:
    """Files whose column types differ from one to the next, as one frame.

    Parquet cannot be read as bigint and double at once. Files are compared by
    their footers, also inside a folder or glob; those that agree share one
    scan, so the plan grows with the number of distinct schemas (a few), not
    with the number of files. Columns a file lacks are NULL, and so are those
    that no file has.
    """
    paths = list(paths)
    groups = schema_groups(spark, paths) if paths else []
    if not groups:
        raise ValueError("no files to read")

    def typed(found: tuple[bool, list[str]]) -> DataFrame:
        merge, group = found
        frame = spark.read.option("mergeSchema", merge).parquet(*group)
        present = {c.lower() for c in frame.columns}
        here = {n: t for n, t in types.items() if n.lower() in present}
        absent = {n: F.lit(None).cast(t) for n, t in types.items() if n not in here}
        return cast_columns(frame, here, strict).withColumns(absent).select(*types)

    return reduce(DataFrame.union, map(typed, groups))


def read_csv(spark: SparkSession, *paths: str, schema: T.StructType | None = None) -> DataFrame:
    """Headed CSV. Without a schema every column is a string; nothing is inferred."""
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(list(paths))


def load_seed(
    spark: SparkSession, path: str, table: str, schema: T.StructType = ZONE_SCHEMA
) -> DataFrame:
    """Small CSV dimension as a managed table, replaced on every load."""
    read_csv(spark, path, schema=schema).write.mode("overwrite").saveAsTable(table)
    return spark.table(table)


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of all files under the paths, from their listing alone."""
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    )
    return listing.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    files: int | None = None,
    partition_by: Iterable[str] = (),
) -> None:
    """Write Parquet; by default an existing target is an error.

    ``files`` fixes the number of output files through a full shuffle. Leave it
    unset at scale and let the upstream partitioning and AQE decide.
    """
    out = df if files is None else df.repartition(files)
    out.write.mode(mode).partitionBy(*partition_by).parquet(path)


class SourceRegistry:
    """Named source relations: (schema, table) -> DataFrame."""

    def __init__(self) -> None:
        self._loaders: dict[tuple[str, str], Callable[[], DataFrame]] = {}

    def register(self, schema: str, table: str, loader: Callable[[], DataFrame]) -> None:
        self._loaders[schema, table] = loader

    def source(self, schema: str, table: str) -> DataFrame:
        if (schema, table) not in self._loaders:
            raise KeyError(f"unknown source {schema}.{table}")
        return self._loaders[schema, table]()
