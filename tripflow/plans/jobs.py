"""Complete jobs: what a user submits. Each reads, composes operators and writes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators import regression
from tripflow.operators.aggregates import revenue_by_month_of_parts, revenue_parts_by_day
from tripflow.operators.align import aligned_union, lower_names, rename, union_all
from tripflow.operators.quality import QualityError, enforce, quality_report
from tripflow.operators.scoring import score_messages
from tripflow.plans import marts
from tripflow.plans.checks import mart_checks, service_checks
from tripflow.plans.descriptions import (
    MONTHLY_COLUMNS,
    TABLES,
    TRIP_COLUMNS,
    ZONE_COLUMNS,
    described,
)
from tripflow.plans.staging import stage_services
from tripflow.plans.tip_model import TIP_SPEC, tip_features
from tripflow.schemas import (
    GREEN,
    MESSAGE_SCHEMA,
    TRIP_TYPES,
    YELLOW,
    ZONE_SCHEMA,
    ServiceLayout,
)
from tripflow.session import fresh_dir, fresh_name, scratch_dir
from tripflow.sources import files, publish, relational, tables
from tripflow.streaming import messages


def service_union(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both services on their common columns, tagged with the service."""

    def times(df: DataFrame, layout: ServiceLayout) -> DataFrame:
        return rename(
            lower_names(df), {layout.pickup: "pickup_datetime", layout.dropoff: "dropoff_datetime"}
        )

    return aligned_union(
        {GREEN.service: times(green, GREEN), YELLOW.service: times(yellow, YELLOW)}
    )


def ingest(spark: SparkSession, paths: list[str], options: dict[str, str]) -> None:
    """Parquet trips into a relational table: replace it, then append in batches."""
    relational.replace_and_load(files.read_parquet(spark, *paths), options)


def load_dated(
    spark: SparkSession,
    source: str,
    table: str,
    ts: str,
    cluster_by: tuple[str, ...] = (),
    path: str | None = None,
    grain: str = "day",
) -> tables.DatedTable:
    """Lake files to a date-partitioned table by way of an external table.

    The external table is dropped at the end, also when the load fails; its
    files stay.
    """
    external = f"{table}_external"
    frame = tables.create_external(spark, external, source)
    try:
        return tables.create_dated_table(frame, table, ts, cluster_by, path, grain=grain)
    finally:
        tables.drop_table(spark, external)


def reload_dates(spark: SparkSession, source: str, table: tables.DatedTable) -> list:
    """Lake files of some dates into a dated table, in place of what it has of them."""
    external = fresh_name("reload_external")
    frame = tables.create_external(spark, external, source)
    try:
        return table.replace_dates(frame)
    finally:
        tables.drop_table(spark, external)


def union_services(
    spark: SparkSession,
    input_green: list[str],
    input_yellow: list[str],
    output: str,
    files_out: int | None = None,
    mode: str = "errorifexists",
) -> DataFrame:
    """Stored union of both services, one folder per service.

    The folder per service lets a later filter on it skip the other one.
    """
    union = service_union(
        files.read_parquet(spark, *input_green), files.read_parquet(spark, *input_yellow)
    )
    files.write_parquet(union, output, mode, files_out, partition_by=["service_type"])
    return spark.read.parquet(output)


def monthly_report(
    spark: SparkSession,
    input_green: list[str],
    input_yellow: list[str],
    output: str,
    mode: str = "errorifexists",
) -> DataFrame:
    """Monthly revenue by zone id over both services, written to ``output``."""
    trips = service_union(
        files.read_parquet(spark, *input_green), files.read_parquet(spark, *input_yellow)
    )
    report = marts.monthly_revenue_by_zone_id(trips)
    files.write_parquet(report, output, mode)
    return spark.read.parquet(output)


def hourly_merge(
    trips: DataFrame, zones: DataFrame, output: str, mode: str = "overwrite"
) -> DataFrame:
    """Hourly revenue of each service, their merge, and the merge in known zones.

    Each step is stored, the last one too, and the next starts from the stored copy.
    """
    spark, sides = trips.sparkSession, {}
    for service in (GREEN.service, YELLOW.service):
        path = f"{output}/hourly_{service.lower()}"
        files.write_parquet(marts.hourly_revenue(trips, service), path, mode)
        sides[service] = spark.read.parquet(path)
    merged = marts.merge_hourly(sides[GREEN.service], sides[YELLOW.service])
    files.write_parquet(merged, f"{output}/merged", mode)
    known = marts.in_known_zones(spark.read.parquet(f"{output}/merged"), zones)
    files.write_parquet(known, f"{output}/in_known_zones", mode)
    return spark.read.parquet(f"{output}/in_known_zones")


def zone_distances(
    trips: DataFrame,
    zones: DataFrame,
    output: str,
    files_out: int | None = None,
    mode: str = "errorifexists",
) -> DataFrame:
    """Trip distances with zone names, written to ``output``."""
    files.write_parquet(marts.trip_zone_names(trips, zones), output, mode, files_out)
    return trips.sparkSession.read.parquet(output)


@dataclass(frozen=True)
class Marts:
    zones: DataFrame
    fact: DataFrame
    monthly: DataFrame
    report: DataFrame


def _audited(report: DataFrame, path: str) -> DataFrame:
    """The stored report; an error in it names where the rejected tables lie."""
    # A row per check, stored once: to judge it and to show it are two reads.
    files.write_parquet(report, f"{path}/quality_report", files=1)
    try:
        return enforce(report.sparkSession.read.parquet(f"{path}/quality_report"))
    except QualityError as error:
        raise QualityError(f"{error}; nothing was published, see {path}") from error


def build_marts(
    staged: DataFrame,
    lookup: DataFrame,
    output: str,
    mode: str = "overwrite",
    tables_prefix: str | None = None,
    run: str | None = None,
) -> Marts:
    """Staged trips to stored zones, fact and monthly mart: written, checked, published.

    All three are written to a folder of this run and checked there. An error
    in a check raises and leaves what was published before as it is; warnings
    are reported. Only then do the new tables take the place of the old ones:
    as folders of ``output``, or with a prefix as tables of the catalog under
    that prefix, with the texts that describe them and their columns. The fact
    is stored because both the mart and its readers use it, staging because the
    fact and every check read it; the latter goes with the run.
    """
    spark, run = lookup.sparkSession, run or publish.new_run()
    folder, output = publish.run_folder(output, run), output.rstrip("/")
    names = ("dim_zones", "fact_trips", "monthly_zone_revenue")
    if mode == "errorifexists":
        there = [n for n in names if publish.folder_exists(spark, f"{output}/{n}")]
        if tables_prefix is not None:
            there = [n for n in names if spark.catalog.tableExists(f"{tables_prefix}{n}")]
        if there:
            raise FileExistsError(f"already published: {there}")

    def store(
        df: DataFrame, name: str, comments: dict[str, str], partition_by: tuple[str, ...] = ()
    ) -> DataFrame:
        path, df = f"{folder}/{name}", described(df, comments)
        if tables_prefix is None:
            files.write_parquet(df, path, partition_by=partition_by)
        else:
            table = f"{tables_prefix}{name}__{run}"
            df.write.partitionBy(*partition_by).option("path", path).saveAsTable(table)
            tables.comment_on(spark, table, TABLES[name])
        return spark.read.schema(df.schema).parquet(path)

    zones = store(marts.dim_zones(lookup), "dim_zones", ZONE_COLUMNS)
    files.write_parquet(staged, f"{folder}/staged")
    staged = spark.read.schema(staged.schema).parquet(f"{folder}/staged")
    fact = store(
        marts.fact_trips(staged, zones), "fact_trips", TRIP_COLUMNS, ("service_type",)
    )
    monthly = store(marts.monthly_zone_revenue(fact), "monthly_zone_revenue", MONTHLY_COLUMNS)
    try:
        report = _audited(
            quality_report(staged, service_checks(zones)).unionByName(
                quality_report(monthly, mart_checks())
            ),
            folder,
        )
    except QualityError:
        if tables_prefix is not None:
            for name in names:
                tables.drop_table(spark, f"{tables_prefix}{name}__{run}")
        raise
    if tables_prefix is not None:
        for name in names:
            publish.publish_table(spark, f"{tables_prefix}{name}__{run}", f"{tables_prefix}{name}")
        publish.remove_folder(spark, f"{folder}/staged")
        return Marts(zones, fact, monthly, report)
    stored = {}
    for name, df in zip((*names, "quality_report"), (zones, fact, monthly, report), strict=True):
        publish.replace_folder(spark, f"{folder}/{name}", f"{output}/{name}")
        stored[name] = spark.read.schema(df.schema).parquet(f"{output}/{name}")
    publish.remove_folder(spark, folder)
    return Marts(*stored.values())


def build_marts_from_files(
    spark: SparkSession,
    input_green: list[str],
    input_yellow: list[str],
    zone_csv: str,
    output: str,
    mode: str = "overwrite",
    tables_prefix: str | None = None,
) -> Marts:
    """The same from raw files, named as the sources of the staging models."""
    sources = files.SourceRegistry()
    sources.register("staging", "green", lambda: files.read_parquet(spark, *input_green))
    sources.register("staging", "yellow", lambda: files.read_parquet(spark, *input_yellow))
    staged = stage_services(
        sources.source("staging", "green"), sources.source("staging", "yellow")
    )
    lookup = files.read_csv(spark, zone_csv, schema=ZONE_SCHEMA)
    return build_marts(staged, lookup, output, mode, tables_prefix)


def create_daily_marts(fact: DataFrame, table: str, path: str | None = None) -> tables.DatedTable:
    """Daily parts of the monthly mart as a dated table, see ``update_daily_marts``."""
    parts = revenue_parts_by_day(fact, "pickup_zone")
    return tables.create_dated_table(parts, table, "revenue_day", path=path, grain="month")


def update_daily_marts(fact: DataFrame, table: tables.DatedTable) -> None:
    """Recompute the days that ``fact`` holds whole, and only their months' files.

    Other days of a touched month are taken from the table as they are; the
    months come from the batch, and folders of others are neither read nor
    written.
    """
    spark = fact.sparkSession
    with scratch_dir(spark, "daily-parts") as fresh, scratch_dir(spark, "months") as merged:
        revenue_parts_by_day(fact, "pickup_zone").write.parquet(fresh)
        new = spark.read.parquet(fresh)
        days = new.select("revenue_day").distinct()
        months = [r[0] for r in days.select(F.trunc("revenue_day", "month")).distinct().collect()]
        touched = F.col(table.date).isin([m for m in months if m is not None])
        if None in months:
            touched |= F.col(table.date).isNull()
        old = spark.table(table.name).filter(touched).drop(table.date)
        same = old.revenue_day.eqNullSafe(days.revenue_day)
        kept = old.join(F.broadcast(days), same, "left_anti")
        # The table cannot be read while its files are replaced.
        kept.unionByName(new).write.parquet(merged)
        table.replace_dates(spark.read.parquet(merged))


def monthly_mart_of_days(table: tables.DatedTable, spark: SparkSession) -> DataFrame:
    """The monthly mart, merged from its daily parts."""
    return revenue_by_month_of_parts(table.read(spark), TRIP_TYPES)


@dataclass(frozen=True)
class TipModelRun:
    model: regression.TrainedModel
    train: DataFrame
    held_out: DataFrame

    @property
    def features(self) -> DataFrame:
        return union_all(self.train, self.held_out)


def stored_tip_features(
    trips: DataFrame, split_on: dict[str, T.DataType]
) -> tuple[DataFrame, DataFrame]:
    """Training and held-out features, stored.

    Fitting and scoring pass over the rows several times; the stored table saves
    recomputing the features and survives a lost executor.
    """
    path = fresh_dir(trips.sparkSession, "tip-features")
    return regression.store_split(tip_features(trips, keep=split_on), path, *split_on)


def tip_model(
    trips: DataFrame, split_on: dict[str, T.DataType], spec: regression.Spec = TIP_SPEC
) -> TipModelRun:
    """Store the feature table, split it by the row key and train."""
    train, held_out = stored_tip_features(trips, split_on)
    return TipModelRun(regression.train(train, spec), train, held_out)


def explained_tips(run: TipModelRun, output: str, mode: str = "overwrite") -> None:
    """What a user reads beside the model: feature info, predictions, reasons, trials."""
    reports = {
        "feature_info": regression.feature_info(run.train, run.model.spec),
        "predictions": run.model.predict(run.held_out),
        "explained": run.model.explain(run.held_out),
        "trials": regression.tune(run.train, run.held_out, run.model.spec)[1],
    }
    for name, report in reports.items():
        files.write_parquet(report, f"{output}/{name}", mode)


def score_messages_stream(
    source: DataFrame,
    model: regression.TrainedModel,
    schema: T.StructType,
    output: str,
    checkpoint: str,
    once: bool = True,
):
    """Score a stream of JSON feature rows with a stored model; malformed ones apart.

    Every message leaves one row, scored or with its text in ``malformed``, in
    a sink that commits per batch: a restart neither loses nor repeats one. The
    weights of the categories are a static table that each batch meets by a join.
    """
    scored = score_messages(source, model, schema)
    return messages.store_messages(scored, output, checkpoint, once)


def produce(rows: DataFrame, output: str, mode: str = "append") -> None:
    """Each row as one JSON message in text files, which ``read_text_files`` streams."""
    messages.encode_messages(rows).write.mode(mode).text(output)


def consume(
    source: DataFrame,
    output: str,
    checkpoint: str,
    schema: T.StructType = MESSAGE_SCHEMA,
    action: Callable[[DataFrame, int], None] | None = None,
    once: bool = True,
):
    """Decode a stream of JSON messages; store it, or hand each batch to ``action``."""
    decoded = messages.decode_messages(source, schema)
    if action is not None:
        return messages.for_each_batch(decoded, action, checkpoint, once)
    return messages.store_messages(decoded, output, checkpoint, once)
