"""One entry per operator: (spark, folder of the supplied tables) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions import hours, surrogate_key
from tripflow.operators import quality, regression
from tripflow.operators.aggregates import exact_sum, group_count, group_mean, total_money
from tripflow.operators.align import union_all
from tripflow.operators.dedup import keep_first
from tripflow.operators.joins import without_parent
from tripflow.operators.scoring import score_batches, score_json
from tripflow.plans import jobs, marts, tip_model
from tripflow.plans.checks import service_checks
from tripflow.plans.staging import stage, stage_green, stage_yellow
from tripflow.plans.tip_model import TIP_INPUT_SCHEMA, TIP_SPEC
from tripflow.schemas import REVENUE_MEASURES, TRIP_TYPES, ZONE_SCHEMA
from tripflow.session import fresh_dir, fresh_name, pin_runtime_settings, size_shuffles
from tripflow.sources import files, supplied, tables
from tripflow.streaming import messages

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the range queries: one month, and nineteen months.
MONTH = (dt.date(1998, 6, 1), dt.date(1998, 6, 30))
NINETEEN_MONTHS = (dt.date(1998, 6, 1), dt.date(1999, 12, 31))
VENDOR = 1
SINCE = "2024-01-05 00:00:00"
PREVIEW_ROWS = 100
DRIFT_FROM = "1998-06-01 00:00:00"
# Trips of one day are loaded anew, those of later months added.
REPLACED, ADDED_FROM = ("1997-03-05 00:00:00", "1997-03-06 00:00:00"), "1998-06-01 00:00:00"
# Two batches of events share what lies between.
RELOADED = ("2024-01-08 00:00:00", "2024-01-20 00:00:00")

ROW_KEY = {"vendorid": T.LongType(), "pickup_datetime": T.TimestampNTZType()}
FARE_SPEC = regression.Spec("tip_amount", ("fare_amount",))
PAYMENT_SPEC = regression.Spec("tip_amount", ("fare_amount",), ("payment_type",))
PROPS_SCHEMA = T.StructType([T.StructField("k", T.LongType())])


def plain(df: DataFrame) -> DataFrame:
    """Types both engines hand over alike: decimals as doubles, dates as text."""
    columns = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        columns.append(column.alias(f.name))
    return df.select(*columns)


def _time(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _staged(spark: SparkSession, d: str) -> DataFrame:
    return stage(supplied.all_trips(spark, d))


def _fact(spark: SparkSession, d: str) -> DataFrame:
    return marts.fact_trips(_staged(spark, d), marts.dim_zones(supplied.zone_lookup(spark, d)))


def _stored(df: DataFrame, label: str, **options) -> DataFrame:
    path = fresh_dir(df.sparkSession, label)
    files.write_parquet(df, path, **options)
    return df.sparkSession.read.parquet(path)


# Staging, dimension, fact, marts


def staging_green(spark, d):
    return stage_green(supplied.raw_green(spark, d))


def staging_yellow(spark, d):
    return stage_yellow(supplied.raw_yellow(spark, d))


def trip_keys(spark, d):
    """Surrogate keys alone, per row of the raw trips."""
    trips = supplied.all_trips(spark, d)
    return trips.select(
        "vendorid", "pickup_datetime", surrogate_key("vendorid", "pickup_datetime").alias("tripid")
    )


def first_trip_per_vendor_day(spark, d):
    """De-duplication by an order the caller names."""
    trips = supplied.table(spark, d, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"
    )
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey"]
    return keep_first(trips, ["l_suppkey", "l_shipdate"], order)


def dim_zones(spark, d):
    return marts.dim_zones(supplied.zone_lookup(spark, d))


def fact_trips(spark, d):
    return _fact(spark, d)


def fact_trip_coverage(spark, d):
    """Trips per service before and after the zone joins."""
    return marts.zone_coverage(_staged(spark, d), supplied.zone_lookup(spark, d))


def monthly_zone_revenue(spark, d):
    return marts.monthly_zone_revenue(_fact(spark, d))


def monthly_mart_from_days(spark, d):
    """The monthly mart of daily parts: days loaded, one replaced, the later ones added."""
    root = fresh_dir(spark, "daily")
    fact = _stored(_fact(spark, d), "fact")
    pickup, added = F.col("pickup_datetime"), _time(ADDED_FROM)
    one = (pickup >= _time(REPLACED[0])) & (pickup < _time(REPLACED[1]))
    # The day to be replaced first comes with every amount doubled.
    amounts = {m: F.when(one, F.col(m) * 2).otherwise(F.col(m)).cast(TRIP_TYPES[m]) for m in REVENUE_MEASURES}
    early = fact.filter((pickup < added) | pickup.isNull()).withColumns(amounts)
    days = jobs.create_daily_marts(early, fresh_name("daily"), f"{root}/daily")
    jobs.update_daily_marts(fact.filter(one), days)
    jobs.update_daily_marts(fact.filter(pickup >= added), days)
    return jobs.monthly_mart_of_days(days, spark)


def monthly_revenue_by_zone_id(spark, d):
    return marts.monthly_revenue_by_zone_id(supplied.all_trips(spark, d))


# Alignment, grouped reports, hourly merge


def aligned_union(spark, d):
    return jobs.service_union(supplied.raw_green(spark, d), supplied.raw_yellow(spark, d))


def service_counts(spark, d):
    union = jobs.service_union(supplied.raw_green(spark, d), supplied.raw_yellow(spark, d))
    return group_count(union, "service_type")


def avg_distance_by_service(spark, d):
    return group_mean(supplied.all_trips(spark, d), "trip_distance", "service_type")


def hourly_revenue_green(spark, d):
    return marts.hourly_revenue(supplied.event_trips(spark, d), "Green", SINCE)


def hourly_outer_merge(spark, d):
    trips = supplied.event_trips(spark, d)
    return marts.merge_hourly(
        marts.hourly_revenue(trips, "Green"), marts.hourly_revenue(trips, "Yellow")
    )


def hourly_service_columns(spark, d):
    """The same merge in one pass; shares its oracle with the join."""
    return marts.hourly_by_service(supplied.event_trips(spark, d))


def hourly_green_yellow_merge(spark, d):
    merged = marts.hourly_by_service(supplied.event_trips(spark, d))
    return marts.in_known_zones(merged, supplied.zone_lookup(spark, d))


def hourly_merge_job(spark, d):
    """The stored form of the hourly merge: every step written and read back."""
    return jobs.hourly_merge(
        supplied.event_trips(spark, d),
        supplied.zone_lookup(spark, d),
        fresh_dir(spark, "hourly"),
    )


def trip_zone_names(spark, d):
    return marts.trip_zone_names(supplied.all_trips(spark, d), supplied.zone_lookup(spark, d))


# Predicates and scalar functions


def long_paid_trips(spark, d):
    """Equality, inequality, lower bound, NOT NULL and their conjunction."""
    return (
        supplied.all_trips(spark, d)
        .filter(
            (F.col("store_and_fwd_flag") == "N")
            & (F.col("payment_type") != 0)
            & (F.col("pickup_datetime") >= F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
            & F.col("vendorid").isNotNull()
        )
        .select("vendorid", "pickup_datetime", "payment_type", "trip_distance")
    )


def trip_date_and_hours(spark, d):
    return supplied.table(spark, d, "events").select(
        "event_id", F.to_date("ts").alias("pickup_date"), hours("value").alias("trip_time_hr")
    )


def ordered_preview(spark, d):
    keys = ["o_orderdate", "o_orderkey"]
    return supplied.table(spark, d, "orders").select(*keys).orderBy(*keys).limit(PREVIEW_ROWS)


# Tables: external, dated, clustered, seed


def _by_month(spark, d, cluster_by=()) -> tables.DatedTable:
    trips = supplied.table(spark, d, "lineitem").selectExpr(
        "l_suppkey AS vendorid", "l_shipdate AS pickup_datetime", "l_quantity AS trip_distance"
    )
    return tables.create_dated_table(
        trips,
        fresh_name("trips_dated"),
        "pickup_datetime",
        cluster_by,
        fresh_dir(spark, "trips-dated"),
        grain="month",
    )


def _events_by_day(spark, d) -> tables.DatedTable:
    """External table over files, dated table from it, external table dropped."""
    return jobs.load_dated(
        spark,
        f"{d.rstrip('/')}/events.parquet",
        fresh_name("events_dated"),
        "ts",
        ("user_id",),
        fresh_dir(spark, "events-dated"),
    )


def distinct_vendors_in_range(spark, d):
    rows = _by_month(spark, d).between(spark, *MONTH)
    return rows.select("vendorid").distinct()


def vendor_trip_count_in_range(spark, d):
    rows = _by_month(spark, d, ("vendorid",)).between(spark, *NINETEEN_MONTHS)
    return rows.filter(F.col("vendorid") == VENDOR).agg(F.count("*").alias("trips"))


def partition_row_counts(spark, d):
    counts = _events_by_day(spark, d).partition_counts(spark)
    # Tables of a run have names of their own; what is before the last part is ours.
    named = F.regexp_replace("table_name", "_[0-9a-f]+$", "")
    return counts.withColumn("table_name", named).orderBy(F.desc("total_rows"), "partition_id")


def reloaded_dates(spark, d):
    """All events in two batches that share dates, both loaded twice: each date once."""
    events, root = supplied.table(spark, d, "events"), fresh_dir(spark, "batches")
    first, second = (F.col("ts") < _time(t) for t in RELOADED)
    files.write_parquet(events.filter(second | F.col("ts").isNull()), f"{root}/early")
    files.write_parquet(events.filter(~first), f"{root}/late")
    table = tables.create_dated_table(
        events.limit(0), fresh_name("events_reloaded"), "ts", ("user_id",), f"{root}/table"
    )
    for batch in ("early", "late", "early", "late"):
        jobs.reload_dates(spark, f"{root}/{batch}", table)
    counts = table.partition_counts(spark).withColumnRenamed("partition_id", "day")
    rows = table.read(spark).withColumn("day", F.to_date("ts"))
    return rows.join(counts.drop("table_name"), rows.day.eqNullSafe(counts.day), "left").drop("day")


def external_to_dated_job(spark, d):
    return _events_by_day(spark, d).read(spark)


def external_csv_view(spark, d):
    """Zones written as headed CSV twice over, read as one external view."""
    zones = marts.dim_zones(supplied.zone_lookup(spark, d))
    root = fresh_dir(spark, "zones-csv")
    for part in ("a", "b"):
        zones.write.option("header", True).csv(f"{root}/zones-{part}")
    return tables.create_external_view(
        spark, fresh_name("zones_csv"), [f"{root}/zones-*"], "csv", ZONE_SCHEMA, header="true"
    )


def typed_feature_table(spark, d):
    """A table created with declared column types."""
    trips = supplied.all_trips(spark, d).filter("fare_amount <> 0")
    types = {
        "passenger_count": T.LongType(),
        "payment_type": T.StringType(),
        "fare_amount": T.DoubleType(),
    }
    return tables.create_table(trips, fresh_name("features"), fresh_dir(spark, "features"), types)


def drifting_months(spark, d):
    """One folder of files whose passenger count is bigint in some and double in others."""
    trips = supplied.all_trips(spark, d).select("pickup_datetime", "passenger_count", "fare_amount")
    early = F.col("pickup_datetime") < F.lit(DRIFT_FROM).cast("timestamp_ntz")
    path = fresh_dir(spark, "drift")
    whole = trips.withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
    files.write_parquet(whole.filter(early), path)
    files.write_parquet(trips.filter(~early), path, "append")
    types = {
        "pickup_datetime": T.TimestampNTZType(),
        "passenger_count": T.IntegerType(),
        "fare_amount": T.DecimalType(18, 2),
        "airport_fee": T.DecimalType(18, 2),
    }
    months = files.read_drifting_parquet(spark, [path], types)
    return months.groupBy("passenger_count").agg(
        F.count("*").alias("trips"),
        total_money(months, "fare_amount").alias("fare_amount"),
        F.count("airport_fee").alias("airport_fees"),
    )


# Whole jobs


def service_union_job(spark, d):
    root = fresh_dir(spark, "union")
    files.write_parquet(supplied.raw_green(spark, d), f"{root}/green")
    files.write_parquet(supplied.raw_yellow(spark, d), f"{root}/yellow")
    stored = jobs.union_services(spark, [f"{root}/green"], [f"{root}/yellow"], f"{root}/union")
    return group_count(stored, "service_type", "payment_type")


def monthly_report_job(spark, d):
    root = fresh_dir(spark, "report")
    files.write_parquet(supplied.raw_green(spark, d), f"{root}/green")
    files.write_parquet(supplied.raw_yellow(spark, d), f"{root}/yellow")
    return jobs.monthly_report(spark, [f"{root}/green"], [f"{root}/yellow"], f"{root}/report")


def zone_distances_job(spark, d):
    stored = jobs.zone_distances(
        supplied.all_trips(spark, d), supplied.zone_lookup(spark, d), fresh_dir(spark, "distances")
    )
    return stored.groupBy("pickup_zone", "dropoff_zone").agg(
        F.count("*").alias("trips"), exact_sum(stored, "trip_distance").alias("distance")
    )


def marts_job(spark, d):
    """Stored staging, dimension, fact and mart; the mart comes back after its checks."""
    staged = _stored(_staged(spark, d), "staged", partition_by=["service_type"])
    zones = supplied.complete_zone_lookup(spark, d)
    built = jobs.build_marts(staged, zones, fresh_dir(spark, "marts"))
    return built.monthly


# Data quality


def quality_report(spark, d):
    zones = supplied.zone_lookup(spark, d)
    checks = [*service_checks(zones), quality.unique("tripid")]
    columns = sorted({column for check in checks for column in check.columns} | {"service_type"})
    staged = _stored(_staged(spark, d).select(*columns), "staged")
    return quality.quality_report(staged, checks)


def shared_trip_keys(spark, d):
    """Keys that a green and a yellow trip share."""
    return quality.duplicate_keys(_staged(spark, d), "tripid")


def trips_without_zone(spark, d):
    trips = supplied.all_trips(spark, d)
    return without_parent(trips, "pulocationid", supplied.zone_lookup(spark, d), "locationid")


def column_profile(spark, d):
    return quality.column_profile(_staged(spark, d)).drop("data_type")


# Tip model


def tip_features(spark, d):
    return tip_model.tip_features(supplied.all_trips(spark, d))


def tip_feature_info(spark, d):
    info = regression.feature_info(tip_model.tip_features(supplied.all_trips(spark, d)), TIP_SPEC)
    return info.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


def tip_model_eval(spark, d):
    """One numeric feature, so SQL has a closed form of the same regression."""
    run = jobs.tip_model(supplied.all_trips(spark, d), ROW_KEY, FARE_SPEC)
    scores = regression.evaluate(run.model, run.held_out)
    return scores.select("rows", *(F.round(c, 4).alias(c) for c in scores.columns if c != "rows"))


def tip_prediction_by_zone(spark, d):
    run = jobs.tip_model(supplied.all_trips(spark, d), ROW_KEY, FARE_SPEC)
    return (
        run.model.predict(run.features)
        .groupBy("pulocationid")
        .agg(
            F.count("*").alias("trips"),
            F.round(F.avg("predicted_tip_amount"), 4).alias("predicted_tip_amount"),
        )
    )


def tip_attribution_by_zone(spark, d):
    run = jobs.tip_model(supplied.all_trips(spark, d), ROW_KEY, FARE_SPEC)
    explained = run.model.explain(run.features)
    return explained.groupBy("pulocationid").agg(
        F.round(F.avg("baseline_prediction"), 4).alias("baseline_prediction"),
        F.round(F.avg(F.col("top_feature_attributions")[0]["attribution"]), 4).alias("attribution"),
    )


def json_scored_by_zone(spark, d):
    """Features as JSON text, decoded and scored."""
    run = jobs.tip_model(supplied.all_trips(spark, d), ROW_KEY, FARE_SPEC)
    sent = {"pulocationid": "PULocationID", "dolocationid": "DOLocationID"}
    inputs = run.features.select(*TIP_INPUT_SCHEMA.names).withColumnsRenamed(sent)
    rows = messages.encode_messages(inputs)
    return (
        score_json(rows, run.model, TIP_INPUT_SCHEMA)
        .groupBy("pulocationid")
        .agg(
            F.count("*").alias("trips"),
            F.round(F.avg("predicted_tip_amount"), 4).alias("predicted_tip_amount"),
        )
    )


def tip_predictions(spark, d):
    """One number and one category: SQL has a closed form of this model, too."""
    run = jobs.tip_model(supplied.all_trips(spark, d), ROW_KEY, PAYMENT_SPEC)
    scored = run.model.predict(run.features)
    return scored.withColumn("predicted_tip_amount", F.round("predicted_tip_amount", 4))


def tip_explained(spark, d):
    """The same with ranked attributions: the stronger of both inputs first."""
    run = jobs.tip_model(supplied.all_trips(spark, d), ROW_KEY, PAYMENT_SPEC)
    explained = run.model.explain(run.features)
    top = F.col("top_feature_attributions")
    ranked = explained.withColumns(
        {
            **{c: F.round(c, 4) for c in ("predicted_tip_amount", "baseline_prediction")},
            **{f"feature_{i}": top[i]["feature"] for i in (0, 1)},
            **{f"attribution_{i}": F.round(top[i]["attribution"], 4) for i in (0, 1)},
        }
    )
    return ranked.drop("top_feature_attributions")


def tip_tuning(spark, d):
    train, held_out = jobs.stored_tip_features(supplied.all_trips(spark, d), ROW_KEY)
    trials = regression.tune(train, held_out, FARE_SPEC)[1]
    return trials.withColumns(
        {c: F.round(c, 4) for c in ("l1_reg", "l2_reg", "rmse", "r2_score")}
    )


def tip_full_predictions(spark, d):
    """The model as users run it: all numbers, zones and payment types as categories."""
    run = jobs.tip_model(supplied.all_trips(spark, d), ROW_KEY)
    return run.model.predict(run.features)


def tip_full_explained(spark, d):
    """Its three strongest reasons for every prediction, of seven inputs."""
    run = jobs.tip_model(supplied.all_trips(spark, d), ROW_KEY)
    return run.model.explain(run.features)


def tip_full_tuning(spark, d):
    """Five penalties for all inputs."""
    train, held_out = jobs.stored_tip_features(supplied.all_trips(spark, d), ROW_KEY)
    return regression.tune(train, held_out, TIP_SPEC)[1]


def stream_scored_by_zone(spark, d):
    """Feature rows and other messages as one stream in batches, scored or set apart.

    The other messages are the events' own, which lack the inputs.
    """
    run = jobs.tip_model(supplied.all_trips(spark, d), ROW_KEY, FARE_SPEC)
    root, inputs = fresh_dir(spark, "scored"), run.features.select(*TIP_INPUT_SCHEMA.names)
    run.model.save(f"{root}/model")
    jobs.produce(inputs, f"{root}/sent")
    other = supplied.table(spark, d, "events").select(F.coalesce("props", F.lit("")).alias("value"))
    other.write.mode("append").text(f"{root}/sent")
    jobs.score_messages_stream(
        messages.read_text_files(spark, f"{root}/sent", files_at_once=2),
        regression.load(spark, f"{root}/model"),
        TIP_INPUT_SCHEMA,
        f"{root}/out",
        f"{root}/checkpoint",
    ).awaitTermination()
    rows = messages.read_stored(spark, f"{root}/out")
    good = F.col("malformed").isNull()
    return rows.groupBy("pulocationid", good.alias("scored")).agg(
        F.count("*").alias("messages"),
        F.round(F.avg("predicted_tip_amount"), 4).alias("predicted_tip_amount"),
    )


def batch_scored_trips(spark, d):
    trips = supplied.all_trips(spark, d).select(
        "vendorid", "pickup_datetime", "pulocationid", "dolocationid", "trip_distance"
    )
    return score_batches(trips, lambda batch: batch["trip_distance"] * 3, "predicted_duration")


# Messages


def json_roundtrip(spark, d):
    events = supplied.table(spark, d, "events").select("event_id", "user_id", "value")
    schema = events.schema
    return messages.well_formed(
        messages.decode_messages(messages.encode_messages(events), schema)
    )


def stream_json_events(spark, d):
    """The events' JSON column as a stream: decoded, stored, read back."""
    stream = supplied.table_stream(spark, d, "events").select(
        "event_id", F.col("props").alias("value")
    )
    out = fresh_dir(spark, "stream")
    jobs.consume(stream, out, f"{out}-checkpoint", PROPS_SCHEMA).awaitTermination()
    return messages.read_stored(spark, out)


def stream_resumed(spark, d):
    """A stream that drains, gets more files, and drains again from its checkpoint."""
    events = supplied.table(spark, d, "events").select("event_id", "props")
    source, out = fresh_dir(spark, "resumed-in"), fresh_dir(spark, "resumed")
    for part in (0, 1):
        files.write_parquet(events.filter(F.col("event_id") % 2 == part), source, "append")
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
        rows = stream.parquet(source).select("event_id", F.col("props").alias("value"))
        jobs.consume(rows, out, f"{out}-checkpoint", PROPS_SCHEMA).awaitTermination()
    return messages.read_stored(spark, out)


def stream_by_batch(spark, d):
    """The same through an action per batch, which overwrites its own batch if repeated."""
    stream = supplied.table_stream(spark, d, "events").select(
        "event_id", F.col("props").alias("value")
    )
    out = fresh_dir(spark, "by-batch")

    def store(batch: DataFrame, number: int) -> None:
        files.write_parquet(batch, f"{out}/batch={number}", "overwrite")

    jobs.consume(stream, out, f"{out}-checkpoint", PROPS_SCHEMA, store).awaitTermination()
    return spark.read.parquet(out).drop("batch")


def produced_messages(spark, d):
    """Rows sent as JSON messages to files, streamed from there and stored."""
    events = supplied.table(spark, d, "events").select("event_id", "user_id", "value")
    sent, out = fresh_dir(spark, "sent"), fresh_dir(spark, "received")
    jobs.produce(events, sent)
    stream = messages.read_text_files(spark, sent, files_at_once=2)
    jobs.consume(stream, out, f"{out}-checkpoint", events.schema).awaitTermination()
    return messages.read_stored(spark, out).drop("malformed")


# Sources by name, seeds, file counts, descriptions


def registered_months(spark, d):
    """Files of every month a service has, written at once, reached the same way.

    A trip without a pickup time belongs to no month.
    """
    trips = supplied.raw_green(spark, d).select("VendorID", "lpep_pickup_datetime")
    pickup = F.col("lpep_pickup_datetime")
    # Spark names the folder of a month "file=" and its value: the service of the paths.
    service, base = "file=green", fresh_dir(spark, "all-months")
    name = F.concat(F.date_format(pickup, "'green_tripdata_'yyyy-MM"), F.lit(".parquet"))
    dated = trips.filter(pickup.isNotNull()).withColumn("file", name)
    files.write_parquet(dated.hint("rebalance", "file"), base, partition_by=["file"])
    present = dated.select(F.year(pickup).alias("year"), F.month(pickup).alias("month")).distinct()
    paths = [
        path
        for year, month in sorted(map(tuple, present.collect()))
        for path in files.month_paths(base, service, [year], [month])
    ]
    sources = files.SourceRegistry()
    sources.register(
        "staging",
        "green",
        # A service without trips has no file.
        lambda: files.read_parquet(spark, *paths, schema=trips.schema) if paths else trips.limit(0),
    )
    rows = sources.source("staging", "green")
    rows = rows.withColumns({"year": F.year(pickup), "month": F.month(pickup)})
    return group_count(rows, "VendorID", "year", "month")


def seed_round_trip(spark, d):
    """Zones as headed CSV, loaded as a seed table."""
    path = fresh_dir(spark, "seed")
    supplied.zone_lookup(spark, d).write.option("header", True).csv(path)
    return files.load_seed(spark, path, fresh_name("seed"))


def output_file_count(spark, d):
    """Trips written to a fixed number of files, counted in what was written."""
    path = fresh_dir(spark, "four-files")
    files.write_parquet(supplied.table(spark, d, "lineitem").select("l_orderkey"), path, files=4)
    stored = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).count()
    return stored.agg(F.count("*").alias("files"), F.sum("count").alias("trips"))


def sampled_staging(spark, d):
    """The row cap of a trial run, in key order."""
    return stage(supplied.all_trips(spark, d), sample_rows=PREVIEW_ROWS).select(
        "tripid", "service_type"
    )


def mart_descriptions(spark, d):
    """Texts of the mart tables and their columns, as the catalog has them."""
    trips, zones = supplied.all_trips(spark, d), supplied.complete_zone_lookup(spark, d)
    prefix = fresh_name("marts")
    jobs.build_marts(stage(trips), zones, fresh_dir(spark, "marts"), tables_prefix=f"{prefix}_")
    found = []
    for name in ("dim_zones", "monthly_zone_revenue"):
        table = f"{prefix}_{name}"
        described = tables.descriptions(spark, table).filter("comment IS NOT NULL")
        rows = F.lit(spark.table(table).count())
        found.append(described.withColumns({"table_name": F.lit(name), "row_count": rows}))
    return union_all(*found)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        monthly_zone_revenue,
        monthly_mart_from_days,
        staging_green,
        staging_yellow,
        trip_keys,
        first_trip_per_vendor_day,
        dim_zones,
        fact_trips,
        fact_trip_coverage,
        monthly_revenue_by_zone_id,
        aligned_union,
        service_counts,
        avg_distance_by_service,
        hourly_revenue_green,
        hourly_outer_merge,
        hourly_service_columns,
        hourly_green_yellow_merge,
        hourly_merge_job,
        trip_zone_names,
        long_paid_trips,
        trip_date_and_hours,
        ordered_preview,
        distinct_vendors_in_range,
        vendor_trip_count_in_range,
        partition_row_counts,
        reloaded_dates,
        external_to_dated_job,
        external_csv_view,
        typed_feature_table,
        drifting_months,
        service_union_job,
        monthly_report_job,
        zone_distances_job,
        marts_job,
        quality_report,
        shared_trip_keys,
        trips_without_zone,
        column_profile,
        tip_features,
        tip_feature_info,
        tip_model_eval,
        tip_prediction_by_zone,
        tip_attribution_by_zone,
        json_scored_by_zone,
        stream_scored_by_zone,
        tip_predictions,
        tip_explained,
        tip_tuning,
        tip_full_predictions,
        tip_full_explained,
        tip_full_tuning,
        batch_scored_trips,
        json_roundtrip,
        stream_json_events,
        stream_resumed,
        stream_by_batch,
        produced_messages,
        registered_months,
        seed_round_trip,
        output_file_count,
        sampled_staging,
        mart_descriptions,
    )
}


# What a query reads that grows with the data, where that is not the trips.
READS = {
    **dict.fromkeys(("dim_zones", "external_csv_view", "seed_round_trip"), ("nation", "region")),
    **dict.fromkeys(
        (
            "hourly_revenue_green", "hourly_outer_merge", "hourly_service_columns",
            "hourly_green_yellow_merge", "hourly_merge_job", "trip_date_and_hours",
            "partition_row_counts", "reloaded_dates", "external_to_dated_job", "json_roundtrip",
            "stream_json_events", "stream_resumed", "stream_by_batch", "produced_messages",
        ),
        ("events",),
    ),
    "ordered_preview": ("orders",),
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    """One registered query, with the settings its results and its scale depend on."""
    pin_runtime_settings(spark)
    paths = [f"{folder.rstrip('/')}/{t}.parquet" for t in READS.get(name, ("lineitem",))]
    size_shuffles(spark, files.stored_bytes(spark, *paths))
    return plain(QUERIES[name](spark, folder))
