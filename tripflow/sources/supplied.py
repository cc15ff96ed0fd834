"""The supplied star-schema tables, shaped as raw trips, zones and messages.

Trip records are flat and wide, so each row of ``lineitem`` is read as one
trip: a pure projection, one scan, no join. Ids 25 of both locations have no
zone on purpose; they exercise unmatched keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.schemas import GREEN, YELLOW, ServiceLayout

# Raw column -> Spark expression over lineitem.
RAW_TRIP = {
    "VendorID": "l_suppkey",
    "pickup": "l_shipdate",
    "dropoff": "l_shipdate + make_dt_interval(0, 0, cast(l_quantity as int))",
    "RatecodeID": "l_linenumber % 6 + 1",
    "PULocationID": "l_partkey % 26",
    "DOLocationID": "l_orderkey % 26",
    "store_and_fwd_flag": "CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END",
    "passenger_count": "cast(l_linenumber as double)",
    "trip_distance": "l_quantity",
    "trip_type": "l_linenumber % 2 + 1",
    "fare_amount": "l_extendedprice",
    "extra": "l_discount * 10",
    "mta_tax": "0.5D",
    "tip_amount": "floor(l_extendedprice) * l_discount",
    "tolls_amount": "l_tax * 100",
    "ehail_fee": "l_tax * 10",
    "improvement_surcharge": "0.3D",
    "total_amount": "l_extendedprice + l_discount * 10 + l_tax * 100",
    "payment_type": "l_partkey % 7",
    "congestion_surcharge": "CASE WHEN l_linenumber > 3 THEN 2.5D ELSE 0D END",
}
SERVICE = "CASE WHEN l_linestatus = 'F' THEN 'Green' ELSE 'Yellow' END"

# Event types that play green trips in the hourly reports; all others are yellow.
GREEN_EVENTS = ("click", "signup")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table as a stream of files.

    A stream wants a folder or a glob; the class of one letter makes it work
    for a table that is a single file, too, and matches no other name.
    """
    schema = table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder.rstrip('/')}/{name}.parque[t]")


def all_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Trips of both services in canonical names, raw values, one scan."""
    trips = table(spark, folder, "lineitem").selectExpr(
        *(f"{expr} AS {name}" for name, expr in RAW_TRIP.items()), f"{SERVICE} AS service_type"
    )
    is_yellow = F.col("service_type") == YELLOW.service
    fixed = {
        name: F.when(is_yellow, F.lit(value)).otherwise(F.col(name))
        for name, value in YELLOW.constants.items()
    }
    return trips.withColumns(fixed).withColumnsRenamed(
        {
            **{name: name.lower() for name in RAW_TRIP},
            "pickup": "pickup_datetime",
            "dropoff": "dropoff_datetime",
        }
    )


def _raw(spark: SparkSession, folder: str, layout: ServiceLayout, columns: list[str]) -> DataFrame:
    status = "=" if layout.service == GREEN.service else "<>"
    names = {"pickup": layout.pickup, "dropoff": layout.dropoff}
    return (
        table(spark, folder, "lineitem")
        .filter(f"l_linestatus {status} 'F'")
        .selectExpr(*(f"{RAW_TRIP[c]} AS {names.get(c, c)}" for c in columns))
    )


def raw_green(spark: SparkSession, folder: str) -> DataFrame:
    return _raw(spark, folder, GREEN, list(RAW_TRIP))


def raw_yellow(spark: SparkSession, folder: str) -> DataFrame:
    """Other column order than green, and without the columns yellow lacks."""
    columns = [c for c in reversed(RAW_TRIP) if c not in YELLOW.constants]
    return _raw(spark, folder, YELLOW, columns)


def zone_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as zones and regions as boroughs; one borough plays ``Unknown``."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS locationid",
        "CASE WHEN r_name = 'MIDDLE EAST' THEN 'Unknown' ELSE r_name END AS borough",
        "n_name AS zone",
        "CASE WHEN r_name = 'AMERICA' THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone",
    )


def complete_zone_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the location number no nation has, as an unknown place."""
    zones = zone_lookup(spark, folder)
    none = spark.createDataFrame([(25, "Unknown", "NV", "N/A")], "a int, b string, c string, d string")
    return zones.union(none.toDF(*zones.columns))


def event_trips(spark: SparkSession, folder: str) -> DataFrame:
    """All events as trips with real clock times, for the hourly reports."""
    green = F.col("event_type").isin(list(GREEN_EVENTS))
    return table(spark, folder, "events").select(
        F.col("ts").alias("pickup_datetime"),
        F.expr("cast(user_id % 26 AS int)").alias("pulocationid"),
        F.col("value").alias("total_amount"),
        F.when(green, GREEN.service).otherwise(YELLOW.service).alias("service_type"),
    )
