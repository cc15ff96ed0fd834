"""Zone dimension, trip fact, and the revenue marts over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions import replace_text
from tripflow.operators.aggregates import hourly_service_columns, revenue_by_hour, revenue_by_month
from tripflow.operators.joins import broadcast_if_small, join_roles, keep_known, outer_merge
from tripflow.schemas import REVENUE_MEASURES

ROLES = {"pickup": "pickup_locationid", "dropoff": "dropoff_locationid"}

# The by-id report works on the columns both services share.
SHARED_MEASURES = tuple(m for m in REVENUE_MEASURES if m != "ehail_fee")

FACT_COLUMNS = (
    "tripid",
    "vendorid",
    "service_type",
    "ratecodeid",
    "pickup_locationid",
    "pickup_borough",
    "pickup_zone",
    "dropoff_locationid",
    "dropoff_borough",
    "dropoff_zone",
    "pickup_datetime",
    "dropoff_datetime",
    "store_and_fwd_flag",
    "passenger_count",
    "trip_distance",
    "trip_type",
    *REVENUE_MEASURES,
    "payment_type",
    "payment_type_description",
)


def dim_zones(lookup: DataFrame) -> DataFrame:
    """Zone dimension; the outer service zone gets its colour name."""
    return lookup.select(
        "locationid",
        "borough",
        "zone",
        replace_text("service_zone", "Boro", "Green").alias("service_zone"),
    )


def known_zones(zones: DataFrame) -> DataFrame:
    return zones.filter(F.col("borough") != "Unknown")


def fact_trips(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips whose pickup and dropoff zones are both known."""
    known = broadcast_if_small(known_zones(zones).select("locationid", "borough", "zone"))
    return join_roles(staged, known, "locationid", ROLES, ["borough", "zone"]).select(
        *FACT_COLUMNS
    )


def zone_coverage(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips per service, and how many the fact keeps or drops for their zones."""
    known = broadcast_if_small(known_zones(zones).select("locationid").distinct())
    for role, key in ROLES.items():
        side = known.select(F.col("locationid").alias(f"_{role}"))
        staged = staged.join(side, F.col(key) == F.col(f"_{role}"), "left")
    kept = F.count_if(F.col("_pickup").isNotNull() & F.col("_dropoff").isNotNull())
    counted = staged.groupBy("service_type").agg(F.count("*").alias("staged"), kept.alias("kept"))
    return counted.withColumn("dropped", F.col("staged") - F.col("kept"))


def monthly_zone_revenue(fact: DataFrame) -> DataFrame:
    """Monthly mart per pickup zone *name*; zones that share a name are one group."""
    return revenue_by_month(fact, "pickup_zone", count="tripid")


def monthly_revenue_by_zone_id(trips: DataFrame) -> DataFrame:
    """Monthly report per pickup zone *id* over stacked raw trips."""
    return revenue_by_month(trips, "pulocationid", SHARED_MEASURES)


def trip_zone_names(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Each trip's distance with the names of both its zones."""
    named = join_roles(
        trips.select("pulocationid", "dolocationid", "trip_distance"),
        broadcast_if_small(zones.select("locationid", "zone")),
        "locationid",
        {"pickup": "pulocationid", "dropoff": "dolocationid"},
        ["zone"],
    )
    return named.select(
        F.col("pulocationid").alias("pickup_location"),
        "pickup_zone",
        F.col("dolocationid").alias("dropoff_location"),
        "dropoff_zone",
        "trip_distance",
    )


def hourly_revenue(trips: DataFrame, service: str, since: str | None = None) -> DataFrame:
    """Hourly revenue of one service per zone, optionally from a start time."""
    mine = trips.filter(F.col("service_type") == service)
    if since is not None:
        mine = mine.filter(F.col("pickup_datetime") >= F.lit(since).cast("timestamp_ntz"))
    return revenue_by_hour(mine, "pulocationid", "total_amount")


def hourly_side(hourly: DataFrame, service: str) -> DataFrame:
    """Hourly revenue with column names that say whose it is."""
    suffix = service.lower()
    return hourly.withColumnsRenamed(
        {
            "zone": "revenue_zone",
            "hour": "revenue_hour",
            "amount": f"revenue_hourly_total_amount_{suffix}",
            "number_records": f"number_records_{suffix}",
        }
    )


def merge_hourly(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Full outer merge of two hourly reports, e.g. ones stored earlier."""
    return outer_merge(
        hourly_side(green, "Green"), hourly_side(yellow, "Yellow"), ["revenue_zone", "revenue_hour"]
    )


def hourly_by_service(trips: DataFrame) -> DataFrame:
    """The same merge computed straight from stacked trips, without a join."""
    return hourly_service_columns(trips, "pulocationid", "total_amount", ("Green", "Yellow"))


def in_known_zones(merged: DataFrame, zones: DataFrame) -> DataFrame:
    """Merged hourly revenue of zones that the dimension lists."""
    ids = broadcast_if_small(zones.select("locationid"))
    return keep_known(merged, ids, F.col("revenue_zone") == F.col("locationid")).select(
        "revenue_zone",
        "revenue_hour",
        "revenue_hourly_total_amount_green",
        "revenue_hourly_total_amount_yellow",
    )
