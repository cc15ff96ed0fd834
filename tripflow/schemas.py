"""Schemas, cast maps and service layouts of the trip model."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
DISTANCE = T.DecimalType(18, 6)

# A bare "numeric" in Spark means decimal(10,0) and would round money away,
# so every decimal carries its precision. Clock times of a trip are local
# wall-clock readings: timestamp without time zone.
TRIP_TYPES: dict[str, T.DataType] = {
    "vendorid": T.IntegerType(),
    "ratecodeid": T.IntegerType(),
    "pickup_locationid": T.IntegerType(),
    "dropoff_locationid": T.IntegerType(),
    "pickup_datetime": T.TimestampNTZType(),
    "dropoff_datetime": T.TimestampNTZType(),
    "store_and_fwd_flag": T.StringType(),
    "passenger_count": T.IntegerType(),
    "trip_distance": DISTANCE,
    "trip_type": T.IntegerType(),
    "fare_amount": MONEY,
    "extra": MONEY,
    "mta_tax": MONEY,
    "tip_amount": MONEY,
    "tolls_amount": MONEY,
    "ehail_fee": MONEY,
    "improvement_surcharge": MONEY,
    "total_amount": MONEY,
    "payment_type": T.IntegerType(),
    "congestion_surcharge": MONEY,
}

# Raw name -> canonical name, shared by both services.
LOCATION_NAMES = {
    "pulocationid": "pickup_locationid",
    "dolocationid": "dropoff_locationid",
}

# Columns summed by the monthly reports, with the suffix of the report column.
# The report column names must stay as readers know them.
REVENUE_MEASURES = {
    "fare_amount": "fare",
    "extra": "extra",
    "mta_tax": "mta_tax",
    "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount",
    "ehail_fee": "ehail_fee",
    "improvement_surcharge": "improvement_surcharge",
    "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge",
}

# Payment codes and their descriptions.
PAYMENT_DESCRIPTIONS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}


@dataclass(frozen=True)
class ServiceLayout:
    """How one service names its times, and which columns it lacks."""

    service: str
    pickup: str
    dropoff: str
    constants: dict[str, int] = field(default_factory=dict)


GREEN = ServiceLayout("Green", "lpep_pickup_datetime", "lpep_dropoff_datetime")
YELLOW = ServiceLayout(
    "Yellow",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    constants={"trip_type": 1, "ehail_fee": 0},
)

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("locationid", T.IntegerType()),
        T.StructField("borough", T.StringType()),
        T.StructField("zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

HIGH_VOLUME_SCHEMA = T.StructType(
    [
        T.StructField("hvfhs_license_num", T.StringType()),
        T.StructField("dispatching_base_num", T.StringType()),
        T.StructField("pickup_datetime", T.TimestampNTZType()),
        T.StructField("dropoff_datetime", T.TimestampNTZType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("SR_Flag", T.StringType()),
    ]
)

# Feature table of the tip model: ids and codes are categories, hence strings.
TIP_FEATURE_TYPES: dict[str, T.DataType] = {
    "passenger_count": T.LongType(),
    "trip_distance": T.DoubleType(),
    "pulocationid": T.StringType(),
    "dolocationid": T.StringType(),
    "payment_type": T.StringType(),
    "fare_amount": T.DoubleType(),
    "tolls_amount": T.DoubleType(),
    "tip_amount": T.DoubleType(),
}
TIP_LABEL = "tip_amount"
TIP_CATEGORIES = ("pulocationid", "dolocationid", "payment_type")
TIP_NUMBERS = ("passenger_count", "trip_distance", "fare_amount", "tolls_amount")

MESSAGE_SCHEMA = T.StructType([T.StructField("number", T.LongType())])
