"""What the stored tables and their columns mean; saved along with them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripflow.sources.tables import describe

ZONE_COLUMNS = {
    "locationid": "Zone number that trips refer to",
    "borough": "Borough of the zone; Unknown for numbers without a place",
    "zone": "Zone name; several zones may share one",
    "service_zone": "Area of service the zone belongs to",
}

TRIP_COLUMNS = {
    "tripid": "MD5 of vendor and pickup time; unique within a service",
    "vendorid": "Company that recorded the trip",
    "service_type": "Green or Yellow",
    "ratecodeid": "Rate in effect when the trip ended, 1 to 6",
    "pickup_locationid": "Zone where the meter started",
    "dropoff_locationid": "Zone where the meter stopped",
    "pickup_datetime": "Local time the meter started",
    "dropoff_datetime": "Local time the meter stopped",
    "store_and_fwd_flag": "Y if the record waited in the vehicle for a connection",
    "passenger_count": "Passengers, as entered by the driver",
    "trip_distance": "Miles by the meter",
    "trip_type": "How the ride was hailed; always 1 for Yellow",
    "fare_amount": "Fare by time and distance",
    "tip_amount": "Card tip; cash is not recorded",
    "tolls_amount": "Tolls paid during the trip",
    "improvement_surcharge": "Fixed charge for each trip since 2015",
    "total_amount": "All charges, without cash tips",
    "payment_type": "Payment code, 1 to 6",
    "payment_type_description": "Text of the payment code; empty for other codes",
}

TABLES = {
    "dim_zones": "Places trips start and end in, one row per zone number",
    "fact_trips": "Trips of both services between known zones, one row per trip",
    "monthly_zone_revenue": "Revenue and trips by pickup zone name, month and service",
}

MONTHLY_COLUMNS = {
    "revenue_zone": "Pickup zone name",
    "revenue_month": "First instant of the month",
    "service_type": "Green or Yellow",
    "revenue_monthly_total_amount": "Sum of all charges of the group's trips",
    "total_monthly_trips": "Trips of the group",
}


def described(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Describe the columns the frame has."""
    return describe(df, {name: text for name, text in comments.items() if name in df.columns})
