"""From raw service files to typed, de-duplicated trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions import as_type, code_description, surrogate_key
from tripflow.operators.align import lower_names, rename, tag, union_all
from tripflow.operators.dedup import keep_first
from tripflow.schemas import (
    GREEN,
    LOCATION_NAMES,
    PAYMENT_DESCRIPTIONS,
    TRIP_TYPES,
    YELLOW,
    ServiceLayout,
)

# The most selective key leads: sorting compares it first.
DEDUP_KEYS = ("pickup_datetime", "vendorid", "service_type")


def canonical(raw: DataFrame, layout: ServiceLayout) -> DataFrame:
    """Canonical names and columns of one service; values and types untouched."""
    times = {layout.pickup: "pickup_datetime", layout.dropoff: "dropoff_datetime"}
    named = rename(lower_names(raw), {**times, **LOCATION_NAMES})
    tagged = tag(named, service_type=layout.service, **layout.constants)
    return tagged.select("service_type", *TRIP_TYPES)


def stage(
    trips: DataFrame, sample_rows: int | None = None, strict: bool = True
) -> DataFrame:
    """Type canonical trips and keep one per service, vendor and pickup time.

    Takes one service or several stacked ones: the service is part of the key,
    so both are staged by the same single shuffle. Rows without a vendor are
    dropped. The key ``tripid`` covers vendor and pickup only, so two services
    can share a value.

    ``sample_rows`` caps a trial run in key order; a full run leaves it unset.
    """
    trips = rename(trips, LOCATION_NAMES).select("service_type", *TRIP_TYPES)
    kept = keep_first(trips.filter(F.col("vendorid").isNotNull()), DEDUP_KEYS)
    sources = {f.name: f.dataType for f in trips.schema.fields}
    typed = kept.select(
        "service_type",
        *(as_type(F.col(n), sources[n], t, strict).alias(n) for n, t in TRIP_TYPES.items()),
    )
    staged = typed.select(
        surrogate_key("vendorid", "pickup_datetime").alias("tripid"),
        "*",
        code_description("payment_type", PAYMENT_DESCRIPTIONS).alias("payment_type_description"),
    )
    if sample_rows is not None:
        staged = staged.orderBy("tripid", "service_type").limit(sample_rows)
    return staged


def stage_green(raw: DataFrame, sample_rows: int | None = None, strict: bool = True) -> DataFrame:
    return stage(canonical(raw, GREEN), sample_rows, strict).drop("service_type")


def stage_yellow(raw: DataFrame, sample_rows: int | None = None, strict: bool = True) -> DataFrame:
    return stage(canonical(raw, YELLOW), sample_rows, strict).drop("service_type")


def stage_services(green: DataFrame, yellow: DataFrame, strict: bool = True) -> DataFrame:
    """Both services staged together and tagged with their service."""
    return stage(union_all(canonical(green, GREEN), canonical(yellow, YELLOW)), strict=strict)
