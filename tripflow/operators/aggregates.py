"""Grouped reports. Sums and counts combine before the shuffle, so hot groups are cheap."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions import truncate
from tripflow.schemas import REVENUE_MEASURES

# Longs are summed in two parts, split at this bit, so no total can overflow.
SPLIT = 20
# Doubles are taken apart in pieces of this many bits.
PIECE = 26
# Columns of the monthly report that are averaged.
MEANS = ("passenger_count", "trip_distance")


def _long_parts(units: Column) -> tuple[Column, Column]:
    return F.shiftright(units, SPLIT), units.bitwiseAND(F.lit(2**SPLIT - 1))


def _joined_parts(high: Column, low: Column) -> Column:
    whole = high.cast("decimal(20,0)") * F.lit(2**SPLIT).cast("decimal(7,0)")
    return whole + low.cast("decimal(20,0)")


def _sum_of_longs(units: Column) -> Column:
    return _joined_parts(*map(F.sum, _long_parts(units)))


def _units(df: DataFrame, name: str) -> tuple[Column, int] | None:
    """A number counted in its smallest digit, and its digits; None if a long cannot hold it."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.IntegralType):
        return value.cast("long"), 0
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return (value * F.lit(10**kind.scale)).cast("long"), kind.scale
    return None


def _sum_of_doubles(value: Column) -> Column:
    """Sum of doubles that does not depend on the order of rows.

    Below 2^53 a double is a whole part and two pieces of 26 bits of fraction;
    all are added as longs, which no 2^36 rows overflow. What a number below
    one has beyond those bits, numbers of 2^53 and more, NaN and infinities
    are added as doubles beside them, so the latter come out as in any sum.
    """
    value = value.cast("double")
    size = float(2**PIECE)
    plain = F.abs(value) < float(2**53)
    # NaN compares as larger than any number, and so is not plain.
    whole = F.when(plain, value).otherwise(F.when(value.isNotNull(), F.lit(0.0))).cast("long")
    first_rest = F.when(plain, value - whole.cast("double")).otherwise(F.lit(0.0)) * size
    first = first_rest.cast("long")
    second_rest = (first_rest - first.cast("double")) * size
    second = second_rest.cast("long")
    beside = F.when(plain, (second_rest - second.cast("double")) / size / size).otherwise(value)
    wholes = _sum_of_longs(whole).cast("double")
    pieces = F.sum(first).cast("decimal(20,0)") * F.lit(2**PIECE).cast("decimal(8,0)")
    pieces = (pieces + F.sum(second).cast("decimal(20,0)")).cast("double")
    return wholes + pieces / F.lit(size * size) + F.sum(beside)


def exact_sum(df: DataFrame, name: str) -> Column:
    """Sum that does not depend on the order of rows.

    Integers and decimals are counted in units of their smallest digit and
    added as longs, in a high and a low part, at a fraction of the cost of
    adding decimals; the result is a decimal, built once per group. Doubles
    give a double, see ``_sum_of_doubles``.
    """
    units = _units(df, name)
    if units is not None:
        return _scaled(_sum_of_longs(units[0]), units[1])
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return _sum_of_doubles(F.col(name))
    return F.sum(name)


def _scaled(total: Column, digits: int) -> Column:
    return total * F.lit(Decimal(1).scaleb(-digits)) if digits else total


# Sums that are merged later: a high and a low part in units, and how many values.
PARTS = ("high", "low", "n")


def sum_parts(df: DataFrame, name: str) -> list[Column]:
    """What a sum or mean of a whole number or decimal needs to be merged with others.

    Longs, in units of the smallest digit, so nothing is divided or rounded
    before the last merge.
    """
    units = _units(df, name)
    if units is None:
        raise TypeError(f"{name} is no whole number or decimal of at most 18 digits")
    high, low = _long_parts(units[0])
    totals = (F.sum(high), F.sum(low), F.count(name))
    return [total.alias(f"{name}_{part}") for total, part in zip(totals, PARTS, strict=True)]


def merged_sum(name: str, kind: T.DataType) -> Column:
    """The sum of a column of type ``kind`` from rows of its parts."""
    total = _joined_parts(F.sum(f"{name}_high"), F.sum(f"{name}_low"))
    return _scaled(total, kind.scale if isinstance(kind, T.DecimalType) else 0)


def merged_mean(name: str, kind: T.DataType) -> Column:
    total = merged_sum(name, kind).cast("double")
    return total / F.nullif(F.sum(f"{name}_n"), F.lit(0))


def total_money(df: DataFrame, name: str) -> Column:
    """Sum in cents; only the total is rounded, never an addend.

    A decimal for exact amounts, a double for doubles, which may be NaN.
    """
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.round(exact_sum(df, name), 2)
    return exact_sum(df, name).cast("decimal(28,2)")


def mean(df: DataFrame, name: str) -> Column:
    """Average as a double from an exact sum; NULL for a group without values."""
    return exact_sum(df, name).cast("double") / F.nullif(F.count(name), F.lit(0))


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def group_mean(df: DataFrame, column: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(mean(df, column).alias(f"avg_{column}"))


def revenue_by_month(
    trips: DataFrame,
    zone: str,
    measures: Sequence[str] = tuple(REVENUE_MEASURES),
    count: str | None = None,
) -> DataFrame:
    """Monthly sums per zone and service, with mean passengers and distance.

    The report's column names, spelling included, are what its readers select.
    """
    totals = [
        total_money(trips, m).alias(f"revenue_monthly_{REVENUE_MEASURES[m]}") for m in measures
    ]
    counts = [F.count(count).alias("total_monthly_trips")] if count else []
    return trips.groupBy(
        F.col(zone).alias("revenue_zone"),
        truncate("month", "pickup_datetime").alias("revenue_month"),
        "service_type",
    ).agg(
        *totals,
        *counts,
        *(mean(trips, m).alias(f"avg_montly_{m}") for m in MEANS),
    )


def revenue_parts_by_day(
    trips: DataFrame,
    zone: str,
    measures: Sequence[str] = tuple(REVENUE_MEASURES),
    count: str = "tripid",
) -> DataFrame:
    """Daily parts of the monthly report, per zone and service, to be merged by month."""
    parts = [p for m in (*measures, *MEANS) for p in sum_parts(trips, m)]
    return trips.groupBy(
        F.col(zone).alias("revenue_zone"),
        truncate("day", "pickup_datetime").alias("revenue_day"),
        "service_type",
    ).agg(*parts, F.count(count).alias("trips"))


def revenue_by_month_of_parts(
    parts: DataFrame,
    types: dict[str, T.DataType],
    measures: Sequence[str] = tuple(REVENUE_MEASURES),
) -> DataFrame:
    """The monthly report from daily parts: they are added, then divided and rounded.

    ``types`` are those of the columns the parts were made of.
    """
    totals = [
        merged_sum(m, types[m]).cast("decimal(28,2)").alias(
            f"revenue_monthly_{REVENUE_MEASURES[m]}"
        )
        for m in measures
    ]
    return parts.groupBy(
        "revenue_zone",
        truncate("month", "revenue_day").alias("revenue_month"),
        "service_type",
    ).agg(
        *totals,
        F.sum("trips").alias("total_monthly_trips"),
        *(merged_mean(m, types[m]).alias(f"avg_montly_{m}") for m in MEANS),
    )


def revenue_by_hour(
    trips: DataFrame, zone: str, amount: str, ts: str = "pickup_datetime"
) -> DataFrame:
    """Hourly revenue and record count per zone. NULL amounts add nothing."""
    return trips.groupBy(
        truncate("hour", ts).alias("hour"), F.col(zone).alias("zone")
    ).agg(total_money(trips, amount).alias("amount"), F.count("*").alias("number_records"))


def hourly_service_columns(
    trips: DataFrame,
    zone: str,
    amount: str,
    services: Sequence[str],
    ts: str = "pickup_datetime",
    service: str = "service_type",
) -> DataFrame:
    """Hourly revenue with one pair of columns per service, in one pass.

    Equal to aggregating each service alone and merging with a full outer join,
    but with one scan, one shuffle and no join. The merge never matches NULL
    keys, so rows with one are also grouped by their service.
    """
    hour = truncate("hour", ts)
    services = list(services)
    trips = trips.withColumns(
        {f"_amount_{n}": F.when(F.col(service) == n, F.col(amount)) for n in services}
    )
    apart = F.when(F.col(zone).isNull() | hour.isNull(), F.col(service))
    pairs = []
    for name in services:
        mine = F.col(service) == name
        suffix = name.lower()
        pairs += [
            total_money(trips, f"_amount_{name}").alias(f"revenue_hourly_total_amount_{suffix}"),
            F.nullif(F.count_if(mine), F.lit(0)).alias(f"number_records_{suffix}"),
        ]
    return (
        trips.filter(F.col(service).isin(services))
        .groupBy(
            F.col(zone).alias("revenue_zone"), hour.alias("revenue_hour"), apart.alias("_apart")
        )
        .agg(*pairs)
        .drop("_apart")
    )
