import math
import random
from decimal import Decimal

import pytest
from helpers import plan, rows, ts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators import aggregates
from tripflow.operators.aggregates import (
    exact_sum,
    group_count,
    group_mean,
    hourly_service_columns,
    revenue_by_hour,
    total_money,
)
from tripflow.operators.joins import (
    broadcast_if_small,
    join_roles,
    keep_known,
    outer_merge,
    without_parent,
)
from tripflow.plans.marts import hourly_by_service, hourly_revenue, merge_hourly


def test_join_roles_drops_rows_unmatched_in_either_role(spark):
    fact = spark.createDataFrame([(1, 1, 2), (2, 1, 9), (3, None, 1)], "id int, p int, d int")
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "z int, name string")
    out = join_roles(fact, dim, "z", {"from": "p", "to": "d"}, ["name"])
    assert out.columns == ["id", "p", "d", "from_name", "to_name"]
    assert rows(out) == [(1, 1, 2, "one", "two")]


def test_broadcast_hint_only_below_the_bounds(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", "o_orderkey")
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey")
    on = F.col("l_orderkey") == F.col("o_orderkey")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(lines.join(broadcast_if_small(orders), on))
        for bound in ({"max_rows": 100}, {"max_bytes": 1000}):
            assert "SortMergeJoin" in plan(lines.join(broadcast_if_small(orders, **bound), on))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    empty = broadcast_if_small(orders.filter("false"))
    assert lines.join(empty, on).count() == 0


def test_outer_merge_never_matches_null_keys(spark):
    left = spark.createDataFrame([(1, "l1"), (None, "ln")], "k int, a string")
    right = spark.createDataFrame([(1, "r1"), (2, "r2"), (None, "rn")], "k int, b string")
    assert set(rows(outer_merge(left, right, ["k"]))) == {
        (1, "l1", "r1"),
        (2, None, "r2"),
        (None, "ln", None),
        (None, None, "rn"),
    }


def test_keep_known_does_not_multiply_on_repeated_dimension_keys(spark):
    df = spark.createDataFrame([(1,), (3,)], "a int")
    dim = spark.createDataFrame([(1,), (1,)], "b int")
    assert rows(keep_known(df, dim, F.col("a") == F.col("b"))) == [(1,)]


def test_without_parent_counts_rows_and_skips_nulls(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "c int")
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    assert rows(without_parent(child, "c", parent, "p")) == [(9, 2)]


def test_group_count_and_mean(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "k string, x int")
    assert rows(group_count(df, "k")) == [("a", 2), ("b", 1)]
    assert rows(group_mean(df, "x", "k")) == [("a", 1.0), ("b", None)]


TRIPS = "pickup_datetime timestamp_ntz, pulocationid int, total_amount decimal(18,2), service_type string"


def trips(spark):
    data = [
        (ts("2020-01-01 10:05:00"), 1, Decimal("1.10"), "Green"),
        (ts("2020-01-01 10:55:00"), 1, Decimal("2.20"), "Green"),
        (ts("2020-01-01 10:15:00"), 1, Decimal("5.00"), "Yellow"),
        (ts("2020-01-01 11:00:00"), 2, None, "Yellow"),
        (ts("2019-12-31 23:59:59"), 2, Decimal("4.00"), "Green"),
        (None, 1, Decimal("7.00"), "Green"),
        (None, 1, Decimal("8.00"), "Yellow"),
        (ts("2020-01-01 10:00:00"), None, Decimal("9.00"), "Green"),
        (ts("2020-01-01 10:00:00"), None, Decimal("9.50"), "Yellow"),
        (ts("2020-01-01 10:00:00"), 3, Decimal("1.00"), None),
    ]
    return spark.createDataFrame(data, TRIPS)


def test_hourly_revenue_filters_service_and_start(spark):
    got = rows(hourly_revenue(trips(spark), "Green", "2020-01-01 00:00:00"))
    assert set(got) == {
        (ts("2020-01-01 10:00:00"), 1, Decimal("3.30"), 2),
        (ts("2020-01-01 10:00:00"), None, Decimal("9.00"), 1),
    }


def test_hourly_revenue_equals_a_map_reduce_over_rows(spark):
    """The keyed pairwise sum the report replaces, done by hand."""
    totals = {}
    clean = trips(spark).dropna(subset=["pickup_datetime", "total_amount"])
    for row in clean.collect():
        key = (row.pickup_datetime.replace(minute=0, second=0), row.pulocationid)
        amount, count = totals.get(key, (Decimal(0), 0))
        totals[key] = (amount + row.total_amount, count + 1)
    got = {(r.hour, r.zone): (r.amount, r.number_records) for r in
           revenue_by_hour(clean, "pulocationid", "total_amount").collect()}
    assert got == totals


def test_single_pass_merge_equals_the_outer_join(spark):
    df = trips(spark)
    joined = merge_hourly(hourly_revenue(df, "Green"), hourly_revenue(df, "Yellow"))
    single = hourly_by_service(df)
    assert rows(single.select(joined.columns)) == rows(joined)


def test_single_pass_merge_scans_once_and_shuffles_once(spark, sf):
    from tripflow.sources.supplied import event_trips

    text = plan(hourly_by_service(event_trips(spark, sf)))
    assert text.count("Location: InMemoryFileIndex") == 1
    assert "Join" not in text


def test_outer_merge_of_aggregates_adds_no_shuffle(spark, sf):
    from tripflow.sources.supplied import event_trips

    df = event_trips(spark, sf)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(merge_hourly(hourly_revenue(df, "Green"), hourly_revenue(df, "Yellow")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    nodes = [line for line in text.split("\n\n")[0].splitlines() if "Exchange" in line]
    assert len(nodes) == 2


def test_hourly_service_columns_ignores_other_services(spark):
    got = rows(hourly_service_columns(trips(spark), "pulocationid", "total_amount", ["Green"]))
    assert len(got) == 4


def test_exact_sum_of_each_kind(spark):
    df = spark.createDataFrame(
        [("a", 0.1, Decimal("0.10"), 7, Decimal(10) ** 20)] * 3
        + [("a", -5.25, Decimal("-5.25"), -(2**40), Decimal(1)), ("b", None, None, None, None)],
        "k string, x double, m decimal(18,2), n long, big decimal(30,0)",
    )
    got = df.groupBy("k").agg(*(exact_sum(df, c).alias(c) for c in ("x", "m", "n", "big")))
    (a, b) = sorted(got.collect())
    assert (a.x, a.m) == (-4.95, Decimal("-4.95"))
    assert (a.n, a.big) == (21 - 2**40, 3 * 10**20 + 1)
    assert (b.x, b.m, b.n, b.big) == (None,) * 4


def test_exact_sum_does_not_overflow_a_long(spark):
    df = spark.createDataFrame([(2**62,)] * 8, "n long")
    assert df.agg(exact_sum(df, "n")).first()[0] == 2**65


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=20))
def test_exact_sum_equals_integer_arithmetic_for_cents(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double").repartition(4)
    assert df.agg(total_money(df, "x")).first()[0] == sum(cents) / 100


def test_sum_of_doubles_keeps_tiny_addends_and_does_not_depend_on_order(spark):
    tiny = spark.createDataFrame([(4e-7,)] * 10, "x double")
    assert math.isclose(tiny.agg(exact_sum(tiny, "x")).first()[0], 4e-6, rel_tol=1e-12)
    values = [1e13, 1.0, -3.7, 4e-7, 0.1, 1e15, -1e15, 2.5] * 4
    totals = set()
    for seed in range(4):
        mixed = random.Random(seed).sample(values, len(values))
        df = spark.createDataFrame([(v,) for v in mixed], "x double").repartition(seed + 1)
        totals.add(df.agg(exact_sum(df, "x")).first()[0])
    assert len(totals) == 1 and math.isclose(totals.pop(), math.fsum(values), rel_tol=1e-15)


@pytest.mark.parametrize(
    "values", [[1e300, 1.0], [math.inf, 1.0], [-math.inf, 2.0], [math.nan, 1.0], [math.inf, -math.inf]]
)
def test_sum_of_doubles_beyond_whole_numbers_is_the_plain_sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    ours, plain_sum, money = df.agg(exact_sum(df, "x"), F.sum("x"), total_money(df, "x")).first()
    assert ours == plain_sum or math.isnan(ours) and math.isnan(plain_sum)
    assert money == ours or math.isnan(money) and math.isnan(ours)


def test_parts_of_days_give_the_sums_and_means_of_all(spark):
    """High and low parts, NULLs, negative amounts and a group without any value."""
    data = [
        (zone, f"2024-0{1 + i % 2}-1{i % 5} 0{i % 9}:00:00", s, a, p, d)
        for i, (zone, s, a, p, d) in enumerate(
            (z, s, a, p, d)
            for z in ("A", None)
            for s in ("Green", "Yellow")
            for a, p, d in ((9_999_999_999.99, 1, 0.000001), (-0.07, None, 12.5), (None, 3, None)) * 4
        )
    ] + [("B", None, "Green", None, None, None)]
    frame = spark.createDataFrame(
        data, "zone string, pickup_datetime string, service_type string, a double, p int, d double"
    )
    money, distance = T.DecimalType(18, 2), T.DecimalType(18, 6)
    trips = frame.select(
        "zone",
        F.col("pickup_datetime").cast("timestamp_ntz").alias("pickup_datetime"),
        "service_type",
        F.lit("k").alias("tripid"),
        F.col("a").cast(money).alias("fare_amount"),
        F.col("p").alias("passenger_count"),
        F.col("d").cast(distance).alias("trip_distance"),
    )
    whole = aggregates.revenue_by_month(trips, "zone", ["fare_amount"], count="tripid")
    parts = aggregates.revenue_parts_by_day(trips, "zone", ["fare_amount"])
    types = {"fare_amount": money, "passenger_count": T.IntegerType(), "trip_distance": distance}
    merged = aggregates.revenue_by_month_of_parts(parts, types, ["fare_amount"])
    assert parts.count() > merged.count() == 9
    assert rows(merged.select(whole.columns)) == rows(whole)
    with pytest.raises(TypeError, match="no whole number"):
        aggregates.sum_parts(frame, "a")
