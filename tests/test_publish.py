"""Marts appear only after their checks; dated tables keep their row counts beside them."""

import datetime as dt
import os

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F
from test_plans import green, supplied_shape, zone_frame

from tripflow.operators.quality import QualityError
from tripflow.plans import jobs, marts
from tripflow.plans.staging import stage
from tripflow.session import fresh_name
from tripflow.sources import publish, tables

NAMES = ("dim_zones", "fact_trips", "monthly_zone_revenue")


def trips(spark, *raw):
    return stage(supplied_shape(spark, *raw))


def published(spark, output, prefix):
    if prefix is None:
        return {n: rows(spark.read.parquet(f"{output}/{n}")) for n in NAMES}
    return {n: rows(spark.table(f"{prefix}{n}")) for n in NAMES}


@pytest.mark.parametrize("catalog", [False, True])
def test_staging_is_shuffled_once_for_fact_and_checks(spark, tmp_path, monkeypatch, catalog):
    output, prefix = str(tmp_path / "out"), f"{fresh_name('m')}_" if catalog else None
    plans, report = [], jobs.quality_report
    monkeypatch.setattr(jobs, "quality_report", lambda df, c: plans.append(plan(df)) or report(df, c))
    jobs.build_marts(trips(spark, green(1.0, 0)), zone_frame(spark), output, tables_prefix=prefix)
    assert plans and not any("Window" in p for p in plans)
    assert not list(tmp_path.rglob("staged"))


@pytest.mark.parametrize("catalog", [False, True])
def test_a_failed_check_leaves_the_old_marts_readable(spark, tmp_path, catalog):
    output, prefix = str(tmp_path / "out"), f"{fresh_name('m')}_" if catalog else None
    zones = zone_frame(spark)
    jobs.build_marts(trips(spark, green(1.0, 0)), zones, output, tables_prefix=prefix)
    before = published(spark, output, prefix)
    assert len(before["fact_trips"]) == 1

    orphan = trips(spark, green(1.0, 0), green(1.0, 1), green(1.0, 2, dropoff=77))
    with pytest.raises(QualityError, match="Green.*nothing was published"):
        jobs.build_marts(orphan, zones, output, tables_prefix=prefix)
    assert published(spark, output, prefix) == before
    held = [t.name for t in spark.catalog.listTables() if prefix and t.name.startswith(prefix)]
    assert sorted(held) == (sorted(f"{prefix}{n}" for n in NAMES) if prefix else [])

    good = trips(spark, green(1.0, 0), green(1.0, 1), green(1.0, 2))
    built = jobs.build_marts(good, zones, output, tables_prefix=prefix)
    after = published(spark, output, prefix)
    assert len(after["fact_trips"]) == 3 and rows(built.fact) == after["fact_trips"]
    assert rows(built.monthly) == after["monthly_zone_revenue"] != before["monthly_zone_revenue"]
    assert built.report.filter("violations > 0 AND severity = 'error'").count() == 0


def test_readers_of_an_old_table_keep_its_files(spark, tmp_path):
    prefix, zones = f"{fresh_name('m')}_", zone_frame(spark)
    jobs.build_marts(trips(spark, green(1.0, 0)), zones, str(tmp_path), tables_prefix=prefix)
    held = spark.read.parquet(tables.location(spark, f"{prefix}fact_trips"))
    jobs.build_marts(
        trips(spark, green(1.0, 0), green(1.0, 5)), zones, str(tmp_path), tables_prefix=prefix
    )
    assert held.count() == 1 and spark.table(f"{prefix}fact_trips").count() == 2
    assert spark.table(f"{prefix}fact_trips").filter("service_type = 'Green'").count() == 2
    assert publish.remove_old_runs(spark, str(tmp_path)) == []
    assert len(publish.remove_old_runs(spark, str(tmp_path), keep=1)) == 1
    assert spark.table(f"{prefix}fact_trips").count() == 2


def test_existing_marts_may_be_an_error(spark, tmp_path):
    zones, prefix = zone_frame(spark), f"{fresh_name('m')}_"
    for name in (None, prefix):
        jobs.build_marts(trips(spark, green(1.0, 0)), zones, f"{tmp_path}/o", "errorifexists", name)
        with pytest.raises(FileExistsError, match="fact_trips"):
            jobs.build_marts(trips(spark, green(1.0, 0)), zones, f"{tmp_path}/o", "errorifexists", name)


def test_a_move_that_fails_puts_the_old_folder_back(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    with pytest.raises(OSError, match="cannot move"):
        publish.replace_folder(spark, f"{tmp_path}/missing", f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3


# Dated tables


def day_rows(spark, *days, n=3, vendor=1):
    data = [(dt.datetime.fromisoformat(d) if d else None, vendor, i) for d in days for i in range(n)]
    return spark.createDataFrame(data, "ts timestamp_ntz, vendor int, i int")


def counts(spark, table):
    found = table.partition_counts(spark)
    assert found.select("table_name").distinct().collect() == [(table.name,)]
    return {r.partition_id: r.total_rows for r in found.collect()}


def test_dates_are_replaced_and_others_stay(spark, tmp_path):
    day = dt.date.fromisoformat
    table = tables.create_dated_table(
        day_rows(spark, "2024-01-01", "2024-01-02", None), fresh_name("t"), "ts", ("vendor",), f"{tmp_path}/t"
    )
    assert counts(spark, table) == {day("2024-01-01"): 3, day("2024-01-02"): 3, None: 3}
    batch = day_rows(spark, "2024-01-02", "2024-01-03", n=5, vendor=2)
    for _ in range(2):
        assert sorted(table.replace_dates(batch)) == [day("2024-01-02"), day("2024-01-03")]
        expected = {day("2024-01-01"): 3, day("2024-01-02"): 5, day("2024-01-03"): 5, None: 3}
        assert counts(spark, table) == expected
        assert rows(table.read(spark)) == rows(
            day_rows(spark, "2024-01-01", None).union(batch)
        )
    assert table.replace_dates(day_rows(spark, None, n=1)) == [None]
    assert counts(spark, table)[None] == 1 and table.read(spark).count() == 14
    assert table.replace_dates(batch.limit(0)) == [] and table.read(spark).count() == 14
    one = table.between(spark, day("2024-01-02"), day("2024-01-02"))
    assert one.count() == 5 and one.columns == ["ts", "vendor", "i"]


def test_command_line_loads_and_reloads(spark, tmp_path, monkeypatch):
    import tripflow.__main__ as cli

    monkeypatch.setattr(cli, "build_session", lambda *_: spark)
    day_rows(spark, "2024-01-01", "2024-01-02").write.parquet(f"{tmp_path}/a")
    day_rows(spark, "2024-01-02", n=1).write.parquet(f"{tmp_path}/b")
    name = fresh_name("cli")
    load = ["load-dated", "--table", name, "--timestamp", "ts", "--cluster_by", "vendor", "--source"]
    cli.main([*load, f"{tmp_path}/a", "--path", f"{tmp_path}/t"])
    cli.main([*load, f"{tmp_path}/b", "--replace_dates"])
    assert sorted(counts(spark, tables.DatedTable(name, "ts")).values()) == [1, 3]


def test_months_are_replaced_whole(spark, tmp_path):
    table = tables.create_dated_table(
        day_rows(spark, "2024-01-01", "2024-02-10"), fresh_name("t"), "ts", path=f"{tmp_path}/t", grain="month"
    )
    assert table.replace_dates(day_rows(spark, "2024-02-28", n=1)) == [dt.date(2024, 2, 1)]
    assert counts(spark, table) == {dt.date(2024, 1, 1): 3, dt.date(2024, 2, 1): 1}


def test_columns_of_a_batch_go_by_name(spark, tmp_path):
    table = tables.create_dated_table(day_rows(spark, "2024-01-01"), fresh_name("t"), "ts", path=f"{tmp_path}/t")
    table.replace_dates(day_rows(spark, "2024-01-01", n=1, vendor=9).select("i", "vendor", "ts"))
    assert rows(table.read(spark)) == [(dt.datetime(2024, 1, 1), 9, 0)]


def test_partition_report_opens_no_data_file(spark, tmp_path):
    """With every data file made unreadable the counts are still there, after a replaced date, too."""
    table = tables.create_dated_table(
        day_rows(spark, "2024-01-01", "2024-01-02"), fresh_name("t"), "ts", path=f"{tmp_path}/t"
    )
    table.replace_dates(day_rows(spark, "2024-01-02", n=7))
    assert sorted(counts(spark, table).values()) == [3, 7]
    for folder, _, names in os.walk(tmp_path / "t"):
        if "partition_date=" in folder:
            for name in names:
                if name.endswith(".parquet"):
                    with open(os.path.join(folder, name), "wb") as broken:
                        broken.write(b"no parquet")
    spark.catalog.refreshTable(table.name)
    assert sorted(counts(spark, table).values()) == [3, 7]
    with pytest.raises(Exception, match="parquet|Parquet"):
        table.read(spark).agg(F.sum("i")).collect()


def test_days_of_a_mart_are_recomputed_alone(spark, tmp_path):
    """A replaced and an added day; files of months that are not touched stay as they are."""
    zones = zone_frame(spark)

    def fact(*hours):
        raw = [green(1.0, i % 60, fare=10.0 + i) for i in range(len(hours))]
        shifted = [(r[0], h, h, *r[3:]) for r, h in zip(raw, hours, strict=True)]
        return marts.fact_trips(trips(spark, *shifted), zones)

    at = [dt.datetime(2020, m, d, h) for m, d, h in ((1, 1, 1), (1, 1, 2), (1, 2, 3), (3, 5, 4), (4, 1, 5))]
    table = jobs.create_daily_marts(fact(at[0], at[2], at[3]), fresh_name("days"), f"{tmp_path}/d")
    march = f"{tmp_path}/d/partition_date=2020-03-01"
    before = sorted(os.listdir(march))
    for batch in (fact(at[0], at[1]), fact(at[4]), fact(at[0], at[1])):
        jobs.update_daily_marts(batch, table)
    assert sorted(os.listdir(march)) == before
    found = {r.revenue_month.month: r.total_monthly_trips for r in jobs.monthly_mart_of_days(table, spark).collect()}
    assert found == {1: 3, 3: 1, 4: 1}
    jobs.update_daily_marts(fact(at[0]).limit(0), table)
    assert jobs.monthly_mart_of_days(table, spark).count() == 3


def test_a_table_others_wrote_is_counted_from_its_files(spark, tmp_path):
    day_rows(spark, "2024-01-01", "2024-01-05").withColumn("partition_date", F.to_date("ts")).write.partitionBy(
        "partition_date"
    ).option("path", f"{tmp_path}/t").saveAsTable("others_table")
    assert sorted(counts(spark, tables.DatedTable("others_table", "ts")).values()) == [3, 3]
    spark.sql("DROP TABLE others_table")


def test_files_of_a_busy_day_hold_ranges_of_their_own(spark, tmp_path):
    """A third of the rows share a day: its files do not overlap in the cluster column."""
    data = spark.range(60_000).selectExpr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(if(id % 3 = 0, 0, cast(id % 90 AS int)), 0, 0, id % 86400)"
        " AS ts",
        "cast(pmod(xxhash64(id), 40) AS int) AS vendor",
        "cast(id AS string) AS text",
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = tables.create_dated_table(data, fresh_name("t"), "ts", ("vendor",), f"{tmp_path}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert rows(table.read(spark).groupBy("vendor").count()) == rows(data.groupBy("vendor").count())
    busy = spark.read.parquet(f"{tmp_path}/t/partition_date=2024-01-01")
    ranges = sorted(
        (r.low, r.high)
        for r in busy.groupBy(F.input_file_name()).agg(F.min("vendor").alias("low"), F.max("vendor").alias("high")).collect()
    )
    assert len(ranges) > 1
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    day = dt.date(2024, 1, 1)
    assert table.between(spark, day, day).count() == data.filter("to_date(ts) = '2024-01-01'").count()
