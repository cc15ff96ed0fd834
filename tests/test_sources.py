import datetime as dt
import os
from unittest.mock import MagicMock

import pytest
from helpers import plan, rows, ts
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.plans import jobs
from tripflow.schemas import HIGH_VOLUME_SCHEMA, ZONE_SCHEMA
from tripflow.session import (
    MAX_SHUFFLE_PARTITIONS,
    SHUFFLE_BYTES,
    build_session,
    fresh_dir,
    fresh_name,
    shared_root,
    shuffle_partitions,
    size_shuffles,
)
from tripflow.sources import files, relational, tables


def test_month_paths_are_zero_padded_and_whole_years_by_default():
    paths = files.month_paths("lake/", "green", [2021, 2022])
    assert len(paths) == 24
    assert paths[0] == "lake/green_tripdata_2021-01.parquet"
    assert paths[-1] == "lake/green_tripdata_2022-12.parquet"
    assert files.month_paths("lake", "yellow", [2020], [3]) == [
        "lake/yellow_tripdata_2020-03.parquet"
    ]


def test_glob_and_column_pruned_scan(spark, tmp_path):
    for month in (1, 2):
        spark.range(month).selectExpr("id", "id AS other").write.parquet(f"{tmp_path}/green_{month}")
    df = files.read_parquet(spark, f"{tmp_path}/green_*").select("id").filter("id = 1")
    assert rows(df) == [(1,)]
    text = plan(df)
    assert "ReadSchema: struct<id:bigint>" in text and "EqualTo(id,1)" in text


def test_drifting_files_of_a_scheme_that_only_spark_opens(spark, tmp_path):
    """Types change twice along the names; some files lack a column. Few looks, not one per file."""
    frames = ["cast(id AS bigint) AS n", "cast(id AS double) AS n, 'x' AS c", "id AS n, 'y' AS c"]
    for i in range(24):
        one = spark.range(i, i + 1).selectExpr(*frames[i // 10].split(", "))
        one.coalesce(1).write.parquet(f"{tmp_path}/in/m{i:02d}.parquet")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.drift.link./in", f"file://{tmp_path}/in")
    types = {"n": T.IntegerType(), "c": T.StringType()}
    looks, merge = [], files._mergeable_runs

    def watched(session, paths):
        looks.append(len(paths))
        return merge(session, paths)

    files._mergeable_runs = watched
    try:
        out = files.read_drifting_parquet(spark, ["viewfs://drift/in"], types)
        found = sorted((r.n, r.c) for r in out.collect())
    finally:
        files._mergeable_runs = merge
    assert found == [(i, [None, "x", "y"][i // 10]) for i in range(24)]
    assert sum(looks[:1]) == 24 and len(looks) < 20
    assert rows(out) == rows(files.read_drifting_parquet(spark, [f"{tmp_path}/in"], types))


def test_drifting_months_share_one_scan_per_schema(spark, tmp_path):
    paths = files.month_paths(str(tmp_path), "green", [2020], range(1, 5))
    one = spark.createDataFrame([(1, "a")], "Passengers long, flag string")
    other = spark.createDataFrame([(2.0,)], "passengers double")
    for path, frame in zip(paths, (one, other, one, other)):
        frame.write.parquet(path)
    types = {"passengers": T.IntegerType(), "flag": T.StringType()}
    df = files.read_drifting_parquet(spark, paths, types)
    assert df.columns == ["passengers", "flag"]
    assert df.schema["passengers"].dataType == T.IntegerType()
    assert sorted(rows(df), key=repr) == [(1, "a"), (1, "a"), (2, None), (2, None)]
    assert plan(df).count("Location: InMemoryFileIndex") == 2
    one.write.parquet(f"{tmp_path}/mixed")
    other.write.mode("append").parquet(f"{tmp_path}/mixed")
    wider = files.read_drifting_parquet(
        spark, [f"{tmp_path}/mixed"], {**types, "fee": T.DecimalType(18, 2)}
    )
    assert wider.schema["fee"].dataType == T.DecimalType(18, 2)
    assert sorted(rows(wider), key=repr) == [(1, "a", None), (2, None, None)]
    with pytest.raises(ValueError):
        files.read_drifting_parquet(spark, [], types)


def test_csv_is_all_strings_without_a_schema(spark, tmp_path):
    (tmp_path / "z.csv").write_text('"locationid","borough","zone","service_zone"\n1,"EWR","N","EWR"\n')
    assert set(files.read_csv(spark, str(tmp_path)).dtypes) == {
        (n, "string") for n in ZONE_SCHEMA.names
    }
    seed = files.load_seed(spark, str(tmp_path), fresh_name("seed"))
    assert rows(seed) == [(1, "EWR", "N", "EWR")] and seed.schema["locationid"].dataType == T.IntegerType()


def test_explicit_schema_scan(spark, tmp_path):
    spark.createDataFrame([], HIGH_VOLUME_SCHEMA).write.parquet(f"{tmp_path}/h")
    assert files.read_parquet(spark, f"{tmp_path}/h", schema=HIGH_VOLUME_SCHEMA).schema.names == (
        HIGH_VOLUME_SCHEMA.names
    )


def test_write_modes_and_file_count(spark, tmp_path):
    df, path = spark.range(100), f"{tmp_path}/out"
    files.write_parquet(df, path, files=4)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 4
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_parquet(df, path)
    files.write_parquet(spark.range(3), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_source_registry(spark):
    registry = files.SourceRegistry()
    registry.register("staging", "green", lambda: spark.range(2))
    assert registry.source("staging", "green").count() == 2
    with pytest.raises(KeyError):
        registry.source("staging", "blue")


def test_relational_writes_go_through_executors_in_batches():
    options = relational.write_options(
        relational.postgres_url("db", 5432, "lake"), "trips", {"user": "u"}, connections=3
    )
    assert options == {
        "user": "u",
        "url": "jdbc:postgresql://db:5432/lake",
        "dbtable": "trips",
        "batchsize": "100000",
        "numPartitions": "3",
    }
    df = MagicMock()
    relational.replace_and_load(df, options)
    df.limit.assert_called_once_with(0)
    empty = df.limit.return_value.write.format.return_value.options.return_value
    empty.mode.assert_called_once_with("overwrite")
    whole = df.write.format.return_value.options.return_value
    whole.mode.assert_called_once_with("append")
    assert not df.collect.called and not df.toPandas.called


def test_relational_parallel_read_options():
    spark = MagicMock()
    relational.read(spark, "jdbc:x", "t", split_on="id", lower=0, upper=9, connections=2)
    _, given = spark.read.format.return_value.options.call_args
    assert given["partitionColumn"] == "id" and given["numPartitions"] == "2"


def test_external_table_survives_its_drop(spark, tmp_path):
    path, name = f"{tmp_path}/ext", fresh_name("ext")
    spark.range(5).write.parquet(path)
    assert tables.create_external(spark, name, path).count() == 5
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    assert spark.read.parquet(path).count() == 5


def test_external_view_over_several_globs(spark, tmp_path):
    for year in (2019, 2020):
        (tmp_path / f"y_{year}-01.csv").write_text(f"a,b\n{year},x\n")
    view = tables.create_external_view(
        spark,
        "external_trips",
        [f"{tmp_path}/y_2019-*.csv", f"{tmp_path}/y_2020-*.csv"],
        schema=T.StructType.fromDDL("a int, b string"),
        header="true",
    )
    assert rows(view) == [(2019, "x"), (2020, "x")]
    assert spark.sql("SELECT count(*) FROM external_trips").first()[0] == 2


def test_typed_table_and_descriptions(spark, tmp_path):
    name = fresh_name("typed")
    df = spark.createDataFrame([(1, 2.5)], "id long, fare double")
    described = tables.describe(df, {"fare": "metered fare"})
    tables.create_table(described, name, f"{tmp_path}/t")
    tables.comment_on(spark, name, "each row's a trip")
    columns = {c.name: c.description for c in spark.catalog.listColumns(name)}
    assert columns["fare"] == "metered fare"
    assert spark.catalog.getTable(name).description == "each row's a trip"
    typed = tables.create_table(df, fresh_name("t"), f"{tmp_path}/u", {"id": T.StringType()})
    assert typed.dtypes == [("id", "string")]


def trips(spark):
    return spark.createDataFrame(
        [
            (1, ts("2020-05-31 23:59:59")),
            (1, ts("2020-06-01 00:00:00")),
            (2, ts("2020-06-30 23:59:59.999999")),
            (2, ts("2020-07-01 00:00:00")),
            (3, None),
        ],
        "vendor int, t timestamp_ntz",
    )


@pytest.mark.parametrize("grain, partitions", [("day", 5), ("month", 4)])
def test_dated_table_includes_both_ends_and_prunes(spark, tmp_path, grain, partitions):
    table = tables.create_dated_table(
        trips(spark), fresh_name("dated"), "t", ("vendor",), f"{tmp_path}/d", grain=grain
    )
    june = table.between(spark, dt.date(2020, 6, 1), dt.date(2020, 6, 30))
    assert rows(june.select("vendor")) == [(1,), (2,)]
    assert june.columns == ["vendor", "t"]
    text = plan(june)
    assert "PartitionFilters: [isnotnull(partition_date" in text
    assert "GreaterThanOrEqual(t,2020-06-01" in text
    counts = {r.partition_id: r.total_rows for r in table.partition_counts(spark).collect()}
    assert len(counts) == partitions and counts[None] == 1 and sum(counts.values()) == 5
    assert table.read(spark).count() == 5


def test_partition_counts_read_no_data_column(spark, tmp_path):
    table = tables.create_dated_table(trips(spark), fresh_name("d"), "t", path=f"{tmp_path}/d")
    text = plan(table.partition_counts(spark))
    assert "_partition_rows" in text and "partition_date" not in text


def test_cluster_columns_are_sorted_inside_files(spark, tmp_path):
    df = spark.range(2000).selectExpr(
        "cast(id * 7919 % 50 AS int) AS vendor", "timestamp_ntz'2020-01-01 00:00:00' AS t"
    )
    table = tables.create_dated_table(df, fresh_name("c"), "t", ("vendor",), f"{tmp_path}/c")
    order = [r.vendor for r in table.read(spark).coalesce(1).collect()]
    assert order == sorted(order)


def test_a_hot_date_is_split_over_several_tasks(spark, tmp_path):
    """Rebalancing splits a date too big for one task instead of making a straggler."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(0, 60_000, 1, 8).select(
            F.expr("timestamp_ntz'2020-01-01 00:00:00'").alias("t"), F.sha2(F.col("id").cast("string"), 256).alias("x")
        )
        tables.create_dated_table(df, fresh_name("hot"), "t", path=f"{tmp_path}/hot")
    finally:
        for key in settings:
            spark.conf.unset(key)
    folder = f"{tmp_path}/hot/partition_date=2020-01-01"
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) > 1
    assert spark.read.parquet(f"{tmp_path}/hot").count() == 60_000


def test_unknown_grain_is_refused(spark):
    with pytest.raises(ValueError):
        tables.create_dated_table(trips(spark), "x", "t", grain="week")


def test_load_job_drops_its_external_table(spark, tmp_path):
    trips(spark).write.parquet(f"{tmp_path}/lake")
    name = fresh_name("green")
    table = jobs.load_dated(spark, f"{tmp_path}/lake", name, "t", path=f"{tmp_path}/dated")
    assert table.read(spark).count() == 5
    assert not spark.catalog.tableExists(f"{name}_external")
    assert spark.read.parquet(f"{tmp_path}/lake").count() == 5


def test_work_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "a") != fresh_dir(spark, "a")
    cluster = MagicMock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.master = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(cluster)


def test_shuffle_setting_returns_after_a_large_input(spark, sf):
    from tripflow.verify.queries import run

    key = "spark.sql.shuffle.partitions"
    own = spark.conf.get(key)
    size_shuffles(spark, 1000 * SHUFFLE_BYTES)
    assert spark.conf.get(key) == "1000"
    size_shuffles(spark, 2000 * SHUFFLE_BYTES, at_most=1500)
    assert spark.conf.get(key) == "1500"
    run("dim_zones", spark, sf)
    assert spark.conf.get(key) == own


def test_shuffle_partitions_follow_the_input(spark, tmp_path):
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(10 * SHUFFLE_BYTES + 1, 8) == 11
    assert shuffle_partitions(100 * 2**40, 8) == MAX_SHUFFLE_PARTITIONS
    before = spark.conf.get("spark.sql.shuffle.partitions")
    size_shuffles(spark, 1)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_stored_bytes_come_from_the_listing(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "a.bin").write_bytes(b"12345")
    (tmp_path / "deep" / "er" / "b.bin").write_bytes(b"123")
    assert files.stored_bytes(spark, str(tmp_path / "deep")) == 8


def test_object_store_settings_reach_the_session(spark):
    session = build_session("again", hadoop={"fs.demo.impl": "x.Y"})
    assert session.conf.get("spark.hadoop.fs.demo.impl") == "x.Y"
    session.conf.unset("spark.hadoop.fs.demo.impl")
