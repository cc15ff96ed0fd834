"""Every registered query against its SQL over the smallest supplied tables."""

import pytest
from compare import difference, spark_frame, sql_frame

import __spark_entry__ as entry
from tripflow.verify.oracle import ORACLE
from tripflow.verify.queries import QUERIES as REGISTERED

QUERIES = {name: entry.queries()[name] for name in REGISTERED}

# Solved by iteration; test_regression holds them against dense solutions.
WITHOUT_SQL = {"tip_full_predictions", "tip_full_explained", "tip_full_tuning"}


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, name):
    ours = spark_frame(QUERIES[name](spark, sf))
    assert len(ours)
    if name in ORACLE:
        assert difference(ours, sql_frame(ORACLE[name], sf)) == ""


@pytest.fixture(scope="module")
def folders(spark, sf, tmp_path_factory):
    """The supplied tables as folders of several files, as a large table is."""
    root = tmp_path_factory.mktemp("folders")
    for name in ("lineitem", "events", "nation", "region"):
        frame = spark.read.parquet(f"{sf}/{name}.parquet")
        frame.repartition(3).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize(
    "name",
    ["monthly_zone_revenue", "stream_json_events", "external_to_dated_job", "hourly_merge_job"],
)
def test_tables_may_be_folders_of_files(spark, sf, folders, name):
    from_folders = spark_frame(QUERIES[name](spark, folders))
    assert difference(from_folders, spark_frame(QUERIES[name](spark, sf))) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
