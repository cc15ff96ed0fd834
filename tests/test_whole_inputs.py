"""Queries over every trip: no month and no payment type is left out."""

from tripflow.sources import supplied
from tripflow.verify.queries import run


def test_descriptions_of_marts_over_all_trips(spark, sf):
    found = {r.row_count for r in run("mart_descriptions", spark, sf).collect()}
    assert found == {26, run("monthly_zone_revenue", spark, sf).count()}


def test_files_of_all_months(spark, sf):
    found = run("registered_months", spark, sf).collect()
    assert sum(r["count"] for r in found) == supplied.raw_green(spark, sf).count()
    assert len({(r.year, r.month) for r in found}) > 6
