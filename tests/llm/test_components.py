"""The test for a fixpoint, on more edges than a sum of 40 bits each fits in a long."""

from tripflow.llm import components


def test_fixpoint_of_many_edges(spark, monkeypatch):
    many = spark.range(1 << 25).selectExpr("id + 1 AS node", "0L AS other")
    monkeypatch.setattr(components, "stored", lambda df, label: many)
    monkeypatch.setattr(components, "_large_star", lambda pairs, label: pairs)
    monkeypatch.setattr(components, "_small_star", lambda pairs, label: pairs)
    found = components.connected_components(many)
    assert found.filter("component = 0").count() == (1 << 25) + 1


def test_another_table_of_equal_size_has_another_print(spark):
    """A chain takes several rounds that keep the number of edges."""
    edges = [(i, i + 1) for i in range(50)]
    found = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {(r.node, r.component) for r in found.collect()} == {(i, 0) for i in range(51)}
