"""Text operators start their shuffles by the size of the table they read."""

import os

import pytest

import corpus_pipeline
from tripflow import session
from tripflow.llm.queries import QUERIES

KEY = "spark.sql.shuffle.partitions"


@pytest.mark.parametrize("name, table", [("op6_sharding", "documents"), ("op7_top_k", "embeddings")])
def test_shuffles_follow_the_table_and_return(spark, sf, monkeypatch, name, table):
    own = spark.conf.get(KEY)
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 5000)
    QUERIES[name](spark, sf)
    size = os.path.getsize(f"{sf}/{table}.parquet")
    assert int(spark.conf.get(KEY)) == -(-size // 5000) > int(own)
    monkeypatch.undo()
    QUERIES[name](spark, sf)
    assert spark.conf.get(KEY) == own


def test_stages_follow_what_they_read(spark, sf, documents, monkeypatch):
    own = spark.conf.get(KEY)
    monkeypatch.setattr(session, "SHUFFLE_BYTES", 5000)
    dict(corpus_pipeline.STAGES)["exact_dedup"](spark, documents, sf)
    assert int(spark.conf.get(KEY)) == -(-os.path.getsize(f"{sf}/documents.parquet") // 5000)
    monkeypatch.undo()
    dict(corpus_pipeline.STAGES)["exact_dedup"](spark, documents, sf)
    assert spark.conf.get(KEY) == own
