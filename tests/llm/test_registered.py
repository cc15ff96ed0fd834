"""Registered queries against their SQL, and the pipeline stage by stage."""

import re

import numpy as np
import pytest
from compare import difference, spark_frame, sql_frame

import __spark_entry__ as entry
import corpus_pipeline
from tripflow.llm.queries import ORACLE, QUERIES


def test_each_operator_is_registered():
    names = entry.queries()
    assert set(QUERIES) <= set(names) and "pipeline" in names
    for n in range(1, 14):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf, name):
    assert difference(spark_frame(QUERIES[name](spark, sf)), sql_frame(ORACLE[name], sf)) == ""


def run_stages(spark, docs, folder, tmp_path):
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], folder).write.parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.parquet(f"{tmp_path}/{name}"))
    return tables


def test_pipeline_stages(spark, sf, documents, tmp_path):
    read, language, exact, near, mixed, packed = run_stages(spark, documents, sf, tmp_path)
    for table in (language, exact, near, mixed):
        assert table.schema.names == read.schema.names
        assert dict(table.dtypes) == dict(read.dtypes)
    texts = {r.doc_id: r.text for r in read.collect()}
    letters = {i for i, t in texts.items() if any(c.isalpha() for c in t)}
    kept = {r.doc_id for r in language.collect()}
    assert kept <= letters and len(kept) >= 0.99 * len(letters)
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", "", t)
    unique = [normal(r.text) for r in exact.collect()]
    assert sorted(unique) == sorted({normal(texts[i]) for i in kept})
    assert near.count() <= exact.count()
    assert all(r.text == texts[r.doc_id] for r in near.collect())
    assert all(r.n_chars == len(r.text) for r in mixed.collect())
    assert mixed.select("doc_id").distinct().count() <= near.count()
    ids = {r.doc_id for r in packed.collect()}
    assert ids == {r.doc_id for r in mixed.collect()}
    whole = packed.groupBy("sequence_id").sum("length").collect()
    assert np.max([r[1] for r in whole]) <= 4096


def test_pipeline_of_odd_rows_and_of_none(spark, sf, odd, empty, tmp_path):
    *_, mixed, packed = run_stages(spark, odd, sf, tmp_path / "odd")
    assert mixed.columns == odd.columns and packed.count() > 0
    *_, none = run_stages(spark, empty, sf, tmp_path / "empty")
    assert none.count() == 0
