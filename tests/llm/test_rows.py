"""Row ids stay with their rows when Spark cuts a table anew between two scans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripflow.llm import exact_dedup, line_dedup, mixing, near_dedup, quality, warc
from tripflow.llm.common import with_row

SPLITS = "spark.sql.files.minPartitionNum"


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    """Eight files, read as one partition or as eight."""
    draw = np.random.default_rng(4)
    rows = []
    for i in range(64):
        words = [f"w{x}" for x in draw.integers(0, 400, 60 + i)]
        rows.append((" ".join(words), f"s{i % 3}"))
        words[5] = "other"
        rows.append((" ".join(words[:30]) + "\n" + " ".join(words[30:]), f"s{i % 3}"))
    rows = [(int(i), *rows[x]) for i, x in enumerate([*draw.permutation(128), *range(32)])]
    path = str(tmp_path_factory.mktemp("rows") / "docs")
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    frame.repartition(8, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


def scored(docs, tmp_path):
    labels = docs.select("doc_id", (F.length("text") > 400).alias("quality"))
    found = quality.score_quality(docs, labels, F.col("source"), F.lit("p")).drop("row")
    return found.select("doc_id", F.round("document_score", 6), F.round("score", 6))


def archived(docs, tmp_path):
    path = f"{tmp_path}/{docs.sparkSession.conf.get(SPLITS, '0')}"
    warc.write_archives(docs, path, id_col="doc_id", url_col="source", payload_col="text")
    found = warc.resolved_records(warc.read_archives(docs.sparkSession, path))
    assert found.filter("NOT digest_matches").count() == 0
    return found


CASES = {
    "exact": (exact_dedup, lambda docs, _: exact_dedup.keep_first_texts(docs)),
    "near": (near_dedup, lambda docs, _: near_dedup.keep_one_of_each(docs)),
    "lines": (line_dedup, lambda docs, _: line_dedup.without_repeated_lines(docs)),
    "mixing": (mixing, lambda docs, _: mixing.Mix(docs, block_words=16).texts()),
    "quality": (quality, scored),
    "archives": (warc, archived),
}


def splits(docs, count):
    docs.sparkSession.conf.set(SPLITS, str(count))
    return docs.select("doc_id").rdd.getNumPartitions()


@pytest.mark.parametrize("case", CASES)
def test_scans_may_be_cut_differently(spark, docs, monkeypatch, tmp_path, case):
    module, made = CASES[case]
    assert splits(docs, 1) < splits(docs, 64)
    try:
        spark.conf.set(SPLITS, "64")
        expected = sorted(map(repr, made(docs, tmp_path).collect()))
        kept, turn = module.stored, []

        def cut_anew(df, label):
            out = kept(df, label)
            turn.append(label)
            spark.conf.set(SPLITS, "1" if len(turn) % 2 else "64")
            return out

        for other in (0, 1):
            turn[:] = [""] * other
            spark.conf.set(SPLITS, "1" if other else "63")
            monkeypatch.setattr(module, "stored", cut_anew)
            found = made(docs, tmp_path / str(other))
            spark.conf.set(SPLITS, "1" if other else "64")
            assert sorted(map(repr, found.collect())) == expected
    finally:
        spark.conf.unset(SPLITS)


def test_rows_are_distinct_and_the_same_in_every_scan(spark, docs):
    try:
        spark.conf.set(SPLITS, "1")
        one = {r.doc_id: r.row for r in with_row(docs).collect()}
        spark.conf.set(SPLITS, "64")
        many = {r.doc_id: r.row for r in with_row(docs.filter("doc_id >= 0").select("doc_id")).collect()}
    finally:
        spark.conf.unset(SPLITS)
    assert one == many and len(set(one.values())) == docs.count()
