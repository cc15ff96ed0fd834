"""Near copies between the pipeline's threshold and that of op 5."""

import numpy as np
from test_dedup import near_by_hand, shingles

import corpus_pipeline
from tripflow.llm.near_dedup import near_duplicates


def test_pipeline_stage_takes_near_copies_of_0_8(spark, tmp_path):
    """Two of 100 words changed far apart: 86 of 106 shingles are common, 0.81."""
    draw = np.random.default_rng(8)
    texts = []
    for i in range(120):
        words = [f"t{i}w{x}" for x in draw.integers(0, 5000, 100)]
        texts.append(" ".join(words))
        for at in (30, 60, 90)[: i % 3 + 1]:
            words[at] = f"new{i}"
        texts.append(" ".join(words))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    sets = [shingles(t) for t in texts]
    at_80, at_85 = near_by_hand(sets, 80), near_by_hand(sets, 85)
    assert len(set(at_80)) == 160 and len(set(at_85)) == 200
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, str(tmp_path)).collect()}
    assert kept == set(at_80)
    assert {r.doc_id: r.component_id for r in near_duplicates(docs).collect()} == dict(enumerate(at_85))
