"""Language identification and quality."""

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tripflow.llm import language, quality
from tripflow.llm.language import Model, Pieces, Scorer, expected_counts, identify, keep_identified
from tripflow.llm.quality import Classifier, score_quality

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SMALL = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba", "bab", "aé"]


def segmentations(word):
    """All ways to cut the marked word, each a list of strings."""
    text = "▁" + word
    for n in range(len(text)):
        for cuts in combinations(range(1, len(text)), n):
            yield [text[i:j] for i, j in zip((0, *cuts), (*cuts, len(text)), strict=True)]


def chance_of(word, known, chances, lang):
    place = {p: i for i, p in enumerate(known.pieces)}
    total = 0.0
    for parts in segmentations(word):
        p = 1.0
        for part in parts:
            if part in place:
                p *= chances[place[part], lang]
            else:
                p *= chances[len(known.pieces), lang] if len(part) == 1 else 0.0
        total += p
    return total


@pytest.fixture(scope="module")
def small():
    known = Pieces(SMALL)
    draw = np.random.default_rng(0).random((len(known), 2)) * 0.2
    return known, np.vstack([draw, np.zeros(2)])


def test_forward_sums_all_segmentations(small):
    known, chances = small
    words = ["a", "ab", "abab", "bab", "aéb", "zab"]
    logs, counts = Scorer(Model(["x", "y"], chances, SMALL)).texts(pa.array([*words, "", "ab 1 ab"]))
    for i, word in enumerate(words):
        for lang in (0, 1):
            assert math.isclose(logs[i, lang], math.log(chance_of(word, known, chances, lang)))
    assert logs[-2].tolist() == [0, 0] and counts.tolist() == [1] * 6 + [0, 2]
    assert math.isclose(logs[-1, 0], 2 * math.log(chance_of("ab", known, chances, 0)))


def test_expected_counts_are_those_of_the_posterior(small):
    known, chances = small
    found = expected_counts(known, ["abab", "ab"], np.array([0, 1]), np.array([3.0, 1.0]), chances)
    place = {p: i for i, p in enumerate(known.pieces)}
    expected = np.zeros_like(found)
    for word, lang, n in (("abab", 0, 3.0), ("ab", 1, 1.0)):
        whole = chance_of(word, known, chances, lang)
        for parts in segmentations(word):
            if all(p in place for p in parts):
                p = n * np.prod([chances[place[x], lang] for x in parts]) / whole
                for x in parts:
                    expected[place[x], lang] += p
    assert np.allclose(found, expected)


def test_words_of_any_length_are_scored_whole(small):
    known, chances = small
    scorer = Scorer(Model(["x", "y"], chances, SMALL))
    logs, _ = scorer.texts(pa.array(["ab" * 500, "ab" * 20]))
    assert np.allclose(logs[0], 25 * logs[1])


def test_languages_of_held_out_documents(documents):
    found = identify(documents, VOCABULARY).collect()
    truth = {r.doc_id: r.lang for r in documents.collect()}
    assert len(found) == len(truth)
    held = [r for r in found if r.held_out]
    assert len(held) > 30
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_odd_texts_and_missing_labels(odd, empty):
    found = identify(odd, VOCABULARY).collect()
    assert len(found) == odd.count()
    und = {r.doc_id for r in found if r.lang_pred == "und"}
    assert und == {4, 5, 6, 14, None}
    assert all(r.score == 0 for r in found if r.lang_pred == "und")
    assert identify(empty, VOCABULARY).count() == 0
    blind = identify(odd.withColumn("lang", F.lit(None).cast("string")), VOCABULARY)
    assert {r.lang_pred for r in blind.collect()} == {"und"}
    kept = keep_identified(odd, VOCABULARY)
    assert kept.columns == odd.columns and {4, 5, 6, 14}.isdisjoint(r.doc_id for r in kept.collect())


def test_held_out_labels_teach_nothing(documents):
    """Wrong labels on held-out documents change no prediction."""
    wrong = documents.withColumn(
        "lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))
    )
    a = {(r.doc_id, r.lang_pred) for r in identify(documents, VOCABULARY).collect()}
    b = {(r.doc_id, r.lang_pred) for r in identify(wrong, VOCABULARY).collect()}
    assert a == b


def test_quality_of_held_out_documents(spark, sf, documents):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    usable = ~language.held_out(F.col("doc_id"))
    scored = score_quality(documents, labels, F.col("source"), F.col("lang"), usable=usable)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = scored.filter(~usable).collect()
    known = [(r.kept, truth[r.doc_id]) for r in rows if r.doc_id in truth]
    assert len(known) > 10 and np.mean([k == bool(t) for k, t in known]) >= 0.8
    assert scored.count() == documents.count()


def test_site_posteriors_equal_a_computation_by_hand(spark, tmp_path):
    hosts = ["big"] * 60 + ["small"] * 3 + [None]
    goods = [i % 4 != 0 for i in range(60)] + [False, False, True, None]
    rows = [(i, f"word {i}", h, "p" if i % 2 else "q") for i, h in enumerate(hosts)]
    spark.createDataFrame(rows, "doc_id long, text string, host string, path string").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    labels = spark.createDataFrame(
        [(i, int(g)) for i, g in enumerate(goods) if g is not None] + [(None, 1), (999, 0)],
        "doc_id long, quality int",
    )
    got = {r.doc_id: r for r in score_quality(docs, labels, F.col("host"), F.col("path")).collect()}
    n, good = 63, sum(map(bool, goods))
    prior = good / n
    by_host = {"big": (60, 45), "small": (3, 1), "": (0, 0)}
    spread = sum(m * (g / m - prior) ** 2 for m, g in by_host.values() if m)
    noise = prior * (1 - prior)
    between = (spread - 2 * noise) / (n - (60**2 + 3**2) / n)
    strength = min(max(noise / between - 1 if between > 0 else 1e6, 1), 1e6)
    for doc_id, host in ((0, "big"), (60, "small"), (63, "")):
        m, g = by_host[host]
        own = goods[doc_id]
        m, g = (m, g) if own is None else (m - 1, g - own)
        assert math.isclose(got[doc_id].host_posterior, (g + prior * strength) / (m + strength))
    assert got[60].host_posterior < got[63].host_posterior  # sparse, but shrunk only so far
    assert math.isclose(got[63].path_posterior, got[63].host_posterior)


def test_quality_of_odd_rows_and_without_labels(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    for labels in (none, spark.createDataFrame([(1, 1), (1, 0), (7, None), (14, 0)], "doc_id long, quality int")):
        found = score_quality(odd, labels, F.col("source"), F.col("lang")).collect()
        assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert score_quality(empty, none, F.col("source"), F.col("lang")).count() == 0
    assert all(math.isclose(r.score, 0.5) for r in score_quality(odd, none, F.lit("a"), F.lit("b")).collect())


def test_classifier_separates_and_knows_nothing_without_labels():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, len(quality.FEATURES)))
    y = (x[:, 0] + 0.1 * draw.normal(size=400) > 0).astype(float)
    assert ((Classifier.fitted(x, y).log_odds(x) > 0) == y).mean() > 0.95
    assert Classifier.fitted(x[:0], y[:0]).log_odds(x[:3]).tolist() == [0, 0, 0]
