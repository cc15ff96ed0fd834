"""Document quality: a classifier's evidence on priors by host and path.

The share of good documents of a path is shrunk towards that of its host, and
the host's towards the whole: a site with few labelled documents gets nearly
the share above it, one with many nearly its own. How strongly follows from
how much shares differ between sites of that level (method of moments). A
document starts from its path's posterior and moves by the evidence of a
classifier that looks at its text alone.

Counts by path are one grouped aggregate that combines before the shuffle;
hosts and the whole are sums of those. A label never counts towards the prior
of its own document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.batches import large_text, slices
from tripflow.llm.common import stored, with_row

FIT_LABELS = 50_000  # expected number of labelled rows the classifier is fitted on
RIDGE = 1.0
LEAST, MOST = 1e-6, 1 - 1e-6

FEATURES = (
    "log_words", "word_length", "upper", "digits", "marks", "symbols", "blanks", "not_ascii",
    "distinct_words", "distinct_pairs", "top_word", "mark_words", "lines", "distinct_lines",
)


def _byte_classes() -> np.ndarray:
    """For each byte: upper, digit, sentence mark, other symbol, blank, not ASCII."""
    table = np.zeros((256, 6))
    for byte in range(256):
        c = chr(byte)
        kinds = (
            "A" <= c <= "Z", "0" <= c <= "9", c in ".,;:!?'\"-()",
            32 < byte < 127 and not c.isalnum() and c not in ".,;:!?'\"-()", c.isspace() and byte < 128,
            byte >= 128,
        )
        table[byte] = kinds
    return table


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text, see ``FEATURES``; zeros for a text without words."""
    classes = _byte_classes()
    out = np.zeros((len(texts), len(FEATURES)))
    lists = pc.ascii_split_whitespace(texts)
    ends = lists.offsets.to_numpy().astype(np.int64)
    ends -= ends[0]
    coded = lists.flatten().dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    words = coded.dictionary.to_pylist()
    size = np.array([len(w) for w in words], np.int64)
    plain = np.array([w.isalnum() for w in words], bool)
    for i, text in enumerate(texts.to_pylist()):
        own = index[ends[i] : ends[i + 1]]
        own = own[size[own] > 0]
        n = len(own)
        if not n:
            continue
        raw = np.frombuffer(text.encode(), np.uint8)
        shares = np.bincount(raw, minlength=256) @ classes / len(raw)
        counts = np.unique(own, return_counts=True)[1]
        pairs = np.unique(own[:-1] * len(words) + own[1:])
        lines = [x for x in text.split("\n") if x.strip()]
        out[i] = (
            np.log(n), size[own].mean(), *shares, len(counts) / n,
            (len(pairs) + 1) / n, counts.max() / n, 1 - plain[own].mean(), np.log(len(lines)),
            len(set(lines)) / len(lines),
        )
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            rows = features(large_text(part.column(1)))
            flat = pa.array(rows.ravel(), pa.float64())
            starts = pa.array(np.arange(0, rows.size + 1, len(FEATURES)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.ListArray.from_arrays(starts, flat)], names=["row", "x"]
            )


@dataclass
class Classifier:
    """Logistic regression on standardised features and their squares."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @staticmethod
    def _wide(z: np.ndarray) -> np.ndarray:
        z = np.clip(z, -6, 6)
        return np.hstack([np.ones((len(z), 1)), z, z * z])

    @classmethod
    def fitted(cls, x: np.ndarray, y: np.ndarray, steps: int = 25) -> Classifier:
        """Newton steps on the penalised likelihood; without labels it knows nothing."""
        if not len(y):
            x = np.zeros((1, len(FEATURES)))
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale = np.where(scale > 1e-9, scale, 1.0)
        wide = cls._wide((x - mean) / scale)
        weights = np.zeros(wide.shape[1])
        penalty = np.full(wide.shape[1], RIDGE)
        penalty[0] = 1e-3
        for _ in range(steps if len(y) else 0):
            p = 1 / (1 + np.exp(-np.clip(wide @ weights, -30, 30)))
            slope = wide.T @ (y - p) - penalty * weights
            curve = (wide * (p * (1 - p))[:, None]).T @ wide + np.diag(penalty)
            move = np.linalg.solve(curve, slope)
            weights += move
            if np.abs(move).max() < 1e-8:
                break
        return cls(mean, scale, weights)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self._wide((x - self.mean) / self.scale) @ self.weights, -30, 30)


def _strength(sites: DataFrame, mean: Column) -> float:
    """Labels that the level above is worth, from how much shares differ between sites.

    ``sites`` has n, good and what ``mean`` needs. The variance between sites is
    what their spread exceeds that of draws with the mean above.
    """
    some = sites.filter("n > 0").withColumn("_mean", mean)
    noise = F.col("_mean") * (1 - F.col("_mean"))
    spread, expected, weight, squares, own = some.agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("_mean"), 2)),
        F.sum(noise),
        F.sum("n"),
        F.sum(F.col("n") * F.col("n")),
        F.sum(F.col("n") * noise),
    ).first()
    if not weight:
        return 1.0
    room = weight - squares / weight
    between = (spread - expected) / room if room > 0 else 0.0
    inside = own / weight
    # Between one label and a million: never all of a site's own, never none of it.
    return float(min(max(inside / between - 1 if between > 0 else 1e6, 1.0), 1e6))


def _posterior(good: Column, n: Column, above: Column, strength: float) -> Column:
    return (good + above * strength) / (n + F.lit(strength))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(LEAST)), F.lit(MOST))
    return F.log(p / (1 - p))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    fit_labels: int = FIT_LABELS,
    least_score: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    usable: Column | None = None,
) -> DataFrame:
    """Probability that each document is good.

    ``host`` and ``path`` name a document's site and the part of it, from the
    columns of ``docs``; null counts as a site of its own. ``usable`` tells
    from ``id_col`` which labels may be learned from (default: all). Repeated
    labels of an id count once, as their mean. Labels that are null or of
    unknown ids teach nothing; without labels every score is one half.

    Returns row, doc_id, host, path, document_score (of the text alone),
    host_posterior, path_posterior, score, kept. ``docs`` must read a stored
    table; extra columns are ignored.
    """
    rows = with_row(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(host.cast("string"), F.lit("")).alias("host"),
            F.coalesce(path.cast("string"), F.lit("")).alias("path"),
            F.col(text_col).alias("text"),
        )
    )
    measured = rows.select("row", "text").mapInArrow(_measured, "row long, x array<double>")
    measured = stored(measured, "quality-features")

    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("doc_id")).agg(
        F.avg(F.col(label_col).cast("double")).alias("good")
    )
    if usable is not None:
        known = known.filter(usable)
    sites = stored(
        rows.select("row", "doc_id", "host", "path").join(stored(known, "quality-labels"), "doc_id", "left"),
        "quality-sites",
    )

    labelled = sites.filter("good IS NOT NULL")
    total = labelled.count()
    drawn = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < F.lit(fit_labels / max(total, 1) * (1 << 30))
    sample = labelled.filter(drawn).join(measured, "row").select("row", "x", "good").toPandas()
    sample = sample.sort_values("row")
    x = np.vstack(sample["x"]) if len(sample) else np.zeros((0, len(FEATURES)))
    model = Classifier.fitted(x, sample["good"].to_numpy(float))

    @F.pandas_udf("double")
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.log_odds(np.vstack(batch)) if len(batch) else [], dtype=float)

    count = (F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0.0)).alias("good"))
    paths = stored(sites.groupBy("host", "path").agg(*count), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    hosts = stored(hosts, "quality-hosts")
    n, good = hosts.agg(F.sum("n"), F.sum("good")).first()
    prior = good / n if n else 0.5
    of_host = _strength(hosts, F.lit(prior))
    above = _posterior(F.col("host_good"), F.col("host_n"), F.lit(prior), of_host)
    renamed = hosts.select("host", F.col("n").alias("host_n"), F.col("good").alias("host_good"))
    paths = stored(paths.join(renamed, "host"), "quality-levels")
    of_path = _strength(paths, above)

    own_n = F.when(F.col("own").isNull(), 0).otherwise(1)
    own = F.coalesce("own", F.lit(0.0))
    placed = sites.withColumnRenamed("good", "own").join(paths, ["host", "path"])
    host_posterior = _posterior(
        F.col("host_good") - own, F.col("host_n") - own_n, F.lit(prior), of_host
    )
    path_posterior = _posterior(
        F.col("good") - own, F.col("n") - own_n, F.col("host_posterior"), of_path
    )
    placed = placed.withColumn("host_posterior", host_posterior).withColumn(
        "path_posterior", path_posterior
    )
    scored = placed.select(
        "row", "doc_id", "host", "path", "host_posterior", "path_posterior"
    ).join(measured.select("row", evidence("x").alias("log_odds")), "row")
    # The classifier's odds contain the share of good labels once; the path replaces it.
    moved = _logit(F.col("path_posterior")) + F.col("log_odds") - _logit(F.lit(prior))
    chance = lambda z: 1 / (1 + F.exp(-z))
    return scored.withColumn("score", chance(moved)).select(
        "row", "doc_id", "host", "path",
        chance(F.col("log_odds")).alias("document_score"),
        "host_posterior", "path_posterior", "score",
        (F.col("score") >= least_score).alias("kept"),
    )
