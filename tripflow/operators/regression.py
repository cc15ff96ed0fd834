"""Linear regression over a table: fit, describe, evaluate, predict, explain, tune.

Numbers enter as they are, missing ones as the training mean. A category gets
a weight of its own; a missing or empty one is a category too. Categories may
be many: they are counted and numbered in a stored table, rows meet it by a
join, and so do the weights when rows are scored. What the driver holds is one
coefficient for each, as the solver does.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from multiprocessing.pool import ThreadPool
from operator import add

import numpy as np
import pandas as pd
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.operators.gram import Moments, collect_moments, solve
from tripflow.operators.numbering import ROWS_PER_TASK, number_within
from tripflow.session import fresh_dir, scratch_dir

# The first byte of a key's MD5, below this bound for 205 of 256 values (80 %).
TRAIN_BELOW = "cd"
# Up to so many features the solver works on the matrix of their moments.
MOST_FEATURES = 4096


@dataclass(frozen=True)
class Spec:
    """Label, numeric features and categorical features of a model."""

    label: str
    numbers: tuple[str, ...]
    categories: tuple[str, ...] = ()

    @property
    def inputs(self) -> tuple[str, ...]:
        return (*self.numbers, *self.categories)


def in_train(*key: str) -> Column:
    """Whether a row belongs to the training part, by a hash of its key: 80 to 20.

    The same row lands on the same side whatever the partitioning, and rows
    that share a key never end up on both sides.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    return F.substring(F.md5(F.concat_ws("-", *parts)), 1, 2) < TRAIN_BELOW


def split_train(df: DataFrame, *key: str) -> tuple[DataFrame, DataFrame]:
    """Training and held-out rows; without a key all columns are the key."""
    flag = in_train(*(key or df.columns))
    return df.filter(flag), df.filter(~flag)


def store_split(df: DataFrame, path: str, *key: str) -> tuple[DataFrame, DataFrame]:
    """The same split, stored: one folder per part, so no pass hashes again."""
    flagged = df.withColumn("in_train", in_train(*(key or df.columns)))
    flagged.write.partitionBy("in_train").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    return tuple(stored.filter(F.col("in_train") == f).drop("in_train") for f in (True, False))


def feature_info(df: DataFrame, spec: Spec) -> DataFrame:
    """Range, mean, spread, categories and NULLs of every input.

    Numbers are one plain aggregate. Categories are counted from one grouping
    by input and category, which combines before the shuffle.
    """
    measures = ("min", "max", "mean", "stddev", "category_count", "null_count")
    aggregates, rows = [], []
    for i, name in enumerate(spec.numbers):
        value = F.col(name).cast("double")
        found = {
            "min": F.min(value),
            "max": F.max(value),
            "mean": F.avg(value),
            "stddev": F.stddev_samp(value),
            "category_count": F.lit(None).cast("long"),
            "null_count": F.count_if(F.col(name).isNull()),
        }
        aggregates += [found[m].alias(f"{m}{i}") for m in measures]
        rows.append(
            F.struct(F.lit(name).alias("input"), *(F.col(f"{m}{i}").alias(m) for m in measures))
        )
    info = df.agg(*aggregates).select(F.inline(F.array(*rows))) if rows else None
    if spec.categories:
        none = F.lit(None).cast("double")
        counts = _pairs(df, spec, lambda c: F.col(c).cast("string")).groupBy("input", "category").count()
        seen = counts.groupBy("input").agg(
            F.count("category").alias("category_count"),
            F.coalesce(F.sum(F.when(F.col("category").isNull(), F.col("count"))), F.lit(0)).alias("null_count"),
        )
        # An input of an empty table is listed, too.
        names = F.array(*(F.lit(c) for c in spec.categories))
        names = df.sparkSession.range(1).select(F.explode(names).alias("input"))
        listed = names.join(seen, "input", "left").select(
            "input",
            *(none.alias(m) for m in measures[:4]),
            *(F.coalesce(m, F.lit(0)).alias(m) for m in measures[4:]),
        )
        info = listed if info is None else info.unionByName(listed)
    return info


def _pairs(df: DataFrame, spec: Spec, value) -> DataFrame:
    """One row per input and row: the input's name and the row's category."""
    pairs = [F.struct(F.lit(c).alias("input"), value(c).alias("category")) for c in spec.categories]
    return df.select(F.inline(F.array(*pairs)))


def _category(name: str) -> Column:
    """A missing category is the empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


@dataclass(frozen=True)
class Summary:
    """What preparation has to know about the data.

    ``categories`` has input, category, n and index, the place of the category
    by falling frequency, then by value; it reads a stored table.
    """

    rows: int
    means: dict[str, float]
    sizes: dict[str, int]
    categories: DataFrame | None
    label_mean: float | None = None


def summarize(df: DataFrame, spec: Spec, rows_per_task: int = ROWS_PER_TASK) -> Summary:
    """Means of the numbers in one pass, and counts of the categories in another.

    Categories are numbered in as many tasks as their number needs.
    """
    label = F.col(spec.label).cast("double") if spec.label in df.columns else F.lit(None)
    found = df.agg(
        F.count("*").alias("rows"),
        F.avg(label).alias("label"),
        *(F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(spec.numbers)),
    ).first()
    means = {c: found[f"m{i}"] for i, c in enumerate(spec.numbers)}
    empty = [c for c in spec.numbers if means[c] is None]
    if empty:
        raise ValueError(f"no values to learn from in: {empty}")
    if not spec.categories:
        return Summary(found.rows, means, {}, None, found.label)
    spark, path = df.sparkSession, fresh_dir(df.sparkSession, "categories")
    counts = _pairs(df, spec, _category).groupBy("input", "category").agg(F.count("*").alias("n"))
    with scratch_dir(spark, "category-counts") as counted, scratch_dir(spark, "ranges") as ranges:
        counts.write.parquet(counted)
        by_frequency = [F.desc("n"), F.col("category")]
        numbered = number_within(
            spark.read.parquet(counted), "input", by_frequency, "index", ranges, rows_per_task
        )
        numbered.withColumn("index", F.col("index").cast("int")).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = {r.input: r.n for r in stored.groupBy("input").agg(F.count("*").alias("n")).collect()}
    return Summary(found.rows, means, sizes, stored, found.label)


def _joined(df: DataFrame, spec: Spec, table: DataFrame | None, value: str, prefix: str) -> DataFrame:
    """Add a column of the category table for each category; NULL where it is unseen.

    Spark broadcasts the table if it is small, and else shuffles both sides
    and splits the partitions of frequent categories.
    """
    for name in spec.categories:
        side = table.filter(F.col("input") == name).select(
            F.col("category").alias(f"_key_{name}"), F.col(value).alias(f"{prefix}{name}")
        )
        df = df.join(side, _category(name) == F.col(f"_key_{name}"), "left").drop(f"_key_{name}")
    return df


def _filled(name: str, means: dict[str, float]) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(means[name]))


def _prepared(df: DataFrame, spec: Spec, summary: Summary, path: str) -> DataFrame:
    """Label and feature vector of each row, stored: every fit reads these alone.

    The rarest category has no place in the vector. With one for each, they
    would always add up to one, and the normal equations had no single solution.
    """
    rows = _joined(df, spec, summary.categories, "index", "_idx_")
    numbers = [_filled(c, summary.means).alias(f"_num_{c}") for c in spec.numbers]
    indexes = [
        F.col(f"_idx_{c}").cast("double").alias(
            f"_idx_{c}",
            metadata={"ml_attr": {"type": "nominal", "num_vals": max(summary.sizes[c], 2), "name": c}},
        )
        for c in spec.categories
    ]
    rows = rows.select(F.col(spec.label).cast("double").alias(spec.label), *numbers, *indexes)
    inputs = [f"_num_{c}" for c in spec.numbers]
    if spec.categories:
        hot = [f"_hot_{c}" for c in spec.categories]
        encoder = OneHotEncoder(inputCols=[f"_idx_{c}" for c in spec.categories], outputCols=hot)
        rows, inputs = encoder.fit(rows).transform(rows), inputs + hot
    vectors = VectorAssembler(inputCols=inputs, outputCol="_features").transform(rows)
    vectors.select(spec.label, "_features").write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _estimator(spec: Spec, l1: float = 0.0, l2: float = 0.0) -> LinearRegression:
    """Up to 4,096 features the solver reduces rows to the normal equations in
    one pass; beyond, it iterates over the prepared rows instead.
    """
    total = l1 + l2
    return LinearRegression(
        featuresCol="_features",
        labelCol=spec.label,
        regParam=total,
        elasticNetParam=l1 / total if total else 0.0,
        tol=1e-10,
        maxIter=500,
    )


@dataclass(frozen=True)
class TrainedModel:
    """Coefficients of the numbers, and a stored table of category weights.

    A weight is relative to the training mean of its input, so a category that
    was never seen counts as the average one.
    """

    spec: Spec
    intercept: float
    coefficients: dict[str, float]
    means: dict[str, float]
    weights: DataFrame | None = field(default=None, compare=False)

    @property
    def predicted(self) -> str:
        return f"predicted_{self.spec.label}"

    @property
    def baseline(self) -> float:
        """Mean prediction over the training rows."""
        return self.intercept + sum(self.coefficients[c] * self.means[c] for c in self.spec.numbers)

    def _weighted(self, df: DataFrame) -> DataFrame:
        return _joined(df, self.spec, self.weights, "weight", "_weight_")

    def _parts(self) -> dict[str, Column]:
        """What each input adds to a prediction, over rows with their weights."""
        parts = {
            c: _filled(c, self.means) * F.lit(self.coefficients[c]) for c in self.spec.numbers
        }
        return parts | {c: F.coalesce(f"_weight_{c}", F.lit(0.0)) for c in self.spec.categories}

    def prediction(self) -> Column:
        return reduce(add, self._parts().values(), F.lit(self.intercept))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add the prediction; all input columns stay."""
        return self._weighted(df).select(*df.columns, self.prediction().alias(self.predicted))

    def explain(self, df: DataFrame, top: int = 3) -> DataFrame:
        """Add the prediction, the baseline and the strongest attributions.

        An attribution is what an input adds to this row's prediction compared
        with the training mean, so baseline plus all of them is the prediction.
        """
        usual = {c: self.coefficients[c] * self.means[c] for c in self.spec.numbers}
        ranked = F.array_sort(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("feature"),
                        (part - F.lit(usual.get(name, 0.0))).alias("attribution"),
                    )
                    for name, part in self._parts().items()
                )
            ),
            lambda a, b: F.when(F.abs(a.attribution) > F.abs(b.attribution), -1)
            .when(F.abs(a.attribution) < F.abs(b.attribution), 1)
            .when(a.feature < b.feature, -1)
            .when(a.feature > b.feature, 1)
            .otherwise(0),
        )
        return self._weighted(df).select(
            *df.columns,
            self.prediction().alias(self.predicted),
            F.lit(self.baseline).alias("baseline_prediction"),
            F.slice(ranked, 1, top).alias("top_feature_attributions"),
        )

    def save(self, path: str) -> None:
        """Write coefficients and category weights under ``path``."""
        spark = SparkSession.active()
        spec = self.spec
        row = (self.intercept, self.coefficients, self.means, spec.label, spec.numbers, spec.categories)
        spark.createDataFrame(
            [row],
            "intercept double, coefficients map<string,double>, means map<string,double>,"
            " label string, numbers array<string>, categories array<string>",
        ).write.mode("overwrite").parquet(f"{path}/model")
        if self.weights is not None:
            self.weights.write.mode("overwrite").parquet(f"{path}/weights")


def load(spark: SparkSession, path: str) -> TrainedModel:
    row = spark.read.parquet(f"{path}/model").first()
    spec = Spec(row.label, tuple(row.numbers), tuple(row.categories))
    weights = spark.read.parquet(f"{path}/weights") if spec.categories else None
    return TrainedModel(spec, row.intercept, row.coefficients, row.means, weights)


def _width(summary: Summary, name: str) -> int:
    """Places of a category in the feature vector."""
    return max(summary.sizes[name], 2) - 1


def _moments(df: DataFrame, spec: Spec, summary: Summary) -> Moments:
    """Moments of the feature vector, from one pass over the rows."""
    places: dict[str, dict[str, int]] = {c: {} for c in spec.categories}
    if spec.categories:
        for r in summary.categories.collect():
            places[r.input][r.category] = r["index"]
    shifted = collect_moments(
        df,
        F.col(spec.label).cast("double") - F.lit(summary.label_mean),
        {c: _filled(c, summary.means) - F.lit(summary.means[c]) for c in spec.numbers},
        {c: _category(c) for c in spec.categories},
        places,
        {c: _width(summary, c) for c in spec.categories},
    )
    means = shifted.means.copy()
    means[: len(spec.numbers)] += [summary.means[c] for c in spec.numbers]
    return replace(shifted, means=means, label_mean=shifted.label_mean + summary.label_mean)


def _finish(
    spec: Spec, summary: Summary, solutions: Sequence[tuple[np.ndarray, float]]
) -> list[TrainedModel]:
    """Fitted vectors and intercepts as models with named coefficients and centred weights.

    The weights of all models are columns of one stored table.
    """
    names = [f"weight{k}" for k in range(len(solutions))]
    usual: dict[str, list[float]] = {}
    if spec.categories:
        start, blocks = len(spec.numbers), []
        for name in spec.categories:
            width = _width(summary, name)
            block = pd.DataFrame(
                {n: v[start : start + width] for n, (v, _) in zip(names, solutions, strict=True)}
            )
            blocks.append(block.assign(input=name, index=range(width)))
            start += width
        spark = summary.categories.sparkSession
        types = ", ".join(f"{n} double" for n in names)
        found = spark.createDataFrame(
            pd.concat(blocks)[["input", "index", *names]], f"input string, index int, {types}"
        )
        raw = summary.categories.join(found, ["input", "index"], "left").fillna(0.0, names)
        path = fresh_dir(spark, "weights")
        raw.write.parquet(path)
        raw = spark.read.parquet(path)
        shares = [(F.sum(F.col(n) * F.col("n")) / summary.rows).alias(n) for n in names]
        usual = {r.input: [r[n] for n in names] for r in raw.groupBy("input").agg(*shares).collect()}

    models = []
    for k, (vector, intercept) in enumerate(solutions):
        coefficients = {c: float(vector[i]) for i, c in enumerate(spec.numbers)}
        weights = None
        if spec.categories:
            intercept += sum(u[k] for u in usual.values())
            (name, first), *others = usual.items()
            shift = F.when(F.col("input") == name, first[k])
            for name, means in others:
                shift = shift.when(F.col("input") == name, means[k])
            weights = raw.select("input", "category", (F.col(names[k]) - shift).alias("weight"))
        models.append(TrainedModel(spec, float(intercept), coefficients, summary.means, weights))
    return models


def train(df: DataFrame, spec: Spec, l1: float = 0.0, l2: float = 0.0) -> TrainedModel:
    """Fit on the rows that have a label: summarize, prepare and store, solve."""
    labelled = df.filter(F.col(spec.label).isNotNull())
    summary = summarize(labelled, spec)
    with scratch_dir(df.sparkSession, "prepared") as path:
        fitted = _estimator(spec, l1, l2).fit(_prepared(labelled, spec, summary, path))
    return _finish(spec, summary, [(fitted.coefficients.toArray(), fitted.intercept)])[0]


def _metrics(label: Column, predicted: Column, suffix: str = "") -> list[Column]:
    error = label - predicted
    return [
        F.count("*").alias(f"rows{suffix}"),
        F.avg(F.abs(error)).alias(f"mean_absolute_error{suffix}"),
        F.avg(error * error).alias(f"mean_squared_error{suffix}"),
        (1 - F.avg(error * error) / F.var_pop(label)).alias(f"r2_score{suffix}"),
        (1 - F.var_pop(error) / F.var_pop(label)).alias(f"explained_variance{suffix}"),
    ]


def evaluate(model: TrainedModel, df: DataFrame) -> DataFrame:
    """Error measures over labelled rows, as one row from one pass."""
    labelled = df.filter(F.col(model.spec.label).isNotNull())
    scored = model.predict(labelled)
    return scored.agg(*_metrics(F.col(model.spec.label), F.col(model.predicted)))


def tune(
    train_rows: DataFrame,
    validation_rows: DataFrame,
    spec: Spec,
    l1_range: tuple[float, float] = (0.0, 20.0),
    l2_candidates: Sequence[float] = (0.0, 0.1, 1.0, 10.0),
    trials: int = 5,
    parallel: int = 2,
    seed: int = 42,
    most_features: int = MOST_FEATURES,
) -> tuple[TrainedModel, DataFrame]:
    """Random search over the penalties; the lowest validation error wins.

    Up to ``most_features`` features all trials are solved from moments that
    one pass over the rows gives. Beyond, where the matrix of moments would be
    too large for the driver, features are prepared and stored once and every
    trial iterates over them. All trials are scored in a single pass over the
    validation rows: each trial's weights are a column of one table.
    """
    draw = random.Random(seed)
    penalties = [(draw.uniform(*l1_range), draw.choice(l2_candidates)) for _ in range(trials)]
    labelled = train_rows.filter(F.col(spec.label).isNotNull())
    summary = summarize(labelled, spec)
    if len(spec.numbers) + sum(_width(summary, c) for c in spec.categories) <= most_features:
        moments = _moments(labelled, spec, summary)
        solutions = [solve(moments, l1, l2) for l1, l2 in penalties]
    else:
        with scratch_dir(train_rows.sparkSession, "prepared") as path, ThreadPool(parallel) as pool:
            prepared = _prepared(labelled, spec, summary, path)
            fitted = pool.map(lambda p: _estimator(spec, *p).fit(prepared), penalties, chunksize=1)
        solutions = [(f.coefficients.toArray(), f.intercept) for f in fitted]
    models = _finish(spec, summary, solutions)

    rows = validation_rows.filter(F.col(spec.label).isNotNull())
    if spec.categories:
        tables = [
            model.weights.withColumnRenamed("weight", f"w{i}") for i, model in enumerate(models)
        ]
        table = reduce(lambda a, b: a.join(b, ["input", "category"]), tables)
        together = F.struct(*(f"w{i}" for i in range(trials))).alias("weights")
        table = table.select("input", "category", together)
        rows = _joined(rows, spec, table, "weights", "_all_")
    measures = []
    for i, model in enumerate(models):
        value = F.lit(model.intercept)
        for c in spec.numbers:
            value += _filled(c, model.means) * F.lit(model.coefficients[c])
        for c in spec.categories:
            value += F.coalesce(F.col(f"_all_{c}.w{i}"), F.lit(0.0))
        measures += _metrics(F.col(spec.label), value, suffix=f"_{i}")
    scores = rows.agg(*measures).first()
    report = [
        (i, l1, l2, scores[f"mean_squared_error_{i}"] ** 0.5, scores[f"r2_score_{i}"])
        for i, (l1, l2) in enumerate(penalties)
    ]
    best = min(report, key=lambda r: r[3])[0]
    table = train_rows.sparkSession.createDataFrame(
        [(*row, row[0] == best) for row in report],
        "trial int, l1_reg double, l2_reg double, rmse double, r2_score double, is_best boolean",
    )
    return models[best], table
