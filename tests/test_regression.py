import json
import math

import numpy as np
import pandas as pd
import pytest
from helpers import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators import gram, regression
from tripflow.operators.numbering import number_within
from tripflow.operators.regression import Spec
from tripflow.operators.scoring import malformed_json, score_batches, score_json, score_messages
from tripflow.plans import jobs
from tripflow.plans.tip_model import TIP_INPUT_SCHEMA, TIP_SPEC, tip_features
from tripflow.schemas import TIP_FEATURE_TYPES
from tripflow.sources import supplied
from tripflow.streaming import messages
from tripflow.verify import queries

SPEC = Spec("y", ("x1", "x2"), ("c",))
EFFECT = {"a": 0.0, "b": 5.0, "d": -3.0}


@pytest.fixture(scope="module")
def data(spark):
    """y = 2 + 3 x1 - x2 + effect(c), exactly."""
    cases = [
        (float(i % 11), float(i * i % 7), "abd"[i % 3], i)
        for i in range(300)
    ]
    return spark.createDataFrame(
        [(2 + 3 * x1 - x2 + EFFECT[c], x1, x2, c, i) for x1, x2, c, i in cases],
        "y double, x1 double, x2 double, c string, id int",
    )


@pytest.fixture(scope="module")
def model(data):
    return regression.train(data, SPEC)


def test_known_coefficients_are_found(model, data):
    found = model.coefficients
    assert math.isclose(found["x1"], 3, abs_tol=1e-6) and math.isclose(found["x2"], -1, abs_tol=1e-6)
    scores = regression.evaluate(model, data).first()
    assert scores.rows == 300 and scores.mean_absolute_error < 1e-6 and scores.r2_score > 0.999999


def test_prediction_keeps_inputs_and_handles_new_categories_and_nulls(spark, model):
    new = spark.createDataFrame([(1.0, 1.0, "zzz"), (None, 1.0, "a"), (1.0, 2.0, None)], "x1 double, x2 double, c string")
    out = model.predict(new)
    assert out.columns == ["x1", "x2", "c", "predicted_y"]
    assert all(r.predicted_y is not None for r in out.collect())


def test_attributions_add_up_to_the_prediction(model, data):
    out = model.explain(data, top=3)
    for r in out.collect():
        total = r.baseline_prediction + sum(a.attribution for a in r.top_feature_attributions)
        assert math.isclose(total, r.predicted_y, abs_tol=1e-6)
        sizes = [abs(a.attribution) for a in r.top_feature_attributions]
        assert sizes == sorted(sizes, reverse=True)
    mean = data.agg(F.avg("y")).first()[0]
    assert math.isclose(model.baseline, mean, abs_tol=1e-6)
    assert all(len(r.top_feature_attributions) == 1 for r in model.explain(data, top=1).collect())


def test_model_survives_a_save(spark, model, data, tmp_path):
    model.save(str(tmp_path / "m"))
    again = regression.load(spark, str(tmp_path / "m"))
    assert again.spec == model.spec and again.baseline == model.baseline
    before, after = model.explain(data), again.explain(data)
    assert rows(before) == rows(after)


def test_split_is_repeatable_disjoint_and_near_80_20(data):
    train, held_out = regression.split_train(data, "id")
    again, _ = regression.split_train(data.repartition(7), "id")
    ids = {r.id for r in train.collect()}
    assert ids == {r.id for r in again.collect()}
    assert not ids & {r.id for r in held_out.collect()}
    assert train.count() + held_out.count() == 300 and 0.7 < len(ids) / 300 < 0.9


def test_stored_split_equals_the_lazy_one(data, tmp_path):
    lazy, stored = regression.split_train(data, "id"), regression.store_split(data, f"{tmp_path}/s", "id")
    for a, b in zip(lazy, stored):
        assert rows(a) == rows(b.select(a.columns))


def test_rows_that_share_a_key_stay_together(spark):
    df = spark.range(200).selectExpr("id % 20 AS k", "id AS v")
    train, held_out = regression.split_train(df, "k")
    assert train.select("k").intersect(held_out.select("k")).isEmpty()


def test_tuning_tries_every_draw_and_keeps_the_best(data):
    train, held_out = regression.split_train(data, "id")
    best, trials = regression.tune(train, held_out, SPEC, l1_range=(0, 2))
    table = trials.collect()
    assert len(table) == 5 and sum(r.is_best for r in table) == 1
    chosen = next(r for r in table if r.is_best)
    assert chosen.rmse == min(r.rmse for r in table)
    assert all(0 <= r.l1_reg <= 2 and r.l2_reg in (0.0, 0.1, 1.0, 10.0) for r in table)
    score = regression.evaluate(best, held_out).first()
    assert math.isclose(score.mean_squared_error**0.5, chosen.rmse, rel_tol=1e-9)
    _, same = regression.tune(train, held_out, SPEC, l1_range=(0, 2))
    assert [(r.l1_reg, r.l2_reg) for r in same.collect()] == [(r.l1_reg, r.l2_reg) for r in table]


def test_summary_matches_plain_aggregates(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (3.0, "a"), (None, "b"), (2.0, None), (2.0, "")], "x1 double, c string"
    )
    summary = regression.summarize(df, Spec("y", ("x1",), ("c",)))
    assert summary.rows == 5 and summary.means == {"x1": 2.0} and summary.sizes == {"c": 3}
    found = {r.category: (r.n, r["index"]) for r in summary.categories.collect()}
    assert found == {"": (2, 0), "a": (2, 1), "b": (1, 2)}


def test_twenty_thousand_categories(spark, tmp_path):
    """y = 2 x1 + effect of c, three rows for each of 20,000 categories."""
    rows = spark.range(60_000).selectExpr(
        "cast(pmod(xxhash64(id), 1000) AS double) / 100 AS x1", "cast(id % 20000 AS string) AS c",
        "id",
    )
    effect = "cast(c AS double) % 17"
    rows.selectExpr("*", f"2 * x1 + {effect} AS y").write.parquet(f"{tmp_path}/wide")
    df = spark.read.parquet(f"{tmp_path}/wide")
    spec = Spec("y", ("x1",), ("c",))
    model = regression.train(df, spec)
    assert math.isclose(model.coefficients["x1"], 2, abs_tol=1e-4)
    scores = regression.evaluate(model, df).first()
    assert scores.rows == 60_000 and scores.r2_score > 0.9999
    explained = model.explain(df.limit(50)).collect()
    for r in explained:
        total = r.baseline_prediction + sum(a.attribution for a in r.top_feature_attributions)
        assert math.isclose(total, r.predicted_y, abs_tol=1e-6)
    best, trials = regression.tune(df, df, spec, l1_range=(0, 0.01), trials=2)
    assert trials.count() == 2 and best.predict(df).count() == 60_000


def test_a_single_category_and_an_unseen_one(spark):
    df = spark.createDataFrame([(1.0, "a", 2.0), (2.0, "a", 4.0), (3.0, "a", 6.0)], "x double, c string, y double")
    model = regression.train(df, Spec("y", ("x",), ("c",)))
    new = spark.createDataFrame([(4.0, "b")], "x double, c string")
    assert math.isclose(model.predict(new).first()[-1], 8, abs_tol=1e-6)


def test_feature_info_of_no_rows_and_its_plan(spark, sf):
    df = spark.createDataFrame([], "n double, c string")
    info = {r.input: r for r in regression.feature_info(df, Spec("y", ("n",), ("c",))).collect()}
    assert (info["c"].category_count, info["c"].null_count, info["n"].null_count) == (0, 0, 0)
    features = tip_features(supplied.all_trips(spark, sf))
    assert "Expand" not in plan(regression.feature_info(features, TIP_SPEC))


def test_feature_info(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "b")], "n double, c string")
    info = {r.input: r for r in regression.feature_info(df, Spec("y", ("n",), ("c",))).collect()}
    assert (info["n"].min, info["n"].max, info["n"].mean, info["n"].null_count) == (1.0, 3.0, 2.0, 1)
    assert math.isclose(info["n"].stddev, 2**0.5) and info["n"].category_count is None
    assert (info["c"].category_count, info["c"].min, info["c"].null_count) == (2, None, 0)


def test_feature_table_types_and_filter(spark, sf):
    trips = supplied.all_trips(spark, sf)
    free = trips.limit(1).withColumn("fare_amount", F.lit(0.0))
    out = tip_features(trips.unionByName(free))
    assert {f.name: f.dataType for f in out.schema} == TIP_FEATURE_TYPES
    assert out.count() == trips.count()


def test_json_rows_are_scored_and_malformed_ones_left_out(spark, sf):
    features = tip_features(supplied.all_trips(spark, sf))
    model = regression.train(features, TIP_SPEC)
    texts = spark.createDataFrame(
        [
            ('{"passenger_count":3, "trip_distance":7.5, "PULocationID":"11", "DOLocationID":"6",'
             ' "payment_type":"5", "fare_amount":31.25, "tolls_amount":1.5}',),
            ("{broken",),
            ('{"passenger_count":3, "trip_distance":7.5, "PULocationID":"11", "DOLocationID":"6",'
             ' "payment_type":"5", "fare_amount":31.25}',),
            ('{"passenger_count":"many", "trip_distance":7.5, "PULocationID":"11",'
             ' "DOLocationID":"6", "payment_type":"5", "fare_amount":31.25, "tolls_amount":0}',),
        ],
        "value string",
    )
    (row,) = score_json(texts, model, TIP_INPUT_SCHEMA).collect()
    direct = spark.createDataFrame([(3, 7.5, "11", "6", "5", 31.25, 1.5)], TIP_INPUT_SCHEMA)
    assert math.isclose(row.predicted_tip_amount, model.predict(direct).first()[-1])
    assert malformed_json(texts, TIP_INPUT_SCHEMA).count() == 3


@pytest.mark.parametrize("score", [score_json, score_messages])
def test_json_is_parsed_once(spark, model, score):
    """A filter or a second reference would repeat the parser for every field."""
    schema = T.StructType.fromDDL("x1 double, X2 double, c string")
    texts = ['{"x1":1, "x2":2, "c":"b"}', '{"X1":1, "x1":9, "x2":null, "C":null}', "{", "[]", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    scored = score(df, model, schema)
    optimized = scored._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json(") == 1
    found = {(r.x1, r.X2, r.c) for r in scored.collect()}
    assert found - {(None, None, None)} == {(1.0, 2.0, "b"), (1.0, None, None)}
    assert rows(malformed_json(df, schema)) == rows(df.filter("value IS NULL OR value IN ('{', '[]', '')"))


def test_json_rows_of_a_stream_are_scored(spark, model, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"x1":1.0,"x2":2.0,"c":"b"}\n{oops\n')
    schema = T.StructType.fromDDL("x1 double, x2 double, c string")
    scored = score_json(spark.readStream.text(str(tmp_path / "in")), model, schema)
    query = (
        scored.writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    (row,) = spark.read.parquet(f"{tmp_path}/out").collect()
    assert math.isclose(row.predicted_y, 2 + 3 * 1 - 2 + 5, abs_tol=1e-6)


def test_a_scored_stream_resumes_and_sets_malformed_messages_apart(spark, model, data, tmp_path):
    """A model with categories, stored and loaded; the stream drains, gets more, drains again."""
    model.save(f"{tmp_path}/model")
    loaded, folder = regression.load(spark, f"{tmp_path}/model"), tmp_path / "in"
    folder.mkdir()
    inputs = data.select("x1", "x2", "c").limit(40).collect()
    schema = T.StructType.fromDDL("x1 double, x2 double, c string")
    for part in (0, 1):
        for i, r in list(enumerate(inputs))[part::2]:
            name, extra = folder / f"{part}-{i}.json", "\n{oops" if i % 8 == 0 else "\n{}"
            name.write_text(json.dumps(r.asDict()) + extra + "\n")
        for _ in (1, 2):
            jobs.score_messages_stream(
                messages.read_text_files(spark, str(folder), files_at_once=7),
                loaded, schema, f"{tmp_path}/out", f"{tmp_path}/cp",
            ).awaitTermination()
    out = messages.read_stored(spark, f"{tmp_path}/out")
    good = out.filter("malformed IS NULL")
    direct = model.predict(data.select("x1", "x2", "c").limit(40))
    assert rows(good.select(direct.columns)) == rows(direct)
    bad = out.filter("malformed IS NOT NULL")
    assert sorted(r.malformed for r in bad.collect()) == ["{oops"] * 5 + ["{}"] * 35
    assert bad.filter("predicted_y IS NOT NULL OR x1 IS NOT NULL").isEmpty()


def test_batches_are_scored_with_all_columns_kept(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "id int, trip_distance double")
    out = score_batches(df, lambda b: b["trip_distance"] * 3, "predicted_duration")
    assert out.columns == ["id", "trip_distance", "predicted_duration"]
    got = {r.id: r.predicted_duration for r in out.collect()}
    assert got[1] == 6.0 and (got[2] is None or pd.isna(got[2]))


def dense(frame: pd.DataFrame, levels: dict) -> np.ndarray:
    columns = [frame[c].to_numpy(float) for c in TIP_SPEC.numbers]
    for c, values in levels.items():
        columns += [(frame[c] == v).to_numpy(float) for v in values]
    return np.column_stack(columns)


@pytest.fixture(scope="module")
def by_hand(spark, sf):
    """Training and held-out rows as frames, their one-hot levels, and the dense solution."""
    trips = supplied.all_trips(spark, sf)
    parts = [p.toPandas() for p in jobs.stored_tip_features(trips, queries.ROW_KEY)]
    levels = {c: sorted(parts[0][c].unique()) for c in TIP_SPEC.categories}
    design = dense(parts[0], levels)
    label = parts[0]["tip_amount"].to_numpy(float)
    solution, *_ = np.linalg.lstsq(
        np.column_stack([np.ones(len(design)), design]), label, rcond=None
    )
    return parts, levels, solution


def test_full_model_equals_least_squares_by_hand(spark, sf, by_hand):
    """The registered predictions of every row against a dense solve of the same design."""
    parts, levels, solution = by_hand
    scored = queries.tip_full_predictions(spark, sf).toPandas()
    assert len(scored) == sum(map(len, parts))
    expected = solution[0] + dense(scored, levels) @ solution[1:]
    assert np.abs(scored["predicted_tip_amount"] - expected).max() < 1e-6


def test_full_explanations_are_the_three_strongest_by_hand(spark, sf, by_hand):
    parts, levels, solution = by_hand
    design = dense(parts[0], levels)
    explained = queries.tip_full_explained(spark, sf).toPandas()
    assert len(explained) == sum(map(len, parts))
    base = solution[0] + design.mean(axis=0) @ solution[1:]
    assert np.abs(explained["baseline_prediction"] - base).max() < 1e-6
    shift = (dense(explained, levels) - design.mean(axis=0)) * solution[1:]
    by_input, at = {}, len(TIP_SPEC.numbers)
    for i, name in enumerate(TIP_SPEC.numbers):
        by_input[name] = shift[:, i]
    for name, values in levels.items():
        by_input[name] = shift[:, at : at + len(values)].sum(axis=1)
        at += len(values)
    parts = pd.DataFrame(by_input)
    for (_, mine), top in zip(parts.iterrows(), explained["top_feature_attributions"], strict=True):
        strongest = mine.abs().sort_values(ascending=False)
        assert len(top) == 3
        for place, reason in enumerate(top):
            assert math.isclose(reason["attribution"], mine[reason["feature"]], abs_tol=1e-6)
            assert math.isclose(abs(reason["attribution"]), strongest.iloc[place], abs_tol=1e-6)


def test_full_trials_by_hand(spark, sf, by_hand):
    """Held-out errors of five penalties against proximal steps over the dense design.

    The last level by frequency has no column of its own, as in the model.
    """
    (train, held_out), levels, _ = by_hand
    trials = queries.tip_full_tuning(spark, sf).collect()
    assert len(trials) == 5 and sum(r.is_best for r in trials) == 1
    kept = {}
    for name, values in levels.items():
        counts = train[name].value_counts()
        kept[name] = sorted(values, key=lambda v: (-counts[v], v))[:-1]
    x, y = dense(train, kept), train["tip_amount"].to_numpy(float)
    mean, spread, unit = x.mean(axis=0), x.std(axis=0), y.std()
    z, t = (x - mean) / spread, (y - y.mean()) / unit
    c, b = z.T @ z / len(z), z.T @ t / len(z)
    for r in trials:
        l1, l2 = r.l1_reg / unit, r.l2_reg / unit
        step = 1 / (np.linalg.eigvalsh(c).max() + l2)
        w = v = np.zeros(len(b))
        for k in range(4000):
            moved = v - step * (c @ v - b + l2 * v)
            last, w = w, np.sign(moved) * np.maximum(np.abs(moved) - step * l1, 0)
            v = w + k / (k + 3) * (w - last)
        error = held_out["tip_amount"].to_numpy(float) - y.mean()
        error = error - (dense(held_out, kept) - mean) / spread @ w * unit
        assert math.isclose(r.rmse, np.sqrt((error**2).mean()), rel_tol=1e-6)


def full_design(spark, sf):
    features = tip_features(supplied.all_trips(spark, sf), keep={"vendorid": T.LongType()})
    return regression.split_train(features, "vendorid")


@pytest.mark.parametrize("l1, l2", [(0.0, 0.0), (0.0, 1.0), (0.4, 0.0), (1.5, 0.1), (30.0, 10.0)])
def test_moments_give_the_solution_of_the_rows(spark, sf, tmp_path, l1, l2):
    """The same penalties solved from moments and by the solver that reads the rows.

    With an l1 penalty that solver iterates and stops some digits before the
    optimum, so there ours must be as good or better by the same measure.
    """
    train, _ = full_design(spark, sf)
    summary = regression.summarize(train, TIP_SPEC)
    moments = regression._moments(train, TIP_SPEC, summary)
    weights, intercept = gram.solve(moments, l1, l2)
    prepared = regression._prepared(train, TIP_SPEC, summary, f"{tmp_path}/prepared")
    fitted = regression._estimator(TIP_SPEC, l1, l2).fit(prepared)
    theirs = fitted.coefficients.toArray()
    assert len(weights) == len(theirs) > 40

    def loss(w):
        unit, spread = moments.label_variance**0.5, np.sqrt(np.diag(moments.covariance))
        v = w * spread / unit
        c = moments.covariance / np.outer(spread, spread)
        fit = v @ c @ v / 2 - moments.with_label / (spread * unit) @ v
        return fit + l1 / unit * np.abs(v).sum() + l2 / unit * v @ v / 2

    assert -1e-12 < loss(theirs) - loss(weights) < 1e-6
    if not l1:
        assert np.abs(weights - theirs).max() < 1e-6
    by_number = weights[: len(TIP_SPEC.numbers)] - theirs[: len(TIP_SPEC.numbers)]
    assert np.abs(by_number).max() < 1e-6


def test_penalised_solutions_meet_the_conditions_of_the_optimum():
    draw = np.random.default_rng(2)
    for d, l1 in ((1, 0.1), (30, 0.02), (60, 0.3), (60, 1e-4)):
        x = draw.standard_normal((200, d)) @ draw.standard_normal((d, d)) + 5
        x[:, d // 2 :: 7] = x[:, :1]  # features that repeat
        y = x @ (draw.standard_normal(d) * (draw.random(d) < 0.3)) + draw.standard_normal(200)
        centred = x - x.mean(axis=0)
        moments = gram.Moments(
            200, x.mean(axis=0), y.mean(), centred.T @ centred / 200, centred.T @ (y - y.mean()) / 200, y.var()
        )
        w, intercept = gram.solve(moments, l1, 0.05)
        spread, unit = x.std(axis=0), y.std()
        v = w * spread / unit
        slope = (centred / spread).T @ ((y - y.mean()) / unit - centred / spread @ v) / 200 - 0.05 / unit * v
        assert (np.abs(slope) <= l1 / unit + 1e-8).all()
        assert np.abs(slope[v != 0] - l1 / unit * np.sign(v[v != 0])).max(initial=0) < 1e-8
        assert math.isclose(intercept, y.mean() - w @ x.mean(axis=0))


def test_moments_of_missing_values_and_odd_categories(spark):
    values = [(1.0, 2.0, "a", "p", 3.0), (None, 1.0, "b", None, 4.0), (3.0, None, None, "", 8.0),
              (5.0, 4.0, "", "q", 1.0), (2.0, 2.0, "a", "q", 7.0), (1.0, 0.0, "c", "p", None)]
    df = spark.createDataFrame(values, "x double, z double, c string, e string, y double")
    df = df.filter("y IS NOT NULL")
    spec = Spec("y", ("x", "z"), ("c", "e"))
    summary = regression.summarize(df, spec)
    moments = regression._moments(df, spec, summary)
    x = np.array([[1, 2], [2.75, 1], [3, 2.25], [5, 4], [2, 2]])
    order = {r.category: r["index"] for r in summary.categories.filter("input = 'c'").collect()}
    levels = sorted(order, key=order.get)[:-1]
    c = np.array([["a", "b", "", "", "a"]]).T == np.array([levels])
    order = {r.category: r["index"] for r in summary.categories.filter("input = 'e'").collect()}
    levels = sorted(order, key=order.get)[:-1]
    e = np.array([["p", "", "", "q", "q"]]).T == np.array([levels])
    design, y = np.column_stack([x, c, e]).astype(float), np.array([3.0, 4, 8, 1, 7])
    assert np.allclose(moments.covariance, np.cov(design.T, bias=True), atol=1e-12)
    assert np.allclose(moments.means, design.mean(axis=0)) and moments.label_mean == y.mean()
    assert np.allclose(moments.with_label, (design - design.mean(axis=0)).T @ (y - y.mean()) / 5)
    assert math.isclose(moments.label_variance, y.var())


def test_both_ways_of_tuning_agree(data):
    train, held_out = regression.split_train(data, "id")
    tables = [
        regression.tune(train, held_out, SPEC, l1_range=(0, 2), most_features=m)[1].collect()
        for m in (4096, 0)
    ]
    for a, b in zip(*tables, strict=True):
        assert (a.trial, a.l1_reg, a.l2_reg, a.is_best) == (b.trial, b.l1_reg, b.l2_reg, b.is_best)
        assert math.isclose(a.rmse, b.rmse, rel_tol=1e-6)


def test_trials_share_one_pass_over_the_rows(spark, data, tmp_path):
    """Rows are counted as they pass: two passes to summarize, one for any number of trials."""
    data.write.parquet(f"{tmp_path}/rows")
    seen = {}
    for trials in (1, 6):
        passed = spark.sparkContext.accumulator(0)

        @F.udf("double")
        def watched(value, passed=passed):
            passed.add(1)
            return value

        stored = spark.read.parquet(f"{tmp_path}/rows")
        once = stored.withColumn("x2", watched.asNondeterministic()("x2"))
        regression.tune(once, stored, SPEC, trials=trials)
        seen[trials] = passed.value / 300
    assert seen[1] == seen[6] <= 3


def test_two_million_categories_are_numbered_in_many_tasks(spark, tmp_path):
    """The places of a window by input, of an input whose categories need eight tasks."""
    counts = spark.range(2_000_100).selectExpr(
        "if(id < 2000000, 'wide', 'narrow') AS input", "cast(id AS string) AS category",
        "pmod(xxhash64(id), 50) AS n",
    )
    counts.write.parquet(f"{tmp_path}/counts")
    counts = spark.read.parquet(f"{tmp_path}/counts")
    order = [F.desc("n"), F.col("category")]
    found = number_within(counts, "input", order, "index", f"{tmp_path}/ranges")
    text = plan(found)
    assert "SortMergeJoin" in text or "BroadcastHashJoin" in text
    ranges = spark.read.parquet(f"{tmp_path}/ranges")
    per_range = ranges.groupBy(F.shiftright("_place", 33)).count().collect()
    assert len(per_range) >= 8 and max(r["count"] for r in per_range) < 600_000
    window = Window.partitionBy("input").orderBy(*order)
    expected = counts.withColumn("expected", F.row_number().over(window) - 1)
    both = found.join(expected, ["input", "category"])
    assert both.count() == 2_000_100 and both.filter(F.col("index") != F.col("expected")).isEmpty()
