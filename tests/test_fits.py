"""Batched searches against closed forms and optimality conditions; fitted models against their tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import features, model_tables, models, search


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    n = 400
    x = rng.standard_normal((n, 3)) * [1.0, 50.0, 0.1] + [0.0, 1000.0, 5.0]
    z = x[:, 0] - 0.03 * (x[:, 1] - 1000) + 4 * (x[:, 2] - 5)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["label"] = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(float)
    pdf["y"] = 3 * z + rng.standard_normal(n) + 100
    pdf["fold"] = np.arange(n) % 5
    pdf["key"] = np.arange(n)
    return pdf, spark.createDataFrame(pdf).repartition(3).cache()


def test_ridge_scores_from_moments(frame):
    pdf, df = frame
    m = search.moments_by_fold(df, ["a", "b", "c"], "y")
    got = search.ridge_scores(m, [0.0, 0.5, 90.0])
    for alpha, score in zip([0.0, 0.5, 90.0], got):
        r2 = []
        for f in range(5):
            tr, te = pdf[pdf.fold != f], pdf[pdf.fold == f]
            x = tr[["a", "b", "c"]].to_numpy()
            xm, ym = x.mean(0), tr.y.mean()
            w = np.linalg.solve((x - xm).T @ (x - xm) + alpha * np.eye(3), (x - xm).T @ (tr.y - ym))
            e = te.y - ym - (te[["a", "b", "c"]].to_numpy() - xm) @ w
            r2.append(1 - (e ** 2).sum() / ((te.y - te.y.mean()) ** 2).sum())
        assert score == pytest.approx(np.mean(r2), rel=1e-9)


@pytest.mark.parametrize("c,penalty", [(1.0, "l2"), (0.01, "l2"), (100.0, "l1"), (0.05, "l1")])
def test_logistic_fits_are_optimal(frame, c, penalty):
    pdf, df = frame
    w = search.logistic_fits(df, ["a", "b", "c"], [(c, penalty, -1), (c, penalty, 2)])
    for held, v in zip((-1, 2), w):
        part = pdf[pdf.fold != held]
        x = np.column_stack([part[["a", "b", "c"]].to_numpy(), np.ones(len(part))])
        g = c * x.T @ (1 / (1 + np.exp(-(x @ v))) - part.label.to_numpy())
        scale = c * np.abs(x).sum(0)
        assert abs(g[3]) < 1e-7 * scale[3]
        for j in range(3):
            if penalty == "l2":
                assert abs(g[j] + v[j]) < 1e-7 * scale[j]
            elif v[j] == 0:
                assert abs(g[j]) <= 1 + 1e-6
            else:
                assert abs(g[j] + np.sign(v[j])) < 1e-7 * scale[j]


def test_logistic_scores_count_held_out_rows(frame):
    pdf, df = frame
    trials = [(1.0, "l2"), (0.001, "l1")]
    got = search.logistic_scores(df, ["a", "b", "c"], trials, 5)
    for (c, p), score in zip(trials, got):
        w = search.logistic_fits(df, ["a", "b", "c"], [(c, p, f) for f in range(5)])
        acc = []
        for f in range(5):
            t = pdf[pdf.fold == f]
            z = t[["a", "b", "c"]].to_numpy() @ w[f, :3] + w[f, 3]
            acc.append(((z > 0) == (t.label > 0.5)).mean())
        assert score == pytest.approx(np.mean(acc))


def test_missing_values_fail_the_trials(frame):
    _, df = frame
    gaps = df.withColumn("a", F.when(F.col("key") != 7, F.col("a")))
    assert all(np.isnan(s) for s in search.ridge_scores(search.moments_by_fold(gaps, ["a", "b"], "y"), [0.5, 2.0]))


def test_search_of_fifty_trials(frame):
    _, df = frame
    for algorithm, problem, label in (("ridge_regression", "regression", "y"),
                                      ("logistic_regression", "binary_classification", "label")):
        res = models.train_selected_model(df, ["a", "b", "c"], label, "key", algorithm, problem)
        assert res.params and res.cv_score > 0.5 and res.warning is None


def test_boosting_from_counts_is_mllibs(frame):
    _, df = frame
    cols = ["a", "b", "c"]
    tables = search.cells_by_fold(df, cols, 5)
    assert len(tables) == 5 and all(rows.sum() == 400 and rows[:, 2:].sum() == 80 for _, rows in tables)
    data = VectorAssembler(inputCols=cols, outputCol="features").transform(df)
    for held, trees, depth, rate in ((0, 6, 2, 0.3), (3, 1, 4, 0.1)):
        est = models.build_estimator("gradient_boosting", "binary_classification",
                                     {"n_estimators": trees, "max_depth": depth, "learning_rate": rate}, 400)
        own = est.fit(data.where(F.col("fold") != held)).transform(data.where(F.col("fold") == held)).toPandas()
        bins, rows = tables[held]
        margin = search.boosted_margins(bins, rows[:, :2], trees, depth, rate, 1.0, 42)
        assert np.repeat(margin, rows[:, 2:].sum(1)).sum() == pytest.approx(sum(v[1] for v in own.rawPrediction), abs=1e-9)
        assert np.sort(np.repeat(margin, rows[:, 2:].sum(1))) == pytest.approx(np.sort([v[1] for v in own.rawPrediction]), abs=1e-9)
        assert np.where(margin > 0, rows[:, 3], rows[:, 2]).sum() == (own.prediction == own.label).sum()


def test_rows_are_drawn_one_by_one_and_by_number():
    counts = np.array([0, 1, 5, 32, 33, 5000])
    draw = search._draws(counts, 0.8, np.random.default_rng(1))
    drawn = np.array([draw() for _ in range(2000)])
    assert (drawn <= counts).all() and drawn.mean(0) == pytest.approx(0.8 * counts, rel=0.03)
    assert drawn.var(0) == pytest.approx(0.16 * counts, rel=0.15)
    assert (search._draws(counts, 1.0, np.random.default_rng(1))() == counts).all()


def test_boosted_search_fits_no_trial_by_jobs(frame, monkeypatch):
    _, df = frame

    def fit(*_):
        raise AssertionError("a trial was fitted by itself")

    monkeypatch.setattr(models.CrossValidator, "fit", fit)
    res = models.train_selected_model(df, ["a", "b", "c"], "label", "key", "gradient_boosting", "binary_classification", n_trials=2)
    assert res.params in models.random_trials(models.get_algorithms("classification")["gradient_boosting"], 2)
    assert 0.6 < res.cv_score <= 1 and res.warning is None


def test_boosted_search_without_room_or_numbers(frame, monkeypatch):
    _, df = frame
    trials = [(3, 2, 0.1, 0.9)]
    scores = search.boosted_scores(df, ["a", "b"], trials, 5, 42)
    assert len(scores) == 1 and 0.5 < scores[0] <= 1 and scores == search.boosted_scores(df.repartition(7), ["a", "b"], trials, 5, 42)
    gaps = df.withColumn("b", F.when(F.col("key") > 9, F.col("b")))
    assert np.isnan(search.boosted_scores(gaps, ["a", "b"], trials, 5, 42)).all()
    monkeypatch.setattr(search, "MAX_CELL_BYTES", 1000)
    assert search.boosted_scores(df, ["a", "b"], trials, 5, 42) == []
    monkeypatch.setattr(search, "MAX_VALUES", 100)
    assert search.cells_by_fold(df, ["a", "b"], 5) is None


def test_fits_do_not_carry_the_plan_of_their_input(frame):
    _, df = frame
    res = models.train_selected_model(df, ["a", "b"], "y", "key", "ridge_regression", "regression", n_trials=2)
    plan = res.predictions._jdf.queryExecution().toString()
    assert "Join" not in plan and "Window" not in plan


def test_least_leaf_keeps_the_split_bound():
    est = models.build_estimator("random_forest", "regression", {"min_samples_split": 20, "min_samples_leaf": 3}, 100)
    assert est.getMinInstancesPerNode() == 10


@pytest.mark.parametrize("algorithm,problem,label", [
    ("random_forest", "binary_classification", "label"), ("random_forest", "regression", "y"),
    ("gradient_boosting", "binary_classification", "label"), ("gradient_boosting", "regression", "y")])
def test_walked_trees(spark, frame, tmp_path, algorithm, problem, label):
    _, df = frame
    cols = ["a", "b", "c"]
    data = VectorAssembler(inputCols=cols, outputCol="features").transform(df.drop("label").join(
        df.select("key", F.col(label).alias("label")), "key"))
    model = models.build_estimator(algorithm, problem, {"n_estimators": 7, "max_depth": 4}, 400).fit(data)
    nodes = model_tables.tree_nodes(spark, model, str(tmp_path / "m"))
    w = model_tables.walked(model.transform(data), cols, nodes, max(t.depth for t in model.trees))
    far = w.select(F.abs(model_tables.tree_prediction(model) - F.col("prediction")).alias("d")).agg(F.max("d")).first()[0]
    assert far < 1e-9
    got = {r.feature: r.importance for r in model_tables.importances(nodes, cols, algorithm == "random_forest").collect()}
    assert [got[c] for c in cols] == pytest.approx(model.featureImportances.toArray().tolist(), abs=1e-12)


def test_walk_takes_batches_and_missing_numbers_go_right(spark):
    nodes = spark.createDataFrame(
        [(0, 0, 0, 1.5, 1, 2, [0.0], 1.0), (0, 1, -1, None, -1, -1, [10.0], 1.0), (0, 2, -1, None, -1, -1, [20.0], 1.0),
         (1, 0, -1, None, -1, -1, [4.0], 0.5)],
        "tree int, node int, feature int, threshold double, left int, right int, value array<double>, weight double")
    rows = spark.createDataFrame([(1, 1.0), (2, 1.5), (3, 2.0), (4, None), (5, float("nan"))], "k int, a double")
    w = model_tables.walked(rows, ["a"], nodes.repartition(3), 2)
    assert {r.k: r.sums for r in w.collect()} == {1: [12.0], 2: [12.0], 3: [22.0], 4: [22.0], 5: [22.0]}
    assert "lambda" not in w._jdf.queryExecution().executedPlan().toString()


def test_a_large_table_of_one_file_is_fitted_on_every_core(spark):
    cores = spark.sparkContext.defaultParallelism
    assert models.row_partitions(spark, 20_000) == 1
    assert models.row_partitions(spark, 7_200_000) == max(cores, 15)
    assert models.trials_at_once(spark, 1) == max(4, 2 * cores) and models.trials_at_once(spark, 1000) == 4
    df = spark.range(120_000).selectExpr("id as k", "cast(id % 9 as double) as x", "cast(id % 9 as double) as y").coalesce(1)
    res = models.train_selected_model(df, ["x"], "y", "k", "linear_regression", "regression", n_trials=0)
    assert res.predictions.rdd.getNumPartitions() == min(cores, 3)


def test_bundle_is_complete_with_its_manifest(spark, frame, tmp_path):
    _, df = frame
    raw = df.select("key", "a", "b", "c", "y")
    fp = features.FeatureProcessor("regression")
    x = fp.fit_transform(raw.drop("key"), "y")
    model = models.build_estimator("ridge_regression", "regression", {}, 400).fit(models.assemble(x, fp.selected, "y"))
    at = models.Bundle("ridge_regression", "regression", "y", fp, model).save(str(tmp_path / "b"))
    again = models.Bundle.load(spark, at)
    assert again.target == "y" and again.score(raw, ["key"]).count() == 400
    with pytest.raises(Exception):
        models.Bundle.load(spark, str(tmp_path / "none"))


def test_correlation_against_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(rng.standard_normal((300, 6)), columns=list("abcdef"))
    pdf["b"] = pdf.a * 2 + pdf.b + 1e9
    pdf.loc[rng.random(300) < 0.3, "c"] = None
    pdf["e"] = 7.25
    pdf["f"] = np.where(pdf.c.notna(), 3.0, pdf.f)     # constant where c is known
    got = {(r.a, r.b): r["corr"] for r in features.correlation_long(
        spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"{c} double" for c in "abcdef")), list("abcdef")).collect()}
    want = pdf.corr()
    for x in "abcdef":
        for y in "abcdef":
            if "e" in (x, y) or {x, y} == {"c", "f"}:
                assert got[x, y] is None
            else:
                assert got[x, y] == pytest.approx(want.loc[x, y], abs=6e-5)
    assert features.correlation_long(spark.createDataFrame(pdf[["a"]]), []).collect() == []
