"""Registered checks of fitted models.

A fit is turned into tables, and its predictions and importances are worked out
again from them (``operators.model_tables``); linear fits are held against
their optimum (``operators.search``).
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.output import round_doubles
from ..operators import model_tables, models, search, split
from . import workloads as W

FEATURES = ["n_chars", "toxic"]
#: Documents' length in thousands of characters, so that coefficients are of order one.
LINEAR = ["k_chars", "toxic"]


def _depth(model) -> int:
    return max(t.depth for t in model.trees)


def _walk(spark, rows: DataFrame, features: list[str], model) -> DataFrame:
    nodes = model_tables.tree_nodes(spark, model, W._scratch(spark))
    rows = rows.repartition(models.row_partitions(spark, rows.count()))
    return model_tables.walked(rows, features, nodes, _depth(model)).withColumn(
        "walked", model_tables.tree_prediction(model))


def _agrees(prediction: Column) -> Column:
    return (F.abs(F.col("walked") - prediction) <= 1e-9 * (1 + F.abs(prediction))).alias("agrees")


def forest_walk(algorithm: str):
    """MLlib's predictions of both parts, and whether the node table gives the same."""
    def run(spark, sf_dir):
        df = W._labels_frame(spark, sf_dir)
        res = models.train_selected_model(df, FEATURES, "quality", "doc_id", algorithm, "binary_classification", n_trials=0)
        w = _walk(spark, df, FEATURES, res.model).select("doc_id", "walked")
        return res.predictions.join(w, "doc_id").select("part", "doc_id", "label", _agrees(F.col("prediction")))
    return run


def default_walk(spark, sf_dir):
    """The same for the default boosted regression."""
    part = W.load(spark, sf_dir, "part")
    res = models.train_selected_model(part, ["p_size"], "p_retailprice", "p_partkey", "gradient_boosting", "regression",
                                      n_trials=0)
    w = _walk(spark, part, ["p_size"], res.model).select("p_partkey", "walked")
    return round_doubles(res.predictions.join(w, "p_partkey").select("part", "p_partkey", "label", _agrees(F.col("prediction"))))


def batch_walk(spark, sf_dir):
    """A fitted model scores every document, labelled or not."""
    df = W._labels_frame(spark, sf_dir)
    res = models.train_selected_model(df, FEATURES, "quality", "doc_id", "random_forest", "binary_classification", n_trials=0)
    docs = W.load(spark, sf_dir, "documents").select("doc_id", "n_chars", F.lit(0).alias("toxic"))
    scored = res.model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(docs))
    w = _walk(spark, scored.select("doc_id", *FEATURES, "prediction"), FEATURES, res.model)
    return w.select("doc_id", F.col("prediction").isin(0.0, 1.0).alias("in_domain"), _agrees(F.col("prediction")))


def _linear_frame(spark, sf_dir):
    df = W._labels_frame(spark, sf_dir).select(
        "doc_id", (F.col("n_chars") / 1000.0).alias("k_chars"), "toxic", F.col("quality").cast("double").alias("label"))
    return split.train_test_split(df, "doc_id", 0.2, "label")


def logistic_optimum(spark, sf_dir):
    """The optimum by Newton steps, and whether MLlib's fit has the same objective."""
    train = _linear_frame(spark, sf_dir).where("part = 'train'").withColumn("fold", F.lit(0)).cache()
    best = search.logistic_fits(train, LINEAR, [(1.0, "l2", -1)])[0].tolist()
    data = VectorAssembler(inputCols=LINEAR, outputCol="features").transform(train)
    model = models.build_estimator("logistic_regression", "binary_classification", {}, train.count()).fit(data)
    own = model.coefficients.toArray().tolist()
    at = model_tables.logistic_objective(train, model_tables.margin(model, LINEAR), own, 1.0)
    z = F.lit(best[-1]) + sum((F.lit(w) * F.col(c) for w, c in zip(best, LINEAR)), F.lit(0.0))
    least = model_tables.logistic_objective(train, z, best[:-1], 1.0)
    train.unpersist()
    rows = [(t, v, abs(at - least) <= 1e-6 * abs(least)) for t, v in zip([*LINEAR, "intercept"], best)]
    return round_doubles(spark.createDataFrame(rows, "term string, coefficient double, mllib_at_optimum boolean"))


def svm_optimum(spark, sf_dir):
    """No step of one or ten percent along a term lowers the objective of the fit by more than 0.1 percent."""
    train = _linear_frame(spark, sf_dir).where("part = 'train'").cache()
    data = VectorAssembler(inputCols=LINEAR, outputCol="features").transform(train)
    model = models.build_estimator("svm", "binary_classification", {}, train.count()).fit(data)
    w = [*model.coefficients.toArray().tolist(), float(model.intercept)]

    def objective(v):
        z = F.lit(v[-1]) + sum((F.lit(x) * F.col(c) for x, c in zip(v, LINEAR)), F.lit(0.0))
        return model_tables.hinge_objective(train, z, v[:-1], 1.0)

    least, rows = objective(w), []
    for i, term in enumerate([*LINEAR, "intercept"]):
        near = [objective([x + (step * max(abs(x), 0.1) if j == i else 0) for j, x in enumerate(w)])
                for step in (-0.1, -0.01, 0.01, 0.1)]
        rows.append((term, min(near) >= least - 1e-3 * abs(least)))
    train.unpersist()
    return spark.createDataFrame(rows, "term string, at_optimum boolean")


def _importances(spark, sf_dir):
    """(model, feature, importance, agrees): of a forest, and of a boosted model with a constant feature."""
    df = W._labels_frame(spark, sf_dir)
    forest = models.train_selected_model(df, FEATURES, "quality", "doc_id", "random_forest", "binary_classification", n_trials=0)
    part = W.load(spark, sf_dir, "part").withColumn("constant", F.lit(1.0))
    boosted = models.train_selected_model(part, ["constant", "p_size"], "p_retailprice", "p_partkey", "gradient_boosting",
                                          "regression", n_trials=0)
    out = None
    for name, res, cols, per_tree in (("forest", forest, FEATURES, True), ("boosted", boosted, ["constant", "p_size"], False)):
        nodes = model_tables.tree_nodes(spark, res.model, W._scratch(spark))
        own = dict(res.feature_importance)
        said = F.element_at(F.create_map(*[F.lit(v) for f in cols for v in (f, float(own[f]))]), F.col("feature"))
        f = model_tables.importances(nodes, cols, per_tree).select(
            F.lit(name).alias("model"), "feature", "importance", (F.abs(F.col("importance") - said) <= 1e-9).alias("agrees"))
        out = f if out is None else out.unionByName(f)
    return out


def importance_table(spark, sf_dir):
    """Importances summed by model are one; those of the constant feature are known."""
    d = _importances(spark, sf_dir)
    w = Window.partitionBy("model")      # a row for each feature of a model
    return round_doubles(d.select("model", "feature", "agrees", F.sum("importance").over(w).alias("total"),
                                  F.when(F.col("model") == "boosted", F.col("importance")).alias("known")))


def importance_ranks(spark, sf_dir):
    """Importances in descending order, of the model whose order is known."""
    w = Window.partitionBy("model").orderBy(F.col("importance").desc(), "feature")
    d = _importances(spark, sf_dir).withColumn("rank", F.row_number().over(w).cast("bigint"))
    return d.where("model = 'boosted'").select("feature", "rank", "agrees")


def ridge_search(spark, sf_dir):
    """All 50 trials of a ridge search with their held-out scores, and the best."""
    part = W.load(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") / 1000.0).alias("x"),
                                                (F.col("p_size") * 3 + F.col("p_retailprice") / 1000).alias("label"))
    train = split.train_test_split(part, "p_partkey", 0.2).where("part = 'train'").select("p_partkey", "x", "label")
    trials = models.random_trials(models.get_algorithms("regression")["ridge_regression"], 50)
    scores = search.ridge_scores(search.moments_by_fold(split.assign_folds(train, "p_partkey", 5), ["x"]),
                                 [t["alpha"] for t in trials])
    top = max(range(len(trials)), key=lambda i: scores[i])
    rows = [(i, t["alpha"], s, i == top) for i, (t, s) in enumerate(zip(trials, scores))]
    return round_doubles(spark.createDataFrame(rows, "trial bigint, alpha double, score double, best boolean"))


def registry() -> dict:
    return {
        "m04_forest_walk": forest_walk("random_forest"),
        "m05_boosting_walk": forest_walk("gradient_boosting"),
        "m06_logistic_optimum": logistic_optimum,
        "m07_svm_optimum": svm_optimum,
        "m11_default_walk": default_walk,
        "m12_ridge_search": ridge_search,
        "m15_batch_walk": batch_walk,
        "e07_importance_table": importance_table,
        "t04_importance_ranks": importance_ranks,
    }
