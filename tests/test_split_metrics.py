"""Splits, folds and metrics against brute force and MLlib evaluators."""

import hashlib
import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tessera.operators import metrics, split


def md5(k):
    return hashlib.md5(str(k).encode()).hexdigest()


def test_split_is_partition_and_exact_size(spark):
    df = spark.range(1000).withColumn("y", F.col("id") % 3)
    out = split.train_test_split(df, "id", 0.2, stratify="y").collect()
    assert len(out) == 1000
    for k in range(3):
        n = sum(1 for r in out if r["y"] == k)
        t = sum(1 for r in out if r["y"] == k and r["part"] == "test")
        assert t == math.ceil(0.2 * n)


def test_hash_rank_brute_force(spark):
    df = spark.range(3000).withColumn("g", F.col("id") % 2)
    got = {r["id"]: r["__rank"] for r in split.hash_rank(df, "id", "g").collect()}
    for g in range(2):
        ids = sorted((i for i in range(3000) if i % 2 == g), key=lambda i: (md5(i), i))
        for rank, i in enumerate(ids, 1):
            assert got[i] == rank


def test_folds_balanced(spark):
    out = split.assign_folds(spark.range(103), "id", 5).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in out) == [20, 20, 21, 21, 21]


def test_class_counts_flag(spark):
    df = spark.createDataFrame([(0,), (0,), (1,)], "y int")
    assert all(r["too_small"] for r in split.class_counts(df, "y").collect())


@pytest.fixture
def binary(spark):
    rows = [(i, i % 2, (i * 7) % 2 if i % 5 else 1 - i % 2, ((i * 37) % 11) / 11.0)
            for i in range(200)]
    return spark.createDataFrame(rows, "k long, label int, prediction int, score double")


def test_accuracy_and_weighted_f1_vs_mllib(spark, binary):
    m = metrics.classification_metrics(binary).collect()[0]
    d = binary.select(F.col("label").cast("double").alias("label"),
                      F.col("prediction").cast("double").alias("prediction"))
    for name, ev in [("accuracy", "accuracy"), ("precision", "weightedPrecision"),
                     ("recall", "weightedRecall"), ("f1", "weightedFMeasure")]:
        exp = MulticlassClassificationEvaluator(metricName=ev).evaluate(d)
        assert m[name] == pytest.approx(exp, rel=1e-9)


def test_auc_vs_mllib_and_brute_force(spark, binary):
    got = metrics.roc_auc(binary, buckets=4).collect()[0]["auc"]
    rows = binary.collect()
    pos = [r["score"] for r in rows if r["label"] == 1]
    neg = [r["score"] for r in rows if r["label"] != 1]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert got == pytest.approx(brute, rel=1e-12)
    d = binary.select(F.col("label").cast("double").alias("label"), F.col("score").alias("raw"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="raw", metricName="areaUnderROC",
                                       numBins=0).evaluate(d)
    assert got == pytest.approx(ev, rel=1e-9)


def test_confusion_matrix_empty_predicted_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 1), (2, 2)], "label int, prediction int")
    cm = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion_grid(df, [0, 1, 2]).collect()}
    assert len(cm) == 9 and cm[(1, 1)] == 0 and cm[(1, 0)] == 1


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    m = metrics.regression_metrics(df).collect()[0]
    assert m["mse"] == pytest.approx((0.25 + 0 + 1) / 3)
    assert m["mae"] == pytest.approx(0.5)
    assert m["r2"] == pytest.approx(1 - 1.25 / 2.0)
