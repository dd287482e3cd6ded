"""Evaluation metrics as aggregations over (label, prediction[, score]).

Confusion counts come from one shuffle on (label, prediction); every other
classification metric is derived from that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import range_buckets


def _div0(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion_counts(pred: DataFrame, group: list[str] | None = None) -> DataFrame:
    """E05 (sparse): (label, prediction, n) for observed pairs."""
    g = group or []
    return pred.groupBy(*g, "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(pred: DataFrame) -> DataFrame:
    """(label, prediction, n) of the observed pairs, at any number of classes."""
    return confusion_counts(pred).select("label", "prediction", F.col("n").cast("bigint").alias("n"))


def confusion_grid(pred: DataFrame, classes: list) -> DataFrame:
    """E05 over the classes the caller names: every pair of them, zeros filled."""
    t = pred.schema["label"].dataType
    cells = pred.sparkSession.createDataFrame([(c,) for c in classes], ["label"]).select(
        F.col("label").cast(t).alias("label"),
        F.explode(F.array(*[F.lit(c).cast(t) for c in classes])).alias("prediction"))
    n = F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    return cells.join(confusion_counts(pred), ["label", "prediction"], "left").select(
        "label", "prediction", n)


def per_class(pred: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Per class: support, predicted count, true positives, precision, recall, F1.

    One scan: every row emits (true class: support 1, tp 0/1) and (predicted
    class: predicted 1); one map-side-combined shuffle on (group, class).
    """
    g = group or []
    hit = (F.col("label") == F.col("prediction")).cast("long")
    ev = F.array(
        F.struct(F.col("label").alias("cls"), F.lit(1).cast("long").alias("s"),
                 F.lit(0).cast("long").alias("p"), hit.alias("t")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("long").alias("s"),
                 F.lit(1).cast("long").alias("p"), F.lit(0).cast("long").alias("t")))
    t = (pred.select(*g, F.inline(ev)).groupBy(*g, "cls")
         .agg(F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("t").alias("tp")))
    p = _div0(F.col("tp"), F.col("predicted"))
    r = _div0(F.col("tp"), F.col("support"))
    return t.select(*g, "cls", F.col("support").cast("bigint").alias("support"),
                    "predicted", "tp", p.alias("precision"), r.alias("recall"),
                    _div0(2 * p * r, p + r).alias("f1"))


def classification_metrics(pred: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Accuracy and support-weighted precision, recall, F1 (zero division -> 0)."""
    g = group or []
    pc = per_class(pred, g)
    agg = pc.groupBy(*g).agg(
        F.sum("support").alias("n"), F.sum("tp").alias("correct"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    return agg.select(*g, (F.col("correct") / F.col("n")).alias("accuracy"),
                      (F.col("wp") / F.col("n")).alias("precision"),
                      (F.col("wr") / F.col("n")).alias("recall"),
                      (F.col("wf") / F.col("n")).alias("f1"))


def classification_report(pred: DataFrame) -> DataFrame:
    """Per-class rows, then accuracy, macro avg and weighted avg rows."""
    pc = per_class(pred)
    rows = pc.select(F.col("cls").cast("string").alias("class_name"), "precision", "recall",
                     F.col("f1").alias("f1_score"), "support")
    tot = pc.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.count("cls").alias("k"),
                 F.avg("precision").alias("mp"), F.avg("recall").alias("mr"),
                 F.avg("f1").alias("mf"),
                 F.sum(F.col("precision") * F.col("support")).alias("wp"),
                 F.sum(F.col("recall") * F.col("support")).alias("wr"),
                 F.sum(F.col("f1") * F.col("support")).alias("wf"))
    acc = F.col("tp") / F.col("n")
    n = F.col("n").cast("bigint")
    summary = tot.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class_name"), acc.alias("precision"),
                 acc.alias("recall"), acc.alias("f1_score"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("class_name"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1_score"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class_name"),
                 (F.col("wp") / F.col("n")).alias("precision"),
                 (F.col("wr") / F.col("n")).alias("recall"),
                 (F.col("wf") / F.col("n")).alias("f1_score"), n.alias("support")))))
    return rows.unionByName(summary)


#: Rows of the carry table of grouped AUC up to which it is broadcast.
BROADCAST_CARRY = 200_000


def _bucket_of(x, bounds):
    e = F.lit(0)
    for b in bounds:
        e = e + F.when(x > F.lit(b), 1).otherwise(0)
    return e


def roc_auc(pred: DataFrame, group: list[str] | None = None,
            buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC, ties counted half: sum over scores of
    pos * (negatives below + negatives equal / 2) / (P * N).

    The running count of negatives is two-level (score-range buckets from
    approximate quantiles, then a window inside each bucket), so no single
    task ever sorts all distinct scores.
    """
    g = group or []
    s = pred.groupBy(*g, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    if buckets is None:      # sized from the number of distinct scores
        bucket, _ = range_buckets(s, "score")
    else:
        probs = [i / buckets for i in range(1, buckets)]
        bounds = sorted(set(b for b in (pred.select(F.percentile_approx("score", probs, 10_000))
                                        .collect()[0][0] or []) if b is not None))
        bucket = _bucket_of(F.col("score"), bounds)
    s = s.withColumn("__b", bucket)
    wl = Window.partitionBy(*g, "__b").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    local = s.withColumn("__below", F.coalesce(F.sum("neg").over(wl), F.lit(0)))
    tot = s.groupBy(*g, "__b").agg(F.sum("neg").alias("__bn"))
    wb = Window.partitionBy(*g).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = tot.select(*g, "__b", F.coalesce(F.sum("__bn").over(wb), F.lit(0)).alias("__carry"))
    # (groups x buckets) rows: counted before they are broadcast
    j = local.join(F.broadcast(carry) if carry.count() <= BROADCAST_CARRY else carry, [*g, "__b"])
    term = F.col("pos") * (F.col("__below") + F.col("__carry") + F.col("neg") / 2.0)
    agg = j.groupBy(*g).agg(F.sum(term).alias("u"), F.sum("pos").alias("P"),
                            F.sum("neg").alias("N"))
    return agg.select(*g, F.coalesce(F.try_divide(F.col("u"), F.col("P") * F.col("N")),
                                     F.lit(0.0)).alias("auc"))


def regression_metrics(pred: DataFrame, group: list[str] | None = None) -> DataFrame:
    """MSE, RMSE, MAE, R^2 = 1 - SSE/SST over the rows with both values.

    A constant label has no SST: R^2 is 1 where every prediction is right, else 0.
    """
    g = group or []
    e = F.col("label") - F.col("prediction")
    pairs = pred.where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
    agg = pairs.groupBy(*g).agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                                F.sum(e * e).alias("sse"), F.min("label").alias("lo"),
                                F.max("label").alias("hi"),
                                F.var_pop("label").alias("v"), F.count(F.lit(1)).alias("n"))
    r2 = F.when(F.col("lo") == F.col("hi"), F.when(F.col("sse") == 0, 1.0).otherwise(0.0)) \
        .otherwise(F.lit(1.0) - F.try_divide(F.col("sse"), F.col("v") * F.col("n")))
    return agg.select(*g, "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))


def metric_bundle(pred: DataFrame, problem_type: str) -> DataFrame:
    """Metrics per ``part`` (train / test); AUC added for two classes."""
    if problem_type in ("classification", "binary_classification"):
        m = classification_metrics(pred, ["part"])
        if "score" in pred.columns:
            m = m.join(roc_auc(pred, ["part"]), "part", "left")
        return m
    return regression_metrics(pred, ["part"])


def evaluation_report(pred: DataFrame, problem_type: str, key: str) -> DataFrame:
    """One row of test metrics plus the first 10 predictions in key order
    (a bounded top-k, never a collect of the whole column)."""
    first = [r["prediction"] for r in pred.orderBy(key).limit(10).select("prediction").collect()]
    if problem_type in ("classification", "binary_classification"):
        m = classification_metrics(pred)
    else:
        m = regression_metrics(pred)
    n = pred.agg(F.count(F.lit(1)).alias("test_samples"))
    return _with_literals(m, n, {"problem_type": problem_type,
                                 "predictions_sample": ",".join(map(str, first))})


def full_evaluation(pred: DataFrame, problem_type: str, key: str, model_name: str,
                    features: list[str], importances: list[tuple[str, float]] = ()) -> DataFrame:
    """E08 in full: the metrics row with model_name, features_used, per-class report,
    confusion pairs and sorted feature importances as arrays of structs."""
    out = evaluation_report(pred, problem_type, key).withColumns({
        "model_name": F.lit(model_name),
        "features_used": F.array(*[F.lit(f) for f in features]).cast("array<string>"),
        "feature_importance": F.array(*[
            F.struct(F.lit(f).alias("feature"), F.lit(float(v)).alias("importance"))
            for f, v in sorted(importances, key=lambda x: -x[1])]).cast(
                "array<struct<feature:string,importance:double>>")})
    if problem_type not in ("classification", "binary_classification"):
        return out

    def gathered(df, name):
        # one row per class, or per observed pair of classes
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name)).withColumn("__one", F.lit(1))

    out = out.withColumn("__one", F.lit(1))
    out = out.join(gathered(classification_report(pred), "classification_report"), "__one")
    return out.join(gathered(confusion_matrix(pred), "confusion_matrix"), "__one").drop("__one")


def _with_literals(metrics_row: DataFrame, count_row: DataFrame, lits: dict) -> DataFrame:
    cnt = count_row.collect()[0]["test_samples"]
    out = metrics_row.withColumn("test_samples", F.lit(cnt).cast("bigint"))
    for k, v in lits.items():
        out = out.withColumn(k, F.lit(v))
    return out
