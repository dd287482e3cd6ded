"""Fitted models as tables.

A tree ensemble is a table of nodes (tree, node, feature, threshold, left,
right, value, ...) read from the form MLlib saves it in, with a weight for each
tree; a linear model is a table of terms. Predictions and importances are then
plain column expressions over these tables, which any engine can recompute, and
which check what MLlib's own ``transform`` and ``featureImportances`` say.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def tree_nodes(spark: SparkSession, model, path: str) -> DataFrame:
    """One row a node of a saved forest or boosted ensemble of continuous features.

    ``value``: class shares of a classification tree, else the one predicted
    number; ``left`` is taken if the feature is at most the threshold, and is
    -1 in a leaf; ``rows`` is the weighted row count that importances use.
    """
    model.write().overwrite().save(path)
    d = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    weights = [float(w) for w in model.treeWeights]
    classes = _votes(model)
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
    value = F.transform("impurityStats", lambda x: x / total) if classes else F.array("prediction")
    return d.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"), F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"), value.alias("value"), "gain",
        (total if classes else F.get("impurityStats", F.lit(0))).alias("rows"),
        F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("treeID") + 1).alias("weight"))


def _votes(model) -> bool:
    """Whether trees vote with class shares (a forest of classification trees) instead of adding numbers."""
    return "RandomForestClassification" in type(model).__name__


def _tree_arrays(nodes: DataFrame) -> list[tuple]:
    """(weight, feature, threshold, left, right, value) of each tree, nodes in order of their number.

    The model is one bounded value, which MLlib's driver holds as well.
    """
    t = nodes.select("tree", "node", "feature", "threshold", "left", "right", "value", "weight").toArrow()
    at = {c: t.column(c).combine_chunks() for c in t.column_names}
    tree = at["tree"].to_numpy()
    order = np.lexsort((at["node"].to_numpy(), tree))
    starts = np.flatnonzero(np.r_[True, np.diff(tree[order]) != 0]) if len(order) else []
    value = np.asarray(at["value"].flatten().to_numpy(zero_copy_only=False), float).reshape(len(order), -1)
    num = {c: np.asarray(at[c].to_numpy(zero_copy_only=False)) for c in ("feature", "left", "right", "weight")}
    threshold = np.asarray(at["threshold"].to_numpy(zero_copy_only=False), float)
    return [(float(num["weight"][i[0]]), num["feature"][i], threshold[i], num["left"][i], num["right"][i], value[i])
            for i in np.split(order, starts[1:])] if len(order) else []


def walked(rows: DataFrame, features: list[str], nodes: DataFrame, depth: int) -> DataFrame:
    """``rows`` with ``sums``: the weighted sum of the leaf values that a row reaches, tree by tree.

    A batch of rows goes down a tree level by level, all rows at once; rows are
    neither multiplied by trees nor shuffled. A missing number goes right.
    """
    trees = _tree_arrays(nodes)

    @F.arrow_udf("array<double>")
    def leaf_sums(*cols: pa.Array) -> pa.Array:
        x = np.stack([np.asarray(c.to_numpy(zero_copy_only=False), float) for c in cols])
        n = x.shape[1]
        each, sums = np.arange(n), np.zeros((n, trees[0][-1].shape[1] if trees else 0))
        for weight, feature, threshold, left, right, value in trees:
            at = np.zeros(n, np.int64)
            for _ in range(max(1, depth)):
                inner = left[at] >= 0
                if not inner.any():
                    break
                down = np.where(x[feature[at], each] <= threshold[at], left[at], right[at])
                at = np.where(inner, down, at)
            sums += value[at] * weight
        stops = np.arange(n + 1, dtype=np.int32) * sums.shape[1]
        return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(sums.ravel()))

    return rows.withColumn("sums", leaf_sums(*[F.col(f"`{c}`").cast("double") for c in features]))


def tree_prediction(model) -> Column:
    """The prediction of a row from its ``sums``."""
    if _votes(model):
        return (F.array_position("sums", F.array_max("sums")) - 1).cast("double")
    if "Classification" in type(model).__name__:
        return F.when(F.get("sums", F.lit(0)) > 0, 1.0).otherwise(0.0)
    total = F.get("sums", F.lit(0))
    return total / F.lit(float(len(model.treeWeights))) if "RandomForest" in type(model).__name__ else total


def importances(nodes: DataFrame, features: list[str], per_tree: bool) -> DataFrame:
    """(feature, importance): share of the gain of all splits, weighted by the rows split; each tree counts alike if ``per_tree``."""
    gains = nodes.where("left >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("g"))
    if per_tree:
        totals = gains.groupBy(F.col("tree").alias("t")).agg(F.sum("g").alias("all"))
        gains = gains.join(totals, F.col("tree") == F.col("t")).select("feature", (F.col("g") / F.col("all")).alias("g"))
    by_feature = gains.groupBy(F.col("feature").alias("i")).agg(F.sum("g").alias("g"))
    total = by_feature.agg(F.sum("g"))
    names = F.array(*[F.lit(f) for f in features])
    every = nodes.sparkSession.range(len(features)).select(F.col("id").cast("int").alias("k"))
    return every.join(by_feature, F.col("k") == F.col("i"), "left").select(
        F.element_at(names, F.col("k") + 1).alias("feature"),
        F.coalesce(F.col("g") / total.scalar(), F.lit(0.0)).alias("importance"))


def margin(model, features: list[str]) -> Column:
    """The decision value of a binary linear model as an expression over the feature columns."""
    out = F.lit(float(model.intercept))
    for w, c in zip(model.coefficients.toArray().tolist(), features):
        out = out + F.lit(w) * F.col(f"`{c}`").cast("double")
    return out


def logistic_objective(rows: DataFrame, z: Column, coefficients: list[float], c: float, label: str = "label") -> float:
    """Summed log loss times C plus half the squared coefficients."""
    loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - F.col(label) * z
    return c * rows.agg(F.sum(loss)).first()[0] + 0.5 * sum(w * w for w in coefficients)


def hinge_objective(rows: DataFrame, z: Column, coefficients: list[float], c: float, label: str = "label") -> float:
    """Summed hinge loss times C plus half the squared coefficients."""
    loss = F.greatest(F.lit(0.0), 1 - (2 * F.col(label) - 1) * z)
    return c * rows.agg(F.sum(loss)).first()[0] + 0.5 * sum(w * w for w in coefficients)
