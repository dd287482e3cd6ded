"""A key holding a third of all rows: results stay exact and whole."""

import math

from pyspark.sql import functions as F

from tessera.operators import split
from tessera.operators.infer import profile_dataset
from tessera.operators.quantiles import exact_quantiles


def hot_frame(spark, n=3000):
    # value 'hot' (and 7.0) in a third of the rows, the rest spread out
    return spark.range(n).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), (F.col("id") % 97).cast("string"))).alias("s"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise(F.col("id").cast("double")).alias("x"))


def test_profile_exact_under_hot_value(spark):
    p = {r["name"]: r for r in profile_dataset(hot_frame(spark)).rows}
    assert p["s"]["unique_count"] == 1 + len({i % 97 for i in range(3000) if i % 3})
    assert p["s"]["most_frequent"] == "hot"
    assert p["x"]["unique_count"] == len({7.0 if i % 3 == 0 else float(i) for i in range(3000)})


def test_quantiles_exact_under_hot_value(spark):
    import numpy as np
    xs = [7.0 if i % 3 == 0 else float(i) for i in range(3000)]
    got = exact_quantiles(hot_frame(spark), ["x"], [0.1, 0.25, 0.5, 0.9])["x"]
    assert np.allclose(got, np.percentile(xs, [10, 25, 50, 90]))


def test_stratified_split_with_hot_class(spark):
    df = hot_frame(spark).withColumn("cls", F.when(F.col("s") == "hot", "hot").otherwise("rest"))
    out = split.train_test_split(df, "id", 0.2, stratify="cls").groupBy("cls", "part").count()
    got = {(r["cls"], r["part"]): r["count"] for r in out.collect()}
    assert got[("hot", "test")] == math.ceil(0.2 * 1000)
    assert got[("rest", "test")] == math.ceil(0.2 * 2000)
    assert sum(got.values()) == 3000
