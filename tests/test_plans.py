"""Plan shape: the properties the design relies on at scale."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import split
from tessera.operators.stats import value_counts
from tools.plan_audit import findings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_value_counts_combine_before_shuffle(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    p = plan(value_counts(df, ["o_orderstatus", "o_orderpriority"]))
    assert "partial_count" in p and "Exchange hashpartitioning" in p
    # the partial aggregate sits below the exchange (map-side combine)
    assert p.index("partial_count") > p.index("Exchange hashpartitioning")


def test_scan_prunes_columns(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    p = plan(value_counts(df, ["l_returnflag"]))
    assert "ReadSchema: struct<l_returnflag:string>" in p


def test_stratified_split_has_no_single_partition_window(spark):
    df = spark.range(5000).withColumn("y", F.col("id") % 3)
    out = split.train_test_split(df, "id", 0.2, stratify="y")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert findings(plan(out)) == []
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_cartesian_in_preprocessing(spark):
    import __spark_entry__ as E
    out = E.queries()["c14_impute_dispatch"](spark, SF_SMALL)
    p = plan(out)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_fill_uses_growing_frames_only(spark):
    from tessera.operators.fill import ffill_bfill
    df = spark.range(2000).withColumn("v", F.when(F.col("id") % 3 == 0, F.col("id")))
    p = plan(ffill_bfill(df, ["v"], "id"))
    assert "unboundedfollowing" not in p.lower()
