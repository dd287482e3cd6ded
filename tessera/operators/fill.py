"""Order-dependent forward/backward fill (C11) without a single-partition window.

A plain ``last(ignorenulls) over (order by key)`` window has no partition key,
so Spark moves the whole table into one task. Instead:

1. cut the key range into buckets by approximate quantiles of the key
   (deterministic literal boundaries, balanced even for skewed keys; the
   bucket count follows the row count);
2. fill inside each bucket with a partitioned window;
3. per bucket keep the last / first non-null value (one row per bucket), and
   carry it across buckets by a prefix scan of several levels over that table;
4. join the carries (broadcast if counted few) and coalesce.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import range_buckets

#: Buckets that one window scans, and rows of a carry table up to which it is broadcast.
SCAN_BUCKETS = 4096
BROADCAST_BUCKETS = 100_000


def _bucket_expr(key: str, bounds: list) -> F.Column:
    k = F.col(f"`{key}`")
    expr = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        expr = F.when(k < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return expr


def _carried(edges: DataFrame, k: int, n: int) -> DataFrame:
    """What each bucket gets from those before (__cf) and after it (__cb), by a prefix scan of several levels.

    Runs of ``SCAN_BUCKETS`` buckets are scanned on their own, their edges one
    level up in the same way, and what comes from there fills what a run has not.
    """
    run = F.floor(F.col("__bucket") / SCAN_BUCKETS).cast("bigint").alias("__run")
    e = edges.select("*", run)
    prev = Window.partitionBy("__run").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("__run").orderBy(F.col("__bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    local = e.select("__bucket", "__run",
                     *[F.last(f"__l{i}", ignorenulls=True).over(prev).alias(f"__cf{i}") for i in range(k)],
                     *[F.last(f"__h{i}", ignorenulls=True).over(after).alias(f"__cb{i}") for i in range(k)])
    if n <= SCAN_BUCKETS:
        return local.drop("__run")
    at = F.col("__bucket")
    up = e.groupBy("__run").agg(
        *[F.max_by(f"__l{i}", F.when(F.col(f"__l{i}").isNotNull(), at)).alias(f"__l{i}") for i in range(k)],
        *[F.min_by(f"__h{i}", F.when(F.col(f"__h{i}").isNotNull(), at)).alias(f"__h{i}") for i in range(k)])
    runs = -(-n // SCAN_BUCKETS)
    above = _carried(up.withColumnRenamed("__run", "__bucket"), k, runs).select(
        F.col("__bucket").alias("__run"), *[F.col(f"__c{s}{i}").alias(f"__u{s}{i}") for i in range(k) for s in "fb"])
    j = local.join(F.broadcast(above) if runs <= BROADCAST_BUCKETS else above, "__run")
    return j.select("__bucket", *[F.coalesce(f"__c{s}{i}", f"__u{s}{i}").alias(f"__c{s}{i}") for i in range(k) for s in "fb"])


def ffill_bfill(df: DataFrame, columns: list[str], order_by: str,
                buckets: int | None = None) -> DataFrame:
    """Forward fill then backward fill ``columns`` in ``order_by`` order (unique key).

    ``buckets=None`` sizes the key-range buckets from the data
    (``quantiles.range_buckets``: ~4M rows each, 8 at least).
    """
    if not columns:
        return df
    if buckets is None:
        bucket, _ = range_buckets(df, order_by)
    else:
        probs = [i / buckets for i in range(1, buckets)]
        bounds = df.select(F.percentile_approx(F.col(f"`{order_by}`"), probs, 10_000)) \
            .collect()[0][0]
        bucket = _bucket_expr(order_by, sorted(set(x for x in (bounds or []) if x is not None)))
    b = df.withColumn("__bucket", bucket)
    key = F.col(f"`{order_by}`")
    # both fills use growing frames (unbounded preceding .. current row), which
    # Spark evaluates incrementally; the backward fill runs in descending key
    # order instead of a (current row .. unbounded following) frame, which
    # would be re-evaluated for every row (quadratic per bucket)
    w_fwd = Window.partitionBy("__bucket").orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    w_bwd = Window.partitionBy("__bucket").orderBy(key.desc()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    local = b.select(
        "*",
        *[F.last(F.col(f"`{c}`"), ignorenulls=True).over(w_fwd).alias(f"__f{i}")
          for i, c in enumerate(columns)],
        *[F.last(F.col(f"`{c}`"), ignorenulls=True).over(w_bwd).alias(f"__b{i}")
          for i, c in enumerate(columns)])

    # one row per bucket: its last and first non-null value per column
    edges = b.groupBy("__bucket").agg(
        *[F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), key)).alias(f"__l{i}")
          for i, c in enumerate(columns)],
        *[F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), key)).alias(f"__h{i}")
          for i, c in enumerate(columns)])
    # a row for each bucket, and few of them beside the rows of the table
    edges = edges.persist(StorageLevel.MEMORY_AND_DISK)
    n = edges.count()
    carry = _carried(edges, len(columns), n)
    joined = local.join(F.broadcast(carry) if n <= BROADCAST_BUCKETS else carry, "__bucket", "left")
    out = []
    for f in df.columns:
        if f in columns:
            i = columns.index(f)
            fwd = F.coalesce(F.col(f"__f{i}"), F.col(f"__cf{i}"))
            bwd = F.coalesce(F.col(f"__b{i}"), F.col(f"__cb{i}"))
            out.append(F.coalesce(fwd, bwd).alias(f))
        else:
            out.append(F.col(f"`{f}`"))
    return joined.select(*out)
