"""Connected components of an edge table by alternating large and small stars.

Each round is two aggregations and two joins over the edges; minima are
combined on the map side and the joins are plain equi-joins, which Spark
splits where a node is hot. No node's neighbours are ever gathered in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import discard, written


def _stars(e: DataFrame) -> DataFrame:
    """Large star, then small star, over edges with u > v."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.union(e.select("u", "v").join(low, "u").select("u", F.col("m").alias("v")))
    large = large.filter("u > v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    hops = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hops.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> tuple[DataFrame, list[str]]:
    """(node, root) for every node of ``edges`` (u, v); root is the component's least node.

    Roots have no row of their own. The second value lists the scratch tables
    that the result reads.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    e, path = written(e.distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        n, to = written(_stars(e), "edges")
        discard(spark, path)
        e, path, before = n, to, mark
        mark = _mark(e)
        if mark == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")), [path]


def _mark(e: DataFrame):
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                       F.bit_xor(F.xxhash64("v", "u"))).first())
