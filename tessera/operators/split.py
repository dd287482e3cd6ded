"""Deterministic splits and folds (M01-M03) by hash rank.

Rows are ordered by ``md5(cast(key as string))``. The exact rank of a row
inside its group (whole table, or one class) is computed without sorting a
group in one task: rows fall into 4096 md5-prefix buckets; bucket sizes per
group (a small table, size checked before broadcast) give the rows before
each bucket, and a window partitioned by (group, bucket) ranks inside it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREFIX_HEX = 3            # at least 16**3 = 4096 buckets per group
BROADCAST_MAX_ROWS = 2_000_000


def hash_key(key: str):
    return F.md5(F.col(f"`{key}`").cast("string"))


def prefix_digits(rows_hint: int) -> int:
    """md5-prefix length so that a bucket holds about a million rows (3..6 hex digits)."""
    return int(min(6, max(PREFIX_HEX, math.ceil(math.log(max(rows_hint, 1) / 1e6, 16)))))


def hash_rank(df: DataFrame, key: str, group: str | None = None,
              rows_hint: int | None = None) -> DataFrame:
    """Adds ``__h`` (md5 text), ``__rank`` (1-based, by md5 within group), ``__n`` (group size).

    """
    h, offsets = _bucketed(df, key, group, rows_hint)
    w = Window.partitionBy("__g", "__bk").orderBy("__h", F.col(f"`{key}`"))
    ranked = h.withColumn("__r", F.row_number().over(w)).join(offsets, ["__g", "__bk"])
    return ranked.withColumn("__rank", F.col("__before") + F.col("__r")) \
                 .drop("__bk", "__r", "__before", "__c")


def _bucketed(df: DataFrame, key: str, group: str | None, rows_hint: int | None):
    """Rows with group, md5 and bucket; (group, bucket, rows in it, rows before it, group size).

    The row count (``rows_hint`` when known, else counted) sets the number of
    md5-prefix buckets, so that a (group, bucket) window stays at about a million rows.
    """
    rows_hint = df.count() if rows_hint is None else rows_hint
    g = F.col(f"`{group}`") if group else F.lit(0)
    h = df.withColumn("__g", g).withColumn("__h", hash_key(key)) \
          .withColumn("__bk", F.substring("__h", 1, prefix_digits(rows_hint)))
    sizes = h.groupBy("__g", "__bk").agg(F.count(F.lit(1)).alias("__c"))
    wcum = Window.partitionBy("__g").orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    wtot = Window.partitionBy("__g")
    offsets = sizes.select("__g", "__bk", "__c",
                           F.coalesce(F.sum("__c").over(wcum), F.lit(0)).alias("__before"),
                           F.sum("__c").over(wtot).alias("__n"))
    if offsets.count() <= BROADCAST_MAX_ROWS:
        offsets = F.broadcast(offsets)
    return h, offsets


def train_test_split(df: DataFrame, key: str, test_size: float = 0.2,
                     stratify: str | None = None, rows_hint: int | None = None) -> DataFrame:
    """Adds ``part`` = 'test' for the first ceil(test_size * n) rows
    (per class when stratified) in md5 order, 'train' otherwise.

    Buckets before the cutoff are all test, those after it all train: only the
    one bucket of each group that holds the cutoff is shuffled and ranked.
    """
    h, offsets = _bucketed(df, key, stratify, rows_hint)
    j = h.join(offsets, ["__g", "__bk"])
    cutoff = F.ceil(F.col("__n") * F.lit(test_size))
    cut = (F.col("__before") < cutoff) & (F.col("__before") + F.col("__c") > cutoff)
    whole = j.where(~cut).withColumn("part", F.when(F.col("__before") < cutoff, "test").otherwise("train"))
    w = Window.partitionBy("__g", "__bk").orderBy("__h", F.col(f"`{key}`"))
    ranked = j.where(cut).withColumn("__r", F.col("__before") + F.row_number().over(w))
    ranked = ranked.withColumn("part", F.when(F.col("__r") <= cutoff, "test").otherwise("train")).drop("__r")
    return whole.unionByName(ranked).drop("__g", "__h", "__bk", "__c", "__before", "__n")


def assign_folds(df: DataFrame, key: str, n_folds: int = 5,
                 stratify: str | None = None, rows_hint: int | None = None) -> DataFrame:
    """``fold`` = (rank - 1) mod n_folds, ranks per class when stratified."""
    r = hash_rank(df, key, stratify, rows_hint)
    return r.withColumn("fold", F.pmod(F.col("__rank") - 1, F.lit(n_folds)).cast("int")) \
            .drop("__g", "__h", "__rank", "__n")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and whether some class has fewer than 2 rows.

    The smallest class is one number, taken to the driver and back as a literal.
    """
    cnt = df.groupBy(F.col(f"`{label}`").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    least = cnt.agg(F.min("n")).first()[0]
    return cnt.select("label", "n", F.lit(least is not None and least < 2).alias("too_small"))
