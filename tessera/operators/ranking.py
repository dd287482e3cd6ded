"""Exact ranks of distinct values without sorting a whole group in one task.

Each group's values are cut into slices by bounds taken from a deterministic
hash-selected sample (computed once, passed as literals, so every branch of
the plan slices identically and a recomputed task lands in the same slice).
Per-(group, slice) sizes form a small table whose running sums are the
offsets; a window over (group, slice) ranks inside each slice. Only the
offsets table (groups x slices rows) is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import count_below

SAMPLE_PER_GROUP = 20_000
ROWS_PER_SLICE = 1_000_000
BROADCAST_OFFSETS = 100_000     # (group, slice) rows
PREFIX = 32       # characters of a value that a slice bound keeps


def _bounds(distinct: DataFrame, group: str, value: str, slices: int) -> dict:
    """Sorted slice bounds by group: ``slices``, or more where a group has over ROWS_PER_SLICE values for each."""
    sizes = {r[group]: r["n"] for r in distinct.groupBy(group).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    rate = max(1, max(sizes.values(), default=1) // SAMPLE_PER_GROUP)
    sample = (distinct.where(F.pmod(F.xxhash64(F.col(group), F.col(value)), F.lit(rate)) == 0)
              # bounds need not be values: a prefix orders as well, and its length is bounded
              .groupBy(group).agg(F.sort_array(F.collect_list(F.substring(value, 1, PREFIX))).alias("s"))
              .collect())
    out = {}
    for r in sample:                       # at most ~SAMPLE_PER_GROUP values per group
        vals = r["s"]
        step = max(1, len(vals) // max(slices, -(-sizes[r[group]] // ROWS_PER_SLICE)))
        out[r[group]] = sorted(set(vals[step::step]))
    return out


def dense_codes(distinct: DataFrame, group: str, value: str, slices: int = 64) -> DataFrame:
    """0-based position of each (group, value) in value order within its group.

    ``distinct`` must hold each (group, value) once.
    """
    bounds = _bounds(distinct, group, value, slices)
    if bounds:
        bmap = F.create_map(*[e for k, v in bounds.items() for e in
                              (F.lit(k), F.array(*[F.lit(x) for x in v]).cast("array<string>"))])
        arr = F.coalesce(F.element_at(bmap, F.col(group)), F.array().cast("array<string>"))
        sl = count_below(arr, F.col(value), max(map(len, bounds.values())).bit_length())
    else:
        sl = F.lit(0)
    sliced = distinct.withColumn("__pid", sl)
    sizes = sliced.groupBy(group, "__pid").agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(group).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "__pid", F.coalesce(F.sum("__c").over(w), F.lit(0))
                           .alias("__off"))
    inner = Window.partitionBy(group, "__pid").orderBy(value)
    return (sliced.withColumn("__r", F.row_number().over(inner))
            .join(F.broadcast(offsets) if offsets.count() <= BROADCAST_OFFSETS else offsets, [group, "__pid"])
            .select(group, value, (F.col("__off") + F.col("__r") - 1).alias("code")))
