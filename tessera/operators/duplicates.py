"""Whole-row duplicates in two phases.

Rows are known by a 64-bit digest first, and only digests are exchanged to find
those met twice. Whole rows are then fetched, exchanged and compared only for
these, so unlike rows with equal digests stay apart and unique rows, most of a
usual table, are never shuffled. NULLs are equal, as are -0.0 and 0.0.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Digests met twice, 8 bytes each, up to which they are broadcast; beyond, whole rows are exchanged.
BROADCAST_DIGESTS = 2_000_000
_D, _MET, _K = "\u0000digest", "\u0000met", "\u0000k"     # no column of a table is named so


def row_digest(df: DataFrame, bits: int = 64):
    """Digest of the scalar columns of a row; others only count when rows are compared."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = c + F.lit(0.0)          # -0.0 is 0.0
        if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            cols.append(F.coalesce(F.xxhash64(c), F.lit(0)))
    h = F.xxhash64(*cols) if cols else F.lit(0).cast("bigint")
    return h if bits >= 64 else F.pmod(h, F.lit(1 << bits))


def _met_twice(df: DataFrame, bits: int) -> tuple[DataFrame, DataFrame, int]:
    """``df`` with its digest, the digests met more than once and their number.

    Digests few enough to be broadcast are kept, so that they are not counted again for it.
    """
    d = df.withColumn(_D, row_digest(df, bits))
    counts = d.groupBy(_D).agg(F.count(F.lit(1)).alias("k"))
    twice = counts.where("k > 1").select(F.col(_D).alias(_MET)).persist(StorageLevel.MEMORY_AND_DISK)
    n = twice.count()
    if not 0 < n <= BROADCAST_DIGESTS:
        twice.unpersist()
    return d, twice, n


def _rows_of(d: DataFrame, twice: DataFrame, n: int, how: str) -> DataFrame:
    t = F.broadcast(twice) if n <= BROADCAST_DIGESTS else twice
    return d.join(t, F.col(_D) == F.col(_MET), how).drop(_D)


def distinct_rows(df: DataFrame, bits: int = 64) -> DataFrame:
    """One of each set of equal rows."""
    d, twice, n = _met_twice(df, bits)
    if n == 0:
        return df
    if n > BROADCAST_DIGESTS:
        return df.dropDuplicates()
    return _rows_of(d, twice, n, "left_anti").unionByName(_rows_of(d, twice, n, "left_semi").dropDuplicates())


def duplicate_counts(df: DataFrame, bits: int = 64) -> DataFrame:
    """One row (n, d): rows, and rows that repeat another one."""
    d, twice, n = _met_twice(df, bits)
    rows = df.agg(F.count(F.lit(1)).alias("n"))
    if n == 0:
        return rows.select("n", F.lit(0).cast("bigint").alias("d"))
    again = _rows_of(d, twice, n, "left_semi")
    extra = again.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias(_K)) \
        .agg(F.sum(F.col(_K) - 1).alias("d"))
    return rows.select("n", F.coalesce(extra.scalar(), F.lit(0)).cast("bigint").alias("d"))
