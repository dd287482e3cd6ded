"""Outlier treatment (C15-C17) and outlier detail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..session import cut_lineage
from .quantiles import exact_quantiles
from .stats import iqr_bounds, smallest_k_per_group


def _quantiles(df: DataFrame, cols: list[str], probs, exact: bool = True) -> dict:
    """Exact (distributed, ``quantiles.exact_quantiles``) or sketch quantiles."""
    if not cols:
        return {}
    if exact:
        return exact_quantiles(df, cols, probs)
    arr = F.array(*[F.lit(float(p)) for p in probs])
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), arr, 100_000)
                   .alias(f"q{i}") for i, c in enumerate(cols)]).collect()[0]
    return {c: row[f"q{i}"] for i, c in enumerate(cols)}


def cap_outliers(df: DataFrame, cols: list[str], exact: bool = True):
    """Clip to the 5th/95th percentile (NULL stays NULL); returns (df, counts)."""
    qs = _quantiles(df, cols, R.CAP_QUANTILES, exact)
    cols = [c for c in cols if qs.get(c) is not None]
    if not cols:
        return df, {}
    counts_row = df.agg(*[
        F.count_if((F.col(f"`{c}`") < F.lit(qs[c][0])) | (F.col(f"`{c}`") > F.lit(qs[c][1])))
        .alias(f"n{i}") for i, c in enumerate(cols)]).collect()[0]
    counts = {c: counts_row[f"n{i}"] for i, c in enumerate(cols)}
    def capped(f):
        x = F.col(f"`{f}`")
        t = df.schema[f].dataType
        # caps are fractions: an integer column widens to double, as a filled one does;
        # least / greatest skip NULL, so NULL is kept apart
        t = t if isinstance(t, (T.DoubleType, T.FloatType)) else T.DoubleType()
        clipped = F.least(F.greatest(x.cast("double"), F.lit(qs[f][0])), F.lit(qs[f][1]))
        return F.when(x.isNotNull(), clipped).cast(t).alias(f)

    out = df.select(*[capped(f) if f in cols else F.col(f"`{f}`") for f in df.columns])
    return out, counts


def remove_outliers(df: DataFrame, cols: list[str], exact: bool = True,
                    checkpoint_every: int = 4) -> DataFrame:
    """Column after column, IQR bounds recomputed on the rows still left.

    Each round is one aggregate plus a lazy filter; lineage is cut with a
    reliable checkpoint every few rounds so a lost executor recomputes little.
    NULLs in the filtered column are dropped (between is NULL for them).
    """
    cur = df
    for i, c in enumerate(cols):
        q = _quantiles(cur, [c], [0.25, 0.75], exact).get(c)
        if q is None:
            continue
        lo, hi = iqr_bounds(q[0], q[1])
        cur = cur.where(F.col(f"`{c}`").cast("double").between(F.lit(lo), F.lit(hi)))
        if checkpoint_every and (i + 1) % checkpoint_every == 0 and i + 1 < len(cols):
            cur = cut_lineage(cur)
    return cur


def keep_outliers(df: DataFrame) -> DataFrame:
    """C17."""
    return df


def outlier_examples(df: DataFrame, bounds: dict, order_by: str, per_side: int = 3) -> DataFrame:
    """First ``per_side`` low and high outliers in key order, of every column of
    ``bounds`` ({column: (low, high)}) from one pass: (name, side, k, v, r).

    Skew-safe top-k (salted two-level ranking); at most ``2 * per_side`` rows a column.
    """
    def candidate(c, lo, hi):
        x = F.col(f"`{c}`").cast("double")
        side = F.when(x < F.lit(lo), F.lit(0)).when(x > F.lit(hi), F.lit(1))
        return F.struct(F.lit(c).alias("name"), side.alias("side"), x.alias("v"))
    cand = df.select(F.col(f"`{order_by}`").alias("k"), F.inline(F.array(
        *[candidate(c, lo, hi) for c, (lo, hi) in bounds.items()]))).where(F.col("side").isNotNull())
    top = smallest_k_per_group(cand, ["name", "side"], [F.col("k")], per_side)
    return top.select("name", "side", "k", "v", F.col("__r").alias("r"))
