"""Type conversion and imputation.

All fill values of all columns come from at most two distributed jobs (one
aggregate for means/medians, one value-count shuffle for modes); the fill
itself is a single projection of ``coalesce`` expressions.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from . import quantiles
from .fill import ffill_bfill
from .stats import NUMERIC, most_frequent, top_texts, value_counts


def convert_numeric_text(df: DataFrame, profile_rows: list[dict]) -> tuple[DataFrame, list[str]]:
    """Text columns inferred numeric become double; unparsable text -> NULL."""
    steps, names = [], set()
    for r in profile_rows:
        if r["kind"] == "string" and r["inferred_type"] == "numeric" and r["name"] in df.columns:
            names.add(r["name"])
            steps.append(f"Converted {r['name']} from string to numeric")
    if not names:
        return df, steps
    return df.select(*[R.parse_number(F.col(f"`{c}`")).alias(c) if c in names
                       else F.col(f"`{c}`") for c in df.columns]), steps


def numeric_method(strategy: str) -> str:
    """Q1: the last '_' token picks mean/median; anything else (the offered
    'statistical_imputation') means mode."""
    if strategy.startswith("statistical_imputation"):
        last = strategy.split("_")[-1]
        return last if last in ("mean", "median") else "mode"
    if strategy == "predictive_imputation":
        return "knn"
    return "median"


def modes(df: DataFrame, columns: list[str]) -> dict:
    """Most frequent non-null value per column, smallest value on ties.

    unpivot -> groupBy(name, value).count() (map-side combined), then the
    highest count per name and the least value with it. Numeric columns are
    keyed by their double value so ties break numerically; texts by digest,
    length and prefix, and a long one is fetched at the end.
    """
    if not columns:
        return {}
    numeric = {c for c in columns
               if isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))}
    whole = {c for c in numeric if isinstance(
        df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))}
    vc = value_counts(df, columns, {c: NUMERIC for c in numeric}, digests=True).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        most = {r["name"]: r["most"] for r in vc.groupBy("name").agg(F.max("cnt").alias("most")).collect()}
        if not most:
            return {}
        at = reduce(or_, [(F.col("name") == n) & (F.col("cnt") == m) for n, m in most.items()])
        # of the numbers met most often the least, in plain aggregates: where none is met twice that is all of them
        least = vc.where(at & F.col("name").isin(list(numeric))).groupBy("name").agg(
            F.min("d").alias("d"), F.min(F.when(F.col("name").isin(list(whole)), F.col("v").try_cast("bigint"))).alias("i"))
        out = {r["name"]: r["i"] if r["name"] in whole else r["d"] for r in least.collect()}
        texts = [n for n in most if n not in numeric]
        top = most_frequent(vc, {n: most[n] for n in texts})
        long = top_texts(df, vc, top)
        out.update({n: long[n] if n in long else top[n]["v"] for n in texts})
        return out
    finally:
        vc.unpersist()


def impute_plan(df: DataFrame, profile_rows: list[dict], missing_strategy: str,
                exact_quantiles: bool = True) -> tuple[dict, list[str], list[str]]:
    """C14 dispatch -> ({column: fill literal}, datetime columns to ffill, log)."""
    method = numeric_method(missing_strategy)
    todo = [r for r in profile_rows if (r["null_count"] or 0) > 0 and r["name"] in df.columns]
    num = [r["name"] for r in todo if r["inferred_type"] == "numeric"]
    other = [r["name"] for r in todo if r["inferred_type"] not in ("numeric", "datetime")]
    dates = [r["name"] for r in todo if r["inferred_type"] == "datetime"]
    n_rows = profile_rows[0]["n_rows"] if profile_rows else 0

    need_mean = method in ("mean", "knn")
    need_median = method == "median" or (method == "knn" and n_rows // 10 == 0)
    aggs = []
    for i, c in enumerate(num):
        x = F.col(f"`{c}`").cast("double")
        if need_mean:
            aggs.append(F.avg(x).alias(f"mean{i}"))
        if need_median and not exact_quantiles:
            aggs.append(F.percentile_approx(x, F.lit(0.5), 100_000).alias(f"med{i}"))
    stat = df.agg(*aggs).collect()[0].asDict() if aggs else {}
    if need_median and exact_quantiles and num:
        med = quantiles.exact_quantiles(df, num, [0.5])
        stat.update({f"med{i}": (med.get(c) or [None])[0] for i, c in enumerate(num)})
    need_mode = other + (num if method == "mode" else [])
    mode_of = modes(df, need_mode) if need_mode else {}
    if method == "mode":
        # a numeric column without a mode (no values) falls back to its median
        empty = [c for c in num if mode_of.get(c) is None]
        if empty:
            med = quantiles.exact_quantiles(df, empty, [0.5])
            stat.update({f"med{i}": (med.get(c) or [None])[0]
                         for i, c in enumerate(num) if c in empty})

    fills, steps = {}, []
    for i, c in enumerate(num):
        r = next(x for x in todo if x["name"] == c)
        mean, med = stat.get(f"mean{i}"), stat.get(f"med{i}")
        if method == "mean":
            v, used = mean, "mean"
        elif method == "mode":
            v, used = (mode_of.get(c) if mode_of.get(c) is not None else med), "imputation"
        elif method == "knn":
            # one column alone: every neighbour distance is undefined, so the
            # kNN estimate is the column mean; k = 0 (n < 10) fails -> median
            v, used = (mean, "knn") if n_rows // 10 > 0 else (med, "median")
        else:
            v, used = med, "median"
        if v is not None:
            fills[c] = v
            steps.append(f"Filled {r['null_count']} missing values ({r['null_percentage']:.1f}%) "
                         f"in {c} with {used} ({v:.2f})")
    for c in other:
        r = next(x for x in todo if x["name"] == c)
        v = mode_of.get(c)
        fills[c] = v if v is not None else "Unknown"
        steps.append(f"Filled {r['null_count']} missing values in {c} with: '{fills[c]}'")
    for c in dates:
        steps.append(f"Filled datetime missing values in {c} using forward/backward fill")
    return fills, dates, steps


def apply_fills(df: DataFrame, fills: dict) -> DataFrame:
    """One projection of coalesce(column, literal)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in fills:
            v = fills[f.name]
            if isinstance(f.dataType, T.StringType):
                c = F.coalesce(c, F.lit(str(v)))
            elif isinstance(f.dataType, T.BooleanType) and not isinstance(v, str):
                c = F.coalesce(c.cast("double"), F.lit(float(v)))       # numeric role: 0/1
            elif isinstance(f.dataType, T.NumericType) and not isinstance(v, str):
                integral = isinstance(f.dataType, (T.IntegerType, T.LongType,
                                                   T.ShortType, T.ByteType))
                if integral and float(v) != int(v):
                    c = F.coalesce(c.cast("double"), F.lit(float(v)))   # as pandas: int -> float
                else:
                    c = F.coalesce(c, F.lit(v).cast(f.dataType))
            c = c.alias(f.name)
        out.append(c)
    return df.select(*out)


def final_sweep(df: DataFrame) -> DataFrame:
    """Remaining NULLs -> 0 in numeric columns, 'Unknown' in all others.

    Booleans have the numeric role and become 0/1 doubles. A temporal column
    cannot hold 'Unknown': it turns to text, but only where it has NULLs left
    (one aggregate over the temporal columns).
    """
    temporal = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    gaps = set()
    if temporal:
        row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}")
                       for i, c in enumerate(temporal)]).collect()[0]
        gaps = {c for i, c in enumerate(temporal) if row[f"n{i}"]}
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = F.coalesce(c.cast("double"), F.lit(0.0))
        elif isinstance(f.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        elif isinstance(f.dataType, T.StringType) or f.name in gaps:
            c = F.coalesce(c.cast("string"), F.lit("Unknown"))
        out.append(c.alias(f.name))
    return df.select(*out)


def impute(df: DataFrame, profile_rows: list[dict], missing_strategy: str,
           order_by: str | None = None, exact_quantiles: bool = True):
    """C06-C14 on a frame whose text numbers are already converted."""
    fills, dates, steps = impute_plan(df, profile_rows, missing_strategy, exact_quantiles)
    out = apply_fills(df, fills)
    if dates:
        if order_by is None:
            raise ValueError("datetime forward/backward fill needs order_by (row order key)")
        out = ffill_bfill(out, dates, order_by)
    return out, steps
