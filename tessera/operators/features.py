"""Encoding, feature scoring, selection and scaling.

Fitted state is three small tables (encoders, selected features, scaler
statistics); applying it is equi-joins plus column expressions, so the same
``transform`` works on batch and streaming frames.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import exact_quantiles
from .ranking import dense_codes

BROADCAST_MAX_BYTES = 64 << 20   # an encoder of more joins by shuffle
HOT_SHARE = 1000   # a value with over a thousandth of the rows is dealt over several tasks
SALTS = 32


def _q(c: str):
    return F.col(f"`{c}`")


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    """P04 by physical type."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def temporal_as_text(df: DataFrame, exclude=()) -> DataFrame:
    """Dates and timestamps as text, so that they are label-encoded like it; booleans as 0/1."""
    def view(f):
        if f.name in exclude:
            return _q(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return _q(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, T.BooleanType):
            return _q(f.name).cast("double").alias(f.name)
        return _q(f.name)
    return df.select(*[view(f) for f in df.schema.fields])


def encoder_text(c: str):
    """Values as the encoder sees them: text, NULL as 'nan'."""
    return F.coalesce(_q(c).cast("string"), F.lit("nan"))


def fit_label_encoders(df: DataFrame, columns: list[str]) -> DataFrame:
    """F01 fit: (column, value, code), codes 0.. in byte order of the value.

    Distinct values per column come from one map-side-combined shuffle; codes
    are exact ranks computed slice by slice (``ranking.dense_codes``), so a
    column with many distinct values is never sorted in a single task.
    """
    long = (df.select(*[encoder_text(c).alias(c) for c in columns])
            .unpivot([], [_q(c) for c in columns], "column", "value")
            .distinct()
            .persist(StorageLevel.MEMORY_AND_DISK))   # read by the slice bounds and the ranks
    return dense_codes(long, "column", "value")


def encoder_sizes(encoders: DataFrame) -> dict:
    """Bytes of each column's encoder, 24 a row beside its values (one small
    aggregate; one row per column)."""
    size = F.sum(F.octet_length("value") + 24).alias("n")
    return {r["column"]: r["n"] for r in encoders.groupBy("column").agg(size).collect()}


def hot_values(df: DataFrame, column: str) -> list[int]:
    """Hashes of the encoder values that hold over 1/HOT_SHARE of the rows each: fewer than HOT_SHARE of them."""
    counts = df.groupBy(F.xxhash64(encoder_text(column)).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    least = df.select(F.count(F.lit(1)) / HOT_SHARE).first()[0]
    return [r["h"] for r in counts.where(F.col("n") > least).collect()]


def apply_label_encoders(df: DataFrame, encoders: DataFrame, columns: list[str],
                         sizes: dict | None = None) -> DataFrame:
    """F01/F03/F11 apply: code by lookup, unseen value -> 0 (the first class).

    Each column's encoder is broadcast only when its size in bytes is known
    (``sizes``, by column, from ``encoder_sizes``) and small; a large one (a
    free-text column) is joined by shuffle without forcing the others to. There
    a hot value, NULL as 'nan' among them, is dealt over ``SALTS`` tasks and
    its one encoder row repeated for each; no other row is.
    """
    out = df
    for c in columns:
        size = (sizes or {}).get(c)
        enc = encoders.where(F.col("column") == c).select(
            F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__code_{c}"))
        on = F.col(f"__k_{c}") == F.col(f"__v_{c}")
        keyed = out.withColumn(f"__k_{c}", encoder_text(c))
        if size is not None and size <= BROADCAST_MAX_BYTES:
            enc = F.broadcast(enc)
        elif not df.isStreaming and (hot := hot_values(df, c)):
            salt = F.pmod(F.xxhash64(*[_q(x) for x in df.columns]), F.lit(SALTS)).cast("int")
            keyed = keyed.withColumn(f"__s_{c}", F.when(F.xxhash64(f"`__k_{c}`").isin(hot), salt).otherwise(0))
            last = F.when(F.xxhash64(f"`__v_{c}`").isin(hot), SALTS - 1).otherwise(0)
            enc = enc.withColumn(f"__t_{c}", F.explode(F.sequence(F.lit(0), last)))
            on = on & (F.col(f"__s_{c}") == F.col(f"__t_{c}"))
        out = (keyed.join(enc, on, "left")
               .withColumn(c, F.coalesce(F.col(f"__code_{c}"), F.lit(0)).cast("int"))
               .drop(*[f"__{x}_{c}" for x in ("k", "v", "code", "s", "t")]))
    return out.select(*[_q(c) for c in df.columns])


def one_hot(df: DataFrame, column: str, fitted_values: list[str]) -> DataFrame:
    """Indicator columns ``<col>_<value>`` for the fitted values minus
    the first (drop-first); missing expected columns come out as 0."""
    ind = [F.when(_q(column).cast("string") == F.lit(v), 1).otherwise(0).alias(f"{column}_{v}")
           for v in fitted_values[1:]]
    return df.select(*[_q(c) for c in df.columns if c != column], *ind)


# ---- scores -----------------------------------------------------------------

def _long(df: DataFrame, features: list[str], label: str) -> DataFrame:
    return df.select(F.col(f"`{label}`").cast("double").alias("y"),
                     *[_q(c).cast("double").alias(c) for c in features]) \
             .unpivot(["y"], [_q(c) for c in features], "feature", "x")


def anova_f(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """one-way ANOVA F per feature against a class label.

    One shuffle on (feature, class) of partial moments; F = (SSB/(k-1))/(SSW/(n-k)).
    Both sums are of squared deviations (the class variances, and the class
    means about the overall one), so a large common offset cancels nothing.
    """
    g = _long(df, features, label).where(F.col("x").isNotNull()).groupBy("feature", "y").agg(
        F.count("x").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    overall = g.groupBy(F.col("feature").alias("__f")).agg(
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("mean"))
    d = F.col("m") - F.col("mean")
    t = g.join(overall, F.col("feature") == F.col("__f")).groupBy("feature").agg(
        F.sum(F.col("n") * d * d).alias("ssb"), F.sum(F.col("n") * F.col("v")).alias("ssw"),
        F.sum("n").alias("N"), F.count(F.lit(1)).alias("k"))
    f = F.try_divide(F.try_divide(F.col("ssb"), F.col("k") - 1),
                     F.try_divide(F.col("ssw"), F.col("N") - F.col("k")))
    return t.select("feature", f.alias("score"))


def _bins(df: DataFrame, cols: list[str], n_bins: int, exact: bool = True) -> dict:
    """Decile edges of every column from one aggregate (sketch when not exact)."""
    if exact:
        qs = exact_quantiles(df, cols, [i / n_bins for i in range(1, n_bins)])
        return {c: sorted(set(qs.get(c) or [])) for c in cols}
    probs = F.array(*[F.lit(i / n_bins) for i in range(1, n_bins)])
    aggs = [F.percentile_approx(_q(c).cast("double"), probs, 100_000).alias(f"b{i}")
            for i, c in enumerate(cols)]
    row = df.agg(*aggs).collect()[0]
    return {c: sorted(set(row[f"b{i}"] or [])) for i, c in enumerate(cols)}


def _bin_expr(x, bounds):
    """How many edges lie below x; NULL for NULL."""
    e = F.lit(0)
    for b in bounds:
        e = e + F.when(x > F.lit(b), 1).otherwise(0)
    return F.when(x.isNotNull(), e)


def mutual_info(df: DataFrame, features: list[str], label: str, bin_label: bool = False,
                n_bins: int = 10, exact: bool = True) -> DataFrame:
    """F06/F07 (re-aimed): MI of quantile-binned features with the label, in nats.

    Bin edges are deciles of each feature, exact or from a bounded sketch
    (``exact=False`` for very large inputs), all in one aggregate; counts
    come from one shuffle on (feature, bin, label). A row without the feature
    or without the label takes no part in that feature's score.
    """
    edges = _bins(df, features + ([label] if bin_label else []), n_bins, exact)
    ycol = F.col(f"`{label}`").cast("double")
    if bin_label:
        ycol = _bin_expr(ycol, edges[label]).cast("double")
    binned = df.select(ycol.alias("y"), *[_bin_expr(_q(c).cast("double"), edges[c]).alias(c)
                                          for c in features])
    long = binned.unpivot(["y"], [_q(c) for c in features], "feature", "b")
    long = long.where(F.col("b").isNotNull() & F.col("y").isNotNull())
    joint = long.groupBy("feature", "b", "y").agg(F.count(F.lit(1)).alias("nj"))
    # windows over the (feature, bin, label) count table: at most bins x labels rows each
    wf = Window.partitionBy("feature")
    wb = Window.partitionBy("feature", "b")
    wy = Window.partitionBy("feature", "y")
    p = joint.select("feature", "nj", F.sum("nj").over(wf).alias("ntot"),
                     F.sum("nj").over(wb).alias("nb"), F.sum("nj").over(wy).alias("ny"))
    term = (F.col("nj") / F.col("ntot")) * F.log(
        F.col("nj") * F.col("ntot") / (F.col("nb") * F.col("ny")))
    return p.groupBy("feature").agg(F.sum(term).alias("score"))


def n_keep(n_features: int, max_features: int | None = None) -> int:
    """k = min(20, max(5, n // 2), n)."""
    m = max_features if max_features is not None else min(20, max(5, n_features // 2))
    return min(m, n_features)


def select_top_k(scores: DataFrame, features: list[str], k: int) -> list[str]:
    """Highest scores (NaN lowest, later column wins ties), original order."""
    order = {c: i for i, c in enumerate(features)}
    rows = scores.collect()   # one row per feature
    rank = sorted(rows, key=lambda r: (r["score"] is not None, r["score"] or 0.0,
                                       order[r["feature"]]), reverse=True)
    keep = {r["feature"] for r in rank[:k]}
    return [c for c in features if c in keep]


def scaler_stats(df: DataFrame, columns: list[str]) -> dict:
    """F09 fit: mean and population std (0 -> 1) in one aggregate."""
    if not columns:
        return {}
    row = df.agg(*[F.avg(_q(c)).alias(f"m{i}") for i, c in enumerate(columns)],
                 *[F.stddev_pop(_q(c)).alias(f"s{i}") for i, c in enumerate(columns)]
                 ).collect()[0]
    return {c: (row[f"m{i}"], row[f"s{i}"] if row[f"s{i}"] else 1.0)
            for i, c in enumerate(columns)}


def scale(df: DataFrame, stats: dict) -> DataFrame:
    """F09 apply: (x - mean) / std."""
    return df.select(*[((_q(c) - F.lit(stats[c][0])) / F.lit(stats[c][1])).alias(c)
                       if c in stats else _q(c) for c in df.columns])


def _moment_sums(centre: list[float], n: int):
    """Batches of rows to (pair, sums): count, x, y, xx, yy and xy about ``centre`` of the rows that have both.

    The sums of all pairs are four matrix products of a batch and its mask.
    """
    def run(batches):
        total = np.zeros((6, n, n))
        for batch in batches:
            x = np.column_stack([np.asarray(c.to_numpy(zero_copy_only=False), float) for c in batch.columns[:n]]) - centre
            has = np.column_stack([np.asarray(c.is_valid().to_numpy(zero_copy_only=False), float) for c in batch.columns[:n]])
            x = np.where(has > 0, x, 0.0)
            sums, squares = x.T @ has, (x * x).T @ has
            total += np.stack([has.T @ has, sums, sums.T, squares, squares.T, x.T @ x])
        flat = total.reshape(6, n * n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n * n)), *map(pa.array, flat)],
                                         names=["pair", "c", "sx", "sy", "sxx", "syy", "sxy"])
    return run


#: Share of a sum of squares about the centre below which what is left about the mean may be rounding.
CANCELLED = 1e-9


def correlation_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson matrix as (a, b, corr) rounded to 4; NULL for a constant column.

    Each pair uses the rows where both columns have a value. One aggregate gives
    the centres, one pass the co-moments of all pairs at once, n * n rows for
    each task. Pairs whose variance may be lost to rounding there (constant on
    their common rows, or far from the centre) are summed up once more about
    their own means.
    """
    n, spark = len(columns), df.sparkSession
    if not n:
        return spark.createDataFrame([], "a string, b string, corr double")
    x = df.select(*[_q(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    centre = [v if v is not None and math.isfinite(v) else 0.0 for v in x.agg(*[F.avg(c) for c in x.columns]).first()]
    sums = x.mapInArrow(_moment_sums(centre, n), "pair bigint, c double, sx double, sy double, sxx double, syy double, sxy double")
    rows = sums.groupBy("pair").agg(*[F.sum(c).alias(c) for c in sums.columns[1:]]).collect()
    corr, again = {}, []
    for r in rows:
        i, j = divmod(r["pair"], n)
        if i > j:
            continue
        dx, dy = (r[s] - r[m] ** 2 / r["c"] if r["c"] else 0.0 for s, m in (("sxx", "sx"), ("syy", "sy")))
        if not (dx > CANCELLED * r["sxx"] and dy > CANCELLED * r["syy"]):
            again.append((i, j))
        else:
            # as Spark's corr, not clipped: rounding to 4 digits hides the last bits
            corr[i, j] = (r["sxy"] - r["sx"] * r["sy"] / r["c"]) / (math.sqrt(dx) * math.sqrt(dy))
    corr.update(_corr_by_pair(x, again))
    values = [(columns[i], columns[j], corr.get((min(i, j), max(i, j)))) for i in range(n) for j in range(n)]
    out = spark.createDataFrame(values, "a string, b string, corr double")
    return out.select("a", "b", F.round("corr", 4).alias("corr"))


def _corr_by_pair(x: DataFrame, pairs: list[tuple[int, int]]) -> dict:
    """Correlations of a few pairs by Spark's own co-moments, NULL where a column is constant."""
    if not pairs:
        return {}
    row = x.agg(*[F.try_divide(F.regr_sxy(f"x{j}", f"x{i}"), F.sqrt(F.regr_sxx(f"x{j}", f"x{i}")) * F.sqrt(
        F.regr_syy(f"x{j}", f"x{i}"))) for i, j in pairs]).first()
    return dict(zip(pairs, row))


#: Fields of a fitted processor that its saved document holds.
STATE = ("problem_type", "encoded", "encoder_bytes", "selected", "scores", "method", "scaler")


@dataclass
class FeatureProcessor:
    """fit on (X, y) frame, then transform any frame with the same columns."""
    problem_type: str
    encoders: DataFrame | None = None
    encoded: list = field(default_factory=list)
    encoder_bytes: dict = field(default_factory=dict)
    selected: list = field(default_factory=list)
    scores: dict = field(default_factory=dict)
    method: str = ""
    scaler: dict = field(default_factory=dict)
    label_map: DataFrame | None = None

    def fit_transform(self, df: DataFrame, label: str, max_features: int | None = None):
        features = [c for c in df.columns if c != label]
        df = temporal_as_text(df)
        self.encoded = string_columns(df, exclude=(label,))
        out = df
        if self.encoded:
            self.encoders = fit_label_encoders(df, self.encoded).cache()
            self.encoder_bytes = encoder_sizes(self.encoders)
            out = apply_label_encoders(df, self.encoders, self.encoded, self.encoder_bytes)
        cls = self.problem_type in ("classification", "binary_classification")
        if cls and isinstance(df.schema[label].dataType, T.StringType):
            self.label_map = fit_label_encoders(df, [label]).cache()
            out = apply_label_encoders(out, self.label_map, [label],
                                       encoder_sizes(self.label_map))
        if cls:
            n_classes = out.select(F.count_distinct(_q(label))).collect()[0][0]
            if n_classes == 2:
                scores, self.method = mutual_info(out, features, label), "mutual_info_classif"
            else:
                scores, self.method = anova_f(out, features, label), "f_classif"
        else:
            scores = mutual_info(out, features, label, bin_label=True)
            self.method = "mutual_info_regression"
        scores = scores.cache()
        self.selected = select_top_k(scores, features, n_keep(len(features), max_features))
        self.scores = {r["feature"]: r["score"] for r in scores.collect()}
        sel = out.select(*[_q(c) for c in self.selected], _q(label))
        self.scaler = scaler_stats(sel, numeric_columns(sel, exclude=(label,)))
        return scale(sel, self.scaler)

    def save(self, path: str) -> str:
        """The fitted state: encoders and label map as parquet, the rest as one JSON document."""
        spark = SparkSession.getActiveSession()
        state = {k: getattr(self, k) for k in STATE}
        for name in ("encoders", "label_map"):
            table = getattr(self, name)
            state[name] = table is not None
            if table is not None:
                table.write.mode("overwrite").parquet(f"{path}/{name}")
        spark.createDataFrame([(json.dumps(state),)], "state string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/state")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> FeatureProcessor:
        state = json.loads(spark.read.text(f"{path}/state", wholetext=True).first()[0])
        tables = {k: spark.read.parquet(f"{path}/{k}") if state.pop(k) else None
                  for k in ("encoders", "label_map")}
        return FeatureProcessor(**state, **tables)

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """encode (unseen -> 0), project to the selected features, scale;
        ``keep`` columns pass through unchanged."""
        keep = [c for c in (keep or []) if c in df.columns and c not in self.selected]
        out = temporal_as_text(df, exclude=keep)
        if self.encoded:
            out = apply_label_encoders(out, self.encoders, [c for c in self.encoded
                                                            if c in df.columns],
                                       self.encoder_bytes)
        cols = [c for c in self.selected if c in out.columns]
        return scale(out.select(*[_q(c) for c in cols], *[_q(c) for c in keep]), self.scaler)
