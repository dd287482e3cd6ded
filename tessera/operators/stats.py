"""Column statistics (A01-A16) from a few aggregates over the data.

Numbers are summed, sketched and compared where they are read: plain aggregates
with one row a task give the moments, the outlier counts and, by way of narrow
ranges about the wanted ranks, the exact quantiles (``quantiles.py``). Only
their distinct counts need an exchange, of (value, count) a column, map-side
combined, of which nothing is kept. Dates and times go the same way.

Texts go by a persisted value-count table ``unpivot -> groupBy(name,
value).count()`` (a value holding a third of all rows costs one row per map
task). Texts are keyed by their 128-bit digest, length and first ``SHORT``
characters: longer ones never take part in an exchange, and the few that are
shown (samples, the most frequent value) are fetched at the end by a join on
their digests. Their statistics are aggregates over that table, weighted by the
counts, the sample a salted top-k of md5-ordered distinct values.

Only per-column numbers (one row per column) reach the driver.
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from .quantiles import column_quantiles, quantiles_from_counts, sketches

NUMERIC, STRING, TEMPORAL = "numeric", "string", "temporal"


def column_kinds(df: DataFrame) -> list[tuple[str, str, str]]:
    """(name, kind, dtype) for every scalar column; nested/binary columns skipped."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.NumericType, T.BooleanType)):
            kind = NUMERIC
        elif isinstance(t, (T.StringType, T.VarcharType, T.CharType)):
            kind = STRING
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kind = TEMPORAL
        else:
            continue
        out.append((f.name, kind, t.simpleString()))
    return out


def normalize_missing(df: DataFrame) -> DataFrame:
    """NaN -> NULL on float columns (one notion of missing, as in the source data model)."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = F.when(~F.isnan(c), c).alias(f.name)
        exprs.append(c)
    return df.select(*exprs)


def value_expr(name: str, kind: str):
    """The numeric view of a column: doubles without +-inf; parsed text; none for time."""
    c = F.col(f"`{name}`")
    if kind == NUMERIC:
        return R.nan_to_null(c)
    if kind == STRING:
        return R.parse_number(c)
    return None


def text_expr(name: str):
    return F.col(f"`{name}`").cast("string")


@dataclass
class ProfileOptions:
    sample_size: int = 10
    salt_buckets: int = 64
    probs: list = field(default_factory=lambda: list(R.PROFILE_QUANTILES))


def iqr_bounds(q25, q75):
    if q25 is None or q75 is None:
        return None, None
    iqr = q75 - q25
    return q25 - R.IQR_FACTOR * iqr, q75 + R.IQR_FACTOR * iqr


def numeric_expr(kinds):
    """Numeric view of a value-count row: the number itself (no NaN/inf) for
    numeric columns, the parsed text for text columns (same rule as ``value_expr``)."""
    num = [n for n, k, _ in kinds if k == NUMERIC]
    txt = [n for n, k, _ in kinds if k == STRING]
    d = F.col("d")
    return (F.when(F.col("name").isin(num) & ~F.isnan(d) & (F.abs(d) != float("inf")), d)
            .when(F.col("name").isin(txt), F.coalesce(R.parse_number(F.col("v")), F.col("lx"))))


def numeric_view(vc: DataFrame) -> DataFrame:
    """(name, x, cnt) of the numeric view of each column, from the value counts with ``x``."""
    return vc.select("name", "x", "cnt").where(F.col("x").isNotNull())


def moment_outlier_stats(xv: DataFrame, stats: dict) -> dict:
    """Pass 2 (A05-A06, A09, A15) over the numeric value counts: central sums
    about the known mean, low/high outlier counts and the normal range. Means
    and IQR bounds enter as literal maps (one entry per column)."""
    means = {n: v["mean"] for n, v in stats.items()
             if isinstance(v, dict) and v.get("mean") is not None}
    bounds = {n: iqr_bounds(v["q25"], v["q75"]) for n, v in stats.items()
              if isinstance(v, dict) and v.get("q25") is not None}
    if not means:
        return {}

    def lit_map(d):
        return F.create_map(*[e for k, v in d.items() for e in (F.lit(k), F.lit(float(v)))])
    name, x, c = F.col("name"), F.col("x"), F.col("cnt")
    dev = x - F.element_at(lit_map(means), name)
    aggs = [F.sum(c * dev * dev).alias("m2"), F.sum(c * dev * dev * dev).alias("m3")]
    if bounds:
        lo = F.element_at(lit_map({k: b[0] for k, b in bounds.items()}), name)
        hi = F.element_at(lit_map({k: b[1] for k, b in bounds.items()}), name)
        aggs += [F.sum(F.when(x < lo, c).otherwise(0)).alias("lo"),
                 F.sum(F.when(x > hi, c).otherwise(0)).alias("hi"),
                 F.min(F.when(x >= lo, x)).alias("nmin"), F.max(F.when(x <= hi, x)).alias("nmax")]
    rows = xv.where(name.isin(list(means))).groupBy("name").agg(*aggs).collect()
    out = {}
    for r in rows:
        d = r.asDict()
        out[d["name"]] = {"m2": d["m2"], "m3": d["m3"],
                          "outlier_low": d.get("lo"), "outlier_high": d.get("hi"),
                          "normal_min": d.get("nmin"), "normal_max": d.get("nmax")}
    return out


def numeric_stats(df: DataFrame, names: list[str], probs) -> tuple[int, dict]:
    """Rows, and the statistics of the numeric columns but their distinct counts.

    Plain aggregates over the table, none of which exchanges its rows: sums and
    sketches; central sums and the counts about the wanted ranks; the values
    there; the counts outside the IQR bounds.
    """
    at = {n: F.col(f"`{n}`") for n in names}
    wide = df.select(*[value_expr(n, NUMERIC).alias(n) for n in names])
    first = [F.count(F.lit(1)).alias("rows")]
    for i, x in enumerate(at.values()):
        first += [F.count(x).alias(f"n{i}"), F.sum(x).alias(f"s{i}"), sketches(x, probs).alias(f"q{i}")]
    row = wide.agg(*first).collect()[0]
    out = {n: {"parsed": row[f"n{i}"], "mean": row[f"s{i}"] / row[f"n{i}"] if row[f"n{i}"] else None} for i, n in enumerate(names)}
    some = [n for n in names if out[n]["parsed"]]
    if not some:
        return row["rows"], out
    aggs = []
    for i, n in enumerate(some):
        dev = at[n] - F.lit(out[n]["mean"])
        aggs += [F.sum(dev * dev).alias(f"m2_{i}"), F.sum(dev * dev * dev).alias(f"m3_{i}")]
    points = {n: row[f"q{i}"] for i, n in enumerate(names)}
    qs, moments = column_quantiles(wide.select(*[at[n] for n in some]), {n: out[n]["parsed"] for n in some}, points, probs, aggs)
    aggs = []
    for i, n in enumerate(some):
        out[n] |= {"m2": moments[f"m2_{i}"], "m3": moments[f"m3_{i}"], "quantiles": qs[n]}
        lo, hi = [F.lit(float(b)) for b in iqr_bounds(qs[n][1], qs[n][2])]
        aggs += [F.count_if(at[n] < lo).alias(f"outlier_low{i}"), F.count_if(at[n] > hi).alias(f"outlier_high{i}"),
                 F.min(F.when(at[n] >= lo, at[n])).alias(f"normal_min{i}"), F.max(F.when(at[n] <= hi, at[n])).alias(f"normal_max{i}")]
    last = wide.agg(*aggs).collect()[0]
    for i, n in enumerate(some):
        out[n] |= {k: last[f"{k}{i}"] for k in ("outlier_low", "outlier_high", "normal_min", "normal_max")}
    return row["rows"], out


#: Columns whose values are counted in one job: each has its own exchange, so a job's plan stays small.
COLUMNS_A_JOB = 16


def _in_jobs(parts: list[DataFrame]) -> list:
    """Rows of frames of one row each, some at a time."""
    jobs = [parts[i:i + COLUMNS_A_JOB] for i in range(0, len(parts), COLUMNS_A_JOB)]
    return [r for job in jobs for r in reduce(DataFrame.unionAll, job).collect()]


def _counts_of(df: DataFrame, value) -> DataFrame:
    """(v, cnt) of the non-null values of one column: the value alone is the key."""
    return df.select(value.alias("v")).where(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("cnt"))


def _number_key(df: DataFrame, name: str):
    """What tells the values of a numeric column apart, as in ``value_counts``."""
    t, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    return c if isinstance(t, T.DecimalType) else c.cast("double")


def distinct_stats(df: DataFrame, names: list[str]) -> dict:
    """Distinct and non-null counts and the spread of the counts of the numeric columns: two aggregates a column, nothing is kept."""
    c = F.col("cnt")
    rows = _in_jobs([_counts_of(df, _number_key(df, n)).agg(
        F.lit(n).alias("name"), F.count(F.lit(1)).alias("unique_count"), F.sum(c).alias("nonnull"),
        F.avg(c).alias("cnt_mean"), F.stddev_samp(c).alias("cnt_std")) for n in names])
    return {r["name"]: r.asDict() for r in rows if r["unique_count"]}


def time_stats(df: DataFrame, names: list[str]) -> dict:
    """The statistics of the date and time columns, counted as such: by value, then by count.

    There are few counts, so one row for each has all that is asked for. Every
    day or time has a date in its text, and the order of the texts is that of
    time in the years 0 to 9999; beyond them the texts themselves are compared.
    """
    c, n = F.col("cnt"), F.col("n")
    days = {m: isinstance(df.schema[m].dataType, T.DateType) for m in names}
    counts = {m: _counts_of(df, F.col(f"`{m}`").cast("date" if days[m] else "timestamp_ntz")) for m in names}
    rows = _in_jobs([counts[m].groupBy("cnt").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("last")).agg(
        F.lit(m).alias("name"), F.sum(n).alias("unique_count"), F.sum(n * c).alias("nonnull"), F.max(c).alias("most"),
        F.sum(n.cast("decimal(19,0)") * c * c).cast("decimal(38,0)").alias("squares"),
        F.max_by("least", "cnt").cast("string").alias("top"),
        (F.min("least").cast("string").startswith("-") | F.max("last").cast("string").startswith("+")).alias("beyond"))
        for m in names])
    out = {}
    for r in rows:
        d, total = r["unique_count"], r["nonnull"]
        if not d:
            continue
        top = r["top"]
        if r["beyond"]:
            top = counts[r["name"]].where(c == r["most"]).agg(F.min(F.col("v").cast("string")).alias("v")).collect()[0]["v"]
        out[r["name"]] = {
            "unique_count": d, "nonnull": total, "parsed": None, "date_share": 1.0, "top": top, "cnt_mean": total / d,
            "cnt_std": math.sqrt((d * int(r["squares"]) - total * total) / (d * (d - 1))) if d > 1 else None}
    return out


def text_stats(df: DataFrame, kinds, opts: ProfileOptions) -> dict:
    """The statistics of the text columns from their value counts, numbers among the texts included."""
    if not kinds:
        return {}
    names = [n for n, _, _ in kinds]
    vc = value_counts(df, names, {n: k for n, k, _ in kinds}, digests=True) \
        .withColumn("x", numeric_expr(kinds)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = value_stats(vc, kinds, opts, df)
        sizes = {n: (s["parsed"], s["unique_count"]) for n, s in out.items() if s.get("parsed")}
        if sizes:
            xv = numeric_view(vc)
            for n, q in quantiles_from_counts(xv, opts.probs, sizes).items():
                if q:
                    out[n] |= {"quantiles": q, "q25": q[1], "q75": q[2]}
            for n, m in moment_outlier_stats(xv, out).items():
                out[n] |= m
    finally:
        vc.unpersist()
    return out


ROWS_NAME = "\u0000rows"   # pseudo column: one value per row, its count is the row count
#: Characters up to which a text is its own key; longer ones are known by digest, length and this prefix.
SHORT = 64
#: Digests up to which a set of texts to fetch is broadcast (some 60 bytes each).
FETCH_ROWS = 200_000


def digest_expr(v):
    """128-bit digest of a text, 16 bytes in the order of its hex form."""
    return F.unhex(F.md5(v.cast("binary")))


def _texts(df: DataFrame, names: list[str]) -> DataFrame:
    """(name, v) of the non-null values of the named columns as text."""
    return df.select(*[text_expr(n).alias(n) for n in names]) \
        .unpivot([], [F.col(f"`{n}`") for n in names], "name", "v").where(F.col("v").isNotNull())


def text_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """(name, h, n, p, lx, ld, cnt): values by digest, length and prefix.

    ``lx`` and ``ld`` are the number and the date test of a long text, worked out
    where it is read; they depend on the value, so as keys they split no group.
    A short text is its own key: its digest is taken once a value, not once a row.
    Dates and times are counted as such and then turned into text, with no digest:
    a time by its wall clock, which is what its text shows.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    days = [n for n in names if isinstance(types[n], T.DateType)]
    times = [n for n in names if isinstance(types[n], (T.TimestampType, T.TimestampNTZType))]
    parts = [_time_counts(df, c, t) for c, t in ((days, "date"), (times, "timestamp_ntz")) if c]
    texts = [n for n in names if n not in days and n not in times]
    if texts or not parts:
        parts.append(_digest_counts(df, texts))
    return reduce(DataFrame.unionByName, parts)


def _time_counts(df: DataFrame, names: list[str], kind: str) -> DataFrame:
    """The ``text_counts`` of columns that turn into ``kind``, a day or a time."""
    counts = df.select(*[F.col(f"`{n}`").cast(kind).alias(n) for n in names]) \
        .unpivot([], [F.col(f"`{n}`") for n in names], "name", "t").where(F.col("t").isNotNull()) \
        .groupBy("name", "t").agg(F.count(F.lit(1)).alias("cnt"))
    none = [F.lit(None).cast(t).alias(c) for c, t in (("h", "binary"), ("lx", "double"), ("ld", "boolean"))]
    return counts.withColumn("p", F.col("t").cast("string")).select("name", "p", F.length("p").alias("n"), *none, "cnt")


def _digest_counts(df: DataFrame, names: list[str]) -> DataFrame:
    """The ``text_counts`` of text columns."""
    v = F.col("v")
    long = F.length(v) > SHORT
    return _texts(df, names).select(
        "name", F.when(long, digest_expr(v)).alias("h"), F.length(v).alias("n"), F.substring(v, 1, SHORT).alias("p"),
        F.when(long, R.parse_number(v)).alias("lx"), F.when(long, v.rlike(R.search_regex(R.DATETIME_PATTERNS))).alias("ld")
    ).groupBy("name", "h", "n", "p", "lx", "ld").agg(F.count(F.lit(1)).alias("cnt")) \
        .withColumn("h", F.coalesce("h", digest_expr(F.col("p"))))


def fetch_texts(df: DataFrame, wanted: DataFrame, names: list[str]) -> DataFrame:
    """(name, h, v) of the texts with the digests ``wanted`` (name, h): the last exchange holds these texts alone."""
    w = wanted.select(F.col("name").alias("__name"), F.col("h").alias("__h"))
    if wanted.count() <= FETCH_ROWS:
        w = F.broadcast(w)
    t = _texts(df, names).withColumn("h", digest_expr(F.col("v")))
    return t.join(w, (F.col("name") == F.col("__name")) & (F.col("h") == F.col("__h")), "left_semi") \
        .groupBy("name", "h").agg(F.min("v").alias("v"))


def least_of_ties(df: DataFrame, tied: DataFrame, names: list[str]) -> dict[str, str]:
    """The smallest text of each column among the digests ``tied`` (name, h); one text a task is exchanged."""
    w = tied.select(F.col("name").alias("__name"), F.col("h").alias("__h"))
    if tied.count() <= FETCH_ROWS:
        w = F.broadcast(w)
    t = _texts(df, names).withColumn("h", digest_expr(F.col("v")))
    t = t.join(w, (F.col("name") == F.col("__name")) & (F.col("h") == F.col("__h")), "left_semi")
    return {r["name"]: r["v"] for r in t.groupBy("name").agg(F.min("v").alias("v")).collect()}


def value_counts(df: DataFrame, names: list[str], kinds: dict | None = None,
                 count_rows: bool = False, digests: bool = False) -> DataFrame:
    """A10: (name, v, d, cnt) over non-null values, map-side combined.

    With ``digests`` texts longer than ``SHORT`` have no ``v``, and the columns
    h, n, p, lx and ld of ``text_counts`` are added (NULL for numbers).

    ``v`` is the value as text. With ``kinds`` given, numeric columns are
    grouped by a number instead (-0.0 and 0.0 fall together as in the source
    semantics) and ``d`` carries it: floats by their double, with ``v`` NULL;
    integers by their own 64-bit value and decimals by their text, so that
    values a double cannot tell apart stay apart, with ``v`` their text. ``count_rows`` adds the pseudo column
    ``ROWS_NAME`` whose single count is the number of rows. Numeric and text
    columns are unpivoted separately (each branch reads only its own
    columns and groups on a primitive key) and the two count tables unioned.
    """
    kinds = kinds or {}
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [n for n in names if kinds.get(n) == NUMERIC]
    whole = [n for n in numeric if isinstance(
        types[n], (T.ByteType, T.ShortType, T.IntegerType, T.LongType))]
    exact = [n for n in numeric if isinstance(types[n], T.DecimalType)]
    num = [n for n in numeric if n not in whole and n not in exact]
    txt = [n for n in names if kinds.get(n) != NUMERIC] + exact
    parts = []
    if whole:
        parts.append(df.select(*[F.col(f"`{n}`").cast("bigint").alias(n) for n in whole])
                     .unpivot([], [F.col(f"`{n}`") for n in whole], "name", "i")
                     .where(F.col("i").isNotNull())
                     .groupBy("name", "i").agg(F.count(F.lit(1)).alias("cnt"))
                     .select("name", F.col("i").cast("string").alias("v"),
                             F.col("i").cast("double").alias("d"), "cnt"))
    if num or count_rows:
        cols = [F.col(f"`{n}`").cast("double").alias(n) for n in num]
        keys = list(num)
        if count_rows:
            cols.append(F.lit(1.0).alias(ROWS_NAME))
            keys.append(ROWS_NAME)
        parts.append(df.select(*cols).unpivot([], [F.col(f"`{n}`") for n in keys], "name", "d")
                     .where(F.col("d").isNotNull())
                     .groupBy("name", "d").agg(F.count(F.lit(1)).alias("cnt"))
                     .select("name", F.lit(None).cast("string").alias("v"), "d", "cnt"))
    if digests:
        extra = [F.lit(None).cast(t).alias(c) for c, t in (("h", "binary"), ("n", "int"), ("p", "string"), ("lx", "double"), ("ld", "boolean"))]
        parts = [p.select("*", *extra) for p in parts]
    if txt:
        as_number = F.when(F.col("name").isin(exact), F.col("v").try_cast("double")) if exact else F.lit(None).cast("double")
        if digests:
            counts = text_counts(df, txt).withColumn("v", F.when(F.col("n") <= SHORT, F.col("p")))
            parts.append(counts.select("name", "v", as_number.alias("d"), "cnt", "h", "n", "p", "lx", "ld"))
        else:
            parts.append(_texts(df, txt).groupBy("name", "v").agg(F.count(F.lit(1)).alias("cnt"))
                         .select("name", "v", as_number.alias("d"), "cnt"))
    if not parts:
        raise ValueError("value_counts needs at least one column (or count_rows)")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def smallest_k_per_group(df: DataFrame, group: list[str], order: list, k: int,
                         buckets: int = 64) -> DataFrame:
    """Top-k per group without putting a whole (possibly huge) group in one task.

    Level 1 ranks inside (group, salt) buckets, level 2 ranks the at most
    buckets*k survivors per group.
    """
    salt = F.pmod(F.xxhash64(*order), F.lit(buckets))
    w1 = Window.partitionBy(*group, "__salt").orderBy(*order)
    w2 = Window.partitionBy(*group).orderBy(*order)
    first = (df.withColumn("__salt", salt)
             .withColumn("__r", F.row_number().over(w1))
             .where(F.col("__r") <= k).drop("__salt", "__r"))
    return (first.withColumn("__r", F.row_number().over(w2))
            .where(F.col("__r") <= k))


def head_preview(df: DataFrame, columns: list[str], order_by: str, rows: int) -> DataFrame:
    """The first ``rows`` rows by ``order_by`` (a take per task, merged) as (r, name, number, text)."""
    head = df.orderBy(F.col(f"`{order_by}`")).limit(rows)
    head = head.withColumn("r", F.row_number().over(Window.orderBy(F.col(f"`{order_by}`"))).cast("bigint"))  # ``rows`` rows
    kinds = {n: k for n, k, _ in column_kinds(df)}
    cells = [F.struct(F.lit(c).alias("name"), (F.col(f"`{c}`").cast("double") if kinds.get(c) == NUMERIC else F.lit(None).cast("double")).alias("number"),
                      (text_expr(c) if kinds.get(c) != NUMERIC else F.lit(None).cast("string")).alias("text")) for c in columns]
    return head.select("r", F.inline(F.array(*cells)))


def first_by_digest(vc: DataFrame, distinct: dict, id_rx: str, opts: ProfileOptions) -> list:
    """The ``sample_size`` texts of each column of ``distinct`` ({name: distinct values}) with the smallest digests.

    Digests are spread evenly, so only those below a bound that leaves many more
    than are wanted get ranked; where they turn out too few, all are.
    """
    k = opts.sample_size
    need = {n: min(k, d) for n, d in distinct.items() if d}
    if not need:
        return []
    few = F.lit(False)
    for n in need:
        mine = F.col("name") == n
        share = 64.0 * k / distinct[n]
        few = few | ((mine & (F.col("h") < F.lit(bytearray(int(share * 2 ** 32).to_bytes(4, "big"))))) if share < 1 else mine)

    def ranked(rows):
        return smallest_k_per_group(rows.select("name", "h", "p", "v", F.col("v").rlike(id_rx).alias("id")), ["name"],
                                    [F.col("h"), F.col("p")], k, opts.salt_buckets).collect()
    out = ranked(vc.where(few))
    found = {n: sum(r["name"] == n for r in out) for n in need}
    if any(found[n] < need[n] for n in need):
        out = ranked(vc.where(F.col("name").isin(list(need))))
    return out


def most_frequent(vc: DataFrame, most: dict) -> dict:
    """By column of ``most`` ({name: highest count}) the least (v, p, n, cnt) by prefix and whether it is long."""
    if not most:
        return {}
    at = F.lit(False)
    for n, m in most.items():
        at = at | ((F.col("name") == n) & (F.col("cnt") == m))
    rows = vc.where(at).groupBy("name").agg(F.min_by(
        F.struct("v", "p", "n", "cnt"), F.struct(F.coalesce("p", "v").alias("b"), F.col("n") > SHORT)).alias("top"))
    return {r["name"]: r["top"] for r in rows.collect()}


def value_stats(vc: DataFrame, kinds, opts: ProfileOptions, df: DataFrame) -> dict:
    """Pass 3: every per-column count and share, weighted by the value counts
    (with digests and ``x``), plus the md5-ordered sample; one shuffle of per-column
    partial aggregates, numbers alone. Long texts among the results are fetched from ``df``."""
    if not kinds:
        return {}
    c, v, x = F.col("cnt"), F.col("v"), F.col("x")
    date_rx = R.search_regex(R.DATETIME_PATTERNS)
    is_text = F.col("name").isin([n for n, k, _ in kinds if k != NUMERIC])
    summary = vc.groupBy("name").agg(
        F.count(F.lit(1)).alias("unique_count"),
        F.sum(c).alias("nonnull"),
        F.max(c).alias("most"),
        F.avg(c).alias("cnt_mean"),
        F.stddev_samp(c).alias("cnt_std"),
        F.sum(F.when(x.isNotNull(), c)).alias("parsed"),
        F.sum(c * x).alias("sx"),
        F.sum(F.when(is_text, F.when(F.coalesce("ld", v.rlike(date_rx)), c).otherwise(0))).alias("n_date"),
        F.bool_and(F.when(is_text, F.coalesce(F.lower(v).isin(R.BINARY_TOKENS), F.lit(False)))).alias("binary_values"),
        F.sum(F.when(is_text, c * F.col("n"))).alias("sum_len"),
    )
    id_rx = R.full_match_regex(R.IDENTIFIER_PATTERNS)
    rows = summary.collect()
    kind_of = {n: k for n, k, _ in kinds}
    # in the order of the digest, which is that of md5; the few long texts come back by digest
    ranked = first_by_digest(vc, {r["name"]: r["unique_count"] for r in rows if kind_of.get(r["name"]) == STRING}, id_rx, opts)
    top = most_frequent(vc, {r["name"]: r["most"] for r in rows if kind_of.get(r["name"], NUMERIC) != NUMERIC})
    found = _long_samples(df, [r for r in ranked if r["v"] is None], id_rx)
    ties = top_texts(df, vc, top)
    sample, ids = {}, {}
    for r in sorted(ranked, key=lambda r: r["__r"]):
        text, is_id = (r["v"], r["id"]) if r["v"] is not None else found[r["name"], bytes(r["h"])]
        sample.setdefault(r["name"], []).append(text)
        ids[r["name"]] = ids.get(r["name"], False) or is_id
    out = {}
    for r in rows:
        k = kind_of.get(r["name"])
        nn = r["nonnull"] or 0
        parsed = r["parsed"] or 0
        out[r["name"]] = {
            "unique_count": r["unique_count"], "nonnull": nn,
            "top": ties[r["name"]] if r["name"] in ties else top[r["name"]]["v"] if r["name"] in top else None,
            "cnt_mean": r["cnt_mean"], "cnt_std": r["cnt_std"],
            "parsed": parsed if k != TEMPORAL else None,
            "mean": (r["sx"] / parsed) if (parsed and r["sx"] is not None) else None,
            "date_share": (r["n_date"] / nn) if (k in (STRING, TEMPORAL) and nn) else None,
            "binary_values": r["binary_values"] if k == STRING else None,
            "avg_length": (r["sum_len"] / nn) if (k == STRING and nn) else None,
            "id_sample": ids.get(r["name"]),
            "sample": sample.get(r["name"], []),
        }
    return out


def top_texts(df: DataFrame, vc: DataFrame, tops: dict) -> dict[str, str]:
    """Of the columns whose most frequent value is a long text, the smallest of the texts that it may be.

    ``tops``: by column the least (v, p, n, cnt) of ``vc`` by descending count, prefix and whether it is long.
    """
    long = {n: t for n, t in tops.items() if t["v"] is None}
    if not long:
        return {}
    same = F.lit(False)
    for n, t in long.items():
        same = same | ((F.col("name") == n) & (F.col("cnt") == t["cnt"]) & (F.col("p") == t["p"]) & (F.col("n") > SHORT))
    return least_of_ties(df, vc.where(same).select("name", "h"), list(long))


def _long_samples(df: DataFrame, rows: list, id_rx: str) -> dict[tuple[str, bytes], tuple[str, bool]]:
    """The texts, and the identifier test, of sample rows that have only their digest: a few for each column."""
    if not rows:
        return {}
    wanted = df.sparkSession.createDataFrame([(r["name"], bytes(r["h"])) for r in rows], "name string, h binary")
    names = sorted({r["name"] for r in rows})
    texts = fetch_texts(df, wanted, names).select("name", "h", "v", F.col("v").rlike(id_rx).alias("id"))
    return {(r["name"], bytes(r["h"])): (r["v"], r["id"]) for r in texts.collect()}


STATS_SCHEMA = T.StructType([
    T.StructField("ordinal", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("dtype", T.StringType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("null_count", T.LongType()),
    T.StructField("nonnull", T.LongType()),
    T.StructField("unique_count", T.LongType()),
    T.StructField("parsed", T.LongType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
    T.StructField("skew_pop", T.DoubleType()),
    T.StructField("q05", T.DoubleType()),
    T.StructField("q25", T.DoubleType()),
    T.StructField("q75", T.DoubleType()),
    T.StructField("q95", T.DoubleType()),
    T.StructField("outlier_low", T.LongType()),
    T.StructField("outlier_high", T.LongType()),
    T.StructField("normal_min", T.DoubleType()),
    T.StructField("normal_max", T.DoubleType()),
    T.StructField("date_share", T.DoubleType()),
    T.StructField("binary_values", T.BooleanType()),
    T.StructField("avg_length", T.DoubleType()),
    T.StructField("top", T.StringType()),
    T.StructField("cnt_mean", T.DoubleType()),
    T.StructField("cnt_std", T.DoubleType()),
    T.StructField("id_sample", T.BooleanType()),
    T.StructField("sample_values", T.ArrayType(T.StringType())),
])


def _moments(n, m2, m3):
    """Sample std and population skewness from central sums (NULL where undefined)."""
    if not n or m2 is None:
        return None, None
    std = (m2 / (n - 1)) ** 0.5 if n > 1 else None
    skew = (n ** 0.5) * m3 / m2 ** 1.5 if m2 > 0 else None
    return std, skew


def column_stats(df: DataFrame, opts: ProfileOptions | None = None) -> DataFrame:
    """Raw per-column statistics, one row per scalar column (input of the rules)."""
    opts = opts or ProfileOptions()
    df = normalize_missing(df)
    kinds = column_kinds(df)
    numeric = [n for n, k, _ in kinds if k == NUMERIC]
    # four sets of jobs that do not wait for each other
    with ThreadPoolExecutor(4) as pool:
        counts = pool.submit(distinct_stats, df, numeric)
        texts = pool.submit(text_stats, df, [k for k in kinds if k[1] == STRING], opts)
        times = pool.submit(time_stats, df, [n for n, k, _ in kinds if k == TEMPORAL])
        n_rows, stats = numeric_stats(df, numeric, opts.probs)
        for found in (counts.result(), texts.result(), times.result()):
            for n, s in found.items():
                stats[n] = {**stats.get(n, {}), **s}
    empty = {"unique_count": 0, "nonnull": 0, "parsed": 0, "sample": []}
    rows = []
    for i, (name, kind, dtype) in enumerate(kinds):
        c = {**empty, **stats.get(name, {})}
        std, skew = _moments(c.get("parsed"), c.get("m2"), c.get("m3"))
        q = c.get("quantiles") or [None] * 4
        f = lambda v: None if v is None else float(v)
        rows.append((
            i, name, kind, dtype, n_rows, n_rows - c["nonnull"], c["nonnull"],
            c.get("unique_count", 0), c.get("parsed"), f(c.get("mean")), f(std), f(skew),
            *[f(x) for x in q],
            c.get("outlier_low"), c.get("outlier_high"), f(c.get("normal_min")),
            f(c.get("normal_max")), f(c.get("date_share")), c.get("binary_values"),
            f(c.get("avg_length")), c.get("top"), f(c.get("cnt_mean")), f(c.get("cnt_std")),
            c.get("id_sample"), c.get("sample", []),
        ))
    return df.sparkSession.createDataFrame(rows, STATS_SCHEMA)
