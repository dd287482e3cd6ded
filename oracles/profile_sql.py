"""DuckDB recomputation of the column profile."""

from __future__ import annotations

from . import values as R
from .schemas import N, S

PROFILE_FIELDS = ["ordinal", "name", "dtype", "unique_count", "null_count", "null_percentage",
                  "inferred_type", "inferred_role", "cardinality", "mean_value", "std_value",
                  "skewness", "has_outliers", "distribution", "most_frequent",
                  "frequency_distribution"]


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _kw(words):
    return R.keyword_regex(words)


def column_sql(src: str, i: int, name: str, kind: str, dtype: str) -> str:
    col = f'"{name}"'
    if kind == N:
        c = f"CASE WHEN NOT isnan(CAST({col} AS DOUBLE)) THEN {col} END" \
            if dtype in ("double", "float") else col
        x = (f"CASE WHEN NOT isnan(CAST({c} AS DOUBLE)) AND NOT isinf(CAST({c} AS DOUBLE)) "
             f"THEN CAST({c} AS DOUBLE) END")
    elif kind == S:
        c = col
        x = (f"CASE WHEN regexp_full_match(trim({col}), {q(R.NUMERIC_TEXT)}) "
             f"THEN TRY_CAST(trim({col}) AS DOUBLE) END")
    else:
        c = col
        x = "CAST(NULL AS DOUBLE)"
    date_share = (f"avg(CASE WHEN s IS NOT NULL THEN CASE WHEN regexp_matches(s, "
                  f"{q(R.search_regex(R.DATETIME_PATTERNS))}) THEN 1.0 ELSE 0.0 END END)"
                  if kind != N else "CAST(NULL AS DOUBLE)")
    tokens = ", ".join(q(t) for t in R.BINARY_TOKENS)
    binary = f"bool_and(lower(s) IN ({tokens}))" if kind == S else "CAST(NULL AS BOOLEAN)"
    avg_len = "avg(length(s))" if kind == S else "CAST(NULL AS DOUBLE)"
    id_rx = "|".join(f"(?:{p})" for p in R.IDENTIFIER_PATTERNS)
    is_num_kind = "TRUE" if kind == N else "FALSE"
    is_str = "TRUE" if kind == S else "FALSE"
    lname = q(name.lower())
    n_sample = 10 if kind == S else 0
    return f"""
SELECT * FROM (
WITH b AS (SELECT {c} AS c, {x} AS x, CAST({c} AS VARCHAR) AS s FROM {src}),
a AS (SELECT count(*) AS n_rows, count(c) AS nonnull, count(x) AS parsed,
             favg(x) AS mean_v, stddev_samp(x) AS std_v, skewness(x) AS skew_v,
             quantile_cont(x, 0.05) AS q05, quantile_cont(x, 0.25) AS q25,
             quantile_cont(x, 0.75) AS q75, quantile_cont(x, 0.95) AS q95,
             count(DISTINCT s) AS unique_count, {date_share} AS date_share,
             {binary} AS binary_values, {avg_len} AS avg_length FROM b),
o AS (SELECT count_if(b.x < a.q25 - 1.5 * (a.q75 - a.q25)) AS outlier_low,
             count_if(b.x > a.q75 + 1.5 * (a.q75 - a.q25)) AS outlier_high,
             min(b.x) FILTER (WHERE b.x >= a.q25 - 1.5 * (a.q75 - a.q25)) AS normal_min,
             max(b.x) FILTER (WHERE b.x <= a.q75 + 1.5 * (a.q75 - a.q25)) AS normal_max
      FROM b, a),
vc AS (SELECT s AS v, count(*) AS cnt FROM b WHERE s IS NOT NULL GROUP BY s),
vs AS (SELECT avg(cnt) AS cnt_mean, stddev_samp(cnt) AS cnt_std,
              (SELECT v FROM vc ORDER BY cnt DESC, v LIMIT 1) AS top_v FROM vc),
smp AS (SELECT bool_or(regexp_full_match(v, {q(id_rx)})) AS id_sample,
               string_agg(v, '|' ORDER BY md5(v), v) AS sample
        FROM (SELECT v FROM vc ORDER BY md5(v), v LIMIT {n_sample})),
st AS (SELECT *, outlier_low + outlier_high AS n_out,
              unique_count / nullif(nonnull, 0) AS ur FROM a, o, vs, smp),
ty AS (SELECT *, CASE
   WHEN nonnull = 0 THEN 'unknown'
   WHEN coalesce(date_share, 0) >= {R.DATETIME_SHARE} THEN 'datetime'
   WHEN {is_num_kind} OR ({is_str} AND parsed / nonnull > {R.NUMERIC_PARSE_SHARE}) THEN 'numeric'
   WHEN coalesce(binary_values, FALSE) THEN 'binary'
   WHEN ur >= {R.IDENTIFIER_UNIQUE_RATIO} AND (regexp_matches({lname}, {q(_kw(R.IDENTIFIER_KEYWORDS))})
        OR coalesce(id_sample, FALSE)) THEN 'identifier'
   WHEN {is_str} AND ur > {R.TEXT_UNIQUE_RATIO} AND avg_length > {R.TEXT_MEAN_LENGTH} THEN 'text'
   ELSE 'categorical' END AS inferred_type,
   CASE WHEN parsed < 3 THEN NULL WHEN coalesce(std_v, 0) = 0 THEN 0.0 ELSE skew_v END AS sk
   FROM st)
SELECT {i} AS ordinal, {q(name)} AS name, {q(dtype)} AS dtype, {q(kind)} AS kind,
  CAST(n_rows AS BIGINT) AS n_rows, CAST(nonnull AS BIGINT) AS nonnull,
  CAST(parsed AS BIGINT) AS parsed,
  CAST(unique_count AS BIGINT) AS unique_count,
  CAST(n_rows - nonnull AS BIGINT) AS null_count,
  (n_rows - nonnull) * 100.0 / n_rows AS null_percentage,
  inferred_type,
  CASE WHEN inferred_type = 'identifier' THEN 'identifier'
       WHEN regexp_matches({lname}, {q(_kw(R.TARGET_KEYWORDS))}) THEN 'target_candidate'
       WHEN regexp_matches({lname}, {q(_kw(R.METADATA_KEYWORDS))}) THEN 'metadata'
       WHEN inferred_type = 'binary' OR (inferred_type = 'categorical'
            AND unique_count <= {R.ROLE_MAX_CATEGORIES}) THEN 'target_candidate'
       ELSE 'feature' END AS inferred_role,
  CASE WHEN unique_count < {R.CARDINALITY_LOW} THEN 'low'
       WHEN unique_count < {R.CARDINALITY_MEDIUM} THEN 'medium' ELSE 'high' END AS cardinality,
  CASE WHEN inferred_type = 'numeric' AND parsed > 0 THEN mean_v END AS mean_value,
  CASE WHEN inferred_type = 'numeric' AND parsed > 0 THEN std_v END AS std_value,
  CASE WHEN inferred_type = 'numeric' AND parsed > 0 THEN
        CASE WHEN std_v > 0 THEN sk ELSE 0.0 END END AS skewness,
  CASE WHEN inferred_type = 'numeric' AND parsed > 0 THEN
       coalesce(n_out > parsed * {R.OUTLIER_SHARE}, FALSE) END AS has_outliers,
  CASE WHEN inferred_type = 'numeric' AND parsed > 0 THEN
       CASE WHEN abs(sk) < 1 THEN 'normal' ELSE 'skewed' END END AS distribution,
  CASE WHEN inferred_type = 'categorical' AND unique_count > 0 THEN top_v END AS most_frequent,
  CASE WHEN inferred_type = 'categorical' THEN
       CASE WHEN cnt_std < cnt_mean THEN 'balanced' ELSE 'imbalanced' END END
       AS frequency_distribution,
  ur AS unique_ratio, avg_length, date_share, binary_values, id_sample, sample,
  CASE WHEN {is_str} THEN parsed / nullif(nonnull, 0) END AS parse_share,
  q05, q25, q75, q95, normal_min, normal_max,
  CAST(outlier_low AS BIGINT) AS outlier_low, CAST(outlier_high AS BIGINT) AS outlier_high,
  top_v, cnt_mean, cnt_std
FROM ty)"""


def profile_sql(src: str, cols, fields=None, rounded: bool = True) -> str:
    """UNION ALL of per-column profiles; ``fields`` picks output columns (doubles
    rounded to 6 places like the Spark side)."""
    body = "\nUNION ALL\n".join(column_sql(src, i, n, k, d) for i, (n, k, d) in enumerate(cols))
    fields = fields or PROFILE_FIELDS
    return f"SELECT {select_list(fields, rounded)} FROM ({body})"


# the mean is given unrounded: it can stand on a tie at the last digit
DOUBLE_FIELDS = {"null_percentage", "std_value", "skewness", "unique_ratio",
                 "avg_length", "date_share", "parse_share", "q05", "q25", "q75", "q95",
                 "normal_min", "normal_max", "cnt_mean", "cnt_std"}


def select_list(fields, rounded=True) -> str:
    return ", ".join(f"round({f}, 6) AS {f}" if rounded and f in DOUBLE_FIELDS else f
                     for f in fields)
