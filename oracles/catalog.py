"""Query id -> DuckDB SQL recomputing the same result over the driver tables."""

from __future__ import annotations

from . import values as R
from .profile_sql import PROFILE_FIELDS, column_sql, q, select_list
from .schemas import DIRTY, N, S, SCHEMAS

DIRTY_SRC = R.DIRTY_ORDERS
CLEAN_COLS = [c for c in DIRTY if c[0] != "sparse_num"]


def nulls(cols) -> str:
    return " + ".join(f'(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END)' for c in cols)


# C01 -> C02 (sparse_num: 80.6 % NULL) -> C03 over the remaining 7 columns
CLEAN_SRC = ("(SELECT * FROM (SELECT DISTINCT " + ", ".join(c for c, _, _ in CLEAN_COLS)
             + f" FROM {DIRTY_SRC}) WHERE ({nulls([c for c, _, _ in CLEAN_COLS])}) / 7.0 <= 0.8)")

SRC = {t: t for t in SCHEMAS}
SRC["dirty"] = DIRTY_SRC
SRC["dirty_clean"] = CLEAN_SRC
COLS = dict(SCHEMAS)
COLS["dirty"] = DIRTY
COLS["dirty_clean"] = CLEAN_COLS

PROFILED = ["dirty", "lineitem", "orders", "customer", "part", "supplier", "events",
            "documents", "labels", "conversations", "nation", "region", "pages", "benchmark",
            "embeddings"]


def prof_body(table: str) -> str:
    return "\nUNION ALL\n".join(column_sql(SRC[table], i, n, k, d)
                                for i, (n, k, d) in enumerate(COLS[table]))


def prof(table: str, fields, where: str = "TRUE", tag: bool = False) -> str:
    lead = f"{q(table)} AS table_name, " if tag else ""
    return f"SELECT {lead}{select_list(fields)} FROM ({prof_body(table)}) WHERE {where}"


def union(parts) -> str:
    return "\nUNION ALL\n".join(f"({p})" for p in parts)


def rd(expr: str, alias: str, d: int = 6) -> str:
    return f"round({expr}, {d}) AS {alias}"


def cols_rounded(cols, exclude=()) -> str:
    return ", ".join(rd(f'"{c}"', f'"{c}"') if k == N and d == "double" else f'"{c}"'
                     for c, k, d in cols if c not in exclude)


# ---- S, P ----------------------------------------------------------------------

def s01():
    toks = ", ".join(q(t) for t in R.NA_TOKENS)
    parts = []
    for c, k, d in DIRTY:
        if k == S:
            parts.append(f"CASE WHEN {c} IN ({toks}) THEN NULL ELSE {c} END AS {c}")
        elif d == "double":
            parts.append(f"round(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 6) AS {c}")
        else:
            parts.append(c)
    return f"SELECT {', '.join(parts)} FROM {DIRTY_SRC}"


def corr_long(table, cols, digits=4):
    parts = [f"SELECT {q(a)} AS a, {q(b)} AS b, round(corr({a}, {b}), {digits}) AS corr FROM {table}"
             for a in cols for b in cols]
    return union(parts)


def p07():
    return (f"SELECT o_orderkey, round(({nulls([c for c, _, _ in DIRTY])}) / 8.0, 6) AS null_share "
            f"FROM {DIRTY_SRC}")


def p08():
    return f"""
WITH d AS (SELECT * FROM {DIRTY_SRC}),
b AS (SELECT quantile_cont(total_price, 0.25) AS q1, quantile_cont(total_price, 0.75) AS q3 FROM d)
SELECT o_orderkey, round(total_price, 6) AS total_price FROM d, b
WHERE total_price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"""


def encoder(src: str, col: str, name: str) -> str:
    return (f"{name} AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM "
            f"(SELECT DISTINCT coalesce(CAST({col} AS VARCHAR), 'nan') AS v FROM {src}))")


def p09():
    return f"""
WITH {encoder("(SELECT * FROM part WHERE p_size <= 25)", "p_name", "en")},
{encoder("(SELECT * FROM part WHERE p_size <= 25)", "p_type", "et")}
SELECT p.p_partkey, CAST(coalesce(en.code, 0) AS INTEGER) AS p_name,
       CAST(coalesce(et.code, 0) AS INTEGER) AS p_type
FROM part p LEFT JOIN en ON coalesce(p.p_name, 'nan') = en.v
            LEFT JOIN et ON coalesce(p.p_type, 'nan') = et.v"""


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def p11():
    ind = ", ".join(f"CASE WHEN o_orderpriority = {q(v)} THEN 1 ELSE 0 END AS "
                    f'"o_orderpriority_{v}"' for v in PRIORITIES[1:])
    return f"SELECT o_orderkey, {ind} FROM orders"


# ---- A ---------------------------------------------------------------------------

def a01():
    parts = [f"SELECT {q(t)} AS table_name, count(*) AS n_rows, "
             f"CAST({len(SCHEMAS[t]) + (1 if t == 'embeddings' else 0)} AS BIGINT) AS n_cols FROM {t}"
             for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                       "events", "documents", "embeddings", "pages", "benchmark", "labels",
                       "conversations"]]
    return union(parts)


def a04():
    cols = ", ".join(c for c, _, _ in DIRTY)
    return (f"SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS duplicate_count, "
            f"round(coalesce(sum(k - 1) * 100.0 / sum(k), 0), 6) AS duplicate_percentage "
            f"FROM (SELECT count(*) AS k FROM {DIRTY_SRC} GROUP BY {cols})")


def a10():
    parts = [f"SELECT {q(c)} AS name, {c} AS value, count(*) AS n FROM {DIRTY_SRC} "
             f"WHERE {c} IS NOT NULL GROUP BY {c}"
             for c in ["status", "urgent", "order_date", "num_text"]]
    return union(parts)


def a16():
    return (f"SELECT count(*) AS n_rows, 8 AS n_cols, CAST(sum({nulls([c for c, _, _ in DIRTY])}) "
            f"AS BIGINT) AS missing_cells, round(100.0 - sum({nulls([c for c, _, _ in DIRTY])}) "
            f"* 100.0 / (count(*) * 8), 6) AS completeness FROM {DIRTY_SRC}")


def complexity_sql(table) -> str:
    return f"""
SELECT {q(table)} AS table_name,
  CASE WHEN n < 10000 THEN 'small' WHEN n < 100000 THEN 'medium' WHEN n < 1000000 THEN 'large'
       ELSE 'very_large' END AS size_category,
  CAST(fc AS BIGINT) AS feature_count,
  CASE WHEN fc <= 20 THEN 'low' WHEN fc <= 200 THEN 'medium' WHEN fc <= 1000 THEN 'high'
       ELSE 'very_high' END AS feature_complexity,
  nt > 3 AS mixed_types, CAST(hc AS BIGINT) AS high_cardinality_features,
  CASE WHEN mnp > 20 THEN 'high' ELSE 'low' END AS missing_data_complexity
FROM (SELECT max(n_rows) AS n, count_if(inferred_role = 'feature') AS fc,
             count(DISTINCT inferred_type) AS nt, count_if(cardinality = 'high') AS hc,
             avg(null_percentage) AS mnp FROM ({prof_body(table)}))"""


def a22():
    return f"""
WITH p AS ({prof_body("dirty")}),
cx AS (SELECT count(*) AS n_columns, count_if(inferred_role = 'feature') AS fc,
              count_if(cardinality = 'high') AS hc, avg(null_percentage) AS mnp,
              count_if(inferred_role = 'target_candidate') AS n_cand FROM p),
m AS (SELECT sum({nulls([c for c, _, _ in DIRTY])}) * 100.0 / (count(*) * 8) AS miss FROM {DIRTY_SRC}),
dup AS (SELECT coalesce(sum(k - 1) * 100.0 / sum(k), 0) AS dp FROM
        (SELECT count(*) AS k FROM {DIRTY_SRC} GROUP BY {", ".join(c for c, _, _ in DIRTY)}))
SELECT CAST(n_columns AS BIGINT) AS n_columns, round(greatest(100.0 - miss * 2 - least(dp * 0.5, 10)
  - CASE WHEN mnp > 20 THEN 5 ELSE 0 END - CASE WHEN hc > 3 THEN 5 ELSE 0 END
  + CASE WHEN n_cand > 0 THEN 5 ELSE 0 END + CASE WHEN fc > 5 THEN 5 ELSE 0 END, 0), 6)
  AS readiness_score FROM cx, m, dup"""


def load_type(table: str, target: str, is_text: bool) -> str:
    """R16 rule as SQL over the target column."""
    small = f"count(DISTINCT {target}) <= 20" if is_text else "FALSE"
    return (f"CASE WHEN count(DISTINCT {target}) = 2 THEN 'binary_classification' "
            f"WHEN {small} THEN 'classification' ELSE 'regression' END")


def a23():
    spec = [("customer", "c_mktsegment", True, 3, 1), ("part", "p_retailprice", False, 2, 3),
            ("labels", "toxic", False, 2, 0)]
    parts = []
    for t, y, txt, nn, nc in spec:
        pt = load_type(t, y, txt)
        parts.append(
            f"SELECT {q(t)} AS table_name, count(*) AS n_rows, "
            f"CAST({len(SCHEMAS[t]) - 1} AS BIGINT) AS n_features, {pt} AS problem_type, "
            f"CASE WHEN {pt} = 'regression' THEN 'continuous' ELSE "
            f"CAST(count(DISTINCT {y}) AS VARCHAR) END AS n_classes, "
            f"CAST({nn} AS BIGINT) AS n_numeric, CAST({nc} AS BIGINT) AS n_categorical FROM {t}")
    return union(parts)


# ---- R -------------------------------------------------------------------------------

def per_table(tables, fields, where="TRUE"):
    return union([prof(t, fields, where, tag=True) for t in tables])


def r08():
    parts = []
    for t in PROFILED:
        parts.append(f"""
SELECT {q(t)} AS table_name, CASE WHEN NOT (cls OR reg OR ts) THEN 'clustering'
  ELSE concat_ws(',', CASE WHEN cls THEN 'classification' END,
                      CASE WHEN reg THEN 'regression' END,
                      CASE WHEN ts THEN 'time_series' END) END AS problem_types
FROM (SELECT coalesce(bool_or(inferred_role = 'target_candidate' AND
               (inferred_type IN ('binary', 'categorical') OR unique_count <= 10)), FALSE) AS cls,
             coalesce(bool_or(inferred_role = 'target_candidate' AND inferred_type = 'numeric'
               AND unique_count > 10), FALSE) AS reg,
             coalesce(bool_or(inferred_type = 'datetime'), FALSE) AS ts
      FROM ({prof_body(t)}))""")
    return union(parts)


def outlier_part(i, name, kind):
    """Per numeric column of the cleaned view: flag, count, range, examples."""
    col = f'"{name}"'
    x = (f"CASE WHEN regexp_full_match(trim({col}), {q(R.NUMERIC_TEXT)}) "
         f"THEN TRY_CAST(trim({col}) AS DOUBLE) END") if kind == S else f"CAST({col} AS DOUBLE)"
    return f"""
SELECT * FROM (
WITH b AS (SELECT o_orderkey AS k, {x} AS x FROM {CLEAN_SRC}),
a AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3, count(x) AS n FROM b),
bd AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi, n FROM a),
o AS (SELECT count_if(x < lo) + count_if(x > hi) AS n_out,
             min(x) FILTER (WHERE x >= lo) AS nmin, max(x) FILTER (WHERE x <= hi) AS nmax,
             any_value(n) AS n FROM b, bd),
ex AS (SELECT side, r, x FROM (
         SELECT side, x, row_number() OVER (PARTITION BY side ORDER BY k) AS r FROM (
           SELECT CASE WHEN x < lo THEN 0 WHEN x > hi THEN 1 END AS side, k, x FROM b, bd)
         WHERE side IS NOT NULL) WHERE r <= 3 ORDER BY side, r LIMIT 5),
e AS (SELECT string_agg(printf('%.2f', x), ', ' ORDER BY side, r) AS examples FROM ex)
SELECT {i} AS ordinal, {q(name)} AS name, n_out > n * 0.05 AS flagged,
  'In column ''' || {q(name)} || ''', values normally range from ' || printf('%.2f', nmin) ||
  ' to ' || printf('%.2f', nmax) || ', but there are ' || CAST(n_out AS VARCHAR) ||
  ' outliers with values like: ' || coalesce(examples, '') AS part
FROM o, e)"""


def issues_sql() -> str:
    numeric_clean = [(i, n, k) for i, (n, k, _) in enumerate(CLEAN_COLS)
                     if n in ("o_orderkey", "cust_num", "total_price", "num_text")]
    parts = union([outlier_part(i, n, k) for i, n, k in numeric_clean])
    return f"""
WITH op AS ({parts}),
pc AS ({prof_body("dirty_clean")}),
oi AS (SELECT 0 AS rk, 'outliers_detected' AS issue_type, 'medium' AS severity,
          string_agg(name, ',' ORDER BY ordinal) AS affected_columns,
          'Outliers detected in ' || CAST(count(*) AS VARCHAR) || ' numeric columns:' || chr(10)
            || string_agg(part, chr(10) ORDER BY ordinal) AS description,
          'Outliers may represent errors or important edge cases' AS business_impact,
          'keep_outliers,cap_outliers,remove_outliers' AS options
       FROM op WHERE flagged HAVING count(*) > 0),
pi AS (SELECT 1 AS rk, 'problem_type_selection' AS issue_type, 'high' AS severity,
          '' AS affected_columns,
          'Please select the type of machine learning problem you want to solve' AS description,
          'Determines the type of analysis and algorithms available' AS business_impact,
          'classification,regression' AS options),
mi AS (SELECT 2 AS rk, 'moderate_missing_values' AS issue_type, 'medium' AS severity,
          string_agg(name, ',' ORDER BY ordinal) AS affected_columns,
          'Columns [' || string_agg('''' || name || '''', ', ' ORDER BY ordinal) ||
            '] have 10-50% missing values' AS description,
          'Moderate impact on model accuracy and reliability' AS business_impact,
          'statistical_imputation,predictive_imputation' AS options
       FROM pc WHERE null_percentage > 10 AND null_percentage <= 50
                 AND inferred_role <> 'identifier' HAVING count(*) > 0),
al AS (SELECT * FROM oi UNION ALL SELECT * FROM pi UNION ALL SELECT * FROM mi)
SELECT CAST(row_number() OVER (ORDER BY rk) - 1 AS INTEGER) AS ord, issue_type, severity,
       affected_columns, description, business_impact, options FROM al"""


def issue_rows(issue_type=None):
    where = f"WHERE issue_type = {q(issue_type)}" if issue_type else ""
    return f"SELECT * FROM ({issues_sql()}) {where}"


def decisions_sql(choices: dict, tag: str) -> str:
    vals = ", ".join(f"({q(k)}, {q(v)})" for k, v in choices.items()) or "('', '')"
    return f"""
SELECT i.ord, i.issue_type || '_' || CAST(i.ord AS VARCHAR) AS key,
  CASE WHEN list_contains(string_split(i.options, ','), c.choice) THEN c.choice
       ELSE string_split(i.options, ',')[1] END AS decision, {q(tag)} AS choice_set
FROM ({issues_sql()}) i LEFT JOIN (VALUES {vals}) c(key, choice)
  ON i.issue_type || '_' || CAST(i.ord AS VARCHAR) = c.key"""


CHOICES = {"outliers_detected_0": "cap_outliers", "problem_type_selection_1": "forecasting",
           "moderate_missing_values_2": "predictive_imputation"}


def r13():
    parts = []
    for tag, ch in [("default", {}), ("given", CHOICES),
                    ("regression", {"problem_type_selection_1": "regression"})]:
        parts.append(f"SELECT {q(tag)} AS choice_set, CASE WHEN decision IN ('classification', "
                     f"'regression') THEN decision ELSE 'classification' END AS problem_type "
                     f"FROM ({decisions_sql(ch, tag)}) WHERE key LIKE 'problem_type_selection%'")
    return union(parts)


def score_expr() -> str:
    def has(words):
        return f"regexp_matches(lower(name), {q(R.keyword_regex(words))})"
    return (f"(CASE WHEN {has(R.TARGET_NAME_WORDS)} THEN 10 ELSE 0 END"
            f" + CASE WHEN {has(R.TARGET_DESCRIPTION_WORDS)} THEN 8 ELSE 0 END"
            f" + CASE WHEN inferred_type = 'binary' THEN 5 ELSE 0 END"
            f" + CASE WHEN inferred_type = 'categorical' AND unique_count = 2 THEN 7 ELSE 0 END"
            f" - CASE WHEN {has(R.TARGET_ID_WORDS)} THEN 15 ELSE 0 END"
            f" - CASE WHEN inferred_type = 'identifier' THEN 12 ELSE 0 END"
            f" - CASE WHEN round(null_percentage, 1) >= 100 THEN 20 ELSE 0 END)")


def scores_sql(table) -> str:
    return (f"SELECT {q(table)} AS table_name, ordinal, name, CAST({score_expr()} AS BIGINT) AS score "
            f"FROM ({prof_body(table)}) WHERE inferred_role NOT IN ('identifier', 'metadata')")


def r14():
    return union([f"SELECT table_name, name, score FROM ({scores_sql(t)})"
                  for t in ["dirty", "customer", "labels", "lineitem", "conversations"]])


def r15():
    parts = []
    for t in ["dirty", "customer", "labels", "lineitem", "conversations", "part"]:
        parts.append(f"""
SELECT {q(t)} AS table_name, CASE WHEN max(score) > 0
  THEN arg_min(name, (-score) * 100000 + ordinal) ELSE arg_min(name, ordinal) END AS target
FROM ({scores_sql(t)})""")
    return union(parts)


LOAD_SPEC = {"customer": ("c_mktsegment", True), "part": ("p_retailprice", False),
             "labels": ("toxic", False), "orders": ("o_orderpriority", True),
             "lineitem": ("l_shipdate", False), "supplier": ("s_acctbal", False),
             "events": ("props", True)}


def r16():
    parts = []
    for t in ["customer", "part", "labels", "orders", "lineitem", "supplier"]:
        y, txt = LOAD_SPEC[t]
        parts.append(f"SELECT {q(t)} AS table_name, {q(y)} AS target, count(DISTINCT {y}) AS "
                     f"n_values, {load_type(t, y, txt)} AS problem_type FROM {t}")
    return union(parts)


def algorithm_sql(wide):
    parts = []
    for t in ["customer", "part", "labels", "orders", "lineitem", "supplier", "events"]:
        y, txt = LOAD_SPEC[t]
        nf = len(SCHEMAS[t]) - 1 + (1 if t == "embeddings" else 0)
        limit = str(wide) if wide is not None else "n_rows / 10"
        parts.append(f"""
SELECT table_name, problem_type, n_rows, n_features,
  CASE WHEN n_rows < 1000 THEN CASE WHEN problem_type IN ('classification',
       'binary_classification') THEN 'logistic_regression' ELSE 'ridge_regression' END
       WHEN n_features > {limit} THEN 'random_forest' ELSE 'gradient_boosting' END AS algorithm
FROM (SELECT {q(t)} AS table_name, {load_type(t, y, txt)} AS problem_type, count(*) AS n_rows,
             {nf} AS n_features FROM {t})""")
    return union(parts)


# ---- C -------------------------------------------------------------------------------

def parse_sql(col: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({col}), {q(R.NUMERIC_TEXT)}) "
            f"THEN TRY_CAST(trim({col}) AS DOUBLE) END")


def mode_sql(col: str, src: str) -> str:
    return (f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1)")


def fill_numeric(method: str) -> str:
    def fill(col):
        if method == "mean":
            return f"(SELECT avg({col}) FROM {CLEAN_SRC})"
        if method == "median":
            return f"(SELECT quantile_cont({col}, 0.5) FROM {CLEAN_SRC})"
        return mode_sql(col, CLEAN_SRC)
    return (f"SELECT o_orderkey, round(coalesce(cust_num, {fill('cust_num')}), 6) AS cust_num, "
            f"round(coalesce(total_price, {fill('total_price')}), 6) AS total_price FROM {CLEAN_SRC}")


FFILL = ("coalesce(last_value(order_date IGNORE NULLS) OVER (ORDER BY o_orderkey ROWS BETWEEN "
         "UNBOUNDED PRECEDING AND CURRENT ROW), first_value(order_date IGNORE NULLS) OVER "
         "(ORDER BY o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")


def impute_clean(numeric_fill: str, sweep: bool) -> str:
    """C05 + C14 (+ C13) on the cleaned view; numeric_fill in mode|median."""
    num = (mode_sql("cust_num", CLEAN_SRC) if numeric_fill == "mode"
           else f"(SELECT quantile_cont(cust_num, 0.5) FROM {CLEAN_SRC})")
    nt = parse_sql("num_text")
    nt = f"coalesce({nt}, 0.0)" if sweep else nt
    return f"""
SELECT o_orderkey, coalesce(cust_num, {num}) AS cust_num, total_price,
  coalesce(status, {mode_sql("status", CLEAN_SRC)}) AS status,
  coalesce(urgent, {mode_sql("urgent", CLEAN_SRC)}) AS urgent,
  {FFILL} AS order_date, {nt} AS num_text
FROM {CLEAN_SRC}"""


def rounded_clean(src: str) -> str:
    return (f"SELECT o_orderkey, round(cust_num, 6) AS cust_num, round(total_price, 6) AS "
            f"total_price, status, urgent, order_date, round(num_text, 6) AS num_text FROM ({src})")


def c15():
    base = impute_clean("median", True)
    return f"""
WITH b AS ({base}),
qs AS (SELECT quantile_cont(total_price, 0.05) AS lo, quantile_cont(total_price, 0.95) AS hi FROM b)
SELECT o_orderkey, round(cust_num, 6) AS cust_num,
  round(least(greatest(total_price, lo), hi), 6) AS total_price, status, urgent, order_date,
  round(num_text, 6) AS num_text FROM b, qs"""


def c16():
    def bounds(src, col):
        return (f"(SELECT quantile_cont({col}, 0.25) - 1.5 * (quantile_cont({col}, 0.75) - "
                f"quantile_cont({col}, 0.25)) AS lo, quantile_cont({col}, 0.75) + 1.5 * "
                f"(quantile_cont({col}, 0.75) - quantile_cont({col}, 0.25)) AS hi FROM {src})")
    return f"""
WITH r1 AS (SELECT l.* FROM labels l, {bounds("labels", "quality")} b
            WHERE l.quality BETWEEN b.lo AND b.hi),
r2 AS (SELECT r1.* FROM r1, {bounds("r1", "toxic")} b WHERE r1.toxic BETWEEN b.lo AND b.hi)
SELECT * FROM r2"""


def c12():
    src = "(SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS c_name, c_acctbal FROM customer)"
    return (f"SELECT c_custkey, coalesce(c_name, {mode_sql('c_name', src)}) AS c_name, "
            f"round(c_acctbal, 6) AS c_acctbal FROM {src}")


def c13():
    parts = []
    for c, k, d in DIRTY:
        if k == S:
            parts.append(f"coalesce({c}, 'Unknown') AS {c}")
        elif d == "double":
            parts.append(f"round(coalesce({c}, 0), 6) AS {c}")
        else:
            parts.append(f"coalesce({c}, 0) AS {c}")
    return f"SELECT {', '.join(parts)} FROM {DIRTY_SRC}"


# ---- F -------------------------------------------------------------------------------

def label_encode(table, key_cols, cols):
    ctes = ", ".join(encoder(table, c, f"e_{c}") for c in cols)
    sel = ", ".join(f"CAST(coalesce(e_{c}.code, 0) AS INTEGER) AS {c}" for c in cols)
    joins = " ".join(f"LEFT JOIN e_{c} ON coalesce(CAST(t.{c} AS VARCHAR), 'nan') = e_{c}.v"
                     for c in cols)
    keys = ", ".join(f"t.{k}" for k in key_cols)
    return f"WITH {ctes} SELECT {keys}, {sel} FROM {table} t {joins}"


def f02():
    types = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    return ("SELECT p_partkey, " + ", ".join(
        f'CASE WHEN p_type = {q(v)} THEN 1 ELSE 0 END AS "p_type_{v}"' for v in types[1:])
        + " FROM part")


LI_FEATURES = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax"]


def anova_sql(feats, label="l_returnflag", src="lineitem") -> str:
    parts = []
    for f in feats:
        parts.append(f"""
SELECT {q(f)} AS feature, (sum((m - mm) ^ 2) / (count(DISTINCT y) - 1))
  / nullif(sum((x - m) ^ 2) / (count(*) - count(DISTINCT y)), 0) AS score
FROM (SELECT x, y, favg(x) OVER (PARTITION BY y) AS m, favg(x) OVER () AS mm
      FROM (SELECT CAST({f} AS DOUBLE) AS x, {label} AS y FROM {src} WHERE {f} IS NOT NULL))""")
    return union(parts)


def bin_sql(col, src):
    probs = ", ".join(str(i / 10) for i in range(1, 10))
    return (f"len(list_filter((SELECT list_distinct(quantile_cont(CAST({col} AS DOUBLE), [{probs}])) "
            f"FROM {src}), lambda b: CAST({col} AS DOUBLE) > b))")


def mi_sql(feats, label, src="lineitem", bin_label=False) -> str:
    y = bin_sql(label, src) if bin_label else label
    parts = []
    for f in feats:
        parts.append(f"""
SELECT {q(f)} AS feature, sum((nj / ntot) * ln(nj * ntot / (nb * ny))) AS score FROM (
  SELECT nj, sum(nj) OVER () AS ntot, sum(nj) OVER (PARTITION BY b) AS nb,
         sum(nj) OVER (PARTITION BY y) AS ny FROM (
    SELECT b, y, CAST(count(*) AS DOUBLE) AS nj FROM (
      SELECT {bin_sql(f, src)} AS b, {y} AS y FROM {src}
      WHERE {f} IS NOT NULL AND {label} IS NOT NULL) GROUP BY b, y))""")
    return union(parts)


def top_k_sql(score_sql, feats, k):
    order = " ".join(f"WHEN {q(f)} THEN {i}" for i, f in enumerate(feats))
    return f"""
SELECT feature FROM (SELECT feature, row_number() OVER (
  ORDER BY score DESC NULLS LAST, CASE feature {order} END DESC) AS r FROM ({score_sql}))
WHERE r <= {k}"""


def scaled(src_alias, stats_src, cols):
    return ", ".join(f"round(({src_alias}.{c} - (SELECT avg({c}) FROM {stats_src})) / "
                     f"coalesce(nullif((SELECT stddev_pop({c}) FROM {stats_src}), 0), 1), 6) AS {c}"
                     for c in cols)


def f09():
    return f"SELECT c_custkey, {scaled('t', 'customer', ['c_acctbal', 'c_nationkey'])} FROM customer t"


F10_FEATURES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate"]


def f10_long():
    """F10 fully in SQL: encode l_linestatus and the date (as text), ANOVA F against
    l_returnflag, keep the top k = min(20, max(5, 10 // 2), 10) = 5 (later column
    wins ties), scale by population std, emit (feature, value, label code) rows."""
    enc = ("(SELECT l.*, CAST(el.code AS INTEGER) AS ls_code, CAST(er.code AS INTEGER) AS rf_code, "
           "dense_rank() OVER (ORDER BY CAST(l_shipdate AS VARCHAR)) - 1 AS sd_code FROM lineitem l "
           "JOIN (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM "
           "(SELECT DISTINCT l_linestatus AS v FROM lineitem)) el ON l.l_linestatus = el.v "
           "JOIN (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code FROM "
           "(SELECT DISTINCT l_returnflag AS v FROM lineitem)) er ON l.l_returnflag = er.v)")
    col = {f: {"l_linestatus": "ls_code", "l_shipdate": "sd_code"}.get(f, f) for f in F10_FEATURES}
    scores = union([
        f"SELECT {q(f)} AS feature, {i} AS ord, ((B - S * S / NN) / (k - 1)) / "
        f"nullif((SS - B) / (NN - k), 0) AS score FROM (SELECT sum(n) AS NN, sum(s) AS S, "
        f"sum(ss) AS SS, sum(s * s / n) AS B, count_if(n > 0) AS k FROM (SELECT count({c}) AS n, "
        f"sum(CAST({c} AS DOUBLE)) AS s, sum(CAST({c} AS DOUBLE) * CAST({c} AS DOUBLE)) AS ss "
        f"FROM {enc} GROUP BY rf_code))"
        for i, (f, c) in enumerate(col.items())])
    k = min(20, max(5, len(F10_FEATURES) // 2), len(F10_FEATURES))
    values = union([
        f"SELECT {q(f)} AS feature, (CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / "
        f"coalesce(nullif(stddev_pop(CAST({c} AS DOUBLE)) OVER (), 0), 1) AS value, rf_code "
        f"AS l_returnflag FROM {enc}" for f, c in col.items()])
    return f"""
WITH sc AS ({scores}),
sel AS (SELECT feature FROM (SELECT feature, row_number() OVER (ORDER BY score DESC NULLS LAST,
        ord DESC) AS r FROM sc) WHERE r <= {k})
SELECT v.feature, round(v.value, 6) AS value, v.l_returnflag FROM ({values}) v
JOIN sel ON v.feature = sel.feature"""


def p10():
    return f"SELECT feature, count(value) AS n FROM ({f10_long()}) GROUP BY feature"


def report_facts():
    """C19's numbers: the cleaned view loses sparse_num, the training set nothing more but identifiers."""
    p = prof_body("dirty_clean")
    ids = f"(SELECT count(*) FROM ({p}) WHERE inferred_type = 'identifier')"
    miss = (f"(SELECT 100.0 - sum({nulls([c for c, _, _ in DIRTY])}) * 100.0 / (count(*) * 8) FROM {DIRTY_SRC})")
    facts = [("summary", "rows", f"(SELECT count(*) FROM {DIRTY_SRC})"), ("summary", "columns", "8"),
             ("summary", "processed_rows", f"(SELECT count(*) FROM {CLEAN_SRC})"),
             ("summary", "processed_columns", f"7 - {ids}"),
             ("completeness", "original", f"round({miss}, 1)"), ("completeness", "final", "100"),
             ("completeness", "improvement", f"round(100.0 - {miss}, 1)"),
             ("quality", "duplicate_count", f"(SELECT count(*) FROM {CLEAN_SRC}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {CLEAN_SRC}))"),
             ("quality", "duplicate_percentage", "0"),
             ("quality", "outlier_columns", f"(SELECT count_if(has_outliers) FROM ({p}))")]
    rows = [f"SELECT {q(s)} AS section, {q(i)} AS item, CAST({v} AS DOUBLE) AS value" for s, i, v in facts]
    rows.append(f"SELECT 'type_counts', inferred_type, CAST(count(*) AS DOUBLE) FROM ({p}) GROUP BY inferred_type")
    rows.append(f"SELECT 'type_percentages', inferred_type, round(count(*) * 100.0 / 7, 1) FROM ({p}) GROUP BY inferred_type")
    return union(rows)


# lineitem with gaps, as the engine's view of the same name
GAPPY = """(SELECT l_orderkey, l_linenumber,
  CASE WHEN (l_orderkey + l_linenumber) % 7 > 0 THEN l_quantity END AS qty,
  CASE WHEN (l_orderkey + l_linenumber) % 5 > 0 THEN CAST(l_suppkey AS INTEGER) END AS supp,
  CASE WHEN (l_orderkey + l_linenumber) % 3 > 0 THEN l_extendedprice END AS price,
  CASE WHEN (l_orderkey + l_linenumber) % 4 > 0 THEN l_discount > 0.05 END AS cheap,
  CASE WHEN (l_orderkey + l_linenumber) % 11 > 0 THEN l_shipdate END AS shipped FROM lineitem)"""


def gaps_sql() -> dict:
    """Queries on NULL, integer, boolean, big-integer, temporal and quoted input."""
    cap = ("least(greatest({c}, (SELECT quantile_cont({c}, 0.05) FROM g)), (SELECT quantile_cont({c}, 0.95) FROM g))")
    mode = "(SELECT {c} FROM g WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    g = f"WITH g AS {GAPPY} "
    part = "(SELECT p_size + 1e9 AS p_size, p_retailprice + 1e9 AS p_retailprice, p_type FROM part)"
    return {
        "c15_cap_outliers_gaps": g + "SELECT l_orderkey, l_linenumber, " + ", ".join(
            f"round(CASE WHEN {c} IS NOT NULL THEN {cap.format(c=c)} END, 6) AS {c}" for c in ("qty", "supp")) + " FROM g",
        "c13_final_sweep_typed": g + (
            "SELECT l_orderkey, l_linenumber, round(coalesce(qty, 0), 6) AS qty, coalesce(supp, 0) AS supp, "
            "round(coalesce(price, 0), 6) AS price, CASE WHEN cheap THEN 1.0 ELSE 0.0 END::DOUBLE AS cheap, "
            "coalesce(CAST(shipped AS VARCHAR), 'Unknown') AS shipped FROM g"),
        "c08_impute_mode_typed": g + (
            f"SELECT l_orderkey, l_linenumber, CAST(CAST(coalesce(cheap, {mode.format(c='cheap')}) AS INT) AS DOUBLE) AS cheap, "
            f"coalesce(supp, {mode.format(c='supp')}) AS supp FROM g"),
        "a20_correlation_gaps": corr_long(GAPPY, ["qty", "supp", "price"]),
        "a03_distinct_wide": (
            "SELECT 'wide_key' AS name, count(DISTINCT o_orderkey) AS unique_count FROM orders UNION ALL "
            "SELECT 'wide_cust', count(DISTINCT o_custkey) FROM orders"),
        "f05_anova_offset": f"SELECT feature, round(score, 4) AS score FROM ({anova_sql(['p_size', 'p_retailprice'], 'p_type', part)})",
        "f06_mutual_info_gaps": f"SELECT feature, round(score, 6) AS score FROM ({mi_sql(['qty', 'supp', 'price'], 'cheap', GAPPY)})",
        "s01_csv_quoted": ("SELECT doc_id, 'say \"hi\", ' || text AS text, source, n_chars > 500 AS is_long FROM documents"),
        "e05_confusion_pairs": ("SELECT l_suppkey AS label, l_partkey % 1500 AS prediction, count(*) AS n FROM lineitem GROUP BY ALL"),
        "e04_constant_label": f"""
WITH p AS (SELECT 'off' AS part, 25.0 AS label, CAST(p_size AS DOUBLE) AS prediction FROM part
  UNION ALL SELECT 'exact', 25.0, 25.0 FROM part
  UNION ALL SELECT 'gaps', CASE WHEN p_partkey % 3 > 0 THEN label END, prediction FROM {REG_PRED})
SELECT part, round(avg((label - prediction) ^ 2), 6) AS mse, round(sqrt(avg((label - prediction) ^ 2)), 6) AS rmse,
  round(avg(abs(label - prediction)), 6) AS mae, round(CASE part WHEN 'off' THEN 0.0 WHEN 'exact' THEN 1.0
  ELSE 1 - sum((label - prediction) ^ 2) / sum((label - m) ^ 2) END, 6) AS r2
FROM (SELECT *, avg(label) OVER (PARTITION BY part) AS m FROM p WHERE label IS NOT NULL) GROUP BY part""",
    }


def f11():
    fit = "(SELECT * FROM part WHERE p_size <= 25)"
    enc_cols = ["p_name", "p_brand", "p_type"]
    ctes = ", ".join(encoder(fit, c, f"e_{c}") for c in enc_cols)

    def coded(tab):
        sel = ", ".join(f"CAST(coalesce(e_{c}.code, 0) AS INTEGER) AS {c}" for c in enc_cols)
        joins = " ".join(f"LEFT JOIN e_{c} ON coalesce(t.{c}, 'nan') = e_{c}.v" for c in enc_cols)
        return f"(SELECT t.p_partkey, {sel}, t.p_size FROM {tab} t {joins})"
    feats = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
    return (f"WITH {ctes}, fe AS {coded(fit)}, ae AS {coded('part')} "
            f"SELECT {scaled('ae', 'fe', feats)} FROM ae")


# ---- M, E, T, N ---------------------------------------------------------------------------

def rank_sql(src, key, part=None):
    p = f"PARTITION BY {part}" if part else ""
    return (f"row_number() OVER ({p} ORDER BY md5(CAST({key} AS VARCHAR)), {key})",
            f"count(*) OVER ({p})")


def m01(stratify=None):
    rn, n = rank_sql("orders", "o_orderkey", stratify)
    extra = ", o_orderpriority" if stratify else ""
    return (f"SELECT o_orderkey{extra}, CASE WHEN {rn} <= ceil({n} * 0.2) THEN 'test' ELSE 'train' "
            f"END AS part FROM orders")


def m03():
    rs, _ = rank_sql("orders", "o_orderkey", "o_orderstatus")
    rp, _ = rank_sql("orders", "o_orderkey")
    return (f"SELECT o_orderkey, CAST(({rs} - 1) % 5 AS INTEGER) AS stratified_fold, "
            f"CAST(({rp} - 1) % 5 AS INTEGER) AS plain_fold FROM orders")


def m09(alpha: float = 1.0):
    """Ridge (alpha 0 = OLS) on one feature, closed form on the md5-ordered 80 % train part."""
    rn, n = rank_sql("part", "p_partkey")
    return f"""
WITH s AS (SELECT p_partkey, p_size AS x, p_retailprice AS y,
                  CASE WHEN {rn} <= ceil({n} * 0.2) THEN 'test' ELSE 'train' END AS part FROM part),
t AS (SELECT avg(x) AS mx, avg(y) AS my FROM s WHERE part = 'train'),
w AS (SELECT sum((x - mx) * (y - my)) / (sum((x - mx) * (x - mx)) + {alpha}) AS w,
             any_value(mx) AS mx, any_value(my) AS my FROM s, t WHERE part = 'train')
SELECT part, p_partkey, round(y, 6) AS label, round(my + w * (x - mx), 6) AS prediction FROM s, w"""


def m10():
    algos = {"classification": ["random_forest", "gradient_boosting", "logistic_regression", "svm"],
             "regression": ["random_forest", "gradient_boosting", "linear_regression",
                            "ridge_regression"]}
    parts = []
    for t in ["customer", "part", "labels"]:
        y, txt = LOAD_SPEC[t]
        for fam, names in algos.items():
            for a in names:
                cond = ("problem_type = 'regression'" if fam == "regression"
                        else "problem_type <> 'regression'")
                parts.append(f"SELECT table_name, problem_type, {q(a)} AS algorithm FROM "
                             f"(SELECT {q(t)} AS table_name, {load_type(t, y, txt)} AS problem_type "
                             f"FROM {t}) WHERE {cond}")
    return union(parts)


BINARY_PRED = """(SELECT l.doc_id, l.quality AS label,
  CASE WHEN d.n_chars % 5 = 0 THEN 1 - l.quality ELSE l.quality END AS prediction,
  (d.n_chars % 97) / 97.0 AS score FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""
MULTI_PRED = """(SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS label,
  CASE WHEN o_orderkey % 6 = 0 THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 5 + 1
       ELSE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS prediction FROM orders)"""
REG_PRED = """(SELECT p_partkey, p_retailprice AS label,
  p_retailprice + p_size - 25 AS prediction FROM part)"""


def per_class_sql(src, group=None):
    g = f"{group}, " if group else ""
    gsel = f"p.{group}, " if group else ""
    return f"""
SELECT {g}c, support, predicted, tp,
  coalesce(tp / nullif(predicted, 0), 0) AS pr, coalesce(tp / nullif(support, 0), 0) AS rc
FROM (SELECT {gsel}cls.c, count_if(p.label = cls.c) AS support,
             count_if(p.prediction = cls.c) AS predicted,
             count_if(p.label = cls.c AND p.prediction = cls.c) AS tp
      FROM {src} p, (SELECT label AS c FROM {src} UNION SELECT prediction FROM {src}) cls
      GROUP BY {gsel}cls.c)"""


def f1(p="pr", r="rc"):
    return f"CASE WHEN {p} + {r} = 0 THEN 0 ELSE 2 * {p} * {r} / ({p} + {r}) END"


def cls_metrics(src, group=None):
    g = f"{group}, " if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {g}round(sum(tp) / sum(support), 6) AS accuracy,
  round(sum(pr * support) / sum(support), 6) AS precision,
  round(sum(rc * support) / sum(support), 6) AS recall,
  round(sum(({f1()}) * support) / sum(support), 6) AS f1
FROM ({per_class_sql(src, group)}) {gb}"""


def auc_sql(src, group=None):
    g = f"{group}, " if group else ""
    pb = f"PARTITION BY {group}" if group else ""
    gb = f"GROUP BY {group}" if group else ""
    return f"""
SELECT {g}coalesce(sum(pos * (below + neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 0) AS auc
FROM (SELECT {g}pos, neg, coalesce(sum(neg) OVER ({pb} ORDER BY score ROWS BETWEEN
        UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT {g}score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg
            FROM {src} GROUP BY {g}score)) {gb}"""


def e04():
    return f"""
SELECT round(avg((label - prediction) ^ 2), 6) AS mse, round(sqrt(avg((label - prediction) ^ 2)), 6) AS rmse,
  round(avg(abs(label - prediction)), 6) AS mae,
  round(1 - sum((label - prediction) ^ 2) / (var_pop(label) * count(*)), 6) AS r2 FROM {REG_PRED}"""


def e05():
    return f"""
WITH p AS {MULTI_PRED}, cls AS (SELECT label AS c FROM p UNION SELECT prediction FROM p)
SELECT a.c AS label, b.c AS prediction,
  (SELECT count(*) FROM p WHERE p.label = a.c AND p.prediction = b.c) AS n
FROM cls a, cls b"""


def e06():
    pc = per_class_sql(MULTI_PRED)
    return f"""
WITH pc AS ({pc}), t AS (SELECT sum(support) AS n, sum(tp) AS tp, avg(pr) AS mp, avg(rc) AS mr,
  avg({f1()}) AS mf, sum(pr * support) AS wp, sum(rc * support) AS wr,
  sum(({f1()}) * support) AS wf FROM pc)
SELECT CAST(c AS VARCHAR) AS class_name, round(pr, 6) AS precision, round(rc, 6) AS recall,
  round({f1()}, 6) AS f1_score, CAST(support AS BIGINT) AS support FROM pc
UNION ALL SELECT 'accuracy', round(tp / n, 6), round(tp / n, 6), round(tp / n, 6), CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'macro avg', round(mp, 6), round(mr, 6), round(mf, 6), CAST(n AS BIGINT) FROM t
UNION ALL SELECT 'weighted avg', round(wp / n, 6), round(wr / n, 6), round(wf / n, 6),
  CAST(n AS BIGINT) FROM t"""


def e08():
    return f"""
SELECT m.*, (SELECT count(*) FROM {BINARY_PRED}) AS test_samples,
  'binary_classification' AS problem_type,
  (SELECT string_agg(CAST(prediction AS VARCHAR), ',' ORDER BY doc_id) FROM
     (SELECT doc_id, prediction FROM {BINARY_PRED} ORDER BY doc_id LIMIT 10)) AS predictions_sample
FROM ({cls_metrics(BINARY_PRED)}) m"""


def e09():
    split_src = (f"(SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY "
                 f"md5(CAST(doc_id AS VARCHAR)), doc_id) <= ceil(count(*) OVER (PARTITION BY label) "
                 f"* 0.2) THEN 'test' ELSE 'train' END AS part FROM {BINARY_PRED})")
    return (f"SELECT m.*, round(a.auc, 6) AS auc FROM ({cls_metrics(split_src, 'part')}) m "
            f"JOIN ({auc_sql(split_src, 'part')}) a ON m.part = a.part")


def t01():
    dedup = f"(SELECT DISTINCT * FROM {DIRTY_SRC})"
    parts = union([f"SELECT {q(c)} AS name, o_orderkey, {c} AS v FROM {dedup} WHERE {c} IS NOT NULL"
                   for c in ["status", "urgent", "order_date", "num_text"]])
    return (f"SELECT name, r, o_orderkey, v FROM (SELECT *, row_number() OVER (PARTITION BY name "
            f"ORDER BY o_orderkey) AS r FROM ({parts})) WHERE r <= 3")


def t01_rows():
    dedup = f"(SELECT *, row_number() OVER (ORDER BY o_orderkey) AS r FROM (SELECT DISTINCT * FROM {DIRTY_SRC}))"
    roles = f"({prof('dirty', ['name', 'inferred_role'])})"
    cell = lambda c, k: (f"{q(c)} AS name, {f'round(CAST({c} AS DOUBLE), 6)' if k == N else 'CAST(NULL AS DOUBLE)'} AS number, "  # noqa: E731
                         f"{'CAST(NULL AS VARCHAR)' if k == N else c} AS text")
    first = union([f"SELECT 'issue' AS shown, r, {cell(c, k)} FROM {dedup} WHERE r <= 5" for c, k, _ in DIRTY[:5]])
    free = union([f"SELECT 'target' AS shown, r, {cell(c, k)} FROM {dedup} WHERE r <= 8" for c, k, _ in DIRTY])
    return (f"SELECT * FROM ({first}) UNION ALL SELECT * FROM ({free}) WHERE name IN "
            f"(SELECT name FROM {roles} WHERE inferred_role NOT IN ('identifier', 'metadata'))")


def t06():
    return f"""
WITH b AS (SELECT o_orderkey AS k, total_price AS x FROM {CLEAN_SRC}),
bd AS (SELECT quantile_cont(x, 0.25) - 1.5 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) AS lo,
              quantile_cont(x, 0.75) + 1.5 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) AS hi
       FROM b)
SELECT side, k, round(x, 6) AS v, r FROM (
  SELECT side, k, x, row_number() OVER (PARTITION BY side ORDER BY k) AS r FROM (
    SELECT CASE WHEN x < lo THEN 0 WHEN x > hi THEN 1 END AS side, k, x FROM b, bd)
  WHERE side IS NOT NULL) WHERE r <= 3"""


def t05():
    return (f"SELECT name, score, row_number() OVER (ORDER BY score DESC, ordinal) AS rank "
            f"FROM ({scores_sql('dirty')})")


def n_scalar():
    title = ("array_to_string(list_transform(string_split(replace(lower(o_orderstatus) || '_status', "
             "'_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')")
    return f"""
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS n01_text, lower(o_orderpriority) AS n02_lower,
  CAST(length(o_orderpriority) AS INTEGER) AS n03_length,
  regexp_matches(o_orderpriority, '\\d-[A-Z]{{3,}}') AS n04_search,
  regexp_full_match(o_orderpriority, '\\d-(?:HIGH|LOW)') AS n04_full,
  {parse_sql("(' ' || CAST(o_custkey AS VARCHAR) || ' ')")} AS n05_parse,
  least(greatest(o_totalprice, 50000.0), 400000.0) AS n06_clip,
  coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, 'Unknown') AS n07_fill,
  round(o_totalprice * 0.7071067, 1) AS n08_round1, round_even(o_custkey / 8.0, 2) AS n08_bround,
  {title} AS n09_title,
  regexp_matches(lower(o_orderpriority), 'urgent|high') AS n10_keyword,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS n11_timestamp,
  printf('%.2f', o_totalprice) AS n12_format,
  round(sqrt(abs(o_totalprice - 250000.0)), 6) AS n13_abs_sqrt
FROM orders"""


def zero_signed(sql: str) -> str:
    """Wrap every ``round(...)`` so that -0.0 comes out as 0.0, as on the Spark side."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + len(key)])
            i = j + len(key)
            continue
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = "round(" + zero_signed(sql[j + len(key):k - 1]) + ")"
        out.append(sql[i:j] + f"(CASE WHEN {inner} = 0 THEN 0.0 ELSE {inner} END)")
        i = k


def registry() -> dict:
    from . import fits
    reg = {**_registry(), **fits.registry()}
    reg.update({k: f"SELECT o_orderkey, {', '.join(v)} FROM ({n_scalar()})"
                for k, v in R.N_COLUMNS.items()})
    reg.update(gaps_sql())
    reg["s07_processor_roundtrip"] = f11()
    m = cls_metrics(BINARY_PRED)
    reg["s08_deployment_info"] = (
        "SELECT 'rule' AS model_name, 'binary_classification' AS problem_type, 'n_chars,quality' AS feature_names, "
        f"'model' AS model_path, accuracy, f1 AS f1_score FROM ({m})")
    report = e06().replace(MULTI_PRED, BINARY_PRED)
    reg["e08_full_evaluation"] = union([
        f"SELECT {q(c)} AS section, class_name AS item, CAST({c} AS DOUBLE) AS value FROM ({report})"
        for c in ("precision", "recall", "f1_score", "support")] + [
        f"SELECT 'confusion', label || '-' || prediction, CAST(count(*) AS DOUBLE) FROM {BINARY_PRED} GROUP BY label, prediction",
        "SELECT 'importance', 'n_chars', 0.75", "SELECT 'importance', 'quality', 0.25"])
    reg["c19_report"] = reg["s05_analysis_report_sink"] = report_facts()
    reg["s03_read_report"] = (
        f"SELECT (SELECT count(*) FROM {DIRTY_SRC}) AS rows, CAST(8 AS BIGINT) AS columns, problem_type, "
        f"CAST(0 AS BIGINT) AS duplicate_count, round((SELECT value FROM ({report_facts()}) "
        f"WHERE section = 'completeness' AND item = 'original'), 6) AS completeness FROM ({r13()}) LIMIT 1")
    reg["e01_accuracy"] = f"SELECT accuracy FROM ({cls_metrics(BINARY_PRED)})"
    reg["e02_weighted_prf"] = f"SELECT precision, recall, f1 FROM ({cls_metrics(BINARY_PRED)})"
    return {k: zero_signed(v) for k, v in reg.items()}


def _registry() -> dict:
    num = "kind = 'numeric'"
    st = "kind = 'string'"
    return {
        "s01_scan_normalize": s01(),
        "s01_csv_roundtrip": (
            f"SELECT o_orderkey, round(cust_num, 6) AS cust_num, round(sparse_num, 6) AS sparse_num, "
            f"round(total_price, 6) AS total_price, status, urgent, order_date, "
            f"CAST(CASE WHEN num_text IN ({', '.join(q(t) for t in R.NA_TOKENS)}) THEN NULL "
            f"ELSE num_text END AS BIGINT) AS num_text FROM {DIRTY_SRC}"),
        "s04_training_sink": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
        "s06_correlation_sink": corr_long("lineitem", ["l_quantity", "l_extendedprice",
                                                       "l_discount", "l_tax"]),
        "p01_drop_columns": f"SELECT {cols_rounded(DIRTY, ('sparse_num',))} FROM {DIRTY_SRC}",
        "p02_without_identifiers": "SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer",
        "p03_features_target": "SELECT p_partkey, p_name, p_brand, p_type, p_size, round(p_retailprice, 6) AS label FROM part",
        "p04_select_numeric": "SELECT " + ", ".join(
            rd(c, c) if d == "double" else c for c, k, d in SCHEMAS["lineitem"] if k == N)
            + " FROM lineitem",
        "p05_select_by_role": "SELECT c_custkey, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer",
        "p06_not_null": f"SELECT o_orderkey, cust_num FROM {DIRTY_SRC} WHERE cust_num IS NOT NULL",
        "p07_row_null_share": p07(),
        "p08_range_filter": p08(),
        "p09_unseen_default": p09(),
        "p10_project_selected": p10(),
        "p11_indicator_columns": p11(),
        "a01_table_shape": a01(),
        "a02_null_counts": prof("dirty", ["name", "null_count", "null_percentage"]),
        "a03_distinct_counts": prof("dirty", ["name", "unique_count"]),
        "a04_duplicates": a04(),
        "a05_mean_std": prof("lineitem", ["name", "mean_value", "std_value"]),
        "a06_skewness": prof("documents", ["name", "skewness"]),
        "a07_distribution": prof("events", ["name", "distribution"]),
        "a08_quantiles": prof("lineitem", ["name", "q05", "q25", "q75", "q95"], num),
        "a09_outlier_flag": prof("labels", ["name", "has_outliers"]),
        "a10_value_counts": a10(),
        "a11_most_frequent": prof("dirty", ["name", "most_frequent"]),
        "a12_balance": prof("conversations", ["name", "frequency_distribution"]),
        "a13_cardinality": prof("part", ["name", "cardinality"]),
        "a14_ratio_length": per_table(["documents", "conversations", "pages", "benchmark"],
                                      ["name", "unique_ratio", "avg_length"], st),
        "a15_outlier_detail": per_table(["dirty", "documents", "events"],
                                        ["name", "normal_min", "normal_max", "outlier_low",
                                         "outlier_high"], "inferred_type = 'numeric'"),
        "a16_missing_cells": a16(),
        "a17_type_composition": (f"SELECT inferred_type, count(*) AS n_columns, "
                                 f"round(count(*) * 100.0 / 8, 1) AS pct FROM "
                                 f"({prof_body('dirty')}) GROUP BY inferred_type"),
        "a18_complexity": union([complexity_sql(t) for t in ["dirty", "lineitem", "documents"]]),
        "a19_class_counts": ("SELECT quality AS label, count(*) AS n, min(count(*)) OVER () < 2 "
                             "AS too_small FROM labels GROUP BY quality"),
        "a20_correlation": corr_long("lineitem", ["l_quantity", "l_extendedprice", "l_discount",
                                                  "l_tax", "l_linenumber"]),
        "a21_column_profile": prof("lineitem", PROFILE_FIELDS),
        "a21_column_profile_dirty": prof("dirty", PROFILE_FIELDS),
        "a21_column_profile_events": prof("events", PROFILE_FIELDS),
        "a21_column_profile_documents": prof("documents", PROFILE_FIELDS),
        "a21_column_profile_pages": prof("pages", PROFILE_FIELDS),
        "a21_column_profile_conversations": prof("conversations", PROFILE_FIELDS),
        "a22_readiness": a22(),
        "a23_characteristics": a23(),
        "r01_type_inference": per_table(PROFILED, ["name", "inferred_type"]),
        "r02_datetime_rule": union([
            f"SELECT {q(t)} AS table_name, name, round(date_share, 6) AS date_share, "
            f"inferred_type = 'datetime' AS is_datetime FROM ({prof_body(t)}) WHERE kind <> 'numeric'"
            for t in ["dirty", "orders", "events"]]),
        "r03_numeric_rule": (f"SELECT name, round(parse_share, 6) AS parse_share, inferred_type = "
                             f"'numeric' AS is_numeric FROM ({prof_body('dirty')}) WHERE {st}"),
        "r04_binary_rule": union([
            f"SELECT {q(t)} AS table_name, name, coalesce(binary_values, FALSE) AS binary_values, "
            f"inferred_type = 'binary' AS is_binary FROM ({prof_body(t)}) WHERE {st}"
            for t in ["dirty", "lineitem", "conversations"]]),
        "r05_identifier_rule": union([
            f"SELECT {q(t)} AS table_name, name, round(unique_ratio, 6) AS unique_ratio, "
            f"coalesce(id_sample, FALSE) AS id_sample, inferred_type = 'identifier' AS "
            f"is_identifier FROM ({prof_body(t)}) WHERE {st}"
            for t in ["customer", "supplier", "part", "pages", "events"]]),
        "r06_text_rule": per_table(["documents", "pages", "benchmark", "conversations", "part"],
                                   ["name", "inferred_type"], st),
        "r07_role_inference": per_table(PROFILED, ["name", "inferred_role"]),
        "r08_problem_types": r08(),
        "r09_outlier_issue": issue_rows("outliers_detected"),
        "r10_missing_issue": issue_rows("moderate_missing_values"),
        "r11_problem_type_issue": issue_rows("problem_type_selection"),
        "r12_issue_table": issue_rows(),
        "r13_problem_type": r13(),
        "r14_target_scores": r14(),
        "r15_validated_target": r15(),
        "r16_problem_type_at_load": r16(),
        "r17_default_algorithm": algorithm_sql(None),
        "r18_fallback_algorithm": algorithm_sql(50),
        "r19_decisions": union([decisions_sql(CHOICES, "given"), decisions_sql({}, "default")]),
        "c01_dedup": f"SELECT DISTINCT {cols_rounded(DIRTY)} FROM {DIRTY_SRC}",
        "c02_drop_high_missing": (f"SELECT DISTINCT {cols_rounded(DIRTY, ('sparse_num',))} "
                                  f"FROM {DIRTY_SRC}"),
        "c03_drop_sparse_rows": (f"SELECT {cols_rounded(DIRTY)} FROM {DIRTY_SRC} WHERE "
                                 f"({nulls([c for c, _, _ in DIRTY])}) / 8.0 <= 0.8"),
        "c04_cleaning_chain": f"SELECT {cols_rounded(CLEAN_COLS)} FROM {CLEAN_SRC}",
        "c05_text_to_numeric": (f"SELECT o_orderkey, round({parse_sql('num_text')}, 6) AS num_text "
                                f"FROM {DIRTY_SRC}"),
        "c06_impute_mean": fill_numeric("mean"),
        "c07_impute_median": fill_numeric("median"),
        "c08_impute_mode": fill_numeric("mode"),
        "c09_impute_knn": fill_numeric("mean"),
        "c10_impute_categorical": (f"SELECT o_orderkey, coalesce(status, "
                                   f"{mode_sql('status', CLEAN_SRC)}) AS status, coalesce(urgent, "
                                   f"{mode_sql('urgent', CLEAN_SRC)}) AS urgent FROM {CLEAN_SRC}"),
        "c11_ffill_bfill": f"SELECT o_orderkey, {FFILL} AS order_date FROM {CLEAN_SRC}",
        "c12_impute_other": c12(),
        "c13_final_sweep": c13(),
        "c14_impute_dispatch": rounded_clean(impute_clean("mode", False)),
        "c15_cap_outliers": c15(),
        "c16_remove_outliers": c16(),
        "c17_keep_outliers": "SELECT doc_id, n_chars FROM documents",
        "c18_execute": rounded_clean(impute_clean("mode", True)),
        "c20_process_dataset": rounded_clean(impute_clean("mode", True)),
        "f01_label_encode": label_encode("part", ["p_partkey"], ["p_name", "p_brand", "p_type"]),
        "f02_one_hot": f02(),
        "f03_binary_encode": label_encode("lineitem", ["l_orderkey", "l_linenumber"],
                                          ["l_linestatus"]),
        "f04_target_mapping": ("SELECT v AS value, dense_rank() OVER (ORDER BY v) - 1 AS code FROM "
                               "(SELECT DISTINCT l_returnflag AS v FROM lineitem)"),
        "f05_anova_f": f"SELECT feature, round(score, 6) AS score FROM ({anova_sql(LI_FEATURES)})",
        "f06_mutual_info_binary": (f"SELECT feature, round(score, 6) AS score FROM "
                                   f"({mi_sql(LI_FEATURES, 'l_linestatus')})"),
        "f07_mutual_info_regression": (
            f"SELECT feature, round(score, 6) AS score FROM ({mi_sql(['l_quantity', 'l_discount', 'l_tax', 'l_partkey', 'l_linenumber'], 'l_extendedprice', bin_label=True)})"),
        "f08_select_top_k": top_k_sql(anova_sql(LI_FEATURES), LI_FEATURES, 5),
        "f09_standard_scale": f09(),
        "f10_fit_features": f10_long(),
        "f10_fit_features_long": f10_long(),
        "f11_transform_new": f11(),
        "m01_split": m01(),
        "m02_stratified_split": m01("o_orderpriority"),
        "m03_folds": m03(),
        "m08_linear_closed_form": m09(0.0),
        "m09_ridge_closed_form": m09(),
        "m10_catalog": m10(),
        "e01_e02_metrics": cls_metrics(BINARY_PRED),
        "e02_multiclass": cls_metrics(MULTI_PRED),
        "e03_auc": f"SELECT round(auc, 6) AS auc FROM ({auc_sql(BINARY_PRED)})",
        "e04_regression": e04(),
        "e05_confusion": e05(),
        "e06_report": e06(),
        "e08_evaluation": e08(),
        "s08_evaluation_sink": e08(),
        "s02_ingest": "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer",
        "e09_bundle": e09(),
        "t01_head_preview": t01(),
        "t01_head_rows": t01_rows(),
        "s07_bundle_scoring": ("SELECT p_partkey, TRUE AS agrees, 'p_retailprice' AS target, "
                               "'ridge_regression' AS algorithm FROM part"),
        "t02_samples": union([
            f"SELECT {q(t)} AS table_name, name, sample FROM ({prof_body(t)}) WHERE {st}"
            for t in ["dirty", "customer", "part"]]),
        "t03_top_k": top_k_sql(mi_sql(LI_FEATURES, "l_linestatus"), LI_FEATURES, 3),
        "t05_ranked_targets": t05(),
        "t06_outlier_examples": t06(),
        "t07_first_predictions": (f"SELECT doc_id, prediction FROM {BINARY_PRED} ORDER BY doc_id "
                                  f"LIMIT 10"),
        "n01_n13_scalar": n_scalar(),
    }
