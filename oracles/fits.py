"""DuckDB SQL for the checks of fitted models; it shares no constant with the engine."""

from __future__ import annotations

import random

# documents joined to their labels, split by class in md5 order
LABELLED = """(SELECT doc_id, n_chars, toxic, quality,
  CASE WHEN row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id)
            <= ceil(count(*) OVER (PARTITION BY quality) * 0.2) THEN 'test' ELSE 'train' END AS part
  FROM labels JOIN documents USING (doc_id))"""


def walk() -> str:
    return f"SELECT part, doc_id, CAST(quality AS DOUBLE) AS label, TRUE AS agrees FROM {LABELLED}"


def default_walk() -> str:
    return """SELECT CASE WHEN row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey)
      <= ceil(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS part, p_partkey,
      round(p_retailprice, 6) AS label, TRUE AS agrees FROM part"""


def logistic(steps: int = 25) -> str:
    """Newton's method for two features and an intercept, penalty on the features alone."""
    return f"""
WITH RECURSIVE t AS (SELECT n_chars / 1000.0 AS a, CAST(toxic AS DOUBLE) AS b, CAST(quality AS DOUBLE) AS y
  FROM {LABELLED} WHERE part = 'train'),
w AS (SELECT 0 AS k, CAST(0 AS DOUBLE) AS u, CAST(0 AS DOUBLE) AS v, CAST(0 AS DOUBLE) AS c UNION ALL
  SELECT k + 1, u - (g1 * (e * f - i * i) - d * (g2 * f - i * g3) + h * (g2 * i - e * g3)) / det,
         v - (p * (g2 * f - i * g3) - g1 * (d * f - i * h) + h * (d * g3 - g2 * h)) / det,
         c - (p * (e * g3 - g2 * i) - d * (d * g3 - g2 * h) + g1 * (d * i - e * h)) / det
  FROM (SELECT *, p * (e * f - i * i) - d * (d * f - i * h) + h * (d * i - e * h) AS det
    FROM (SELECT k, u, v, c, sum((q - y) * a) + u AS g1, sum((q - y) * b) + v AS g2, sum(q - y) AS g3,
                 sum(q * (1 - q) * a * a) + 1 AS p, sum(q * (1 - q) * b * b) + 1 AS e, sum(q * (1 - q)) AS f,
                 sum(q * (1 - q) * a * b) AS d, sum(q * (1 - q) * a) AS h, sum(q * (1 - q) * b) AS i
          FROM (SELECT w.*, t.*, 1 / (1 + exp(-(u * a + v * b + c))) AS q FROM w, t) GROUP BY k, u, v, c))
  WHERE k < {steps}),
z AS (SELECT * FROM w WHERE k = {steps})
SELECT 'k_chars' AS term, round(u, 6) AS coefficient, TRUE AS mllib_at_optimum FROM z
UNION ALL SELECT 'toxic', round(v, 6), TRUE FROM z UNION ALL SELECT 'intercept', round(c, 6), TRUE FROM z"""


def ridge(trials: int = 50, low: float = 0.01, high: float = 100.0, seed: int = 42) -> str:
    """Closed form of ridge regression on one feature for every trial and fold."""
    draws = random.Random(seed)
    alphas = ", ".join(f"({i}, {draws.uniform(low, high)!r}::DOUBLE)" for i in range(trials))
    return f"""
WITH s AS (SELECT p_partkey, p_size / 1000.0 AS x, p_size * 3 + p_retailprice / 1000 AS y,
    row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey) AS r, count(*) OVER () AS n FROM part),
t AS (SELECT x, y, (row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR)), p_partkey) - 1) % 5 AS f
      FROM s WHERE r > ceil(n * 0.2)),
a(trial, alpha) AS (VALUES {alphas}),
m AS (SELECT h.f, avg(x) AS mx, avg(y) AS my FROM range(0, 5) h(f) JOIN t ON t.f <> h.f GROUP BY h.f),
c AS (SELECT m.f, any_value(mx) AS mx, any_value(my) AS my, sum((x - mx) * (y - my)) AS sxy, sum((x - mx) ** 2) AS sxx
      FROM m JOIN t ON t.f <> m.f GROUP BY m.f),
e AS (SELECT trial, any_value(alpha) AS alpha, c.f, 1 - sum((y - my - sxy / (sxx + alpha) * (x - mx)) ** 2) / any_value(sst) AS r2
      FROM a, c JOIN t ON t.f = c.f JOIN (SELECT f, sum(y * y) - sum(y) ** 2 / count(*) AS sst FROM t GROUP BY f) v ON v.f = c.f
      GROUP BY trial, c.f),
g AS (SELECT trial, any_value(alpha) AS alpha, avg(r2) AS score FROM e GROUP BY trial)
SELECT CAST(trial AS BIGINT) AS trial, round(alpha, 6) AS alpha, round(score, 6) AS score, score = max(score) OVER () AS best FROM g"""


def registry() -> dict:
    return {
        "m04_forest_walk": walk(),
        "m05_boosting_walk": walk(),
        "m06_logistic_optimum": logistic(),
        "m07_svm_optimum": "SELECT term, TRUE AS at_optimum FROM (VALUES ('k_chars'), ('toxic'), ('intercept')) t(term)",
        "m11_default_walk": default_walk(),
        "m12_ridge_search": ridge(),
        "m15_batch_walk": "SELECT doc_id, TRUE AS in_domain, TRUE AS agrees FROM documents",
        "e07_importance_table": """SELECT 'forest' AS model, f AS feature, TRUE AS agrees, 1.0::DOUBLE AS total, NULL::DOUBLE AS known
          FROM (VALUES ('n_chars'), ('toxic')) t(f)
          UNION ALL SELECT 'boosted', f, TRUE, 1.0::DOUBLE, k FROM (VALUES ('constant', 0.0::DOUBLE), ('p_size', 1.0::DOUBLE)) t(f, k)""",
        "t04_importance_ranks": "SELECT * FROM (VALUES ('p_size', 1::BIGINT, TRUE), ('constant', 2::BIGINT, TRUE)) t(feature, rank, agrees)",
    }
