"""Data-quality issue table.

One row per issue, in fixed order: outliers, problem type, missing values.
The option lists are the fixed choices offered for each issue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..functions import rules as R
from .outliers import outlier_examples
from .stats import iqr_bounds

# FIXED VALUES: issue types, severities and offered options (first = default).
OUTLIER_OPTIONS = ["keep_outliers", "cap_outliers", "remove_outliers"]
PROBLEM_TYPE_OPTIONS = ["classification", "regression"]
MISSING_OPTIONS = ["statistical_imputation", "predictive_imputation"]
OUTLIER_IMPACT = "Outliers may represent errors or important edge cases"
PROBLEM_TYPE_DESCRIPTION = "Please select the type of machine learning problem you want to solve"
PROBLEM_TYPE_IMPACT = "Determines the type of analysis and algorithms available"
MISSING_IMPACT = "Moderate impact on model accuracy and reliability"
OUTLIER_TITLE = "Outliers detected in {n} numeric columns:\n"
OUTLIER_LINE = ("In column '{column}', values normally range from {normal_range}, but there are "
                "{outlier_count} outliers with values like: {examples}")
MISSING_DESCRIPTION = "Columns {columns} have 10-50% missing values"

ISSUE_SCHEMA = T.StructType([
    T.StructField("ord", T.IntegerType()),
    T.StructField("issue_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("affected_columns", T.ArrayType(T.StringType())),
    T.StructField("description", T.StringType()),
    T.StructField("business_impact", T.StringType()),
    T.StructField("options", T.ArrayType(T.StringType())),
    T.StructField("details", T.MapType(T.StringType(), T.StringType())),
])


def outlier_columns(rows: list[dict]) -> list[str]:
    return [r["name"] for r in rows if r["inferred_type"] == "numeric" and r["has_outliers"]]


def outlier_detail(row: dict, examples: list[float]) -> dict:
    """A15 + T06 for one flagged column: normal range, count, up to 5 examples."""
    return {
        "normal_range": f"{row['normal_min']:.2f} to {row['normal_max']:.2f}",
        "outlier_examples": [f"{v:.2f}" for v in examples[:5]],
        "outlier_count": int((row["outlier_low"] or 0) + (row["outlier_high"] or 0)),
    }


def outlier_issue(df: DataFrame, rows: list[dict], order_by: str | None):
    """R09."""
    cols = outlier_columns(rows)
    if not cols:
        return None
    by = {r["name"]: r for r in rows}
    examples = {c: [] for c in cols}
    bounds = {c: iqr_bounds(by[c]["q25"], by[c]["q75"]) for c in cols}
    bounds = {c: b for c, b in bounds.items() if b[0] is not None}
    if order_by is not None and bounds:
        for r in outlier_examples(df, bounds, order_by).orderBy("side", "r").collect():
            examples[r["name"]].append(r["v"])
    details = {c: outlier_detail(by[c], examples[c]) for c in cols}
    parts = [OUTLIER_LINE.format(column=c, examples=", ".join(d["outlier_examples"]), **d)
             for c, d in details.items()]
    desc = OUTLIER_TITLE.format(n=len(cols)) + "\n".join(parts)
    flat = {f"{c}.outlier_count": str(d["outlier_count"]) for c, d in details.items()}
    flat.update({f"{c}.normal_range": d["normal_range"] for c, d in details.items()})
    return ("outliers_detected", "medium", cols, desc, OUTLIER_IMPACT, OUTLIER_OPTIONS, flat)


def problem_type_issue():
    """Always present."""
    return ("problem_type_selection", "high", [], PROBLEM_TYPE_DESCRIPTION, PROBLEM_TYPE_IMPACT,
            PROBLEM_TYPE_OPTIONS, {})


def missing_columns(rows: list[dict]) -> list[str]:
    return [r["name"] for r in rows
            if R.MISSING_ISSUE_LOW < (r["null_percentage"] or 0) <= R.MISSING_ISSUE_HIGH
            and r["inferred_role"] != "identifier"]


def missing_issue(rows: list[dict]):
    """R10."""
    cols = missing_columns(rows)
    if not cols:
        return None
    pct = {r["name"]: r["null_percentage"] for r in rows if r["name"] in cols}
    return ("moderate_missing_values", "medium", cols,
            MISSING_DESCRIPTION.format(columns=cols), MISSING_IMPACT, MISSING_OPTIONS,
            {c: f"{v:.1f}" for c, v in pct.items()})


def identify_issues(spark: SparkSession, df: DataFrame, rows: list[dict],
                    order_by: str | None = None) -> DataFrame:
    """Outliers, problem type, missing values, as a small DataFrame."""
    issues = [outlier_issue(df, rows, order_by), problem_type_issue(), missing_issue(rows)]
    data = [(i, *iss) for i, iss in enumerate(x for x in issues if x is not None)]
    return spark.createDataFrame(data, ISSUE_SCHEMA)
