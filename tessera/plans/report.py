"""Analysis report (C19) and readiness score (A22) as column expressions.

Both are one-row frames over the column profile; nothing but literals (counts
already known, the chosen strategies, the log lines) enters from the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators.infer import DatasetProfile, complexity

# Readiness points (fixed values): start, cost per percent with its cap, points by condition.
READINESS_START = 100.0
READINESS_RATES = {"missing_pct": (2.0, None), "duplicate_pct": (0.5, 10.0)}
READINESS_POINTS = {
    "mean_null_pct > 20": -5.0,
    "n_high_cardinality > 3": -5.0,
    "n_target_candidates > 0": 5.0,
    "n_features > 5": 5.0,
}

# Report texts (fixed values).
ENGINE_TEXT = "Spark preprocessing pipeline"
FEATURE_ENGINEERING_TEXT = "Automatic type conversion"


def readiness(prof: DatasetProfile, missing_pct: float, duplicate_pct: float) -> DataFrame:
    """(n_columns, readiness_score)."""
    facts = prof.columns.agg(
        F.count(F.lit(1)).alias("n_columns"), F.avg("null_percentage").alias("mean_null_pct"),
        F.count_if(F.col("cardinality") == "high").alias("n_high_cardinality"),
        F.count_if(F.col("inferred_role") == "target_candidate").alias("n_target_candidates"),
        F.count_if(F.col("inferred_role") == "feature").alias("n_features"),
    ).withColumns({"missing_pct": F.lit(float(missing_pct)), "duplicate_pct": F.lit(float(duplicate_pct))})
    score = F.lit(READINESS_START)
    for fact, (rate, cap) in READINESS_RATES.items():
        cost = F.col(fact) * rate
        score = score - (cost if cap is None else F.least(cost, F.lit(cap)))
    for condition, points in READINESS_POINTS.items():
        score = score + F.when(F.expr(condition), points).otherwise(0.0)
    return facts.select("n_columns", F.greatest(score, F.lit(0.0)).alias("readiness_score"))


def _texts(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _type_shares(prof: DatasetProfile) -> DataFrame:
    """One row: maps from inferred type to its number and percentage of columns."""
    n = F.count(F.lit(1))
    by_type = prof.columns.groupBy("inferred_type").agg(n.alias("n"))
    pairs = F.collect_list(F.struct("inferred_type", "n"))
    total = F.sum("n")
    shares = F.transform(pairs, lambda p: F.struct(
        p["inferred_type"].alias("inferred_type"), (p["n"] * 100.0).alias("n")))
    return by_type.agg(pairs.alias("p"), total.alias("total"), shares.alias("s")).select(
        F.map_from_entries("p").alias("type_counts"),
        F.transform_values(F.map_from_entries("s"), lambda _, v: F.round(v / F.col("total"), 1))
        .alias("type_percentages"))


def analysis_report(res) -> DataFrame:
    """One row with a struct for each section of the report."""
    from .preprocess import missing_cells
    prof, before = res.profile, res.original_missing
    final = missing_cells(res.training).withColumnsRenamed(
        {"n_rows": "final_rows", "n_cols": "final_cols"}).drop("missing_cells")
    size = complexity(prof.columns).select("size_category", "feature_complexity")
    outliers = prof.columns.agg(F.sort_array(F.collect_list(
        F.when(F.col("has_outliers"), F.col("name")))).alias("outlier_columns"))
    one = F.lit(1).alias("__one")
    # four one-row frames side by side
    row = final.select("*", one)
    for part in (size, outliers, _type_shares(prof)):
        row = row.join(part.select("*", one), "__one")
    original = F.lit(float(before["completeness"] or 0.0))
    choices = [e for k, v in res.decisions.items() for e in (F.lit(k), R.title_case(F.lit(v)))]
    return row.select(
        F.struct(
            F.lit(before["n_rows"]).cast("bigint").alias("rows"), F.lit(before["n_cols"]).cast("bigint").alias("columns"),
            F.array(F.col("final_rows"), F.col("final_cols").cast("bigint")).alias("processed_shape"),
            F.lit(res.problem_type).alias("problem_type"), F.lit(res.target).cast("string").alias("target_column"),
            F.struct(F.round(original, 1).alias("original"), F.round("completeness", 1).alias("final"),
                     F.round(F.col("completeness") - original, 1).alias("improvement")).alias("data_completeness"),
            F.lit(True).alias("processing_success")).alias("summary"),
        F.struct("type_counts", "type_percentages").alias("composition"),
        F.struct(F.lit(prof.duplicates["duplicate_count"]).cast("bigint").alias("duplicate_count"),
                 F.round(F.lit(float(prof.duplicates["duplicate_percentage"])), 1).alias("duplicate_percentage"),
                 "outlier_columns").alias("quality_assessment"),
        _texts(res.cleaning_actions).alias("cleaning_actions"),
        _texts(res.processing_steps).alias("processing_steps"),
        F.struct(F.lit(res.problem_type).alias("problem_type"), "size_category", "feature_complexity")
        .alias("algorithm_rationale"),
        F.struct(F.lit(ENGINE_TEXT).alias("engine"),
                 (F.create_map(*choices) if choices else F.create_map().cast("map<string,string>")).alias("choices"),
                 F.lit(FEATURE_ENGINEERING_TEXT).alias("feature_engineering")).alias("technical_specs"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("generated_at"))


def report_facts(report: DataFrame) -> DataFrame:
    """The numbers of a report as (section, item, value) rows."""
    def fixed(section, item, value):
        return F.struct(F.lit(section).alias("section"), F.lit(item).alias("item"), value.cast("double").alias("value"))

    def entries(section, column):
        return F.transform(F.map_entries(column), lambda e: F.struct(
            F.lit(section).alias("section"), e["key"].alias("item"), e["value"].cast("double").alias("value")))

    s, q = F.col("summary"), F.col("quality_assessment")
    rows = F.concat(F.array(
        fixed("summary", "rows", s["rows"]), fixed("summary", "columns", s["columns"]),
        fixed("summary", "processed_rows", s["processed_shape"][0]),
        fixed("summary", "processed_columns", s["processed_shape"][1]),
        fixed("completeness", "original", s["data_completeness"]["original"]),
        fixed("completeness", "final", s["data_completeness"]["final"]),
        fixed("completeness", "improvement", s["data_completeness"]["improvement"]),
        fixed("quality", "duplicate_count", q["duplicate_count"]),
        fixed("quality", "duplicate_percentage", q["duplicate_percentage"]),
        fixed("quality", "outlier_columns", F.size(q["outlier_columns"]))),
        entries("type_counts", F.col("composition.type_counts")),
        entries("type_percentages", F.col("composition.type_percentages")))
    return report.select(F.inline(rows))


