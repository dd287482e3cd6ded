"""Decision policy (R13-R19): the deterministic seat of the remote chooser.

Choices are a plain ``dict[str, str]`` keyed like ``"<issue_type>_<i>"``;
anything not given falls back to the first offered option, the rule-based
target score, and the size-based algorithm choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R


def make_decisions(issues: DataFrame, choices: dict | None = None) -> dict:
    """One option per issue; a given choice must be one of the options."""
    choices = choices or {}
    out = {}
    for r in issues.orderBy("ord").collect():
        key = f"{r['issue_type']}_{r['ord']}"
        given = choices.get(key) or next(
            (v for k, v in choices.items() if r["issue_type"] in k), None)
        out[key] = given if given in r["options"] else r["options"][0]
    return out


def decisions_frame(issues: DataFrame, choices: dict | None = None) -> DataFrame:
    """R19 as a join: issue table left join the given choices, default first option."""
    spark = issues.sparkSession
    given = spark.createDataFrame(list((choices or {}).items()) or [("", "")],
                                  "key string, choice string")
    keyed = issues.withColumn("key", F.concat_ws("_", "issue_type", F.col("ord").cast("string")))
    j = keyed.join(F.broadcast(given), "key", "left")
    ok = F.array_contains(F.col("options"), F.col("choice"))
    return j.select("ord", "key", F.when(ok, F.col("choice"))
                    .otherwise(F.element_at("options", 1)).alias("decision"))


def validated_problem_type(decisions: dict) -> str:
    """The problem-type choice if classification/regression, else classification."""
    for k, v in decisions.items():
        if "problem_type_selection" in k:
            return v if v in ("classification", "regression") else "classification"
    return "classification"


def target_scores(profile: DataFrame) -> DataFrame:
    """R14 score per candidate column (roles other than identifier/metadata)."""
    name, t = F.col("name"), F.col("inferred_type")
    score = (F.when(R.name_has(name, R.TARGET_NAME_WORDS), 10).otherwise(0)
             + F.when(R.name_has(name, R.TARGET_DESCRIPTION_WORDS), 8).otherwise(0)
             + F.when(t == "binary", 5).otherwise(0)
             + F.when((t == "categorical") & (F.col("unique_count") == 2), 7).otherwise(0)
             - F.when(R.name_has(name, R.TARGET_ID_WORDS), 15).otherwise(0)
             - F.when(t == "identifier", 12).otherwise(0)
             - F.when(F.round(F.col("null_percentage"), 1) >= 100, 20).otherwise(0))
    return (profile.where(~F.col("inferred_role").isin("identifier", "metadata"))
            .select("ordinal", "name", score.alias("score")))


def choose_target(profile: DataFrame) -> DataFrame:
    """Best positive score (earliest column on ties), else first column."""
    s = target_scores(profile)
    agg = s.agg(
        F.min_by("name", F.struct((-F.col("score")).alias("a"), F.col("ordinal").alias("b")))
        .alias("best"),
        F.max("score").alias("top"),
        F.min_by("name", F.col("ordinal")).alias("first"))
    return agg.select(F.when(F.col("top") > 0, F.col("best")).otherwise(F.col("first"))
                      .alias("target"))


def validated_target(profile: DataFrame, problem_type: str, choice: str | None = None):
    """A given target must be an available column, else the rule-based one."""
    if problem_type not in ("classification", "regression"):
        return None
    avail = [r["name"] for r in profile.where(
        ~F.col("inferred_role").isin("identifier", "metadata")).orderBy("ordinal").collect()]
    if not avail:
        return None
    if choice is not None:
        return choice if choice in avail else avail[0]
    rows = choose_target(profile).collect()
    return rows[0]["target"] if rows else avail[0]


def problem_type_at_load(df: DataFrame, dataset_name: str = "", target: str | None = None) -> str:
    """From the file name, else from the last (target) column."""
    target = target or df.columns[-1]
    n = df.select(F.count_distinct(F.col(f"`{target}`"))).collect()[0][0]
    name = dataset_name.lower()
    if "classification" in name:
        return "binary_classification" if n == 2 else "classification"
    if "regression" in name:
        return "regression"
    if n == 2:
        return "binary_classification"
    is_text = dict(df.dtypes)[target] == "string"
    return "classification" if (n <= 20 and is_text) else "regression"


def choose_algorithm(problem_type: str, n_rows: int, n_features: int,
                     wide_features: int | None = 50) -> str:
    """R18 (default, threshold 50 features) or R17 (``wide_features=None``: rows/10)."""
    cls = problem_type in ("classification", "binary_classification")
    if n_rows < 1000:
        return "logistic_regression" if cls else "ridge_regression"
    wide = n_features > (wide_features if wide_features is not None else n_rows / 10)
    return "random_forest" if wide else "gradient_boosting"


def algorithm_frame(stats: DataFrame, wide_features: int | None = 50) -> DataFrame:
    """R17/R18 over a frame with columns problem_type, n_rows, n_features."""
    cls = F.col("problem_type").isin("classification", "binary_classification")
    limit = F.lit(wide_features) if wide_features is not None else F.col("n_rows") / 10
    return stats.select("*", F.when(F.col("n_rows") < 1000, F.when(cls, "logistic_regression")
                                    .otherwise("ridge_regression"))
                        .when(F.col("n_features") > limit, "random_forest")
                        .otherwise("gradient_boosting").alias("algorithm"))
