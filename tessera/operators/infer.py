"""Semantic type, role and characteristics.

Every rule is a column expression over the per-column statistics frame of
``stats.column_stats``; nothing here touches the data table again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .duplicates import duplicate_counts
from .stats import NUMERIC, STRING, ProfileOptions, column_stats


def _c(name):
    return F.col(name)


def unique_ratio():
    return F.try_divide(_c("unique_count").cast("double"), _c("nonnull"))


def corrected_skew():
    """Bias-corrected sample skewness from Spark's population form; NULL for n < 3,
    0 for a constant column."""
    n = _c("parsed").cast("double")
    g1 = _c("skew_pop") * F.sqrt(n * (n - 1)) / (n - 2)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.coalesce(_c("std"), F.lit(0.0)) == 0, F.lit(0.0))
            .otherwise(g1))


def inferred_type():
    """Unknown -> datetime -> numeric -> binary -> identifier -> text/categorical."""
    numeric = (_c("kind") == NUMERIC) | (
        (_c("kind") == STRING) &
        (F.try_divide(_c("parsed").cast("double"), _c("nonnull")) > R.NUMERIC_PARSE_SHARE))
    id_name = R.name_has(_c("name"), R.IDENTIFIER_KEYWORDS)
    identifier = (unique_ratio() >= R.IDENTIFIER_UNIQUE_RATIO) & (
        id_name | F.coalesce(_c("id_sample"), F.lit(False)))
    text = ((_c("kind") == STRING) & (unique_ratio() > R.TEXT_UNIQUE_RATIO)
            & (_c("avg_length") > R.TEXT_MEAN_LENGTH))
    return (F.when(_c("nonnull") == 0, "unknown")
            .when(F.coalesce(_c("date_share"), F.lit(0.0)) >= R.DATETIME_SHARE, "datetime")
            .when(numeric, "numeric")
            .when(F.coalesce(_c("binary_values"), F.lit(False)), "binary")
            .when(identifier, "identifier")
            .when(text, "text")
            .otherwise("categorical"))


def inferred_role():
    """Identifier -> target words -> metadata words -> small categorical -> feature."""
    t = _c("inferred_type")
    return (F.when(t == "identifier", "identifier")
            .when(R.name_has(_c("name"), R.TARGET_KEYWORDS), "target_candidate")
            .when(R.name_has(_c("name"), R.METADATA_KEYWORDS), "metadata")
            .when((t == "binary") | ((t == "categorical") &
                                     (_c("unique_count") <= R.ROLE_MAX_CATEGORIES)),
                  "target_candidate")
            .otherwise("feature"))


def characteristics(df: DataFrame) -> DataFrame:
    """A05-A07, A09, A11-A13 as flat columns (NULL where the type has none)."""
    t = _c("inferred_type")
    is_num = (t == "numeric") & (_c("parsed") > 0)
    skew = corrected_skew()
    outliers = _c("outlier_low") + _c("outlier_high")
    return df.select(
        "*",
        F.when(_c("unique_count") < R.CARDINALITY_LOW, "low")
         .when(_c("unique_count") < R.CARDINALITY_MEDIUM, "medium")
         .otherwise("high").alias("cardinality"),
        F.when(is_num, _c("mean")).alias("mean_value"),
        F.when(is_num, _c("std")).alias("std_value"),
        F.when(is_num, F.when(_c("std") > 0, skew).otherwise(F.lit(0.0))).alias("skewness"),
        F.when(is_num, F.coalesce(outliers > _c("parsed") * R.OUTLIER_SHARE, F.lit(False)))
         .alias("has_outliers"),
        F.when(is_num, outliers).alias("outlier_count"),
        F.when(is_num, F.when(F.abs(skew) < 1, "normal").otherwise("skewed")).alias("distribution"),
        F.when((t == "categorical") & (_c("unique_count") > 0), _c("top")).alias("most_frequent"),
        F.when(t == "categorical",
               F.when(_c("cnt_std") < _c("cnt_mean"), "balanced").otherwise("imbalanced"))
         .alias("frequency_distribution"),
    )


def profile_columns(stats: DataFrame) -> DataFrame:
    """A21 column part: statistics + type + role + characteristics."""
    typed = stats.withColumn("unique_ratio", unique_ratio()) \
                 .withColumn("null_percentage",
                             F.try_divide(_c("null_count") * 100.0, _c("n_rows"))) \
                 .withColumn("inferred_type", inferred_type())
    roled = typed.withColumn("inferred_role", inferred_role())
    return characteristics(roled)


def problem_types(profile: DataFrame) -> DataFrame:
    """One row, array of candidates in fixed order."""
    t, role = _c("inferred_type"), _c("inferred_role")
    cand = role == "target_candidate"
    agg = profile.agg(
        F.coalesce(F.bool_or(cand & (t.isin("binary", "categorical") |
                                     (_c("unique_count") <= 10))), F.lit(False)).alias("cls"),
        F.coalesce(F.bool_or(cand & (t == "numeric") & (_c("unique_count") > 10)),
                   F.lit(False)).alias("reg"),
        F.coalesce(F.bool_or(t == "datetime"), F.lit(False)).alias("ts"),
    )
    arr = F.filter(F.array(F.when(_c("cls"), "classification"),
                           F.when(_c("reg"), "regression"),
                           F.when(_c("ts"), "time_series")), lambda x: x.isNotNull())
    return agg.select(F.when(F.size(arr) == 0, F.array(F.lit("clustering")))
                      .otherwise(arr).alias("problem_types"))


def complexity(profile: DataFrame) -> DataFrame:
    """Size class, feature count/class, mixed types, high-cardinality count,
    missing complexity; one row."""
    agg = profile.agg(
        F.max("n_rows").alias("n_rows"),
        F.count_if(_c("inferred_role") == "feature").alias("feature_count"),
        F.count_distinct("inferred_type").alias("n_types"),
        F.count_if(_c("cardinality") == "high").alias("high_cardinality_features"),
        F.avg("null_percentage").alias("mean_null_pct"),
    )
    n, fc = _c("n_rows"), _c("feature_count")
    return agg.select(
        F.when(n < 10_000, "small").when(n < 100_000, "medium")
         .when(n < 1_000_000, "large").otherwise("very_large").alias("size_category"),
        fc.cast("bigint").alias("feature_count"),
        F.when(fc <= 20, "low").when(fc <= 200, "medium").when(fc <= 1000, "high")
         .otherwise("very_high").alias("feature_complexity"),
        (_c("n_types") > 3).alias("mixed_types"),
        _c("high_cardinality_features").cast("bigint").alias("high_cardinality_features"),
        F.when(_c("mean_null_pct") > 20, "high").otherwise("low").alias("missing_data_complexity"),
    )


def duplicate_stats(df: DataFrame) -> DataFrame:
    """Duplicate rows (NULLs equal) as count and percentage; digests are shuffled, and repeated rows."""
    agg = duplicate_counts(df)
    return agg.select(F.coalesce(_c("d"), F.lit(0)).cast("bigint").alias("duplicate_count"),
                      F.coalesce(F.try_divide(_c("d") * 100.0, _c("n")), F.lit(0.0))
                      .alias("duplicate_percentage"))


class DatasetProfile:
    """The column table (small, cached) plus dataset-level facts."""

    def __init__(self, df: DataFrame, opts: ProfileOptions | None = None):
        self.source = df
        self.columns = profile_columns(column_stats(df, opts)).cache()
        self._rows = None
        self._dup = None

    @property
    def rows(self) -> list:
        if self._rows is None:
            self._rows = [r.asDict() for r in self.columns.orderBy("ordinal").collect()]
        return self._rows

    def by_name(self) -> dict:
        return {r["name"]: r for r in self.rows}

    @property
    def n_rows(self) -> int:
        return self.rows[0]["n_rows"] if self.rows else 0

    @property
    def duplicates(self) -> dict:
        if self._dup is None:
            self._dup = duplicate_stats(self.source).collect()[0].asDict()
        return self._dup

    def target_candidates(self) -> list[str]:
        return [r["name"] for r in self.rows if r["inferred_role"] == "target_candidate"]

    def problem_types(self) -> list[str]:
        return problem_types(self.columns).collect()[0]["problem_types"]

    def complexity(self) -> dict:
        return complexity(self.columns).collect()[0].asDict()


def profile_dataset(df: DataFrame, opts: ProfileOptions | None = None) -> DatasetProfile:
    return DatasetProfile(df, opts)


PROFILE_OUTPUT = ["name", "dtype", "unique_count", "null_count", "null_percentage",
                  "inferred_type", "inferred_role", "cardinality", "mean_value", "std_value",
                  "skewness", "has_outliers", "distribution", "most_frequent",
                  "frequency_distribution"]
