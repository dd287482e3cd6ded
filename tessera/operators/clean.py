"""Automatic cleaning (C01-C04) and the column/row projections it uses."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .duplicates import distinct_rows


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedup (NULLs compare equal); only rows whose digest is met twice are shuffled."""
    return distinct_rows(df)


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Names that are absent are ignored."""
    present = [n for n in names if n in df.columns]
    return df.drop(*present) if present else df


def high_missing_columns(profile_rows: list[dict],
                         threshold: float = R.DROP_COLUMN_NULL_PCT) -> list[str]:
    """C02 selection: null % above the threshold and not an identifier."""
    return [r["name"] for r in profile_rows
            if (r["null_percentage"] or 0) > threshold and r["inferred_role"] != "identifier"]


def row_null_share(columns: list[str]):
    """Share of NULL cells in a row, one expression (no shuffle)."""
    if not columns:
        return F.lit(0.0)
    flags = [F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0) for c in columns]
    return reduce(lambda a, b: a + b, flags) / F.lit(float(len(columns)))


def is_dense(columns: list[str], threshold: float = R.DROP_ROW_NULL_SHARE):
    """Whether the share of NULL cells of a row is at most the threshold."""
    return row_null_share(columns) <= threshold


def drop_sparse_rows(df: DataFrame, threshold: float = R.DROP_ROW_NULL_SHARE) -> DataFrame:
    """Keep rows whose NULL share is at most the threshold."""
    return df.where(is_dense(df.columns, threshold))


# FIXED VALUES: sentences of the action log, for a step that took something away and for one that did not.
LOG = {
    "duplicates": ("Removed {n} duplicate rows ({pct:.1f}%)", "No duplicate rows found"),
    "columns": ("Automatically removed {n} columns with >70% missing values: {what}",
                "No columns with >70% missing values found"),
    "sparse": ("Removed {n} rows with >80% missing data ({pct:.1f}%)", "No rows with >80% missing data found"),
}


def perform_automatic_cleaning(df: DataFrame, profile_rows: list[dict],
                               n_rows: int | None = None) -> tuple[DataFrame, list[str]]:
    """The steps of LOG in turn over the frame, with their log.

    Columns go by the profile taken before. The rows left by the first step are
    persisted; one pass over them counts those left by either row step.
    """
    gone = high_missing_columns(profile_rows)
    rows = df.count() if n_rows is None else n_rows
    unique = drop_duplicate_rows(df).persist(StorageLevel.MEMORY_AND_DISK)
    kept = drop_columns(unique, gone)
    left = unique.agg(F.count(F.lit(1)).alias("unique"), F.count_if(is_dense(kept.columns)).alias("dense")).collect()[0]

    def said(name, n, of):
        return LOG[name][n <= 0].format(n=n, pct=n * 100.0 / max(of, 1), what=gone)
    log = [said("duplicates", rows - left["unique"], rows), said("columns", len(gone), 1),
           said("sparse", left["unique"] - left["dense"], left["unique"])]
    return drop_sparse_rows(kept), log
