"""Registered queries against their DuckDB oracle on the smallest driver tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
FAST = ["a21_column_profile", "a21_column_profile_dirty", "a04_duplicates", "a10_value_counts",
        "r12_issue_table", "r15_validated_target", "c04_cleaning_chain", "c11_ffill_bfill",
        "c14_impute_dispatch", "c16_remove_outliers", "c20_process_dataset", "f05_anova_f",
        "f06_mutual_info_binary", "f11_transform_new", "m02_stratified_split", "m03_folds",
        "e01_e02_metrics", "e03_auc", "e05_confusion", "e06_report", "t01_head_preview",
        "t02_samples", "n01_n13_scalar", "s01_csv_roundtrip", "f10_fit_features_long",
        "m08_linear_closed_form", "m09_ridge_closed_form", "a15_outlier_detail",
        "r05_identifier_rule", "c15_cap_outliers", "a05_mean_std", "c15_cap_outliers_gaps",
        "c13_final_sweep_typed", "c08_impute_mode_typed", "a20_correlation", "a20_correlation_gaps",
        "a03_distinct_wide", "f05_anova_offset", "f06_mutual_info_gaps", "s01_csv_quoted",
        "e05_confusion_pairs", "e04_constant_label", "f10_fit_features", "p10_project_selected",
        "a22_readiness", "c19_report", "s03_read_report"]


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "∅"
    if isinstance(v, float):
        return f"{v:.9g}"   # a relative 1e-9
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", FAST)
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert canon(sdf.columns, [tuple(r) for r in sdf.collect()]) == canon(dcols, cur.fetchall())


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 11
