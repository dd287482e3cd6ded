"""Column profile: thresholds and edge cases on hand-made frames."""

import math

import pytest
from pyspark.sql import types as T

from tessera.operators.infer import profile_dataset


def prof(spark, rows, schema):
    return {r["name"]: r for r in profile_dataset(spark.createDataFrame(rows, schema)).rows}


def test_null_thresholds_and_types(spark):
    rows = [(i, None if i < 7 else float(i), None if i < 8 else "a") for i in range(10)]
    p = prof(spark, rows, "id long, x double, s string")
    assert p["x"]["null_count"] == 7 and p["x"]["null_percentage"] == pytest.approx(70.0)
    assert p["s"]["null_percentage"] == pytest.approx(80.0)
    assert p["x"]["inferred_type"] == "numeric"


def test_all_null_is_unknown(spark):
    p = prof(spark, [(1, None), (2, None)], "id long, s string")
    assert p["s"]["inferred_type"] == "unknown"
    assert p["s"]["unique_count"] == 0


def test_constant_column_skew_zero_and_normal(spark):
    p = prof(spark, [(i, 5.0) for i in range(10)], "id long, c double")
    assert p["c"]["skewness"] == 0.0
    assert p["c"]["distribution"] == "normal"
    assert p["c"]["has_outliers"] is False


def test_small_n_skew_is_null_and_skewed(spark):
    p = prof(spark, [(1, 1.0), (2, 3.0)], "id long, c double")
    assert p["c"]["distribution"] == "skewed"


def test_skewness_matches_bias_corrected_formula(spark):
    xs = [1.0, 2.0, 2.0, 3.0, 10.0, 4.0, 5.0]
    p = prof(spark, [(i, x) for i, x in enumerate(xs)], "id long, c double")
    n = len(xs)
    m = sum(xs) / n
    m2 = sum((x - m) ** 2 for x in xs) / n
    m3 = sum((x - m) ** 3 for x in xs) / n
    g1 = m3 / m2 ** 1.5
    G1 = g1 * math.sqrt(n * (n - 1)) / (n - 2)
    assert p["c"]["skewness"] == pytest.approx(G1, rel=1e-9)


def test_nan_counts_as_null(spark):
    p = prof(spark, [(1, float("nan")), (2, None), (3, 1.0)], "id long, c double")
    assert p["c"]["null_count"] == 2


def test_numeric_text_guard(spark):
    vals = ["5d", "1_000", " 7 ", "NaN", "inf", "", "3", "4.5", "1e3", "-2"]
    p = prof(spark, [(i, v) for i, v in enumerate(vals)], "id long, s string")
    # parses: ' 7 ', '3', '4.5', '1e3', '-2' -> 5 of 10
    assert p["s"]["parsed"] == 5
    assert p["s"]["inferred_type"] != "numeric"


def test_numeric_text_above_80_percent(spark):
    vals = [str(i) for i in range(9)] + ["x"]
    p = prof(spark, [(i, v) for i, v in enumerate(vals)], "id long, s string")
    assert p["s"]["inferred_type"] == "numeric"     # 90 % > 80 %


def test_binary_and_role(spark):
    vals = ["Yes", "no", "Y", "n"] * 3
    p = prof(spark, [(i, v) for i, v in enumerate(vals)], "id long, flag string")
    assert p["flag"]["inferred_type"] == "binary"
    assert p["flag"]["inferred_role"] == "target_candidate"


def test_identifier_by_ratio_and_name(spark):
    p = prof(spark, [(i, f"Person {i}") for i in range(20)], "id long, user_name string")
    assert p["user_name"]["inferred_type"] == "identifier"
    assert p["user_name"]["inferred_role"] == "identifier"


def test_identifier_needs_ratio_09(spark):
    vals = [f"v{i}" for i in range(9)] + ["v0"]          # ratio 0.9 exactly
    p = prof(spark, [(i, v) for i, v in enumerate(vals)], "id long, ref_code string")
    assert p["ref_code"]["inferred_type"] == "identifier"
    vals = [f"v{i}" for i in range(8)] + ["v0", "v1"]    # ratio 0.8
    p = prof(spark, [(i, v) for i, v in enumerate(vals)], "id long, ref_code string")
    assert p["ref_code"]["inferred_type"] != "identifier"


def test_text_vs_categorical(spark):
    long = ["word " * 10 + str(i) for i in range(10)]
    p = prof(spark, [(i, v) for i, v in enumerate(long)], "id long, body string")
    assert p["body"]["inferred_type"] == "text"


def test_mode_tie_smallest_and_balance(spark):
    vals = ["b", "a", "b", "a", "c"]
    p = prof(spark, [(i, v) for i, v in enumerate(vals)], "id long, cat string")
    assert p["cat"]["most_frequent"] == "a"
    assert p["cat"]["frequency_distribution"] == "balanced"   # std 0.577 < mean 1.67


def test_single_value_imbalanced(spark):
    p = prof(spark, [(i, "x") for i in range(4)], "id long, cat string")
    assert p["cat"]["frequency_distribution"] == "imbalanced"


def test_outlier_share_strictly_above_5_percent(spark):
    # 40 values 0..39 plus outliers: 2 of 42 = 4.8 % -> not flagged; 3 of 43 -> 7 % flagged
    base = [float(i) for i in range(40)]
    p = prof(spark, [(i, v) for i, v in enumerate(base + [1000.0, 2000.0])], "id long, x double")
    assert p["x"]["has_outliers"] is False
    p = prof(spark, [(i, v) for i, v in enumerate(base + [1000.0, 2000.0, 3000.0])],
             "id long, x double")
    assert p["x"]["has_outliers"] is True


def test_datetime_text(spark):
    vals = ["2024-01-0%d" % (i + 1) for i in range(6)] + ["x", "y"]
    p = prof(spark, [(i, v) for i, v in enumerate(vals)], "id long, created string")
    assert p["created"]["inferred_type"] == "datetime"
    assert p["created"]["inferred_role"] == "metadata"


def test_one_row_and_empty(spark):
    p = prof(spark, [(1, 2.0)], "id long, x double")
    assert p["x"]["unique_count"] == 1
    sch = T.StructType([T.StructField("x", T.DoubleType())])
    e = profile_dataset(spark.createDataFrame([], sch)).rows
    assert e[0]["inferred_type"] == "unknown"


def test_quantiles_by_refinement(spark, monkeypatch):
    """Small ranges and few parts a round force many rounds; ties and skew included."""
    import numpy as np
    from tessera.operators import quantiles
    monkeypatch.setattr(quantiles, "SMALL", 4)
    monkeypatch.setattr(quantiles, "PARTS", 3)
    rng = np.random.default_rng(5)
    a = np.round(rng.lognormal(0, 3, 800), 3)
    b = np.r_[np.zeros(500), rng.integers(-50, 50, 300)].astype(float)
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b)], "a double, b double, c double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.exact_quantiles(df, ["a", "b", "c"], probs)
    for name, x in (("a", a), ("b", b)):
        assert got[name] == [float(v) for v in np.quantile(x, probs)] or np.allclose(got[name], np.quantile(x, probs), rtol=1e-12)
    assert got.get("c") is None


def test_mode_and_counts_of_wide_integers(spark):
    from tessera.operators import impute, infer
    base = 2 ** 53
    rows = [(base + i % 7,) for i in range(70)] + [(base + 3,), (None,)]
    df = spark.createDataFrame(rows, "k long")
    assert impute.modes(df, ["k"]) == {"k": base + 3}
    assert infer.profile_dataset(df).rows[0]["unique_count"] == 7


def test_checkpoint_folder_is_required_on_a_cluster(spark):
    from types import SimpleNamespace
    import pytest
    from tessera import session
    sc = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn",
                         getConf=lambda: SimpleNamespace(get=lambda *a: None))
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError):
        session.checkpoint_dir(fake)
