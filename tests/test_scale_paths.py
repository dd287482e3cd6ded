"""Paths that only large tables take, forced on small ones and held against brute force."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.operators import clean, duplicates, features, fill, impute, infer, metrics, quantiles, ranking, stats
from tessera.plans import workloads


@pytest.mark.parametrize("bits", [0, 2, 64])
def test_duplicates_with_clashing_digests(spark, bits):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2]), rng.choice([0.0, -0.0, 1.5, None]), rng.choice(["x", "", None]), [rng.randrange(2)])
            for _ in range(200)]
    df = spark.createDataFrame(rows, "a int, b double, c string, d array<int>").repartition(4)
    want = {(a, None if b is None else b + 0.0, c, tuple(d)) for a, b, c, d in rows}
    got = [(r.a, None if r.b is None else r.b + 0.0, r.c, tuple(r.d)) for r in duplicates.distinct_rows(df, bits).collect()]
    assert len(got) == len(want) and set(got) == want
    assert tuple(duplicates.duplicate_counts(df, bits).first()) == (200, 200 - len(want))


def test_duplicates_of_unlike_rows_with_equal_digests(spark):
    df = spark.range(50).selectExpr("id", "cast(id as string) s").union(spark.createDataFrame([(3, "3")], "id long, s string"))
    assert duplicates.distinct_rows(df, 1).count() == 50
    assert duplicates.distinct_rows(df.where("id < 0")).collect() == []
    assert tuple(duplicates.duplicate_counts(df.where("id < 0")).first()) == (0, 0)


def test_unique_rows_are_not_shuffled(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 100) t")
    plan = duplicates.distinct_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_fill_over_thousands_of_tiny_buckets(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ROWS_PER_BUCKET", 2)
    monkeypatch.setattr(fill, "SCAN_BUCKETS", 7)
    rng = random.Random(2)
    pdf = pd.DataFrame({"k": rng.sample(range(10 ** 6), 3000)})
    pdf["v"] = [float(rng.randrange(99)) if rng.random() < 0.02 else None for _ in range(3000)]
    pdf["w"] = [str(rng.randrange(99)) if 900 < i < 904 else None for i in range(3000)]
    df = spark.createDataFrame([(int(a), None if pd.isna(b) else b, c) for a, b, c in pdf.itertuples(index=False)],
                               "k long, v double, w string").repartition(5)
    got = {r.k: (r.v, r.w) for r in fill.ffill_bfill(df, ["v", "w"], "k").collect()}
    s = pdf.sort_values("k")
    filled = s.assign(v=s.v.ffill().bfill(), w=s.w.ffill().bfill())
    assert got == {int(a): (b, c) for a, b, c in filled.itertuples(index=False)}


def test_auc_over_many_buckets_and_groups(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "ROWS_PER_BUCKET", 2)
    monkeypatch.setattr(metrics, "BROADCAST_CARRY", 10)
    rng = np.random.default_rng(6)
    rows = [(int(g), float(s), int(y)) for g, s, y in zip(rng.integers(0, 40, 4000), rng.random(4000).round(3), rng.integers(0, 2, 4000))]
    got = {r.g: r.auc for r in metrics.roc_auc(spark.createDataFrame(rows, "g int, score double, label int"), ["g"]).collect()}
    for g in range(40):
        pos = [s for h, s, y in rows if h == g and y]
        neg = [s for h, s, y in rows if h == g and not y]
        want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
        assert got[g] == pytest.approx(want, abs=1e-12)


def test_count_below(spark):
    bounds = [1, 4, 4, 9]
    df = spark.createDataFrame([(x,) for x in range(12)], "x int").select(
        "x", quantiles.count_below(F.array(*map(F.lit, bounds)), F.col("x"), 3).alias("n"))
    assert all(r.n == sum(b < r.x for b in bounds) for r in df.collect())


def test_dense_codes_with_many_slices(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_SLICE", 3)
    monkeypatch.setattr(ranking, "BROADCAST_OFFSETS", 5)
    values = [f"v{i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", "only")], "g string, v string")
    got = {(r.g, r.v): r.code for r in ranking.dense_codes(df, "g", "v").collect()}
    assert got == {**{("g", v): i for i, v in enumerate(sorted(values))}, ("h", "only"): 0}


LONG = "x" * 70


def test_long_texts_are_counted_by_digest_and_shown_whole(spark):
    rows = [LONG + "b", LONG + "a", LONG + "a", LONG + "b", "short", None, "2024-01-02" + " " * 70, "1." + "5" * 80]
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    row = infer.profile_dataset(df).rows[0]
    assert row["unique_count"] == 5
    assert stats.column_stats(df).first()["top"] == LONG + "a"      # tie: the smaller text
    assert sorted(row["sample_values"]) == sorted({r for r in rows if r})
    assert impute.modes(df, ["t"]) == {"t": LONG + "a"}
    vc = stats.value_counts(df, ["t"], {"t": "string"}, digests=True).collect()
    assert {r.n for r in vc if r.v is None} == {71, 80, 82} and sum(r.cnt for r in vc) == 7
    assert [r.lx for r in vc if r.lx is not None] == [float("1." + "5" * 80)]
    assert [r.ld for r in vc if r.ld] == [True]


def test_no_text_in_an_exchange_of_the_counts(spark):
    df = spark.createDataFrame([("a" * 500,)], "t string")
    plan = stats.text_counts(df, ["t"])._jdf.queryExecution().executedPlan().toString()
    exchange = re.search(r"Exchange hashpartitioning\(([^)]*)\)", plan).group(1)
    assert not re.search(r"\bv#", exchange) and re.search(r"\bh#", exchange)


def test_head_preview(spark):
    df = spark.range(30).selectExpr("30 - id as k", "cast(id as string) s", "id / 2.0 as x").repartition(4)
    got = [tuple(r) for r in stats.head_preview(df, ["s", "x"], "k", 5).orderBy("r", "name").collect()]
    assert got == [c for i in range(5) for c in ((i + 1, "s", None, str(29 - i)), (i + 1, "x", (29 - i) / 2.0, None))]


@pytest.mark.parametrize("broadcast", [-1, 64 << 20])
def test_encoder_with_hot_values_joined_by_shuffle(spark, monkeypatch, broadcast):
    monkeypatch.setattr(features, "BROADCAST_MAX_BYTES", broadcast)
    rng = random.Random(11)
    values = [None if rng.random() < 0.6 else rng.choice(["hot", f"v{rng.randrange(5000):04d}", "nan"]) for _ in range(8000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k long, t string").repartition(4)
    enc = features.fit_label_encoders(df.where("k % 2 = 0"), ["t"])
    known = sorted({"nan" if v is None else v for v in values[::2]})
    code = {v: i for i, v in enumerate(known)}
    got = features.apply_label_encoders(df, enc, ["t"], features.encoder_sizes(enc))
    assert got.columns == ["k", "t"]
    assert {r.k: r.t for r in got.collect()} == {
        i: code.get("nan" if v is None else v, 0) for i, v in enumerate(values)}


def test_hot_values_are_few_and_dealt(spark, monkeypatch):
    df = spark.range(9000).selectExpr("id k", "if(id % 3 = 0, NULL, concat('v', id)) t").repartition(4)
    assert len(features.hot_values(df, "t")) == 1
    assert features.hot_values(df.where("k < 0"), "t") == []
    monkeypatch.setattr(features, "BROADCAST_MAX_BYTES", -1)
    enc = features.fit_label_encoders(df, ["t"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = features.apply_label_encoders(df, enc, ["t"], features.encoder_sizes(enc))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sum(sizes) == 9000 and max(sizes) < 1500  # one task would hold the 3000 NULLs


def test_sample_texts_by_digest_of_many_and_of_clashing_values(spark, monkeypatch):
    texts = [f"t{i}" for i in range(3000)]
    df = spark.createDataFrame([(t, "ab"[i % 2]) for i, t in enumerate(texts)], "t string, u string").repartition(4)
    rows = {r["name"]: r["sample_values"] for r in infer.profile_dataset(df).rows}
    assert rows["t"] == sorted(texts, key=lambda t: hashlib.md5(t.encode()).digest())[:10]
    assert rows["u"] == sorted("ab", key=lambda t: hashlib.md5(t.encode()).digest())
    monkeypatch.setattr(stats, "digest_expr", lambda v: F.unhex(F.lit("ff" * 16)))    # none lies below a bound
    assert infer.profile_dataset(df).rows[0]["sample_values"] == sorted(texts)[:10]


def test_short_texts_are_digested_once_a_value(spark):
    df = spark.range(8).selectExpr("cast(id % 2 as string) t")
    plan = stats.text_counts(df, ["t"])._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("Exchange hashpartitioning")[1].splitlines():
        assert "md5" not in line or re.search(r"CASE WHEN \(length\(v#\d+\) > 64\) THEN unhex\(md5", line)


def test_no_sort_of_the_counts_for_the_summary(spark):
    df = spark.range(50).selectExpr("id", "cast(id as string) t", "id / 7 x")
    kinds = stats.column_kinds(df)
    vc = stats.value_counts(df, ["id", "t", "x"], {n: k for n, k, _ in kinds}, True, True).withColumn("x", stats.numeric_expr(kinds))
    plans = []
    collect = type(vc).collect
    try:
        type(vc).collect = lambda d: (plans.append(d._jdf.queryExecution().executedPlan().toString()), collect(d))[1]
        stats.value_stats(vc, kinds, stats.ProfileOptions(), df)
    finally:
        type(vc).collect = collect
    assert "HashAggregate" in plans[0] and "SortAggregate" not in plans[0]


def test_quantiles_from_bounds_of_some_values(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SMALL", 50)
    monkeypatch.setattr(quantiles, "SKETCHED", 2)
    rng = np.random.default_rng(9)
    x = np.r_[rng.lognormal(0, 9, 4000), np.full(900, 3.5), -rng.random(100)]
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(4)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    assert quantiles.exact_quantiles(df, ["x"], probs)["x"] == pytest.approx(np.quantile(x, probs).tolist(), rel=1e-12)


def test_profiles_of_tables_in_their_order(spark):
    names = ["region", "dirty", "nation"]
    got = workloads.profiles_of(spark, SF_SMALL, names)
    assert [t for t, _ in got] == names
    assert [len(p.rows) for _, p in got] == [len(workloads.source(spark, SF_SMALL, t).columns) for t in names]


def test_quantiles_of_columns_without_rounds(spark, monkeypatch):
    """A sketch of all rows finds the ranges of the wanted ranks: no round of refinement, few values ranked."""
    def never(*_):
        raise AssertionError("refined")
    monkeypatch.setattr(quantiles, "SMALL", 100)
    monkeypatch.setattr(quantiles, "_refined", never)
    rng = np.random.default_rng(3)
    x, y = rng.lognormal(0, 9, 20_000), rng.integers(-3, 4, 20_000).astype(float)
    df = spark.createDataFrame([(float(a), float(b), int(b)) for a, b in zip(x, y)], "x double, y double, k int").repartition(4)
    probs = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    got = quantiles.exact_quantiles(df, ["x", "y"], probs)
    assert got["x"] == pytest.approx(np.quantile(x, probs).tolist(), rel=1e-12) and got["y"] == np.quantile(y, probs).tolist()
    rows = {r["name"]: r for r in infer.profile_dataset(df).rows}
    for c, v in (("x", x), ("y", y), ("k", y)):
        assert [rows[c]["q05"], rows[c]["q25"], rows[c]["q75"], rows[c]["q95"]] == pytest.approx(np.quantile(v, [0.05, 0.25, 0.75, 0.95]).tolist(), rel=1e-12)


def test_quantiles_where_the_sketch_misses(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SMALL", 50)
    monkeypatch.setattr(quantiles, "sketches", lambda x, probs: F.percentile_approx(x, [0.9] * 2 * len(probs), 100))
    x = np.random.default_rng(4).random(3000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    assert quantiles.exact_quantiles(df, ["x"], [0.25, 0.9])["x"] == pytest.approx(np.quantile(x, [0.25, 0.9]).tolist(), rel=1e-12)


def _plans(monkeypatch, run):
    plans = []
    from pyspark.sql.classic.dataframe import DataFrame as Frame
    collect = Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda d: (plans.append(d._jdf.queryExecution().executedPlan().toString()), collect(d))[1])
    return run(), plans


def test_modes_of_numbers_without_a_sort_of_the_counts(spark, monkeypatch):
    df = spark.createDataFrame([(i, i % 5 / 2, i % 3 == 0) for i in range(60)] + [(None, None, None)], "k long, x double, b boolean").repartition(3)
    got, plans = _plans(monkeypatch, lambda: impute.modes(df, ["k", "x", "b"]))
    assert got == {"k": 0, "x": 0.0, "b": 0.0} and not any("SortAggregate" in p for p in plans)


def test_times_are_counted_as_times(spark):
    """Turned into text once a value; a time by its wall clock, as its text shows it."""
    times = spark.sql("SELECT timestamp_seconds(1730610000 + 3600 * (id % 4)) t, date_add(date'2024-01-01', cast(id % 3 as int)) d FROM range(12)")
    plan = stats.text_counts(times, ["t", "d"])._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("Exchange hashpartitioning")[1:]:
        assert "as string" not in line.split("Union")[0]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")     # 01:00 is met twice in that night
    try:
        rows = {r["name"]: r for r in infer.profile_dataset(times).rows}
        texts = {r[0] for r in times.selectExpr("cast(t as string)").distinct().collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows["t"]["unique_count"] == len(texts) == 3 and rows["t"]["inferred_type"] == "datetime"
    assert rows["d"]["unique_count"] == 3 and rows["d"]["top"] == "2024-01-01"


def test_buckets_take_a_coarse_sketch(spark, monkeypatch):
    """The sketches of all tasks meet in one task, so they are no finer than even buckets ask for."""
    asked, sketch = [], F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, p, a: (asked.append(a), sketch(c, p, a))[1])
    _, n = quantiles.range_buckets(spark.range(1000), "id")
    assert n == 8 and asked == [2_000]


def test_distinct_numbers_are_exchanged_by_value_alone(spark, monkeypatch):
    df = spark.sql("SELECT id % 3 k, cast(NULL as int) e, id / 4.0 x, IF(id % 2 = 0, -0D, 0D) z, id % 5 = 0 b, cast(id % 4 as decimal(30,2)) d, "
                   "2 * id + 9007199254740992 w FROM range(20)")
    got, plans = _plans(monkeypatch, lambda: stats.distinct_stats(df, df.columns))
    assert {n: (r["unique_count"], r["nonnull"]) for n, r in got.items()} == {
        "k": (3, 20), "x": (20, 20), "z": (1, 20), "b": (2, 20), "d": (4, 20), "w": (20, 20)}
    assert got["b"]["cnt_mean"] == 10 and got["b"]["cnt_std"] == pytest.approx(72 ** 0.5) and got["z"]["cnt_std"] is None
    assert len(plans) == 1 and not re.search(r"hashpartitioning\(name", plans[0])


def test_distinct_numbers_of_many_columns(spark, monkeypatch):
    monkeypatch.setattr(stats, "COLUMNS_A_JOB", 2)
    df = spark.range(6).selectExpr("id", "id % 2 a", "id % 3 b", "id % 4 c", "cast(NULL as double) e")
    assert {n: r["unique_count"] for n, r in stats.distinct_stats(df, df.columns).items()} == {"id": 6, "a": 2, "b": 3, "c": 4}
    assert stats.distinct_stats(df, []) == {}


def test_times_by_value_and_count(spark, monkeypatch):
    rows = [("2024-01-02", "2024-01-02 00:00:00.5")] * 3 + [("2024-01-01", "2024-01-02 00:00:00")] * 3 + [("2025-07-09", None), (None, None)]
    df = spark.createDataFrame(rows, "d string, t string").selectExpr("cast(d as date) d", "cast(t as timestamp) t", "cast(NULL as date) e")
    got, plans = _plans(monkeypatch, lambda: stats.time_stats(df, df.columns))
    assert set(got) == {"d", "t"} and len(plans) == 1 and "SortAggregate" not in plans[0]
    assert [got["d"][k] for k in ("unique_count", "nonnull", "top", "date_share")] == [3, 7, "2024-01-01", 1.0]
    assert got["d"]["cnt_std"] == pytest.approx(np.std([3, 3, 1], ddof=1), rel=1e-12) and got["t"]["cnt_std"] == 0.0
    assert got["t"]["top"] == "2024-01-02 00:00:00"
    row = {r["name"]: r for r in infer.profile_dataset(df).rows}
    assert (row["e"]["inferred_type"], row["e"]["null_count"], row["t"]["inferred_type"]) == ("unknown", 8, "datetime")


def test_most_frequent_day_beyond_four_digit_years(spark):
    """The least text, not the earliest day."""
    df = spark.sql("SELECT explode(array(make_date(2024, 1, 1), make_date(12024, 1, 1), make_date(12025, 1, 1))) d")
    assert stats.time_stats(df, ["d"])["d"]["top"] == "+12024-01-01"


def test_digests_met_twice_are_counted_once(spark):
    df = spark.range(40).selectExpr("id % 30 as a").repartition(3)
    out = duplicates.distinct_rows(df)
    assert "InMemoryTableScan" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 30 and duplicates.duplicate_counts(df).collect()[0].asDict() == {"n": 40, "d": 10}


def test_cleaning_keeps_one_frame(spark, monkeypatch):
    df = spark.createDataFrame([(1, 1.0, None), (1, 1.0, None), (2, 2.0, None), (None, None, None), (None, None, None), (3, 3.0, None)],
                               "k int, x double, gone string")
    rows = infer.profile_dataset(df).rows
    kept, frame = [], type(df)
    persist = frame.persist
    monkeypatch.setattr(frame, "persist", lambda d, *a: (kept.append(d.columns), persist(d, *a))[1])
    out, log = clean.perform_automatic_cleaning(df, rows)
    assert sum(c == ["k", "x", "gone"] for c in kept) == 1 and ["k", "x"] not in kept
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1.0), (2, 2.0), (3, 3.0)]
    assert log == ["Removed 2 duplicate rows (33.3%)", "Automatically removed 1 columns with >70% missing values: ['gone']",
                   "Removed 1 rows with >80% missing data (25.0%)"]


def test_dirty_orders_from_one_scan(spark, tmp_path):
    spark.sql("""SELECT IF(id = 7, NULL, id * 10 - 100) o_orderkey, IF(id = 3, NULL, id) o_custkey, 'O' o_orderstatus, id * 1.5D o_totalprice,
                 timestamp'2024-01-01 00:00:00' o_orderdate, IF(id % 2 = 0, '1-URGENT', '5-LOW') o_orderpriority FROM range(60)""") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    got = workloads.dirty_orders(spark, str(tmp_path))
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    spark.read.parquet(str(tmp_path / "orders.parquet")).createOrReplaceTempView("orders_as_given")
    want = spark.sql(f"SELECT * FROM {workloads.dirty_sql('orders_as_given')}")
    assert got.dtypes == want.dtypes and got.count() == 72
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
