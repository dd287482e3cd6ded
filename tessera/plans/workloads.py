"""Registered workloads over the driver tables: (spark, sf_dir) -> DataFrame.

Each function reads whole driver tables (or frames Spark derives from them)
and runs one library operator; ``__spark_entry__`` registers them by id.
"""

from __future__ import annotations

import os
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.output import round_doubles
from ..operators import clean, features, impute, infer, metrics, outliers, policy, quality, split
from ..operators.fill import ffill_bfill
from ..operators.quantiles import exact_quantiles
from ..operators.stats import head_preview, iqr_bounds, smallest_k_per_group, value_counts
from ..session import checkpoint_dir, table_path
from ..sources import io
from . import preprocess, report


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# FIXTURES section 3: the dirty orders view (same SQL text runs in DuckDB).
DIRTY_SQL_BODY = """
SELECT o_orderkey,
 CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS cust_num,
 CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 10 < 8 THEN NULL ELSE o_totalprice END AS sparse_num,
 CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN o_totalprice * 20 ELSE o_totalprice END AS total_price,
 CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status,
 CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 3 = 0 THEN NULL WHEN o_orderpriority < '3' THEN 'Yes' ELSE 'no' END AS urgent,
 CASE WHEN o_orderkey % 101 = 0 OR o_orderkey % 4 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
 CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(o_custkey % 40 AS STRING) END AS num_text
FROM {orders}"""


def dirty_sql(orders: str = "orders") -> str:
    body = DIRTY_SQL_BODY.format(orders=orders)
    return f"(SELECT * FROM ({body}) UNION ALL SELECT * FROM ({body}) WHERE o_orderkey % 50 = 0)"


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nulls, outliers, text numbers and duplicate rows injected."""
    view = f"tessera_orders_{uuid.uuid5(uuid.NAMESPACE_URL, sf_dir).hex[:12]}"
    load(spark, sf_dir, "orders").createOrReplaceTempView(view)
    # the rows of ``dirty_sql`` from one scan: a repeated row is given out twice where it is read
    twice = f"(SELECT o.* FROM {view} o LATERAL VIEW explode(IF(o_orderkey % 50 = 0, array(0, 1), array(0))) r AS again)"
    return spark.sql(DIRTY_SQL_BODY.format(orders=twice))


def prediction_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIXTURES section 4: deterministic binary predictions (label, prediction, score)."""
    lab, doc = load(spark, sf_dir, "labels"), load(spark, sf_dir, "documents")
    j = lab.join(doc.select("doc_id", "n_chars"), "doc_id")
    return j.select("doc_id", F.col("quality").alias("label"),
                    F.when(F.col("n_chars") % 5 == 0, 1 - F.col("quality"))
                    .otherwise(F.col("quality")).alias("prediction"),
                    ((F.col("n_chars") % 97) / 97.0).alias("score"))


def multiclass_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders priority code as label; every 6th key moved to the next code."""
    o = load(spark, sf_dir, "orders")
    code = F.substring("o_orderpriority", 1, 1).cast("int")
    return o.select("o_orderkey", code.alias("label"),
                    F.when(F.col("o_orderkey") % 6 == 0, F.pmod(code, 5) + 1)
                    .otherwise(code).alias("prediction"))


def regression_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = load(spark, sf_dir, "part")
    return p.select("p_partkey", F.col("p_retailprice").alias("label"),
                    (F.col("p_retailprice") + F.col("p_size") - 25).alias("prediction"))


# ---- sources and their profiles -------------------------------------------------

def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    if table == "dirty":
        return dirty_orders(spark, sf_dir)
    if table == "dirty_clean":
        return cleaned_dirty(spark, sf_dir)[0]
    df = load(spark, sf_dir, table)
    return df.drop("embedding") if table == "embeddings" else df


def profile_of(spark: SparkSession, sf_dir: str, table: str) -> infer.DatasetProfile:
    return infer.profile_dataset(source(spark, sf_dir, table))


#: Tables profiled at a time: the many short jobs of small tables run beside the long ones of large tables.
PROFILES_AT_ONCE = 4


def profiles_of(spark: SparkSession, sf_dir: str, tables: list[str]):
    """(table, profile) in the order of ``tables``."""
    with ThreadPoolExecutor(PROFILES_AT_ONCE) as pool:
        return list(zip(tables, pool.map(lambda t: profile_of(spark, sf_dir, t), tables)))


def cleaned_dirty(spark: SparkSession, sf_dir: str):
    p = profile_of(spark, sf_dir, "dirty")
    return clean.perform_automatic_cleaning(p.source, p.rows, p.n_rows)


# ---- S: sources and sinks ------------------------------------------------------

def s01_scan_normalize(spark, sf_dir):
    return round_doubles(io.normalize_na(dirty_orders(spark, sf_dir)))


def _scratch(spark) -> str:
    return os.path.join(checkpoint_dir(spark), "sinks", uuid.uuid4().hex)


def s04_training_sink(spark, sf_dir):
    df = load(spark, sf_dir, "customer")
    path = _scratch(spark)
    io.write_training_set(df, "c_mktsegment", path)
    return spark.read.parquet(path)


def s06_correlation_sink(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    path = _scratch(spark)
    io.write_json(features.correlation_long(li, cols), path)
    return round_doubles(spark.read.schema("a string, b string, corr double").json(path), 4)


def _report(spark, sf_dir):
    res = preprocess.process_dataset(dirty_orders(spark, sf_dir), order_by="o_orderkey")
    return report.analysis_report(res)


def s05_analysis_report_sink(spark, sf_dir):
    """S05, read back with the report's own schema: its numbers survive the JSON."""
    path, rep = _scratch(spark), _report(spark, sf_dir)
    io.write_json(rep, path)
    return round_doubles(report.report_facts(spark.read.schema(rep.schema).json(path)))


def s03_read_report(spark, sf_dir):
    path = _scratch(spark)
    _report(spark, sf_dir).select(F.to_json(F.struct("*"), {"pretty": "true"})).coalesce(1).write.text(path)
    return round_doubles(io.read_report(spark, path).select(
        "summary.rows", "summary.columns", "summary.problem_type", "quality_assessment.duplicate_count",
        F.col("summary.data_completeness.original").alias("completeness")))


def s01_csv_roundtrip(spark, sf_dir):
    """S01 on CSV: written with a header, read back as text, NA tokens -> NULL,
    then each column typed (long / double / text) by what all its values parse as."""
    path = _scratch(spark)
    dirty_orders(spark, sf_dir).write.option("header", True).csv(path)
    return round_doubles(io.read_table(spark, path, fmt="csv"))


def s02_ingest(spark, sf_dir):
    return round_doubles(io.ingest(spark, load(spark, sf_dir, "customer")))


def s07_model_save(spark, sf_dir):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from ..operators import models
    df = _labels_frame(spark, sf_dir)
    res = models.train_selected_model(df, ["n_chars", "toxic"], "quality", "doc_id",
                                      "random_forest", "binary_classification", n_trials=0)
    path = models.save_model(res.model, _scratch(spark))
    loaded = PipelineModel.load(path)
    va = VectorAssembler(inputCols=["n_chars", "toxic"], outputCol="features")
    return loaded.transform(va.transform(df)).select("doc_id", "prediction")


def s07_bundle_scoring(spark, sf_dir):
    """Model, processor and metadata saved as one bundle, loaded and applied to the raw table."""
    from ..operators import models
    part = load(spark, sf_dir, "part")
    fp = features.FeatureProcessor("regression")
    x = fp.fit_transform(part.drop("p_partkey"), "p_retailprice")
    fitted = models.build_estimator("ridge_regression", "regression", {}, part.count()).fit(
        models.assemble(x, fp.selected, "p_retailprice"))
    own = models.Bundle("ridge_regression", "regression", "p_retailprice", fp, fitted)
    loaded = models.Bundle.load(spark, own.save(_scratch(spark)))
    before = own.score(part, ["p_partkey"]).withColumnRenamed("prediction", "before")
    after = loaded.score(part, ["p_partkey"])
    return after.join(before, "p_partkey").select(
        "p_partkey", (F.col("prediction") == F.col("before")).alias("agrees"),
        F.lit(loaded.target).alias("target"), F.lit(loaded.algorithm).alias("algorithm"))


def s07_processor_roundtrip(spark, sf_dir):
    """A fitted feature processor saved, loaded and applied to the whole table."""
    part = load(spark, sf_dir, "part")
    fp = features.FeatureProcessor("regression")
    fp.fit_transform(part.where(F.col("p_size") <= 25), "p_retailprice")
    loaded = features.FeatureProcessor.load(spark, fp.save(_scratch(spark)))
    return round_doubles(loaded.transform(part))


def _full_evaluation(spark, sf_dir):
    return metrics.full_evaluation(prediction_table(spark, sf_dir), "binary_classification", "doc_id",
                                   "rule", ["n_chars", "quality"], [("quality", 0.25), ("n_chars", 0.75)])


def e08_full_evaluation(spark, sf_dir):
    """The report's arrays, read back from its JSON, as (section, item, value) rows."""
    path, rep = _scratch(spark), _full_evaluation(spark, sf_dir)
    io.write_json(rep, path)
    r = spark.read.schema(rep.schema).json(path)

    def rows(section, column, item, value):
        return F.transform(column, lambda x: F.struct(F.lit(section).alias("section"), item(x).alias("item"),
                                                      value(x).cast("double").alias("value")))
    parts = [rows(m, "classification_report", lambda x: x["class_name"], lambda x, m=m: x[m])
             for m in ("precision", "recall", "f1_score", "support")]
    parts.append(rows("confusion", "confusion_matrix",
                      lambda x: F.concat_ws("-", x["label"], x["prediction"]), lambda x: x["n"]))
    parts.append(rows("importance", "feature_importance", lambda x: x["feature"], lambda x: x["importance"]))
    return round_doubles(r.select(F.inline(F.concat(*parts))))


def s08_deployment_info(spark, sf_dir):
    from ..operators import models
    path = _scratch(spark)
    info = models.deployment_info(_full_evaluation(spark, sf_dir), {
        "model_path": "model", "feature_processor_path": "processor", "evaluation_report_path": "report"})
    io.write_json(info, path)
    return round_doubles(spark.read.schema(info.schema).json(path).select(
        "model_name", "problem_type", F.array_join("feature_names", ",").alias("feature_names"), "model_path",
        "performance_metrics.accuracy", "performance_metrics.f1_score"))


def s08_evaluation_sink(spark, sf_dir):
    path = _scratch(spark)
    io.write_json(e08_evaluation(spark, sf_dir), path)
    return round_doubles(spark.read.json(path).select(
        "accuracy", "precision", "recall", "f1", "test_samples", "problem_type",
        "predictions_sample"))


def s09_metadata_sink(spark, sf_dir):
    from ..operators import models
    c = load(spark, sf_dir, "customer")
    ptype = policy.problem_type_at_load(c, "customer", "c_mktsegment")
    feats = [x for x in c.columns if x != "c_mktsegment"]
    algo = policy.choose_algorithm(ptype, c.count(), len(feats))
    path = _scratch(spark)
    spark.createDataFrame([(models.model_metadata(algo, ptype, feats, "c_mktsegment"),)],
                          "value string").coalesce(1).write.text(path)
    return spark.read.json(path)


# ---- P: projections and filters ------------------------------------------------

def p01_drop_columns(spark, sf_dir):
    return round_doubles(clean.drop_columns(dirty_orders(spark, sf_dir),
                                            ["sparse_num", "no_such_column"]))


def p02_without_identifiers(spark, sf_dir):
    p = profile_of(spark, sf_dir, "customer")
    ids = [r["name"] for r in p.rows if r["inferred_type"] == "identifier"]
    return round_doubles(clean.drop_columns(p.source, ids))


def p03_features_target(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    x, y = part.columns[:-1], part.columns[-1]
    return round_doubles(part.select(*x, F.col(y).alias("label")))


def p04_select_numeric(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return round_doubles(li.select(*features.numeric_columns(li)))


def p05_select_by_role(spark, sf_dir):
    p = profile_of(spark, sf_dir, "customer")
    keep = [r["name"] for r in p.rows if r["inferred_role"] not in ("identifier", "metadata")]
    return round_doubles(p.source.select(*keep))


def p06_not_null(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    return d.where(F.col("cust_num").isNotNull()).select("o_orderkey", "cust_num")


def p07_row_null_share(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    return round_doubles(d.select("o_orderkey", clean.row_null_share(d.columns).alias("null_share")))


def p08_range_filter(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    q = exact_quantiles(d, ["total_price"], [0.25, 0.75])["total_price"]
    lo, hi = iqr_bounds(q[0], q[1])
    return round_doubles(d.where(F.col("total_price").between(lo, hi))
                         .select("o_orderkey", "total_price"))


def _part_fit_apply(spark, sf_dir, cols):
    part = load(spark, sf_dir, "part")
    fit = part.where(F.col("p_size") <= 25)
    enc = features.fit_label_encoders(fit, cols).cache()
    return features.apply_label_encoders(part, enc, cols, features.encoder_sizes(enc))


def p09_unseen_default(spark, sf_dir):
    out = _part_fit_apply(spark, sf_dir, ["p_name", "p_type"])
    return out.select("p_partkey", "p_name", "p_type")


def p10_project_selected(spark, sf_dir):
    """The projection alone: which of the columns F08 picks are left, with their row counts."""
    _, out = _fitted_lineitem(spark, sf_dir)
    kept = [c for c in out.columns if c != "l_returnflag"]
    return out.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in kept]).unpivot(
        [], [F.col(f"`{c}`") for c in kept], "feature", "n")


def p11_indicator_columns(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    values = sorted(r[0] for r in o.select("o_orderpriority").distinct().collect())
    return features.one_hot(o.select("o_orderkey", "o_orderpriority"), "o_orderpriority", values)


# ---- A: profiling aggregations --------------------------------------------------

def _prof_cols(table, cols):
    def run(spark, sf_dir):
        p = profile_of(spark, sf_dir, table)
        return round_doubles(p.columns.select("name", *cols), keep=("mean_value",))
    return run


def a01_table_shape(spark, sf_dir):
    tables = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations"]
    parts = []
    for t in tables:
        df = load(spark, sf_dir, t)
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(t).alias("table_name"), "n_rows",
                             F.lit(len(df.columns)).cast("bigint").alias("n_cols")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def a04_duplicates(spark, sf_dir):
    return round_doubles(infer.duplicate_stats(dirty_orders(spark, sf_dir)))


def a08_quantiles(spark, sf_dir):
    p = profile_of(spark, sf_dir, "lineitem")
    return round_doubles(p.columns.where(F.col("kind") == "numeric")
                         .select("name", "q05", "q25", "q75", "q95"))


def a10_value_counts(spark, sf_dir):
    d = dirty_orders(spark, sf_dir)
    return value_counts(d, ["status", "urgent", "order_date", "num_text"]) \
        .select("name", F.col("v").alias("value"), F.col("cnt").alias("n"))


def a14_ratio_length(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, ["documents", "conversations", "pages", "benchmark"]):
        f = p.columns.where(F.col("kind") == "string").select(
            F.lit(t).alias("table_name"), "name", "unique_ratio", "avg_length")
        out = f if out is None else out.unionByName(f)
    return round_doubles(out)


def a15_outlier_detail(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, ["dirty", "documents", "events"]):
        f = p.columns.where(F.col("inferred_type") == "numeric").select(
            F.lit(t).alias("table_name"), "name", "normal_min", "normal_max",
            "outlier_low", "outlier_high")
        out = f if out is None else out.unionByName(f)
    return round_doubles(out)


def a16_missing_cells(spark, sf_dir):
    return round_doubles(preprocess.missing_cells(dirty_orders(spark, sf_dir)))


def a17_type_composition(spark, sf_dir):
    p = profile_of(spark, sf_dir, "dirty")
    n = len(p.rows)
    return round_doubles(p.columns.groupBy("inferred_type").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.round(F.count(F.lit(1)) * 100.0 / n, 1).alias("pct")))


def a18_complexity(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, ["dirty", "lineitem", "documents"]):
        c = infer.complexity(p.columns)
        c = c.select(F.lit(t).alias("table_name"), "*")
        out = c if out is None else out.unionByName(c)
    return out


def a19_class_counts(spark, sf_dir):
    return split.class_counts(load(spark, sf_dir, "labels"), "quality")


def a20_correlation(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return round_doubles(features.correlation_long(li, cols), 4)


def a21_column_profile(table):
    def run(spark, sf_dir):
        p = profile_of(spark, sf_dir, table)
        return round_doubles(p.columns.select("ordinal", *infer.PROFILE_OUTPUT), keep=("mean_value",))
    return run


def a22_readiness(spark, sf_dir):
    p = profile_of(spark, sf_dir, "dirty")
    complete = preprocess.missing_cells(p.source).collect()[0]["completeness"]
    return round_doubles(report.readiness(p, 100.0 - complete, p.duplicates["duplicate_percentage"]))


def a23_characteristics(spark, sf_dir):
    out = None
    for t, target in [("customer", "c_mktsegment"), ("part", "p_retailprice"),
                      ("labels", "toxic")]:
        df = load(spark, sf_dir, t)
        ptype = policy.problem_type_at_load(df, t, target)
        x = [c for c in df.columns if c != target]
        agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count_distinct(F.col(target)).alias("n_target_values"))
        f = agg.select(F.lit(t).alias("table_name"), "n_rows",
                       F.lit(len(x)).cast("bigint").alias("n_features"),
                       F.lit(ptype).alias("problem_type"),
                       F.when(F.lit(ptype) == "regression", F.lit("continuous"))
                       .otherwise(F.col("n_target_values").cast("string")).alias("n_classes"),
                       F.lit(len(features.numeric_columns(df.select(*x)))).cast("bigint")
                       .alias("n_numeric"),
                       F.lit(len(features.string_columns(df.select(*x)))).cast("bigint")
                       .alias("n_categorical"))
        out = f if out is None else out.unionByName(f)
    return out


# ---- R: rules --------------------------------------------------------------------

def r02_datetime_rule(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, ["dirty", "orders", "events"]):
        f = p.columns.where(F.col("kind") != "numeric").select(
            F.lit(t).alias("table_name"), "name", "date_share",
            (F.col("inferred_type") == "datetime").alias("is_datetime"))
        out = f if out is None else out.unionByName(f)
    return round_doubles(out)


def r03_numeric_rule(spark, sf_dir):
    p = profile_of(spark, sf_dir, "dirty")
    return round_doubles(p.columns.where(F.col("kind") == "string").select(
        "name", F.try_divide(F.col("parsed").cast("double"), F.col("nonnull")).alias("parse_share"),
        (F.col("inferred_type") == "numeric").alias("is_numeric")))


def r04_binary_rule(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, ["dirty", "lineitem", "conversations"]):
        f = p.columns.where(F.col("kind") == "string").select(
            F.lit(t).alias("table_name"), "name",
            F.coalesce(F.col("binary_values"), F.lit(False)).alias("binary_values"),
            (F.col("inferred_type") == "binary").alias("is_binary"))
        out = f if out is None else out.unionByName(f)
    return out


def r05_identifier_rule(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, ["customer", "supplier", "part", "pages", "events"]):
        f = p.columns.where(F.col("kind") == "string").select(
            F.lit(t).alias("table_name"), "name", "unique_ratio",
            F.coalesce(F.col("id_sample"), F.lit(False)).alias("id_sample"),
            (F.col("inferred_type") == "identifier").alias("is_identifier"))
        out = f if out is None else out.unionByName(f)
    return round_doubles(out)


def r06_text_rule(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, ["documents", "pages", "benchmark", "conversations", "part"]):
        f = p.columns.where(F.col("kind") == "string").select(
            F.lit(t).alias("table_name"), "name", "inferred_type")
        out = f if out is None else out.unionByName(f)
    return out


def _types_roles(tables, col):
    def run(spark, sf_dir):
        out = None
        for t, p in profiles_of(spark, sf_dir, tables):
            f = p.columns.select(
                F.lit(t).alias("table_name"), "name", col)
            out = f if out is None else out.unionByName(f)
        return out
    return run


PROFILED = ["dirty", "lineitem", "orders", "customer", "part", "supplier", "events",
            "documents", "labels", "conversations", "nation", "region", "pages", "benchmark",
            "embeddings"]


def r08_problem_types(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, PROFILED):
        f = infer.problem_types(p.columns).select(
            F.lit(t).alias("table_name"), F.array_join("problem_types", ",").alias("problem_types"))
        out = f if out is None else out.unionByName(f)
    return out


def _issues(spark, sf_dir):
    cleaned = cleaned_dirty(spark, sf_dir)[0]
    p = infer.profile_dataset(cleaned)
    return quality.identify_issues(spark, cleaned, p.rows, "o_orderkey")


def _issue_rows(issue_type=None):
    def run(spark, sf_dir):
        iss = _issues(spark, sf_dir)
        if issue_type:
            iss = iss.where(F.col("issue_type") == issue_type)
        return iss.select("ord", "issue_type", "severity",
                          F.array_join("affected_columns", ",").alias("affected_columns"),
                          "description", "business_impact",
                          F.array_join("options", ",").alias("options"))
    return run


CHOICES = {"outliers_detected_0": "cap_outliers", "problem_type_selection_1": "forecasting",
           "moderate_missing_values_2": "predictive_imputation"}


def r13_problem_type(spark, sf_dir):
    iss = _issues(spark, sf_dir)
    out = None
    for name, ch in [("default", None), ("given", CHOICES), ("regression",
                     {"problem_type_selection_1": "regression"})]:
        ptype = policy.validated_problem_type(policy.make_decisions(iss, ch))
        f = iss.where(F.col("issue_type") == "problem_type_selection").select(
            F.lit(name).alias("choice_set"), F.lit(ptype).alias("problem_type"))
        out = f if out is None else out.unionByName(f)
    return out


def r14_target_scores(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, ["dirty", "customer", "labels", "lineitem", "conversations"]):
        f = policy.target_scores(p.columns).select(
            F.lit(t).alias("table_name"), "name", F.col("score").cast("bigint").alias("score"))
        out = f if out is None else out.unionByName(f)
    return out


def r15_validated_target(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, ["dirty", "customer", "labels", "lineitem", "conversations", "part"]):
        f = policy.choose_target(p.columns).select(
            F.lit(t).alias("table_name"), "target")
        out = f if out is None else out.unionByName(f)
    return out


def r16_problem_type_at_load(spark, sf_dir):
    out = None
    for t in ["customer", "part", "labels", "orders", "lineitem", "supplier"]:
        df = load(spark, sf_dir, t)
        target = df.columns[-1]
        n = df.agg(F.count_distinct(F.col(target)).alias("n_values"))
        f = n.select(F.lit(t).alias("table_name"), F.lit(target).alias("target"), "n_values",
                     F.lit(policy.problem_type_at_load(df, t, target)).alias("problem_type"))
        out = f if out is None else out.unionByName(f)
    return out


def _algorithm(wide):
    def run(spark, sf_dir):
        out = None
        for t in ["customer", "part", "labels", "orders", "lineitem", "supplier", "events"]:
            df = load(spark, sf_dir, t)
            ptype = policy.problem_type_at_load(df, t, df.columns[-1])
            st = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(t).alias("table_name"), F.lit(ptype).alias("problem_type"), "n_rows",
                F.lit(len(df.columns) - 1).alias("n_features"))
            f = policy.algorithm_frame(st, wide)
            out = f if out is None else out.unionByName(f)
        return out
    return run


def r19_decisions(spark, sf_dir):
    iss = _issues(spark, sf_dir)
    a = policy.decisions_frame(iss, CHOICES).withColumn("choice_set", F.lit("given"))
    b = policy.decisions_frame(iss, {}).withColumn("choice_set", F.lit("default"))
    return a.unionByName(b)


# ---- C: cleaning and imputation -------------------------------------------------

def c01_dedup(spark, sf_dir):
    return round_doubles(clean.drop_duplicate_rows(dirty_orders(spark, sf_dir)))


def c02_drop_high_missing(spark, sf_dir):
    p = profile_of(spark, sf_dir, "dirty")
    out = clean.drop_columns(clean.drop_duplicate_rows(p.source), clean.high_missing_columns(p.rows))
    return round_doubles(out)


def c03_drop_sparse_rows(spark, sf_dir):
    return round_doubles(clean.drop_sparse_rows(dirty_orders(spark, sf_dir)))


def c04_cleaning_chain(spark, sf_dir):
    return round_doubles(cleaned_dirty(spark, sf_dir)[0])


def c05_text_to_numeric(spark, sf_dir):
    p = profile_of(spark, sf_dir, "dirty")
    out, _ = impute.convert_numeric_text(p.source, p.rows)
    return round_doubles(out.select("o_orderkey", "num_text"))


def _impute_numeric(strategy):
    def run(spark, sf_dir):
        cleaned = cleaned_dirty(spark, sf_dir)[0]
        p = infer.profile_dataset(cleaned)
        rows = [r for r in p.rows if r["name"] in ("cust_num", "total_price")]
        fills, _, _ = impute.impute_plan(cleaned, rows, strategy)
        return round_doubles(impute.apply_fills(cleaned, fills)
                             .select("o_orderkey", "cust_num", "total_price"))
    return run


def c10_impute_categorical(spark, sf_dir):
    cleaned = cleaned_dirty(spark, sf_dir)[0]
    p = infer.profile_dataset(cleaned)
    rows = [r for r in p.rows if r["inferred_type"] in ("categorical", "binary")]
    fills, _, _ = impute.impute_plan(cleaned, rows, "statistical_imputation")
    return impute.apply_fills(cleaned, fills).select("o_orderkey", "status", "urgent")


def c11_ffill_bfill(spark, sf_dir):
    cleaned = cleaned_dirty(spark, sf_dir)[0]
    return ffill_bfill(cleaned, ["order_date"], "o_orderkey").select("o_orderkey", "order_date")


def _customer_with_gaps(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_name"))
                    .alias("c_name"), "c_acctbal")


def c12_impute_other(spark, sf_dir):
    df = _customer_with_gaps(spark, sf_dir)
    p = infer.profile_dataset(df)
    rows = [r for r in p.rows if r["inferred_type"] not in ("numeric", "datetime",
                                                            "categorical", "binary")]
    fills, _, _ = impute.impute_plan(df, rows, "statistical_imputation")
    return round_doubles(impute.apply_fills(df, fills))


def c13_final_sweep(spark, sf_dir):
    return round_doubles(impute.final_sweep(dirty_orders(spark, sf_dir)))


def _executed(spark, sf_dir, decisions):
    cleaned = cleaned_dirty(spark, sf_dir)[0]
    p = infer.profile_dataset(cleaned)
    return preprocess.execute_preprocessing(cleaned, p, decisions, None, "o_orderkey")


def c14_impute_dispatch(spark, sf_dir):
    cleaned = cleaned_dirty(spark, sf_dir)[0]
    p = infer.profile_dataset(cleaned)
    conv, _ = impute.convert_numeric_text(cleaned, p.rows)
    out, _ = impute.impute(conv, p.rows, "statistical_imputation", "o_orderkey")
    return round_doubles(out)


def c15_cap_outliers(spark, sf_dir):
    train, _, _ = _executed(spark, sf_dir, {"outliers_detected_0": "cap_outliers"})
    return round_doubles(train)


def c16_remove_outliers(spark, sf_dir):
    lab = load(spark, sf_dir, "labels")
    p = profile_of(spark, sf_dir, "labels")
    return outliers.remove_outliers(lab, quality.outlier_columns(p.rows))


def gappy_lineitem(spark, sf_dir):
    """Lineitem numbers with NULLs: a double and an integer column, and booleans."""
    li = load(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey") + F.col("l_linenumber")
    return li.select("l_orderkey", "l_linenumber", F.when(k % 7 > 0, F.col("l_quantity")).alias("qty"),
                     F.when(k % 5 > 0, F.col("l_suppkey").cast("int")).alias("supp"),
                     F.when(k % 3 > 0, F.col("l_extendedprice")).alias("price"),
                     F.when(k % 4 > 0, F.col("l_discount") > 0.05).alias("cheap"),
                     F.when(k % 11 > 0, F.col("l_shipdate")).alias("shipped"))


def c15_cap_outliers_gaps(spark, sf_dir):
    """C15 on NULLs (which stay) and on an integer column (which widens)."""
    d = gappy_lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "qty", "supp")
    return round_doubles(outliers.cap_outliers(d, ["qty", "supp"])[0])


def c13_final_sweep_typed(spark, sf_dir):
    """C13 on boolean, temporal, integer and double NULLs."""
    return round_doubles(impute.final_sweep(gappy_lineitem(spark, sf_dir)))


def c08_impute_mode_typed(spark, sf_dir):
    """C08 on a boolean and an integer column with NULLs."""
    d = gappy_lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", "cheap", "supp")
    out, _ = impute.impute(d, infer.profile_dataset(d).rows, "statistical_imputation")
    return round_doubles(out)


def a20_correlation_gaps(spark, sf_dir):
    """A20 on columns with NULLs: each pair over the rows that have both."""
    return features.correlation_long(gappy_lineitem(spark, sf_dir), ["qty", "supp", "price"])


def a03_distinct_wide(spark, sf_dir):
    """A03 on integers beyond 2^53, which a double cannot tell apart."""
    o = load(spark, sf_dir, "orders").select((F.col("o_orderkey") + F.lit(9007199254740992)).alias("wide_key"),
                                             (F.col("o_custkey") * -1 - F.lit(9007199254740992)).alias("wide_cust"))
    return infer.profile_dataset(o).columns.select("name", "unique_count")


def f05_anova_offset(spark, sf_dir):
    """F05 with a common offset of 1e9 on every feature."""
    p = load(spark, sf_dir, "part")
    y = F.dense_rank().over(Window.orderBy("p_type"))
    types = p.select("p_type").distinct().select("p_type", y.alias("y"))
    d = p.join(F.broadcast(types), "p_type").select("y", (F.col("p_size") + 1e9).alias("p_size"),
                                                   (F.col("p_retailprice") + 1e9).alias("p_retailprice"))
    return features.anova_f(d, ["p_size", "p_retailprice"], "y").select("feature", F.round("score", 4).alias("score"))


def f06_mutual_info_gaps(spark, sf_dir):
    """F06 on features and a label with NULLs."""
    d = gappy_lineitem(spark, sf_dir).withColumn("y", F.col("cheap").cast("int"))
    return round_doubles(features.mutual_info(d, ["qty", "supp", "price"], "y"))


def s01_csv_quoted(spark, sf_dir):
    """S01 on quoted fields, line ends within them and booleans."""
    path = _scratch(spark)
    d = load(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit('say "hi", '), "text").alias("text"), "source", (F.col("n_chars") > 500).alias("is_long"))
    d.write.option("header", True).option("escape", '"').csv(path)
    return io.read_table(spark, path, fmt="csv")


def c17_keep_outliers(spark, sf_dir):
    return outliers.keep_outliers(load(spark, sf_dir, "documents")).select("doc_id", "n_chars")


def c18_execute(spark, sf_dir):
    train, _, _ = _executed(spark, sf_dir, {"outliers_detected_0": "keep_outliers",
                                            "moderate_missing_values_2": "statistical_imputation"})
    return round_doubles(train)


def c19_report(spark, sf_dir):
    return round_doubles(report.report_facts(_report(spark, sf_dir)))


def c20_process_dataset(spark, sf_dir):
    res = preprocess.process_dataset(dirty_orders(spark, sf_dir), order_by="o_orderkey")
    return round_doubles(res.training)


# ---- F: features -------------------------------------------------------------------

def f01_label_encode(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    cols = ["p_name", "p_brand", "p_type"]
    enc = features.fit_label_encoders(part, cols).cache()
    return features.apply_label_encoders(part, enc, cols, features.encoder_sizes(enc)) \
        .select("p_partkey", *cols)


def f02_one_hot(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    values = sorted(r[0] for r in part.select("p_type").distinct().collect())
    return features.one_hot(part.select("p_partkey", "p_type"), "p_type", values)


def f03_binary_encode(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    enc = features.fit_label_encoders(li, ["l_linestatus"]).cache()
    return features.apply_label_encoders(li.select("l_orderkey", "l_linenumber", "l_linestatus"),
                                         enc, ["l_linestatus"], features.encoder_sizes(enc))


def f04_target_mapping(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    return features.fit_label_encoders(li, ["l_returnflag"]).select("value", "code")


LI_FEATURES = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax"]


def f05_anova(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    enc = features.fit_label_encoders(li, ["l_returnflag"]).cache()
    y = features.apply_label_encoders(li, enc, ["l_returnflag"], features.encoder_sizes(enc))
    return round_doubles(features.anova_f(y, LI_FEATURES, "l_returnflag"))


def _mi_binary(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    enc = features.fit_label_encoders(li, ["l_linestatus"]).cache()
    y = features.apply_label_encoders(li, enc, ["l_linestatus"], features.encoder_sizes(enc))
    return features.mutual_info(y, LI_FEATURES, "l_linestatus")


def f06_mutual_info_binary(spark, sf_dir):
    return round_doubles(_mi_binary(spark, sf_dir))


def f07_mutual_info_regression(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    feats = ["l_quantity", "l_discount", "l_tax", "l_partkey", "l_linenumber"]
    return round_doubles(features.mutual_info(li, feats, "l_extendedprice", bin_label=True))


def f08_select_top_k(spark, sf_dir):
    sc = f05_anova(spark, sf_dir)
    keep = features.select_top_k(sc, LI_FEATURES, features.n_keep(len(LI_FEATURES)))
    return sc.where(F.col("feature").isin(keep)).select("feature")


def f09_standard_scale(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    st = features.scaler_stats(c, ["c_acctbal", "c_nationkey"])
    return round_doubles(features.scale(c.select("c_custkey", "c_acctbal", "c_nationkey"), st))


def _fitted_lineitem(spark, sf_dir):
    fp = features.FeatureProcessor("classification")
    return fp, fp.fit_transform(load(spark, sf_dir, "lineitem"), "l_returnflag")


def f10_fit_features(spark, sf_dir):
    """F10 on every column, the ship date among them, as (feature, value, label)
    rows of the selected, scaled features."""
    fp, out = _fitted_lineitem(spark, sf_dir)
    long = out.unpivot(["l_returnflag"], [F.col(f"`{c}`").cast("double") for c in fp.selected],
                       "feature", "value")
    return round_doubles(long.select("feature", "value", "l_returnflag"))


f10_fit_features_long = f10_fit_features


def f11_transform_new(spark, sf_dir):
    part = load(spark, sf_dir, "part")
    fp = features.FeatureProcessor("regression")
    fp.fit_transform(part.where(F.col("p_size") <= 25), "p_retailprice")
    return round_doubles(fp.transform(part))


# ---- M: split, training --------------------------------------------------------------

def m01_split(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return split.train_test_split(o, "o_orderkey", 0.2).select("o_orderkey", "part")


def m02_stratified_split(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return split.train_test_split(o, "o_orderkey", 0.2, stratify="o_orderpriority") \
        .select("o_orderkey", "o_orderpriority", "part")


def m03_folds(spark, sf_dir):
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    a = split.assign_folds(o, "o_orderkey", 5, stratify="o_orderstatus") \
        .select("o_orderkey", F.col("fold").alias("stratified_fold"))
    b = split.assign_folds(o, "o_orderkey", 5).select("o_orderkey", F.col("fold").alias("plain_fold"))
    return a.join(b, "o_orderkey")


def _labels_frame(spark, sf_dir):
    lab = load(spark, sf_dir, "labels")
    doc = load(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    return lab.join(doc, "doc_id")


def _train(algorithm, problem_type, trials=0):
    def run(spark, sf_dir):
        from ..operators import models
        if problem_type == "regression":
            df = load(spark, sf_dir, "part")
            feats, label, key = ["p_size", "p_partkey"], "p_retailprice", "p_partkey"
        else:
            df = _labels_frame(spark, sf_dir)
            feats, label, key = ["n_chars", "toxic"], "quality", "doc_id"
        res = models.train_selected_model(df, feats, label, key, algorithm, problem_type,
                                          n_trials=trials)
        return res.predictions
    return run


def m09_ridge_closed_form(spark, sf_dir):
    from ..operators import models
    part = load(spark, sf_dir, "part")
    res = models.train_selected_model(part, ["p_size"], "p_retailprice", "p_partkey",
                                      "ridge_regression", "regression", n_trials=0)
    return round_doubles(res.predictions)


def m08_linear_closed_form(spark, sf_dir):
    from ..operators import models
    part = load(spark, sf_dir, "part")
    res = models.train_selected_model(part, ["p_size"], "p_retailprice", "p_partkey",
                                      "linear_regression", "regression", n_trials=0)
    return round_doubles(res.predictions)


def m10_catalog(spark, sf_dir):
    from ..operators import models
    out = None
    for t in ["customer", "part", "labels"]:
        df = load(spark, sf_dir, t)
        ptype = policy.problem_type_at_load(df, t, df.columns[-1])
        algs = list(models.get_algorithms(ptype))
        f = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t).alias("table_name"), F.lit(ptype).alias("problem_type"),
            F.explode(F.array(*[F.lit(a) for a in algs])).alias("algorithm"))
        out = f if out is None else out.unionByName(f)
    return out


def m13_train(spark, sf_dir):
    from ..operators import models
    df = _labels_frame(spark, sf_dir)
    res = models.train_selected_model(df, ["n_chars", "toxic"], "quality", "doc_id",
                                      "logistic_regression", "binary_classification")
    return res.metrics


def m14_automl(spark, sf_dir):
    from . import automl
    return automl.run_automl(_labels_frame(spark, sf_dir), "quality",
                             key="doc_id").metrics


def m15_batch_predict(spark, sf_dir):
    return _train("random_forest", "binary_classification")(spark, sf_dir)


# ---- E: metrics -----------------------------------------------------------------------

def e01_e02_metrics(spark, sf_dir):
    return round_doubles(metrics.classification_metrics(prediction_table(spark, sf_dir)))


def e02_multiclass(spark, sf_dir):
    return round_doubles(metrics.classification_metrics(multiclass_predictions(spark, sf_dir)))


def e03_auc(spark, sf_dir):
    return round_doubles(metrics.roc_auc(prediction_table(spark, sf_dir)))


def e04_regression(spark, sf_dir):
    return round_doubles(metrics.regression_metrics(regression_predictions(spark, sf_dir)))


def e05_confusion(spark, sf_dir):
    return metrics.confusion_grid(multiclass_predictions(spark, sf_dir), [1, 2, 3, 4, 5])


def e05_confusion_pairs(spark, sf_dir):
    """E05 over a wide class domain: the observed pairs of supplier and part keys."""
    li = load(spark, sf_dir, "lineitem")
    return metrics.confusion_matrix(li.select(F.col("l_suppkey").alias("label"), (F.col("l_partkey") % 1500).alias("prediction")))


def e04_constant_label(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    off = p.select(F.lit("off").alias("part"), F.lit(25.0).alias("label"), F.col("p_size").cast("double").alias("prediction"))
    exact = p.select(F.lit("exact").alias("part"), F.lit(25.0).alias("label"), F.lit(25.0).alias("prediction"))
    gaps = regression_predictions(spark, sf_dir).select(
        F.lit("gaps").alias("part"), F.when(F.col("p_partkey") % 3 > 0, F.col("label")).alias("label"), "prediction")
    return round_doubles(metrics.regression_metrics(off.union(exact).union(gaps), ["part"]))


def e06_report(spark, sf_dir):
    return round_doubles(metrics.classification_report(multiclass_predictions(spark, sf_dir)))


def e07_importance(spark, sf_dir):
    from ..operators import models
    res = models.train_selected_model(_labels_frame(spark, sf_dir), ["n_chars", "toxic"],
                                      "quality", "doc_id", "random_forest",
                                      "binary_classification", n_trials=0)
    return res.predictions.groupBy("part").count() if not res.feature_importance else \
        spark.createDataFrame(res.feature_importance, "feature string, importance double")


def t04_sorted_importances(spark, sf_dir):
    imp = e07_importance(spark, sf_dir)
    w = Window.orderBy(F.col("importance").desc(), "feature")   # one row per feature
    return imp.select("feature", "importance", F.row_number().over(w).cast("bigint").alias("rank"))


def m11_default_fit(spark, sf_dir):
    from ..operators import models
    part = load(spark, sf_dir, "part")
    res = models.train_selected_model(part, ["p_size"], "p_retailprice", "p_partkey",
                                      "gradient_boosting", "regression", n_trials=0)
    return res.predictions


def e08_evaluation(spark, sf_dir):
    pred = prediction_table(spark, sf_dir)
    return round_doubles(metrics.evaluation_report(pred, "binary_classification", "doc_id"))


def e09_bundle(spark, sf_dir):
    pred = split.train_test_split(prediction_table(spark, sf_dir), "doc_id", 0.2, "label")
    return round_doubles(metrics.metric_bundle(pred, "binary_classification"))


# ---- T: sort / limit / top-k -------------------------------------------------------------

def t01_head_preview(spark, sf_dir):
    d = clean.drop_duplicate_rows(dirty_orders(spark, sf_dir))
    cols = ["status", "urgent", "order_date", "num_text"]
    long = d.select("o_orderkey", *cols).unpivot(["o_orderkey"], cols, "name", "v") \
        .where(F.col("v").isNotNull())
    top = smallest_k_per_group(long, ["name"], [F.col("o_orderkey")], 3)
    return top.select("name", F.col("__r").cast("bigint").alias("r"), "o_orderkey", "v")


def t01_head_rows(spark, sf_dir):
    """Five rows of the first columns, as an issue shows them, and eight of all that a target can be chosen from."""
    d = clean.drop_duplicate_rows(dirty_orders(spark, sf_dir))
    p = infer.profile_dataset(d)
    free = [r["name"] for r in p.rows if r["inferred_role"] not in ("identifier", "metadata")]
    out = None
    for shown, cols, n in (("issue", d.columns[:5], 5), ("target", free, 8)):
        f = head_preview(d, cols, "o_orderkey", n).select(F.lit(shown).alias("shown"), "*")
        out = f if out is None else out.unionByName(f)
    return round_doubles(out)


def t02_samples(spark, sf_dir):
    out = None
    for t, p in profiles_of(spark, sf_dir, ["dirty", "customer", "part"]):
        f = p.columns.where(F.col("kind") == "string").select(
            F.lit(t).alias("table_name"), "name", F.array_join("sample_values", "|").alias("sample"))
        out = f if out is None else out.unionByName(f)
    return out


def t03_top_k(spark, sf_dir):
    sc = _mi_binary(spark, sf_dir)
    keep = features.select_top_k(sc, LI_FEATURES, 3)
    return sc.where(F.col("feature").isin(keep)).select("feature")


def t05_ranked_targets(spark, sf_dir):
    s = policy.target_scores(profile_of(spark, sf_dir, "dirty").columns)
    # one row per column of the profiled table: a global window here is bounded
    w = Window.orderBy(F.col("score").desc(), "ordinal")
    return s.select("name", F.col("score").cast("bigint").alias("score"),
                    F.row_number().over(w).cast("bigint").alias("rank"))


def t06_outlier_examples(spark, sf_dir):
    cleaned = cleaned_dirty(spark, sf_dir)[0]
    p = infer.profile_dataset(cleaned)
    r = p.by_name()["total_price"]
    lo, hi = iqr_bounds(r["q25"], r["q75"])
    ex = outliers.outlier_examples(cleaned, {"total_price": (lo, hi)}, "o_orderkey")
    return round_doubles(ex.drop("name").withColumn("r", F.col("r").cast("bigint")))


def t07_first_predictions(spark, sf_dir):
    return prediction_table(spark, sf_dir).orderBy("doc_id").limit(10) \
        .select("doc_id", "prediction")


# ---- N: scalar functions ------------------------------------------------------------------

def n_scalar(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("n01_text"),
        F.lower("o_orderpriority").alias("n02_lower"),
        F.length("o_orderpriority").alias("n03_length"),
        F.col("o_orderpriority").rlike(r"\d-[A-Z]{3,}").alias("n04_search"),
        F.col("o_orderpriority").rlike(r"^(?:\d-(?:HIGH|LOW))\z").alias("n04_full"),
        R.parse_number(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")))
        .alias("n05_parse"),
        F.least(F.greatest(F.col("o_totalprice"), F.lit(50000.0)), F.lit(400000.0)).alias("n06_clip"),
        F.coalesce(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), F.lit("Unknown"))
        .alias("n07_fill"),
        F.round(F.col("o_totalprice") * 0.7071067, 1).alias("n08_round1"),
        F.bround(F.col("o_custkey") / 8.0, 2).alias("n08_bround"),
        R.title_case(F.concat(F.lower("o_orderstatus"), F.lit("_status"))).alias("n09_title"),
        R.name_has(F.col("o_orderpriority"), ["urgent", "high"]).alias("n10_keyword"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("n11_timestamp"),
        R.fmt2(F.col("o_totalprice")).alias("n12_format"),
        F.round(F.sqrt(F.abs(F.col("o_totalprice") - 250000.0)), 6).alias("n13_abs_sqrt"),
    )


N_COLUMNS = {
    "n01_cast_text": ["n01_text"], "n02_lower": ["n02_lower"], "n03_length": ["n03_length"],
    "n04_regex": ["n04_search", "n04_full"], "n05_parse": ["n05_parse"],
    "n06_clip": ["n06_clip"], "n07_fill_null": ["n07_fill"],
    "n08_round": ["n08_round1", "n08_bround"], "n09_title_case": ["n09_title"],
    "n10_keyword_test": ["n10_keyword"], "n11_timestamp_format": ["n11_timestamp"],
    "n12_number_format": ["n12_format"], "n13_abs_sqrt": ["n13_abs_sqrt"],
}


def _n_single(cols):
    def run(spark, sf_dir):
        return n_scalar(spark, sf_dir).select("o_orderkey", *cols)
    return run


def e01_accuracy(spark, sf_dir):
    return e01_e02_metrics(spark, sf_dir).select("accuracy")


def e02_weighted_prf(spark, sf_dir):
    return e01_e02_metrics(spark, sf_dir).select("precision", "recall", "f1")


def registry() -> dict:
    """Query id -> workload."""
    from . import fits
    q = {
        "s01_scan_normalize": s01_scan_normalize,
        "s01_csv_roundtrip": s01_csv_roundtrip,
        "s03_read_report": s03_read_report,
        "s04_training_sink": s04_training_sink,
        "s05_analysis_report_sink": s05_analysis_report_sink,
        "s06_correlation_sink": s06_correlation_sink,
        "s02_ingest": s02_ingest,
        "s07_model_save": s07_model_save,
        "s08_evaluation_sink": s08_evaluation_sink,
        "s09_metadata_sink": s09_metadata_sink,
        "p01_drop_columns": p01_drop_columns,
        "p02_without_identifiers": p02_without_identifiers,
        "p03_features_target": p03_features_target,
        "p04_select_numeric": p04_select_numeric,
        "p05_select_by_role": p05_select_by_role,
        "p06_not_null": p06_not_null,
        "p07_row_null_share": p07_row_null_share,
        "p08_range_filter": p08_range_filter,
        "p09_unseen_default": p09_unseen_default,
        "p10_project_selected": p10_project_selected,
        "p11_indicator_columns": p11_indicator_columns,
        "a01_table_shape": a01_table_shape,
        "a02_null_counts": _prof_cols("dirty", ["null_count", "null_percentage"]),
        "a03_distinct_counts": _prof_cols("dirty", ["unique_count"]),
        "a04_duplicates": a04_duplicates,
        "a05_mean_std": _prof_cols("lineitem", ["mean_value", "std_value"]),
        "a06_skewness": _prof_cols("documents", ["skewness"]),
        "a07_distribution": _prof_cols("events", ["distribution"]),
        "a08_quantiles": a08_quantiles,
        "a09_outlier_flag": _prof_cols("labels", ["has_outliers"]),
        "a10_value_counts": a10_value_counts,
        "a11_most_frequent": _prof_cols("dirty", ["most_frequent"]),
        "a12_balance": _prof_cols("conversations", ["frequency_distribution"]),
        "a13_cardinality": _prof_cols("part", ["cardinality"]),
        "a14_ratio_length": a14_ratio_length,
        "a15_outlier_detail": a15_outlier_detail,
        "a16_missing_cells": a16_missing_cells,
        "a17_type_composition": a17_type_composition,
        "a18_complexity": a18_complexity,
        "a19_class_counts": a19_class_counts,
        "a20_correlation": a20_correlation,
        "a21_column_profile": a21_column_profile("lineitem"),
        "a21_column_profile_dirty": a21_column_profile("dirty"),
        "a21_column_profile_events": a21_column_profile("events"),
        "a21_column_profile_documents": a21_column_profile("documents"),
        "a21_column_profile_pages": a21_column_profile("pages"),
        "a21_column_profile_conversations": a21_column_profile("conversations"),
        "a22_readiness": a22_readiness,
        "a23_characteristics": a23_characteristics,
        "r01_type_inference": _types_roles(PROFILED, "inferred_type"),
        "r02_datetime_rule": r02_datetime_rule,
        "r03_numeric_rule": r03_numeric_rule,
        "r04_binary_rule": r04_binary_rule,
        "r05_identifier_rule": r05_identifier_rule,
        "r06_text_rule": r06_text_rule,
        "r07_role_inference": _types_roles(PROFILED, "inferred_role"),
        "r08_problem_types": r08_problem_types,
        "r09_outlier_issue": _issue_rows("outliers_detected"),
        "r10_missing_issue": _issue_rows("moderate_missing_values"),
        "r11_problem_type_issue": _issue_rows("problem_type_selection"),
        "r12_issue_table": _issue_rows(),
        "r13_problem_type": r13_problem_type,
        "r14_target_scores": r14_target_scores,
        "r15_validated_target": r15_validated_target,
        "r16_problem_type_at_load": r16_problem_type_at_load,
        "r17_default_algorithm": _algorithm(None),
        "r18_fallback_algorithm": _algorithm(50),
        "r19_decisions": r19_decisions,
        "c01_dedup": c01_dedup,
        "c02_drop_high_missing": c02_drop_high_missing,
        "c03_drop_sparse_rows": c03_drop_sparse_rows,
        "c04_cleaning_chain": c04_cleaning_chain,
        "c05_text_to_numeric": c05_text_to_numeric,
        "c06_impute_mean": _impute_numeric("statistical_imputation_mean"),
        "c07_impute_median": _impute_numeric("statistical_imputation_median"),
        "c08_impute_mode": _impute_numeric("statistical_imputation"),
        "c09_impute_knn": _impute_numeric("predictive_imputation"),
        "c10_impute_categorical": c10_impute_categorical,
        "c11_ffill_bfill": c11_ffill_bfill,
        "c12_impute_other": c12_impute_other,
        "c13_final_sweep": c13_final_sweep,
        "c14_impute_dispatch": c14_impute_dispatch,
        "c15_cap_outliers": c15_cap_outliers,
        "c16_remove_outliers": c16_remove_outliers,
        "c17_keep_outliers": c17_keep_outliers,
        "c18_execute": c18_execute,
        "c19_report": c19_report,
        "c20_process_dataset": c20_process_dataset,
        "f01_label_encode": f01_label_encode,
        "f02_one_hot": f02_one_hot,
        "f03_binary_encode": f03_binary_encode,
        "f04_target_mapping": f04_target_mapping,
        "f05_anova_f": f05_anova,
        "f06_mutual_info_binary": f06_mutual_info_binary,
        "f07_mutual_info_regression": f07_mutual_info_regression,
        "f08_select_top_k": f08_select_top_k,
        "f09_standard_scale": f09_standard_scale,
        "f10_fit_features": f10_fit_features,
        "f10_fit_features_long": f10_fit_features_long,
        "f11_transform_new": f11_transform_new,
        "m01_split": m01_split,
        "m02_stratified_split": m02_stratified_split,
        "m03_folds": m03_folds,
        "m04_random_forest": _train("random_forest", "binary_classification"),
        "m05_gradient_boosting": _train("gradient_boosting", "binary_classification"),
        "m06_logistic_regression": _train("logistic_regression", "binary_classification"),
        "m07_linear_svm": _train("svm", "binary_classification"),
        "m08_linear_regression": _train("linear_regression", "regression"),
        "m09_ridge": _train("ridge_regression", "regression"),
        "m08_linear_closed_form": m08_linear_closed_form,
        "m09_ridge_closed_form": m09_ridge_closed_form,
        "m10_catalog": m10_catalog,
        "m11_default_fit": m11_default_fit,
        "m12_search": _train("logistic_regression", "binary_classification", trials=50),
        "m13_train": m13_train,
        "m14_automl": m14_automl,
        "m15_batch_predict": m15_batch_predict,
        "e01_e02_metrics": e01_e02_metrics,
        "e02_multiclass": e02_multiclass,
        "e03_auc": e03_auc,
        "e04_regression": e04_regression,
        "e05_confusion": e05_confusion,
        "e05_confusion_pairs": e05_confusion_pairs,
        "s07_processor_roundtrip": s07_processor_roundtrip,
        "e08_full_evaluation": e08_full_evaluation,
        "s08_deployment_info": s08_deployment_info,
        "e04_constant_label": e04_constant_label,
        "c15_cap_outliers_gaps": c15_cap_outliers_gaps,
        "c13_final_sweep_typed": c13_final_sweep_typed,
        "c08_impute_mode_typed": c08_impute_mode_typed,
        "a20_correlation_gaps": a20_correlation_gaps,
        "a03_distinct_wide": a03_distinct_wide,
        "f05_anova_offset": f05_anova_offset,
        "f06_mutual_info_gaps": f06_mutual_info_gaps,
        "s01_csv_quoted": s01_csv_quoted,
        "e06_report": e06_report,
        "e07_importance": e07_importance,
        "e08_evaluation": e08_evaluation,
        "e09_bundle": e09_bundle,
        "t01_head_preview": t01_head_preview,
        "t01_head_rows": t01_head_rows,
        "s07_bundle_scoring": s07_bundle_scoring,
        "t02_samples": t02_samples,
        "t03_top_k": t03_top_k,
        "t04_sorted_importances": t04_sorted_importances,
        "t05_ranked_targets": t05_ranked_targets,
        "t06_outlier_examples": t06_outlier_examples,
        "t07_first_predictions": t07_first_predictions,
        "n01_n13_scalar": n_scalar,
        "e01_accuracy": e01_accuracy,
        "e02_weighted_prf": e02_weighted_prf,
    }
    q.update({k: _n_single(v) for k, v in N_COLUMNS.items()})
    q.update(fits.registry())
    return q
