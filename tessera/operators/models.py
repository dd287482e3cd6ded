"""Training and tuning on MLlib.

Estimators are distributed MLlib stages; tuning is a seeded random search over
a fold column (M03). Linear, ridge and binary logistic regression and boosted
trees of two classes are scored from sufficient statistics, all trials in a few
passes (``search``); the others by ``CrossValidator``, trials in parallel.
"""

from __future__ import annotations

import json
import math
import random
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       OneVsRest, RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import search
from .split import assign_folds, train_test_split

SEED = 42
FAILED_TRIAL = -999.0

# FIXED VALUES: search spaces (low, high) or choices, and default parameters.
SEARCH_SPACES = {
    "classification": {
        "random_forest": {"n_estimators": (50, 300), "max_depth": (3, 20),
                          "min_samples_split": (2, 20), "min_samples_leaf": (1, 10)},
        "gradient_boosting": {"n_estimators": (50, 200), "learning_rate": (0.01, 0.3),
                              "max_depth": (3, 10), "subsample": (0.8, 1.0)},
        "logistic_regression": {"C": (0.01, 100.0), "penalty": ["l1", "l2"]},
        "svm": {"C": (0.1, 100.0)},
    },
    "regression": {
        "random_forest": {"n_estimators": (50, 300), "max_depth": (3, 20),
                          "min_samples_split": (2, 20), "min_samples_leaf": (1, 10)},
        "gradient_boosting": {"n_estimators": (50, 200), "learning_rate": (0.01, 0.3),
                              "max_depth": (3, 10), "subsample": (0.8, 1.0)},
        "linear_regression": {},
        "ridge_regression": {"alpha": (0.01, 100.0)},
    },
}
DEFAULT_PARAMS = {
    "random_forest": {"n_estimators": 100, "max_depth": None},
    "gradient_boosting": {"n_estimators": 100, "learning_rate": 0.1},
    "logistic_regression": {"C": 1.0, "max_iter": 1000},
    "svm": {"C": 1.0},
    "linear_regression": {},
    "ridge_regression": {"alpha": 1.0},
}
MAX_TREE_DEPTH = 30     # MLlib limit; "no limit" maps here
ROWS_PER_PARTITION = 500_000
#: Rows below which a partition is not split further to give every core one.
LEAST_ROWS = 50_000


def family(problem_type: str) -> str:
    return "classification" if problem_type in ("classification",
                                                  "binary_classification") else "regression"


def get_algorithms(problem_type: str) -> dict:
    """Algorithm name -> search space."""
    return SEARCH_SPACES[family(problem_type)]


def build_estimator(algorithm: str, problem_type: str, params: dict, n_rows: int,
                    n_classes: int = 2, features: str = "features", label: str = "label",
                    label_std: float = 1.0):
    """MLlib estimator for an algorithm name and reference-style parameters.

    Penalties are rescaled to MLlib's objectives: logistic C -> regParam
    1/(C n); ridge alpha -> regParam alpha * std_pop(y) / n (the normal-equation
    solver standardises the label internally), which reproduces the closed form.
    """
    cls = family(problem_type) == "classification"
    p = dict(DEFAULT_PARAMS.get(algorithm, {}))
    p.update(params or {})
    common = {"featuresCol": features, "labelCol": label}
    if algorithm == "random_forest":
        depth = p.get("max_depth") or MAX_TREE_DEPTH
        kw = dict(numTrees=int(p.get("n_estimators", 100)), maxDepth=int(min(depth, MAX_TREE_DEPTH)),
                  minInstancesPerNode=_least_leaf(p), seed=SEED, **common)
        return RandomForestClassifier(**kw) if cls else RandomForestRegressor(**kw)
    if algorithm == "gradient_boosting":
        kw = dict(maxIter=int(p.get("n_estimators", 100)), stepSize=float(p.get("learning_rate", 0.1)),
                  maxDepth=int(p.get("max_depth", 3)), subsamplingRate=float(p.get("subsample", 1.0)),
                  seed=SEED, **common)
        if cls:
            gbt = GBTClassifier(**kw)
            return gbt if n_classes <= 2 else OneVsRest(classifier=gbt, **common)
        return GBTRegressor(**kw)
    if algorithm == "logistic_regression":
        c = float(p.get("C", 1.0))
        return LogisticRegression(regParam=1.0 / (c * max(n_rows, 1)),
                                  elasticNetParam=1.0 if p.get("penalty") == "l1" else 0.0,
                                  standardization=False, maxIter=int(p.get("max_iter", 1000)),
                                  **common)
    if algorithm == "svm":
        c = float(p.get("C", 1.0))
        svc = LinearSVC(regParam=1.0 / (c * max(n_rows, 1)), standardization=False, **common)
        return svc if n_classes <= 2 else OneVsRest(classifier=svc, **common)
    if algorithm == "linear_regression":
        return LinearRegression(regParam=0.0, solver="normal", **common)
    if algorithm == "ridge_regression":
        return LinearRegression(regParam=float(p.get("alpha", 1.0)) * label_std / max(n_rows, 1),
                                elasticNetParam=0.0, standardization=False, solver="normal",
                                **common)
    raise ValueError(f"unknown algorithm {algorithm}")


def _least_leaf(p: dict) -> int:
    """MLlib bounds leaves, not the nodes that are split: a leaf of half of min_samples_split implies that bound."""
    return max(int(p.get("min_samples_leaf", 1)), -(-int(p.get("min_samples_split", 2)) // 2))


def random_trials(space: dict, n_trials: int, seed: int = SEED) -> list[dict]:
    """M12 (re-aimed from TPE): seeded random draws from the search space."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n_trials):
        t = {}
        for k, v in space.items():
            if isinstance(v, list):
                t[k] = rnd.choice(v)
            elif isinstance(v[0], int):
                t[k] = rnd.randint(v[0], v[1])
            else:
                t[k] = rnd.uniform(v[0], v[1])
        out.append(t)
    return out


def assemble(df: DataFrame, features: list[str], label: str) -> DataFrame:
    va = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    return va.transform(df).select("*", F.col(f"`{label}`").cast("double").alias("label")) \
        if label != "label" else va.transform(df)


def _search_scores(folded: DataFrame, features: list[str], algorithm: str, trials: list[dict],
                   n_classes: int, two_classes: bool = False) -> list[float]:
    """Scores of the trials from sufficient statistics; empty if the algorithm has none.

    ``two_classes``: the labels are 0 and 1, both of them and no other.
    """
    if algorithm in ("linear_regression", "ridge_regression"):
        moments = search.moments_by_fold(folded, features)
        scores = search.ridge_scores(moments, [float(t.get("alpha", 0.0)) for t in trials])
    elif algorithm == "logistic_regression" and n_classes <= 2:
        scores = search.logistic_scores(folded, features, [(float(t["C"]), t["penalty"]) for t in trials], 5)
    elif algorithm == "gradient_boosting" and two_classes:
        # what the estimators are built with
        ests = [build_estimator(algorithm, "classification", t, 0) for t in trials]
        scores = search.boosted_scores(folded, features, [(e.getMaxIter(), e.getMaxDepth(), e.getStepSize(), e.getSubsamplingRate())
                                                          for e in ests], 5, SEED)
    else:
        return []
    return [s if math.isfinite(s) else FAILED_TRIAL for s in scores]


def row_partitions(spark: SparkSession, rows: int) -> int:
    """Partitions for passes over ``rows``: one a core once each has LEAST_ROWS, then of ROWS_PER_PARTITION.

    However few files the input has: a file of some MB can hold millions of rows.
    """
    cores = spark.sparkContext.defaultParallelism
    return max(1, min(cores, math.ceil(rows / LEAST_ROWS)), math.ceil(rows / ROWS_PER_PARTITION))


def trials_at_once(spark: SparkSession, parts: int) -> int:
    """Trials whose jobs, of ``parts`` tasks each, keep every core busy while as many wait for the driver."""
    return max(4, 2 * spark.sparkContext.defaultParallelism // parts)


def _work(trial: dict) -> float:
    """What a trial costs beside others: trees times their depth."""
    return float(trial.get("n_estimators") or 1) * float(trial.get("max_depth") or 1)


@dataclass
class TrainResult:
    algorithm: str
    model: object
    params: dict
    cv_score: float | None
    predictions: DataFrame
    metrics: DataFrame
    feature_importance: list = field(default_factory=list)
    warning: str | None = None


def train_selected_model(df: DataFrame, features: list[str], label: str, key: str,
                         algorithm: str, problem_type: str, test_size: float = 0.2,
                         n_trials: int = 50, parallelism: int | None = None) -> TrainResult:
    """Split -> (tune by CV) -> fit -> predict train and test -> metrics.

    ``parallelism``: trials at a time, ``trials_at_once`` if not given.
    """
    from .metrics import metric_bundle
    cls = family(problem_type) == "classification"
    data = df.select(*[F.col(f"`{c}`") for c in features],
                     *([] if key in features else [F.col(f"`{key}`")]),
                     F.col(f"`{label}`").cast("double").alias("label"))
    counts = {r[0]: r[1] for r in data.groupBy("label").count().collect()} if cls else {}
    small_class = cls and any(v < 2 for v in counts.values())   # A19
    total = sum(counts.values()) if counts else data.count()
    split = train_test_split(data, key, test_size, stratify=None if (small_class or not cls)
                             else "label", rows_hint=total)
    # iterative MLlib fits launch one job per iteration over every partition
    parts = row_partitions(df.sparkSession, total)
    # each pass of a fit or search plans, keeps and logs all that its input was made by: the lineage is cut
    split = cut_lineage(VectorAssembler(inputCols=features, outputCol="features",
                                        handleInvalid="keep").transform(split).repartition(parts)) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    train = split.where(F.col("part") == "train")
    n_rows = train.count()
    n_classes = max(len(counts), 2)
    label_std = (train.agg(F.stddev_pop("label")).collect()[0][0] or 1.0) \
        if algorithm == "ridge_regression" else 1.0
    space = get_algorithms(problem_type).get(algorithm, {})
    best, cv_score, warning = {}, None, None
    if small_class:
        warning = "Used simple train-test split due to insufficient class samples"
    elif space and n_trials > 0:
        trials = random_trials(space, n_trials)
        folded = cut_lineage(assign_folds(train, key, 5, stratify="label" if cls else None,
                                          rows_hint=total).repartition(parts)) \
            .persist(StorageLevel.MEMORY_AND_DISK)
        scores = _search_scores(folded, features, algorithm, trials, n_classes, set(counts) == {0.0, 1.0})
        ests = [] if scores else [build_estimator(algorithm, problem_type, t, n_rows, n_classes,
                                label_std=label_std) for t in trials]
        ev = (MulticlassClassificationEvaluator(metricName="accuracy") if cls
              else RegressionEvaluator(metricName="r2"))

        def score(est):
            """A trial's mean score; one that fails scores FAILED_TRIAL and the search goes on."""
            try:
                cv = CrossValidator(estimator=est, estimatorParamMaps=[{}], evaluator=ev,
                                    numFolds=5, foldCol="fold", seed=SEED)
                s = cv.fit(folded).avgMetrics[0]
                return FAILED_TRIAL if math.isnan(s) else s
            except (PySparkException, Py4JJavaError):
                return FAILED_TRIAL

        # the folds are persisted once; the longest trials start first, so that none is left alone at the end
        if not scores:
            with ThreadPoolExecutor(parallelism or trials_at_once(df.sparkSession, parts)) as pool:
                started = {j: pool.submit(score, ests[j])
                           for j in sorted(range(len(trials)), key=lambda j: -_work(trials[j]))}
                scores = [started[j].result() for j in range(len(trials))]
        folded.unpersist()
        i = max(range(len(scores)), key=lambda j: scores[j])
        best, cv_score = trials[i], scores[i]
        if cv_score == FAILED_TRIAL:
            best, warning = {}, "Every trial failed; fitted with default parameters"
    model = build_estimator(algorithm, problem_type, best, n_rows, n_classes,
                            label_std=label_std).fit(train)
    pred = model.transform(split)
    out_cols = ["part", key, "label", F.col("prediction").cast("double").alias("prediction")]
    if cls and "probability" in pred.columns and n_classes == 2:
        # positive-class probability for ROC AUC (E03), JVM-side vector access
        out_cols.append(F.element_at(vector_to_array(F.col("probability")), 2).alias("score"))
    pred = pred.select(*out_cols)
    imp = []
    if hasattr(model, "featureImportances"):
        fi = model.featureImportances.toArray().tolist()
        imp = sorted(zip(features, fi), key=lambda x: x[1], reverse=True)   # E07/T04
    return TrainResult(algorithm, model, best, cv_score, pred,
                       metric_bundle(pred, problem_type), imp, warning)


def save_model(model, path: str) -> str:
    """MLlib persistence (shared storage path)."""
    PipelineModel(stages=[model]).write().overwrite().save(path)
    return path


@dataclass
class Bundle:
    """A fitted processor and model that score raw rows; one folder, complete once its manifest is there."""
    algorithm: str
    problem_type: str
    target: str
    processor: object
    model: object
    VERSION = 1

    def save(self, path: str) -> str:
        """Parts go to folders of their own names first; the manifest that names them is written last."""
        version = uuid.uuid4().hex
        parts = {"processor": f"{version}/processor", "model": f"{version}/model"}
        self.processor.save(f"{path}/{parts['processor']}")
        save_model(self.model, f"{path}/{parts['model']}")
        manifest = {"version": self.VERSION, "algorithm": self.algorithm, "problem_type": self.problem_type,
                    "target": self.target, "features": self.processor.selected, "parts": parts}
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(manifest),)], "manifest string").coalesce(1).write.mode("overwrite").text(
            f"{path}/manifest")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Bundle:
        from .features import FeatureProcessor
        m = json.loads(spark.read.text(f"{path}/manifest", wholetext=True).first()[0])
        if m["version"] != cls.VERSION:
            raise ValueError(f"a bundle of version {m['version']} cannot be read")
        return cls(m["algorithm"], m["problem_type"], m["target"],
                   FeatureProcessor.load(spark, f"{path}/{m['parts']['processor']}"),
                   PipelineModel.load(f"{path}/{m['parts']['model']}").stages[0])

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` columns and the prediction of every raw row."""
        x = self.processor.transform(df, keep=keep)
        va = VectorAssembler(inputCols=self.processor.selected, outputCol="features", handleInvalid="keep")
        return self.model.transform(va.transform(x)).select(*[F.col(f"`{c}`") for c in keep], "prediction")


# What each algorithm is, and when it is the one to choose.
DESCRIPTIONS = {
    "random_forest": ("Averages many decision trees grown on samples of rows and columns.",
                      "Mixed and noisy columns; little tuning needed."),
    "gradient_boosting": ("Adds small trees one by one, each fitted to what is still wrong.",
                          "Structured data with interactions, where accuracy counts most."),
    "logistic_regression": ("Linear model of the log-odds of each class.",
                            "Near-linear class borders, or coefficients that must be read."),
    "svm": ("Separates the classes by the widest linear margin.",
            "Many scaled columns and few rows."),
    "linear_regression": ("Least-squares line through the data.",
                          "A plain baseline for a numeric target."),
    "ridge_regression": ("Least squares with a penalty on large coefficients.",
                         "Correlated columns, where plain least squares is unstable."),
}


def deployment_info(evaluation: DataFrame, paths: dict[str, str]) -> DataFrame:
    """One row naming the model, its features, where its parts are kept, and its main metrics."""
    have = set(evaluation.columns)
    metric = lambda c, name: (F.col(c) if c in have else F.lit(None)).cast("double").alias(name)
    return evaluation.select(
        "model_name", "problem_type", F.col("features_used").alias("feature_names"),
        *[F.lit(v).alias(k) for k, v in paths.items()],
        F.struct(metric("accuracy", "accuracy"), metric("r2", "r2_score"), metric("f1", "f1_score"))
        .alias("performance_metrics"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("timestamp"))


def model_metadata(algorithm: str, problem_type: str, features: list[str], target: str) -> str:
    """Pre-training metadata as JSON text."""
    what, why = DESCRIPTIONS.get(algorithm, ("", ""))
    return json.dumps({"model_name": algorithm, "problem_type": problem_type,
                       "description": what, "reason_for_selection": why,
                       "feature_columns": features, "target_column": target,
                       "default_params": DEFAULT_PARAMS.get(algorithm, {})})

