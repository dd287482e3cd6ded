"""End-to-end AutoML (M14): load facts -> features -> algorithm -> train -> evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import features, metrics, models, policy
from ..session import cut_lineage


@dataclass
class AutoMLResult:
    problem_type: str
    algorithm: str
    selected_features: list
    train: models.TrainResult
    metrics: DataFrame
    evaluation: DataFrame


def run_automl(df: DataFrame, target: str, key: str, dataset_name: str = "",
               algorithm: str | None = None, n_trials: int = 50) -> AutoMLResult:
    """M14. ``key`` is a unique row key (splits and folds are hash-ordered by it).

    The rows and their encoded features are made once each: every pass over
    them would join again, and each join keeps its broadcast on the driver.
    """
    df = cut_lineage(df).persist(StorageLevel.MEMORY_AND_DISK)
    ptype = policy.problem_type_at_load(df, dataset_name, target)          # R16
    fp = features.FeatureProcessor(ptype)
    x = df.drop(key) if key != target else df
    fp.fit_transform(x.select(*[c for c in x.columns if c != target], target), target)   # F10
    keyed = fp.transform(df, keep=[key, target])                                         # F11
    if fp.label_map is not None:
        keyed = features.apply_label_encoders(keyed, fp.label_map, [target],
                                              features.encoder_sizes(fp.label_map))
    keyed = cut_lineage(keyed).persist(StorageLevel.MEMORY_AND_DISK)
    n_rows = df.count()
    df.unpersist()
    algo = algorithm or policy.choose_algorithm(ptype, n_rows, len(fp.selected))   # R18
    res = models.train_selected_model(keyed, fp.selected, target, key, algo, ptype,
                                      n_trials=n_trials)                      # M13
    keyed.unpersist()
    test = res.predictions.where(F.col("part") == "test")
    ev = metrics.evaluation_report(test, ptype, key)                          # E08
    return AutoMLResult(ptype, algo, fp.selected, res, res.metrics, ev)
