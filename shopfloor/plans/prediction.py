"""Failure prediction from the seed file: checks, training, scores and the metrics table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shopfloor.operators import learning
from shopfloor.session import stage
from shopfloor.sources import files

RUN_NAME = "predictive_maintenance_rf"


@dataclass(frozen=True)
class Report:
    balance: DataFrame
    duplicates: DataFrame
    metrics: DataFrame
    importances: DataFrame
    predictions: DataFrame


def predict_failures(
    spark: SparkSession,
    seed_csv: str,
    metrics_path: str | None = None,
    params: learning.ForestParams = learning.ForestParams(),
    folds: int = 5,
) -> Report:
    """Train on the file's own readings and score the held-out quarter."""
    seed = files.read_seed_csv(spark, seed_csv)
    frame = stage(learning.training_frame(seed, learning.FEATURES, "machine_failure", ["udi"]), "training")
    trained = learning.train_and_score(frame, learning.FEATURES, ["udi"], params)
    scores = learning.cross_validate(frame, learning.FEATURES, ["udi"], folds, params)
    metrics = learning.metrics_table(spark, RUN_NAME, trained.predictions, scores)
    if metrics_path:
        metrics.write.mode("append").parquet(metrics_path)
    return Report(
        learning.class_balance(frame),
        learning.duplicate_audit(frame.drop("udi")),
        metrics,
        learning.importances(trained.model, spark, learning.FEATURES),
        trained.predictions,
    )
