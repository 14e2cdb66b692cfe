"""Train, evaluate, publish, score, and retrain when predictions drift."""

import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthmill.constants import MODEL_GATE_AUC, MODEL_VERSION
from depthmill.operators import evaluation as E
from depthmill.operators import features as X
from depthmill.operators import model as M
from depthmill.operators.monitor import drift
from depthmill.session import written
from depthmill.sources.writers import append_log


@dataclass
class Trained:
    model: PipelineModel
    metrics: DataFrame
    default_metrics: DataFrame
    description: DataFrame
    test: DataFrame
    scored: DataFrame


def train_and_evaluate(bars: DataFrame, every_column: bool = False, version: str = MODEL_VERSION, **boosting) -> Trained:
    """Training set of bars, then `fit_and_evaluate`."""
    return fit_and_evaluate(X.training_set(bars, every_column=every_column), version, **boosting)


def fit_and_evaluate(labelled: DataFrame, version: str = MODEL_VERSION, **boosting) -> Trained:
    """Time split, fit on the past, threshold and metrics on the rest.

    The labelled rows and the scored test rows are written once: several passes read each of them.
    """
    rows = written(labelled, "training")
    X.require_rows(rows)
    boundary = written(X.split_boundary(rows), "boundary")
    marked = X.mark_split(rows, boundary=boundary)
    train, test = marked.where(~F.col("is_test")), marked.where(F.col("is_test"))
    model = M.fit_classifier(train, **boosting)
    scored = written(M.add_score(test, model).select("symbol", "window_start", "label", "score"), "scored")
    threshold = written(E.best_threshold(E.roc_points(scored)), "threshold")
    metrics = written(E.evaluate(scored, threshold.select("threshold").scalar()), "metrics")
    default = E.evaluate(scored, 0.5)
    described = M.metadata(metrics, threshold, train, boundary, version)
    return Trained(model, metrics, default, written(described, "description"), test, scored)


def save(trained: Trained, folder: str, version: str) -> str:
    """Model and description under a new folder; nothing existing is touched."""
    path = f"{folder}/models/{version}-{uuid.uuid4().hex}"
    trained.model.save(f"{path}/model")
    trained.description.write.json(f"{path}/description")
    return path


def publish(spark: SparkSession, folder: str, path: str) -> None:
    """Make a saved model the current one by appending to the pointer table: readers see old or new."""
    row = spark.range(1).select(F.current_timestamp().alias("published_at"), F.lit(path).alias("path"))
    append_log(row, f"{folder}/current_model")


def current_path(spark: SparkSession, folder: str) -> str:
    pointers = spark.read.schema("published_at timestamp, path string").parquet(f"{folder}/current_model")
    return pointers.agg(F.max_by("path", "published_at").alias("path")).first()["path"]


def load(spark: SparkSession, path: str) -> tuple[PipelineModel, float]:
    model = PipelineModel.load(f"{path}/model")
    # Declared: a model that never beat chance has no threshold, and JSON leaves a NULL out.
    return model, spark.read.schema("optimal_threshold double").json(f"{path}/description").first()["optimal_threshold"]


def score_latest(bars: DataFrame, model: PipelineModel, threshold: float, lag_labels: bool = False) -> DataFrame:
    """Answer for the newest complete bar of each symbol.

    `lag_labels` scores the newest *labelled* bar instead, which trails by the label horizon.
    """
    rows = X.training_set(bars) if lag_labels else X.features_for_scoring(bars)
    return M.predictions(X.latest_per_symbol(rows), model, threshold)


def scoring_batches(model: PipelineModel, threshold: float, log_path: str):
    """`foreachBatch` writer: score each micro-batch of feature rows; a retried batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = M.log_rows(M.predictions(batch, model, threshold))
        rows.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")

    return write


def retrain_if_drifted(
    bars: DataFrame, log: DataFrame, folder: str, version: str = MODEL_VERSION, minimum_auc: float = MODEL_GATE_AUC, **boosting
) -> str:
    """Drift check, then train and evaluate; only a model that passes `acceptance` is published."""
    status = drift(log).first()["status"]
    if status != "drift_detected":
        return "skipped"
    trained = train_and_evaluate(bars, version=version, **boosting)
    path = save(trained, folder, version)
    append_log(M.run_record(path.rsplit("/", 1)[1], {**M.BOOSTING, **boosting}, trained.metrics), f"{folder}/model_runs")
    if not M.acceptance(trained.description, minimum_auc).first()["accepted"]:
        return "rejected"
    publish(bars.sparkSession, folder, path)
    return "retrained"
