"""Direction classifier: fit, score, describe, log, gate."""

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthmill.constants import (
    FEATURE_COLS,
    LABEL_HORIZON,
    METADATA_REQUIRED_KEYS,
    MODEL_GATE_AUC,
    MODEL_VERSION,
    PREDICTION_TARGET,
)
from depthmill.functions import scoring as S
from depthmill.session import work_root

# The published hyperparameters, under the names of the boosted-tree learner used here.
# 31 leaves fit in a tree of depth 5.
BOOSTING = {"maxIter": 200, "stepSize": 0.05, "maxDepth": 5, "minInstancesPerNode": 10, "seed": 42}


def fit_classifier(train: DataFrame, features: Sequence[str] = tuple(FEATURE_COLS), **overrides) -> PipelineModel:
    """Boosted trees on the feature columns; trees grow over the distributed rows.

    Iterations are checkpointed to the cluster's shared folder, so lineage stays short.
    """
    train.sparkSession.sparkContext.setCheckpointDir(work_root(train.sparkSession))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    trees = GBTClassifier(featuresCol="features", labelCol="label", checkpointInterval=10, **{**BOOSTING, **overrides})
    return Pipeline(stages=[assembler, trees]).fit(train.select(*features, F.col("label").cast("double").alias("label")))


def add_score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Probability of a rise as `score`; all input columns stay."""
    scored = model.transform(df).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*df.columns, "score")


def predictions(df: DataFrame, model: PipelineModel, threshold: float | Column, time: Column | None = None) -> DataFrame:
    """Full answer per row: direction, confidence, probability, threshold and the features behind it."""
    at = F.lit(threshold) if isinstance(threshold, float) else threshold
    scored = add_score(df, model).withColumn("prediction", S.direction(F.col("score"), at))
    return scored.select(
        "symbol",
        "window_start",
        "prediction",
        S.rounded(S.confidence(F.col("score"), F.col("prediction")), 4).alias("confidence"),
        S.rounded(F.col("score"), 4).alias("probability"),
        S.rounded(at, 4).alias("threshold"),
        (time if time is not None else F.current_timestamp()).alias("ts"),
        S.feature_map(FEATURE_COLS).alias("features_used"),
    )


def log_rows(answers: DataFrame) -> DataFrame:
    """The part of an answer that goes to the prediction log."""
    return answers.select("ts", "symbol", "prediction", "confidence", "probability")


def metadata(
    metrics: DataFrame,
    threshold: DataFrame,
    trained_on: DataFrame,
    boundary: DataFrame,
    version: str = MODEL_VERSION,
    horizon: int = LABEL_HORIZON,
) -> DataFrame:
    """One row describing a model: threshold, rounded metrics, feature list, row count and time cut."""
    names = metrics.columns
    rounded = F.create_map(*[part for n in names for part in (F.lit(n), S.rounded(F.col(n), 4))])
    return (
        metrics.select(rounded.alias("test_metrics"))
        .withColumns(
            {
                "model_version": F.lit(version),
                "prediction_target": F.lit(PREDICTION_TARGET),
                "label_horizon": F.lit(horizon),
                "feature_cols": F.array(*[F.lit(c) for c in FEATURE_COLS]),
                "optimal_threshold": threshold.select("threshold").scalar(),
                "trained_on_rows": trained_on.agg(F.count(F.lit(1))).scalar(),
                "split_boundary": boundary.scalar(),
            }
        )
    )


def missing_keys(description: DataFrame) -> list[str]:
    return sorted(set(METADATA_REQUIRED_KEYS) - set(description.columns))


def acceptance(description: DataFrame, minimum_auc: float = MODEL_GATE_AUC) -> DataFrame:
    """Gate on AUC and on an unchanged feature list."""
    auc = F.col("test_metrics")["roc_auc"]
    same = F.col("feature_cols") == F.array(*[F.lit(c) for c in FEATURE_COLS])
    return description.select(
        "model_version", auc.alias("roc_auc"), same.alias("features_match"), (F.coalesce(auc > minimum_auc, F.lit(False)) & same).alias("accepted")
    )


def run_record(run_id: str, parameters: dict, metrics: DataFrame) -> DataFrame:
    """Parameters and metrics of one training run as maps, for an append-only run table."""
    given = [part for k, v in parameters.items() for part in (F.lit(k), F.lit(str(v)))]
    measured = [part for n in metrics.columns for part in (F.lit(n), F.col(n))]
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("ts"),
        F.create_map(*given).alias("params"),
        F.create_map(*measured).alias("metrics"),
    )
