import datetime as dt

import pytest
from pyspark.sql import functions as F

from depthmill.operators import model as M
from depthmill.plans import adapters as A
from depthmill.plans import catalog, training
from depthmill.sources import readers as R
from depthmill.sources.writers import append_log


@pytest.fixture(scope="module")
def bars(spark):
    return catalog.hourly(A.events(spark, "/root/testdata/sf0.01"))


@pytest.fixture(scope="module")
def trained(bars):
    return training.train_and_evaluate(bars, maxIter=5)


def test_defaults_are_the_published_ones():
    assert M.BOOSTING == {"maxIter": 200, "stepSize": 0.05, "maxDepth": 5, "minInstancesPerNode": 10, "seed": 42}


def test_description_and_gate(trained):
    row = trained.description.first()
    assert M.missing_keys(trained.description) == []
    assert row.trained_on_rows == 2354 or row.trained_on_rows > 2000
    assert set(row.test_metrics) == {"accuracy", "precision", "recall", "f1", "roc_auc"}
    assert row.split_boundary["at"] is not None
    assert M.acceptance(trained.description).first().accepted == (row.test_metrics["roc_auc"] > 0.70)
    assert M.acceptance(trained.description, 0.999).first().accepted is False
    other = trained.description.withColumn("feature_cols", F.array(F.lit("vwap")))
    assert M.acceptance(other, 0.0).first().accepted is False
    assert M.missing_keys(trained.description.drop("model_version")) == ["model_version"]


def test_score_save_load_log(spark, bars, trained, folder):
    path = training.save(trained, folder, "v1")
    training.publish(spark, folder, path)
    assert training.current_path(spark, folder) == path
    model, threshold = training.load(spark, path)
    assert threshold == pytest.approx(trained.description.first().optimal_threshold)
    answers = training.score_latest(bars, model, threshold)
    for row in answers.collect():
        assert row.prediction == ("up" if row.probability >= round(threshold, 4) else "down")
        assert row.confidence == pytest.approx(row.probability if row.prediction == "up" else 1 - row.probability, abs=2e-4)
        assert set(row.features_used) == set(M.FEATURE_COLS)
    log = f"{folder}/log"
    append_log(M.log_rows(answers), log)
    append_log(M.log_rows(training.score_latest(bars, model, threshold, lag_labels=True)), log)
    assert R.prediction_log(spark, log).count() == 10


def test_scoring_batches_may_repeat(spark, bars, trained, folder):
    from depthmill.operators import features as X

    write = training.scoring_batches(trained.model, 0.5, folder + "/log")
    rows = X.latest_per_symbol(X.features_for_scoring(bars))
    write(rows, 0)
    write(rows, 0)
    assert spark.read.parquet(folder + "/log").count() == 5


def test_retrain_only_on_drift(spark, bars, folder):
    def log(directions):
        data = [(dt.datetime(2024, 1, 1, 0, i), "X", d, 0.9, 0.9) for i, d in enumerate(directions)]
        return spark.createDataFrame(data, "ts timestamp, symbol string, prediction string, confidence double, probability double")

    assert training.retrain_if_drifted(bars, log(["up", "down"]), folder) == "skipped"
    assert training.retrain_if_drifted(bars, log(["up"] * 10), folder, minimum_auc=1.0, maxIter=2) == "rejected"
    folder += "/second"
    assert training.retrain_if_drifted(bars, log(["up"] * 10), folder, minimum_auc=0.0, maxIter=2) == "retrained"
    runs = spark.read.parquet(folder + "/model_runs").first()
    assert runs.params["maxIter"] == "2" and "roc_auc" in runs.metrics
    assert training.current_path(spark, folder).endswith(runs.run_id)


def test_too_few_rows(spark, bars):
    with pytest.raises(ValueError, match="at least 100"):
        training.train_and_evaluate(bars.where(F.col("window_start") < "2024-01-01 12:00:00"))
