import datetime as dt

import pytest
from pyspark.sql import functions as F

from depthmill.operators import monitor as M
from depthmill.operators import quality as C

NOON = dt.datetime(2024, 1, 1, 12)


def minute(n, seconds=0):
    return NOON + dt.timedelta(minutes=n, seconds=seconds)


def test_every_check_finds_its_violation(spark, folder):
    rows = [("a", 1, 2.0, "up"), ("a", 1, -1.0, "sideways"), (None, 2, 0.5, None), ("b", 3, None, "down")]
    df = spark.createDataFrame(rows, "k string, n int, x double, d string")
    checks = [
        C.not_null("k"),
        C.non_negative("x"),
        C.accepted_values("d", ["up", "down"]),
        C.in_range("x", 0.0, 1.0),
        C.null_only_when("x", F.col("n") == 2),
        C.unique("n"),
        C.unique_combination(["k", "n"]),
        C.min_rows(6),
        C.not_empty(),
        C.required_columns(["k", "missing"]),
        C.has_data_files(),
    ]
    report = {r.check: (r.failed_rows, r.status) for r in C.run_checks(df, checks, "t").collect()}
    assert report == {
        "not_null(k)": (1, "fail"),
        "non_negative(x)": (1, "fail"),
        "accepted_values(d)": (2, "fail"),
        "in_range(x)": (2, "fail"),
        "null_only_when(x)": (2, "fail"),
        "unique(n)": (1, "fail"),
        "unique(k, n)": (1, "fail"),
        "min_rows(6)": (2, "fail"),
        "not_empty": (0, "pass"),
        "required_columns": (1, "fail"),
        "has_data_files": (1, "fail"),
    }
    assert C.failures(C.run_checks(df, checks, "t")).count() == 10
    df.write.parquet(folder + "/t")
    stored = C.run_checks(spark.read.parquet(folder + "/t"), [C.has_data_files()], "t")
    assert stored.first().status == "pass"
    assert C.run_checks(df.limit(0), [C.not_empty()], "t").first().failed_rows == 1


def test_row_checks_share_one_scan(spark, folder):
    spark.range(5).select(F.col("id").alias("a"), F.col("id").alias("b")).write.parquet(folder + "/t")
    df = spark.read.parquet(folder + "/t")
    rows = [C.not_null("a"), C.non_negative("b"), C.in_range("a", 0, 9)]
    for checks in (rows, [*rows, C.unique("a"), C.unique_combination(["a", "b"]), C.not_empty(), C.min_rows(9), C.required_columns(["a"]), C.has_data_files()]):
        report = C.run_checks(df, checks, "t")
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and plan.count("Exchange") <= 2
        assert [r.check for r in report.collect()] == [c.name for c in checks]
        assert {r.check: r.failed_rows for r in report.collect() if r.failed_rows} == ({} if checks is rows else {"min_rows(9)": 4})


def log(spark, directions, start=0):
    rows = [(minute(start + i), "X", d, 0.9, 0.9 if d == "up" else 0.1) for i, d in enumerate(directions)]
    return spark.createDataFrame(rows, "ts timestamp, symbol string, prediction string, confidence double, probability double")


@pytest.mark.parametrize(
    "directions, status, up",
    [(["up"] * 81 + ["down"] * 19, "drift_detected", 0.81), (["up"] * 80 + ["down"] * 20, "ok", 0.8), (["down"] * 3, "drift_detected", 0.0),
     (["up"] * 500 + ["up", "down"] * 50, "ok", 0.5), ([], "no_data", None)],
)
def test_drift(spark, directions, status, up):
    row = M.drift(log(spark, directions)).first()
    assert (row.status, row.up_ratio) == (status, up) and row.total_predictions == min(len(directions), 100)


def test_drift_by_symbol(spark):
    both = log(spark, ["up"] * 120).unionByName(log(spark, ["up", "down"]).withColumn("symbol", F.lit("Y")))
    rows = {r.symbol: (r.status, r.total_predictions) for r in M.drift(both, by="symbol").collect()}
    assert rows == {"X": ("drift_detected", 100), "Y": ("ok", 2)}


def test_counters(spark):
    df = log(spark, ["up", "down", "up"]).withColumn("confidence", F.when(F.col("prediction") == "up", 0.5).otherwise(0.96))
    assert {r.prediction: r.predictions for r in M.predictions_by_direction(df).collect()} == {"up": 2, "down": 1}
    buckets = {r.le: r.observations for r in M.confidence_histogram(df).collect()}
    assert buckets == {"0.5": 2, "0.6": 2, "0.7": 2, "0.8": 2, "0.9": 2, "0.95": 2, "0.99": 3, "1.0": 3, "+Inf": 3}
    assert M.prediction_rate(df).count() == 3 and M.prediction_rate(df, "1 hour").count() == 2
    assert M.predictions_of(df, "up").count() == 2


def test_freshness_adds_both_lags(spark):
    ticks = spark.createDataFrame([("X", minute(0)), ("X", minute(1))], "symbol string, event_ts timestamp")
    bars = spark.createDataFrame([("X", minute(0)), ("Y", minute(0))], "symbol string, window_start timestamp")
    rows = {r.symbol: r for r in M.freshness(ticks, bars, F.lit(minute(2))).collect()}
    assert (rows["X"].tick_lag_seconds, rows["X"].gold_lag_seconds, rows["X"].total_lag_seconds) == (60.0, 120.0, 180.0)
    assert rows["Y"].tick_lag_seconds is None and rows["Y"].total_lag_seconds is None


def test_stalls_match_a_minute_by_minute_watch(spark):
    heard = [0, 1, 5, 6, 9, 13, 700, 1500, 1504]
    offsets = {m: 10 * i for i, m in enumerate(heard)}
    ticks = spark.createDataFrame([("X", minute(m, 5), offsets[m]) for m in heard], "symbol string, event_ts timestamp, last_update_id long")
    active = M.activity(ticks)
    failures, alerts, runs = 0, [], []
    for m in range(heard[0], heard[-1] + 1):
        if m in offsets:
            if failures >= 3:
                runs.append((minute(m), failures))
            failures = 0
        else:
            failures += 1
            if failures >= 3:
                alerts.append((minute(m + 1), failures))
    found = M.stall_runs(active)
    assert sorted((r.recovered_at, r.consecutive_failures) for r in found.collect()) == runs
    got = M.stall_alerts(found).collect()
    assert sorted((r.ts, r.consecutive_failures) for r in got) == alerts
    assert all(r.message == f"kafka is silent: nothing new in {r.consecutive_failures} checks" for r in got)
    growth = [r.new_messages for r in M.offset_growth(active).orderBy("window_start").collect()]
    assert growth == [None] + [10] * (len(heard) - 1)


def test_running_silence_is_a_run(spark):
    ticks = spark.createDataFrame(
        [("A", minute(0), 1), ("A", minute(1), 2), ("B", minute(0), 1), ("B", minute(540), 2)], "symbol string, event_ts timestamp, last_update_id long"
    )
    found = M.stall_runs(M.activity(ticks), now=F.lit(minute(540)))
    assert sorted((r.symbol, r.stall_start, r.recovered_at, r.consecutive_failures) for r in found.collect()) == [
        ("A", minute(2), None, 538),
        ("B", minute(1), minute(540), 539),
    ]
