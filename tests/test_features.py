import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from depthmill.constants import FEATURE_COLS
from depthmill.operators import features as X

START = pd.Timestamp("2024-01-01 23:40:00")
NUMBERS = ["mid_price_avg", "vwap", "spread_bps_avg", "imbalance_avg", "depth_ratio"]


def bars(spark, seed=0, symbols=("A", "B"), minutes=400, with_nulls=True):
    rng = np.random.default_rng(seed)
    parts = []
    for symbol in symbols:
        kept = np.sort(rng.choice(minutes, size=minutes * 3 // 4, replace=False))
        part = pd.DataFrame({"symbol": symbol, "window_start": START + pd.to_timedelta(kept, unit="min")})
        for name in NUMBERS:
            part[name] = rng.normal(100, 5, len(part)).round(4)
            if with_nulls:
                part.loc[rng.random(len(part)) < 0.03, name] = np.nan
        parts.append(part)
    pdf = pd.concat(parts).reset_index(drop=True)
    records = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in row) for row in pdf.itertuples(index=False)]
    schema = "symbol string, window_start timestamp, " + ", ".join(f"{c} double" for c in NUMBERS)
    return spark.createDataFrame([(r[0], r[1].to_pydatetime(), *r[2:]) for r in records], schema).repartition(4), pdf


def pandas_features(part):
    out = part.copy()
    out["spread_change"] = out.spread_bps_avg.diff()
    out["imbalance_change"] = out.imbalance_avg.diff()
    out["vwap_vs_mid"] = (out.vwap - out.mid_price_avg) / out.mid_price_avg
    out["rolling_spread_mean"] = out.spread_bps_avg.rolling(5).mean()
    out["rolling_imbalance_std"] = out.imbalance_avg.rolling(5).std()
    return out


def pandas_training(part, horizon=5):
    out = pandas_features(part).dropna()
    future = out.mid_price_avg.shift(-horizon)
    out["label"] = (future > out.mid_price_avg).astype(int)
    return out[future.notna()]


def same(df, expected, columns):
    got = df.select("symbol", "window_start", *columns).toPandas().sort_values(["symbol", "window_start"]).reset_index(drop=True)
    want = expected.sort_values(["symbol", "window_start"]).reset_index(drop=True)[["symbol", "window_start", *columns]]
    assert len(got) == len(want)
    assert (got.symbol.values == want.symbol.values).all() and (got.window_start.values == want.window_start.values).all()
    for c in columns:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-9)


def per_symbol(pdf, fn):
    return pd.concat([fn(part) for _, part in pdf.groupby("symbol")])


@pytest.mark.parametrize("slice_by", [None, "hour", "minute"])
def test_features_match_pandas(spark, slice_by):
    df, pdf = bars(spark)
    cut = None if slice_by is None else F.date_trunc(slice_by, "window_start")
    same(X.add_features(df, slice_by=cut), per_symbol(pdf, pandas_features), FEATURE_COLS)


@pytest.mark.parametrize("slice_by", [None, "hour", "minute"])
def test_training_set_matches_pandas(spark, slice_by):
    df, pdf = bars(spark, 3)
    cut = None if slice_by is None else F.date_trunc(slice_by, "window_start")
    same(X.training_set(df, every_column=True, slice_by=cut), per_symbol(pdf, pandas_training), [*FEATURE_COLS, "label"])


def test_partial_frames(spark):
    df, _ = bars(spark, 1, symbols=("A",), minutes=8, with_nulls=False)
    short, full = X.add_features(df, partial=True), X.add_features(df)
    assert short.where(F.col("rolling_spread_mean").isNull()).count() == 0
    assert full.where(F.col("rolling_spread_mean").isNull()).count() == 4


def test_labels_tail_and_flat_price(spark):
    rows = [("A", (START + pd.Timedelta(minutes=i)).to_pydatetime(), 5.0) for i in range(8)]
    df = spark.createDataFrame(rows, "symbol string, window_start timestamp, mid_price_avg double")
    labelled = [r.label for r in X.add_label(df).orderBy("window_start").collect()]
    assert labelled == [0, 0, 0] + [None] * 5
    assert X.create_labels(df).count() == 3
    assert X.create_labels(df, horizon=7).count() == 1


def test_labels_by_minutes_need_that_very_bar(spark):
    times = [0, 1, 2, 5, 6]
    rows = [("A", (START + pd.Timedelta(minutes=m)).to_pydatetime(), float(m)) for m in times]
    df = spark.createDataFrame(rows, "symbol string, window_start timestamp, mid_price_avg double")
    got = {r.mid_price_avg: r.label for r in X.add_label(df, 5, mode="minutes").collect()}
    assert got == {0.0: 1, 1.0: 1, 2.0: None, 5.0: None, 6.0: None}


def test_gold_features_keep_every_bar(spark):
    df, pdf = bars(spark, 7)
    gold = X.gold_features(df, slice_by=F.date_trunc("hour", "window_start"))
    assert gold.count() == len(pdf)
    assert gold.where(F.col("label").isNull()).count() >= 10

    def twin(part):
        out = part.copy()
        out["vwap_vs_mid"] = (out.vwap - out.mid_price_avg) / out.mid_price_avg * 10000
        out["rolling_spread_mean"] = out.spread_bps_avg.rolling(5, min_periods=1).mean()
        out["rolling_imbalance_std"] = out.imbalance_avg.rolling(5, min_periods=1).std()
        return out

    same(gold, per_symbol(pdf, twin), ["vwap_vs_mid", "rolling_spread_mean", "rolling_imbalance_std"])


@pytest.mark.parametrize("fraction", [0.2, 0.5, 0.01, 0.99])
def test_split_equals_positional_cut(spark, fraction):
    df, pdf = bars(spark, 4, symbols=("A", "B", "C"), minutes=97)
    ordered = pdf.sort_values(["window_start", "symbol"]).reset_index(drop=True)
    cut = int(len(ordered) * (1 - fraction))
    train, test = X.time_split(df, fraction)
    def key(frame):
        return sorted((r.symbol, pd.Timestamp(r.window_start)) for r in frame.collect())
    assert key(train) == sorted(zip(ordered.symbol[:cut], ordered.window_start[:cut]))
    assert key(test) == sorted(zip(ordered.symbol[cut:], ordered.window_start[cut:]))


def test_split_moves_no_rows(spark):
    df, _ = bars(spark, 4)
    boundary = spark.range(1).select(
        F.struct(F.lit(dt.datetime(2024, 1, 2)).alias("at"), F.lit("A").alias("last_train")).alias("boundary")
    )
    plan = X.mark_split(df, boundary=boundary)
    main = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in main and "Window" not in main and "Sort" not in main


def test_minimum_rows(spark):
    df, _ = bars(spark, 1, minutes=60)
    with pytest.raises(ValueError, match="at least 100"):
        X.require_rows(df.limit(99))
    assert X.require_rows(df.limit(80), 80).count() == 80


def test_scoring_rows_reach_the_newest_bar(spark):
    df, pdf = bars(spark, 2, with_nulls=False)
    newest = {s: part.window_start.max() for s, part in pdf.groupby("symbol")}
    latest = X.latest_per_symbol(X.features_for_scoring(df)).collect()
    assert {r.symbol: pd.Timestamp(r.window_start) for r in latest} == newest
    trailing = X.latest_per_symbol(X.training_set(df)).collect()
    assert all(pd.Timestamp(r.window_start) < newest[r.symbol] for r in trailing)


def test_positions_and_ends(spark):
    df, pdf = bars(spark, 9)
    numbered = X.numbered(df, slice_by=F.date_trunc("hour", "window_start")).toPandas()
    for _, part in numbered.groupby("symbol"):
        assert part.sort_values("window_start").row_index.tolist() == list(range(len(part)))
    assert [r.window_start for r in X.newest(df, 3).collect()] == sorted([r.window_start for r in df.collect()], reverse=True)[:3]
    assert "TakeOrderedAndProject" in X.newest(df, 3)._jdf.queryExecution().executedPlan().toString()
    assert X.oldest(df, 5).count() == 5 and X.in_time_order(df).count() == len(pdf)
