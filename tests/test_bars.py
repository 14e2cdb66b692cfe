import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from depthmill.operators import bars as B

SCHEMA = (
    "symbol string, event_ts timestamp, last_update_id long, mid_price double, spread_bps double, order_imbalance double,"
    " bid_depth_total double, ask_depth_total double"
)


def at(minute, second=0, ms=0):
    return dt.datetime(2024, 1, 1, 0, minute, second, ms * 1000)


def ticks(spark, *rows):
    return spark.createDataFrame([("X", t, i, m, s, o, b, a) for t, i, m, s, o, b, a in rows], SCHEMA)


def test_one_bar(spark):
    df = ticks(
        spark,
        (at(0, 5), 1, 10.0, 3.0, 0.5, 2.0, 4.0),
        (at(0, 1), 2, 12.0, 1.0, None, None, 4.0),
        (at(0, 9), 3, 11.0, 2.0, -0.5, 1.0, 1.0),
        (at(1, 0), 4, 20.0, 5.0, 0.0, 1.0, 1.0),
    )
    first, second = B.depth_bars(df).orderBy("window_start").collect()
    assert (first.window_start, first.window_end, first.update_count) == (at(0), at(1), 3)
    assert (first.mid_price_open, first.mid_price_close, first.mid_price_change) == (12.0, 11.0, -1.0)
    assert first.mid_price_avg == 11.0 and first.mid_price_stddev == pytest.approx(statistics.stdev([10, 12, 11]))
    assert first.vwap == pytest.approx((10 * 6 + 11 * 2) / 8)
    assert (first.spread_bps_avg, first.spread_bps_min, first.imbalance_avg) == (2.0, 1.0, 0.0)
    assert (first.bid_depth_avg, first.ask_depth_avg, first.depth_ratio) == (1.5, 3.0, 0.5)
    assert second.mid_price_stddev is None and second.mid_price_open == second.mid_price_close == 20.0


@pytest.mark.parametrize("wide", [False, True])
def test_ties_in_time_are_broken_by_update_id(spark, wide):
    rows = [(at(0, 5, 7), i, float(i), 1.0, 0.0, 1.0, 1.0) for i in (9, 3, 7, 1 << 40)]
    (bar,) = B.depth_bars(ticks(spark, *rows), "60 minutes", wide_ids=wide).collect()
    assert (bar.mid_price_open, bar.mid_price_close) == (3.0, float(1 << 40))


def test_time_beats_update_id(spark):
    rows = [(at(0, 5), 100, 1.0, 1.0, 0.0, 1.0, 1.0), (at(0, 4), 200, 2.0, 1.0, 0.0, 1.0, 1.0)]
    for wide in (False, True):
        (bar,) = B.depth_bars(ticks(spark, *rows), wide_ids=wide).collect()
        assert (bar.mid_price_open, bar.mid_price_close) == (2.0, 1.0)


def test_null_mid_never_opens_or_closes(spark):
    rows = [(at(0, 1), 1, None, None, 0.0, 1.0, 1.0), (at(0, 2), 2, 5.0, 1.0, 0.0, 1.0, 1.0), (at(0, 3), 3, None, None, 0.0, 1.0, 1.0)]
    (bar,) = B.depth_bars(ticks(spark, *rows)).collect()
    assert (bar.mid_price_open, bar.mid_price_close, bar.update_count) == (5.0, 5.0, 3)


def test_an_id_that_does_not_fit_stops_the_job(spark):
    rows = [(at(0, 1), 1 << 62, 1.0, 1.0, 0.0, 1.0, 1.0)]
    with pytest.raises(Exception, match="wide_ids"):
        B.depth_bars(ticks(spark, *rows)).collect()
    (bar,) = B.depth_bars(ticks(spark, *rows), wide_ids=True).collect()
    assert bar.mid_price_open == 1.0


def test_vwap_null_without_depth(spark):
    (bar,) = B.depth_bars(ticks(spark, (at(0), 1, 1.0, 1.0, 0.0, None, 1.0))).collect()
    assert bar.vwap is None and bar.depth_ratio is None


def test_odd_widths_use_the_contract_origin(spark):
    start = dt.datetime(2000, 1, 3)
    df = ticks(spark, (dt.datetime(2024, 1, 1, 0, 5), 1, 1.0, 1.0, 0.0, 1.0, 1.0))
    (bar,) = B.depth_bars(df, "37 minutes").collect()
    assert (bar.window_start - start) % dt.timedelta(minutes=37) == dt.timedelta(0)


def test_bars_stay_a_hash_aggregation(spark):
    for df in (
        B.depth_bars(ticks(spark, (at(0), 1, 1.0, 1.0, 0.0, 1.0, 1.0))),
        B.depth_bars(ticks(spark, (at(0), 1, 1.0, 1.0, 0.0, 1.0, 1.0)), wide_ids=True),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and plan.count("Exchange") == 1


def test_top_of_book_variant(spark):
    schema = (
        "symbol string, event_ts timestamp, best_bid_price double, best_ask_price double, best_bid_qty double,"
        " best_ask_qty double, bid_count int, ask_count int"
    )
    rows = [("X", at(0, 1), 9.0, 11.0, 1.0, 3.0, 2, 4), ("X", at(0, 2), 11.0, 9.0, 2.0, 0.0, 1, 0), ("X", at(0, 3), None, 9.0, 2.0, 0.0, 1, 0)]
    (bar,) = B.top_bars(spark.createDataFrame(rows, schema)).collect()
    assert bar.tick_count == 2 and bar.mid_price_avg == 10.0 and bar.spread_avg == 0.0
    assert bar.imbalance_avg == pytest.approx((-0.5 + 1.0) / 2) and bar.depth_ratio == 0.5 and bar.vwap == 10.0


def test_series_of_text_times(spark):
    df = spark.createDataFrame([("X", "2024-01-01 00:01:00", 1.0, 2.0, 3.0, 4.0)],
                               "symbol string, window_start string, mid_price_avg double, spread_bps_avg double, imbalance_avg double, depth_ratio double")
    rows = B.metric_series(df).collect()
    assert {r.metric: r.value for r in rows} == {"mid_price_avg": 1.0, "spread_bps_avg": 2.0, "imbalance_avg": 3.0, "depth_ratio": 4.0}
    assert rows[0].window_start == at(1)


def test_no_rows(spark):
    assert B.depth_bars(ticks(spark, (at(0), 1, 1.0, 1.0, 0.0, 1.0, 1.0)).where(F.lit(False))).count() == 0
