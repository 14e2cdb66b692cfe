"""Tumbling bars of any width, from ticks."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthmill.constants import BUCKET_ORIGIN_SECONDS
from depthmill.functions import quotes as Q

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def width_seconds(width: str) -> int:
    count, unit = width.split()
    return int(count) * _UNIT_SECONDS[unit.lower().rstrip("s")]


def bucket(ts: Column, width: str) -> Column:
    """Window column aligned to the contract's origin instead of the epoch."""
    offset = BUCKET_ORIGIN_SECONDS % width_seconds(width)
    return F.window(ts, width, startTime=f"{offset} seconds")


def tick_order(width: str, wide_ids: bool = False) -> Column:
    """Total order of ticks inside one bar: event time (ms), then update id.

    A struct would be the obvious key, but min_by/max_by over a struct rules out hash aggregation and sorts
    every tick (measured 4 to 8 times slower). Time since the bar began and the id share one long instead.
    An id that does not fit stops the job; `wide_ids` then switches to a 128-bit decimal key.
    """
    millis, ids = F.unix_millis("event_ts"), F.coalesce("last_update_id", F.lit(0))
    if wide_ids:
        return millis.cast("decimal(18,0)") * F.lit(Decimal(10**19)) + ids.cast("decimal(19,0)")
    width_millis = width_seconds(width) * 1000
    id_bits = 63 - width_millis.bit_length()
    since = F.pmod(millis - F.lit(BUCKET_ORIGIN_SECONDS * 1000), F.lit(width_millis))
    fits = (ids >= 0) & (ids < F.lit(1 << id_bits))
    problem = F.lit(f"update id outside 0..2^{id_bits}-1: call with wide_ids=True")
    return F.when(fits, F.shiftleft(since, id_bits).bitwiseOR(ids)).otherwise(F.raise_error(problem).cast("long"))


def _grouped(ticks: DataFrame, width: str):
    return ticks.groupBy(bucket(F.col("event_ts"), width).alias("_bucket"), "symbol")


def depth_bars(metrics: DataFrame, width: str = "1 minute", wide_ids: bool = False) -> DataFrame:
    """Bars over per-message metrics, weighted by the whole visible depth of each message.

    One hash aggregation with map-side partials: each task ships one row per (bar, symbol), so a dominant
    symbol costs no more than any other. With a watermark on the input the same call runs as a stream.
    """
    mid, order = F.col("mid_price"), tick_order(width, wide_ids)
    # Null mids must not win open or close: their key is NULL, and min_by/max_by ignore NULL keys.
    order = F.when(mid.isNotNull(), order)
    weight = F.col("bid_depth_total") + F.col("ask_depth_total")
    grouped = _grouped(metrics, width).agg(
        F.count(F.lit(1)).alias("update_count"),
        F.min_by(mid, order).alias("mid_price_open"),
        F.max_by(mid, order).alias("mid_price_close"),
        F.avg(mid).alias("mid_price_avg"),
        F.stddev_samp(mid).alias("mid_price_stddev"),
        Q.ratio(F.sum(mid * weight), F.sum(weight)).alias("vwap"),
        F.avg("spread_bps").alias("spread_bps_avg"),
        F.min("spread_bps").alias("spread_bps_min"),
        F.avg("order_imbalance").alias("imbalance_avg"),
        F.avg("bid_depth_total").alias("bid_depth_avg"),
        F.avg("ask_depth_total").alias("ask_depth_avg"),
    )
    return grouped.select(
        F.col("_bucket.start").alias("window_start"),
        F.col("_bucket.end").alias("window_end"),
        "symbol",
        "update_count",
        "mid_price_open",
        "mid_price_close",
        (F.col("mid_price_close") - F.col("mid_price_open")).alias("mid_price_change"),
        "mid_price_avg",
        "mid_price_stddev",
        "vwap",
        "spread_bps_avg",
        "spread_bps_min",
        "imbalance_avg",
        "bid_depth_avg",
        "ask_depth_avg",
        Q.ratio(F.col("bid_depth_avg"), F.col("ask_depth_avg")).alias("depth_ratio"),
    )


def top_bars(quotes: DataFrame, width: str = "1 minute") -> DataFrame:
    """Bars over quotes, weighted by the quantity at the best level; no open, close or filters beyond NULL."""
    bid, ask = F.col("best_bid_price"), F.col("best_ask_price")
    mid = Q.mid_price(bid, ask)
    weight = F.col("best_bid_qty") + F.col("best_ask_qty")
    usable = quotes.where(F.col("event_ts").isNotNull() & bid.isNotNull() & ask.isNotNull())
    grouped = _grouped(usable, width).agg(
        F.avg(mid).alias("mid_price_avg"),
        F.avg(Q.spread_bps(bid, ask)).alias("spread_bps_avg"),
        F.avg(Q.imbalance(F.col("best_bid_qty"), F.col("best_ask_qty"))).alias("imbalance_avg"),
        F.avg(Q.count_ratio(F.col("bid_count"), F.col("ask_count"))).alias("depth_ratio"),
        Q.ratio(F.sum(mid * weight), F.sum(weight)).alias("vwap"),
        F.avg(Q.spread(bid, ask)).alias("spread_avg"),
        F.count(F.lit(1)).alias("tick_count"),
    )
    return grouped.select(F.col("_bucket.start").alias("window_start"), "symbol", *grouped.columns[2:])


def metric_series(bars: DataFrame) -> DataFrame:
    """Long form of the four charted metrics: one row per bar, symbol and metric."""
    typed = bars.withColumn("window_start", F.to_timestamp("window_start"))
    metrics = ["mid_price_avg", "spread_bps_avg", "imbalance_avg", "depth_ratio"]
    return typed.unpivot(["symbol", "window_start"], metrics, "metric", "value")
