"""Freshness, stalls, drift and prediction counters."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthmill.constants import CONFIDENCE_BOUNDS, DRIFT_LAST, DRIFT_SHARE, FAILURE_THRESHOLD
from depthmill.functions import scoring as S
from depthmill.operators.bars import bucket, width_seconds
from depthmill.operators.ordered import sliced_window, with_neighbours, without_neighbours


def freshness(ticks: DataFrame, bars: DataFrame, now: Column) -> DataFrame:
    """Age of the newest tick and bar per symbol at `now`.

    `total_lag_seconds` adds both although a bar's age already contains its ticks' age: that is the
    published definition, and the two parts are there to read separately.
    """
    tick = ticks.groupBy("symbol").agg(F.max("event_ts").alias("latest_tick"))
    bar = bars.groupBy("symbol").agg(F.max("window_start").alias("latest_bar"))
    both = tick.join(bar, "symbol", "full")
    tick_lag = S.rounded(S.age_seconds(now, F.col("latest_tick")), 1)
    bar_lag = S.rounded(S.age_seconds(now, F.col("latest_bar")), 1)
    return both.select(
        "symbol",
        "latest_tick",
        "latest_bar",
        tick_lag.alias("tick_lag_seconds"),
        bar_lag.alias("gold_lag_seconds"),
        S.rounded(tick_lag + bar_lag, 1).alias("total_lag_seconds"),
    )


def newest_predictions(log: DataFrame, last: int = DRIFT_LAST, by: str | None = None, tie: str = "probability") -> DataFrame:
    """The most recent predictions, overall or per group; a top-k in every task either way."""
    if by is None:
        return log.orderBy(F.desc("ts"), F.desc(tie)).limit(last)
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("ts"), F.desc(tie)))
    return log.withColumn("_rank", rank).where(F.col("_rank") <= last).drop("_rank")


def drift(log: DataFrame, last: int = DRIFT_LAST, limit: float = DRIFT_SHARE, by: str | None = None) -> DataFrame:
    """Share of each direction among the newest predictions; flagged when one exceeds `limit`."""
    recent = newest_predictions(log, last, by)
    counts = (recent.groupBy(by) if by else recent.groupBy()).agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.count_if(F.col("prediction") == "up").alias("_up"),
        F.count_if(F.col("prediction") == "down").alias("_down"),
    )
    total = F.nullif(F.col("total_predictions").cast("double"), F.lit(0.0))
    shares = counts.withColumns(
        {"up_ratio": S.rounded(F.col("_up") / total, 4), "down_ratio": S.rounded(F.col("_down") / total, 4)}
    )
    status = (
        F.when(F.col("total_predictions") == 0, "no_data")
        .when((F.col("up_ratio") > limit) | (F.col("down_ratio") > limit), "drift_detected")
        .otherwise("ok")
    )
    return shares.select(
        *([by] if by else []),
        status.alias("status"),
        "total_predictions",
        "up_ratio",
        "down_ratio",
        F.lit(limit).alias("drift_threshold"),
    )


def predictions_by_direction(log: DataFrame) -> DataFrame:
    return log.groupBy("prediction").agg(F.count(F.lit(1)).alias("predictions"))


def predictions_of(log: DataFrame, direction: str) -> DataFrame:
    return log.where(F.col("prediction") == direction)


def prediction_rate(log: DataFrame, width: str = "1 minute") -> DataFrame:
    counts = log.groupBy(bucket(F.col("ts"), width).alias("_w"), "prediction").agg(F.count(F.lit(1)).alias("predictions"))
    return counts.select(F.col("_w.start").alias("window_start"), "prediction", "predictions")


def confidence_histogram(log: DataFrame, bounds: list[float] = CONFIDENCE_BOUNDS) -> DataFrame:
    """Cumulative counts at or below each bound, and overall, from one aggregate."""
    counts = log.agg(
        *[F.count_if(F.col("confidence") <= b).alias(f"_{i}") for i, b in enumerate(bounds)],
        F.count("confidence").alias("_all"),
    )
    lines = [F.struct(F.lit(str(b)).alias("le"), F.col(f"_{i}").alias("observations")) for i, b in enumerate(bounds)]
    lines.append(F.struct(F.lit("+Inf").alias("le"), F.col("_all").alias("observations")))
    return counts.select(F.inline(F.array(*lines)))


def activity(ticks: DataFrame, width: str = "1 minute", offset: str = "last_update_id") -> DataFrame:
    """Highest offset and message count of every interval in which a symbol was heard."""
    counts = ticks.groupBy("symbol", bucket(F.col("event_ts"), width).alias("_w")).agg(
        F.max(offset).alias("max_offset"), F.count(F.lit(1)).alias("messages")
    )
    return counts.select("symbol", F.col("_w.start").alias("window_start"), "max_offset", "messages")


def _beside_previous(active: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Values of the previous active interval, from (symbol, day) slices."""
    needed = active.select("symbol", "window_start", *[c for c in columns.values() if c != "window_start"])
    near = with_neighbours(needed, ["symbol"], ["window_start"], F.to_date("window_start"), before=1)
    window = sliced_window(["symbol"], ["window_start"])
    return without_neighbours(near.withColumns({new: F.lag(old).over(window) for new, old in columns.items()}))


def offset_growth(active: DataFrame) -> DataFrame:
    """New messages by offset since the previous active interval; NULL for the first."""
    beside = _beside_previous(active, {"_previous": "max_offset"})
    return beside.select(
        "symbol", "window_start", "max_offset", (F.col("max_offset") - F.col("_previous")).alias("new_messages")
    )


def stall_runs(
    active: DataFrame, width: str = "1 minute", threshold: int = FAILURE_THRESHOLD, now: Column | None = None
) -> DataFrame:
    """Runs of at least `threshold` silent intervals between two active ones.

    Silence is read off the distance between neighbouring active intervals, so no grid of empty intervals
    is ever built. With `now`, silence since a symbol's newest interval is a run too; its `recovered_at` is NULL.
    """
    seconds = width_seconds(width)
    start = F.col("window_start")
    spans = _beside_previous(active, {"_previous": "window_start"}).select(
        "symbol", "_previous", start.alias("recovered_at"), start.alias("_until")
    )
    if now is not None:
        newest = active.groupBy("symbol").agg(F.max("window_start").alias("_previous"))
        spans = spans.unionByName(newest.withColumns({"recovered_at": F.lit(None).cast("timestamp"), "_until": now}))
    silent = F.floor(S.age_seconds(F.col("_until"), F.col("_previous")) / F.lit(seconds)) - 1
    runs = spans.withColumn("consecutive_failures", silent).where(F.col("consecutive_failures") >= threshold)
    return runs.select(
        "symbol",
        (F.col("_previous") + F.make_dt_interval(secs=F.lit(seconds))).alias("stall_start"),
        "recovered_at",
        "consecutive_failures",
    )


def stall_alerts(
    runs: DataFrame, width: str = "1 minute", threshold: int = FAILURE_THRESHOLD, component: str = "kafka"
) -> DataFrame:
    """One alert per failed check from the threshold on, as the checks would have raised them.

    Rows follow the silence: a symbol that is silent for a year gives half a million alerts by the minute. Bound `now` in `stall_runs`
    by the last check that was made.
    """
    each = runs.withColumn("_n", F.explode(F.sequence(F.lit(threshold).cast("long"), F.col("consecutive_failures"))))
    seconds = F.lit(width_seconds(width))
    text = F.format_string(S.alert_text(component.replace("%", "%%"), "%d"), F.col("_n"))
    return each.select(
        F.timestamp_seconds(F.unix_seconds("stall_start") + F.col("_n") * seconds).alias("ts"),
        "symbol",
        F.lit(component).alias("component"),
        F.col("_n").alias("consecutive_failures"),
        text.alias("message"),
    )
