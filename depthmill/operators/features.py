"""Bar-to-bar features, forward labels, training sets and the time split."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthmill.constants import FEATURE_COLS, LABEL_HORIZON, MIN_TRAINING_ROWS, ROLLING_ROWS, TEST_FRACTION
from depthmill.functions import quotes as Q
from depthmill.operators.ordered import (
    running_totals,
    sliced_window,
    with_neighbours,
    without_neighbours,
)

KEY, TIME = "symbol", "window_start"
# The feature vector is five bar columns followed by the five that `add_features` adds.
BAR_COLS, ENGINEERED_COLS = FEATURE_COLS[:5], FEATURE_COLS[5:]


def by_day() -> Column:
    """Default slice of the bar timeline."""
    return F.to_date(TIME)


def _step(name: str, window) -> Column:
    return F.col(name) - F.lag(name, 1).over(window)


def _whole_frame(statistic: Column, name: str, frame, rows: int) -> Column:
    """Statistic only where the frame holds `rows` non-null values."""
    return F.when(F.count(name).over(frame) == rows, statistic)


def _feature_columns(window, partial: bool, scale: float, rows: int) -> dict[str, Column]:
    frame = window.rowsBetween(-(rows - 1), 0)
    mean, deviation = F.avg("spread_bps_avg").over(frame), F.stddev_samp("imbalance_avg").over(frame)
    if not partial:
        mean = _whole_frame(mean, "spread_bps_avg", frame, rows)
        deviation = _whole_frame(deviation, "imbalance_avg", frame, rows)
    return {
        "spread_change": _step("spread_bps_avg", window),
        "imbalance_change": _step("imbalance_avg", window),
        "vwap_vs_mid": Q.vwap_gap(F.col("vwap"), F.col("mid_price_avg"), scale),
        "rolling_spread_mean": mean,
        "rolling_imbalance_std": deviation,
    }


def add_features(
    bars: DataFrame,
    partial: bool = False,
    scale: float = 1.0,
    rows: int = ROLLING_ROWS,
    slice_by: Column | None = None,
) -> DataFrame:
    """Five engineered columns in one pass over (symbol, day) slices.

    `partial=False` leaves rolling columns NULL until a frame is full; `partial=True` uses short frames.
    """
    near = with_neighbours(bars, [KEY], [TIME], by_day() if slice_by is None else slice_by, before=rows - 1)
    columns = _feature_columns(sliced_window([KEY], [TIME]), partial, scale, rows)
    return without_neighbours(near.withColumns(columns))


def drop_incomplete(df: DataFrame, every_column: bool = False) -> DataFrame:
    """Drop rows with a NULL or NaN among the features, or in any column at all."""
    return df.na.drop("any") if every_column else df.na.drop("any", subset=FEATURE_COLS)


def engineer_features(bars: DataFrame, every_column: bool = False, slice_by: Column | None = None) -> DataFrame:
    return drop_incomplete(add_features(bars, slice_by=slice_by), every_column)


def add_label(
    df: DataFrame, horizon: int = LABEL_HORIZON, mode: str = "rows", slice_by: Column | None = None
) -> DataFrame:
    """1 when the mid is higher `horizon` bars later, 0 when not, NULL where that bar does not exist.

    `mode="rows"` counts surviving rows, `mode="minutes"` looks at the bar exactly that many minutes later.
    """
    if mode == "minutes":
        later = df.select(
            KEY,
            (F.col(TIME) - F.make_interval(mins=F.lit(horizon))).alias(TIME),
            F.col("mid_price_avg").alias("_future"),
        )
        return df.join(later, [KEY, TIME], "left").withColumn("label", _rise()).drop("_future")
    near = with_neighbours(df, [KEY], [TIME], by_day() if slice_by is None else slice_by, after=horizon)
    future = F.lead("mid_price_avg", horizon).over(sliced_window([KEY], [TIME]))
    return without_neighbours(near.withColumn("_future", future).withColumn("label", _rise()).drop("_future"))


def _rise() -> Column:
    return (F.col("_future") > F.col("mid_price_avg")).cast("int")


def create_labels(
    df: DataFrame, horizon: int = LABEL_HORIZON, mode: str = "rows", slice_by: Column | None = None
) -> DataFrame:
    """Labelled rows only: the tail without a future is dropped."""
    return add_label(df, horizon, mode, slice_by).na.drop(subset=["label"])


def gold_features(bars: DataFrame, horizon: int = LABEL_HORIZON, slice_by: Column | None = None) -> DataFrame:
    """One-pass gold table of the minute refresh: short frames kept, gap in basis points, NULL tail labels."""
    slices = by_day() if slice_by is None else slice_by
    near = with_neighbours(bars, [KEY], [TIME], slices, before=ROLLING_ROWS - 1, after=horizon)
    window = sliced_window([KEY], [TIME])
    columns = _feature_columns(window, partial=True, scale=10000.0, rows=ROLLING_ROWS)
    columns["_future"] = F.lead("mid_price_avg", horizon).over(window)
    return without_neighbours(near.withColumns(columns).withColumn("label", _rise()).drop("_future"))


def training_set(
    bars: DataFrame, horizon: int = LABEL_HORIZON, every_column: bool = False, slice_by: Column | None = None
) -> DataFrame:
    """Features, NULL rows out, then labels over what survived: the horizon counts surviving rows."""
    featured = engineer_features(bars, every_column, slice_by)
    return create_labels(featured.drop("label"), horizon, slice_by=slice_by)


def require_rows(df: DataFrame, minimum: int = MIN_TRAINING_ROWS) -> DataFrame:
    """Raise unless the frame has `minimum` rows; stops counting once it does."""
    found = df.limit(minimum).count()
    if found < minimum:
        raise ValueError(f"training set has {found} rows, at least {minimum} are needed")
    return df


def features_for_scoring(bars: DataFrame, slice_by: Column | None = None) -> DataFrame:
    """Complete feature rows up to the newest bar; no label step, so nothing recent is lost."""
    return engineer_features(bars.drop("label"), slice_by=slice_by)


def latest_per_symbol(df: DataFrame, time: str = TIME) -> DataFrame:
    """Newest row of each symbol, trimmed to one row per symbol in every task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(KEY).orderBy(F.desc(time)))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def newest(df: DataFrame, rows: int, time: str = TIME, tie: str = KEY) -> DataFrame:
    """The last `rows` rows in time: a top-k, not a sort."""
    return df.orderBy(F.desc(time), F.asc(tie)).limit(rows)


def oldest(df: DataFrame, rows: int, time: str = TIME, tie: str = KEY) -> DataFrame:
    return df.orderBy(F.asc(time), F.asc(tie)).limit(rows)


def in_time_order(df: DataFrame) -> DataFrame:
    return df.orderBy(KEY, TIME)


def numbered(df: DataFrame, slice_by: Column | None = None) -> DataFrame:
    """Position of each row in its symbol, from 0."""
    slices = by_day() if slice_by is None else slice_by
    counted = running_totals(df, [KEY], [TIME], slices, {"_n": F.lit(1)})
    return counted.withColumn("row_index", F.col("_n") - 1).drop("_n")


def split_boundary(df: DataFrame, test_fraction: float = TEST_FRACTION) -> DataFrame:
    """One row: the bar time of the first test row, and the last symbol of that bar that still trains.

    Rows are counted per bar time and added up by day; the bar in which position int(n * (1 - test)) falls
    is picked, and only that bar is ranked by symbol. No task ever sees the frame in global order.
    """
    per_time = df.groupBy(TIME).agg(F.count(F.lit(1)).alias("_rows"))
    upto = running_totals(per_time, [], [TIME], F.to_date(TIME), {"_upto": F.col("_rows")})
    kept = per_time.agg(F.floor(F.lit(1 - test_fraction) * F.sum("_rows")).alias("_kept")).scalar()
    placed = upto.withColumn("_kept", kept).where(F.col("_upto") > F.col("_kept"))
    still = F.col("_kept") - F.col("_upto") + F.col("_rows")
    edge = placed.agg(F.min_by(F.struct(F.col(TIME).alias("at"), still.alias("still_train")), TIME).alias("_edge"))
    bar = df.select(TIME, KEY).withColumn("_edge", edge.scalar()).where(F.col(TIME) == F.col("_edge.at"))
    ranked = bar.withColumn("_rank", F.row_number().over(Window.partitionBy(TIME).orderBy(KEY)))
    last = ranked.where(F.col("_rank") == F.col("_edge.still_train")).agg(F.max(KEY).alias("_last"))
    return edge.select(F.struct(F.col("_edge.at").alias("at"), last.scalar().alias("last_train")).alias("boundary"))


def mark_split(df: DataFrame, test_fraction: float = TEST_FRACTION, boundary: DataFrame | None = None) -> DataFrame:
    """Add `is_test` by comparing (bar time, symbol) with the boundary; moves no rows."""
    edge = split_boundary(df, test_fraction) if boundary is None else boundary
    cut = df.withColumn("_edge", edge.scalar())
    at, last = F.col("_edge.at"), F.col("_edge.last_train")
    beyond = (F.col(TIME) > at) | ((F.col(TIME) == at) & (last.isNull() | (F.col(KEY) > last)))
    return cut.withColumn("is_test", F.coalesce(beyond, F.lit(False))).drop("_edge")


def time_split(df: DataFrame, test_fraction: float = TEST_FRACTION) -> tuple[DataFrame, DataFrame]:
    """Earlier rows to train on, the last `test_fraction` of rows to test on."""
    marked = mark_split(df, test_fraction)
    return (
        marked.where(~F.col("is_test")).drop("is_test"),
        marked.where(F.col("is_test")).drop("is_test"),
    )
