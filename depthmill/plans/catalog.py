"""Registered batch queries: each runs one operator over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depthmill.constants import FEATURE_COLS
from depthmill.operators import bars as B
from depthmill.operators import book as K
from depthmill.operators import evaluation as E
from depthmill.operators import features as X
from depthmill.operators import monitor as M
from depthmill.operators import parse as P
from depthmill.operators import quality as C
from depthmill.operators import sequence as N
from depthmill.operators import staging as S
from depthmill.plans import adapters as A
from depthmill.session import written

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
# Moves values that lie exactly between two roundings (averages of short decimals do) off the tie, where
# the last bit of a sum would decide; far below the digits shown.
TIE_OFFSET = 3.14159265e-8
SCORE_THRESHOLD = 80.0
SPOT_CHECK_ID = 5000


def comparable(df: DataFrame) -> DataFrame:
    """Output form shared with the oracle: doubles at six digits, zone-free timestamps, level arrays as text."""

    def column(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            c = F.round(c + F.lit(TIE_OFFSET), DIGITS) + F.lit(0.0)
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            c = F.to_json(c)
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("string") if field.dataType.scale == 8 else c.cast("double")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


# ---- shared inputs -------------------------------------------------------------------------------------


def bronze(source: DataFrame) -> DataFrame:
    return P.accepted(P.parse_depth(A.message_text(A.retried(source)), "message"))


def parsed(source: DataFrame) -> DataFrame:
    return P.parse_depth(A.message_text(A.retried(source)), "message")


def silver(source: DataFrame) -> DataFrame:
    return bronze(source).transform(S.stage_quotes).transform(S.quote_metrics)


def metrics(source: DataFrame) -> DataFrame:
    return A.quotes(source).transform(S.valid_quotes).transform(S.price_metrics)


def hourly(source: DataFrame) -> DataFrame:
    return B.depth_bars(metrics(source), "60 minutes")


def narrow_hourly(source: DataFrame) -> DataFrame:
    """Bars with the columns features need and no others.

    Slice borders carry whole rows; where both they and the rows themselves need the same columns, the
    plan reuses one shuffle of bars for both.
    """
    return hourly(source).select("symbol", "window_start", *X.BAR_COLS)


def mids(source: DataFrame) -> DataFrame:
    return hourly(source).select("symbol", "window_start", "mid_price_avg")


def training(source: DataFrame) -> DataFrame:
    """The training set as a table, for steps that read it more than once."""
    return written(X.training_set(narrow_hourly(source)), "training")


def predicted(source: DataFrame) -> DataFrame:
    return E.with_prediction(A.scores(source), SCORE_THRESHOLD)


def latest_event(source: DataFrame):
    """The stand-in for the clock: the newest event in the data."""
    return source.agg(F.max(F.col("ts").cast("timestamp"))).scalar()


# ---- queries ---------------------------------------------------------------------------------------------


def _time_split_counts(source: DataFrame) -> DataFrame:
    return (
        X.mark_split(training(source))
        .groupBy("is_test")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("window_start").alias("first_window"),
            F.max("window_start").alias("last_window"),
        )
    )


def _quality_report(source: DataFrame) -> DataFrame:
    """Checks over every stage, and over the raw bronze rows, where they find the planted violations."""
    raw = A.quotes(source).transform(S.price_metrics)
    reports = [
        C.run_checks(bronze(source), C.staging_checks(), "bronze"),
        C.run_checks(raw, C.silver_checks(), "unfiltered"),
        C.run_checks(metrics(source), C.silver_checks(), "silver"),
        C.run_checks(hourly(source), C.gold_checks(), "gold"),
        C.run_checks(A.prediction_log(source), C.prediction_checks(), "predictions"),
    ]
    result = reports[0]
    for report in reports[1:]:
        result = result.unionByName(report)
    return result


def _spot_check(source: DataFrame) -> DataFrame:
    levels = A.level_changes(source)
    book = K.top_levels(K.book_state(levels), 5)
    reference = K.top_levels(K.book_state(levels, as_of=SPOT_CHECK_ID), 5)
    return K.spot_check(book, reference, 5).drop("mismatches")


def _snapshot_book(source: DataFrame) -> DataFrame:
    """A book rebuilt from an early state as the snapshot plus all later diffs."""
    levels = A.level_changes(source)
    base = K.book_state(levels, as_of=SPOT_CHECK_ID).select(
        "symbol",
        F.lit(SPOT_CHECK_ID).cast("long").alias("first_update_id"),
        F.lit(SPOT_CHECK_ID).cast("long").alias("last_update_id"),
        "side",
        F.lit(0).alias("pos"),
        "price",
        "qty",
    )
    return K.book_state(levels.where(F.col("last_update_id") > SPOT_CHECK_ID), base=base).drop("last_update_id")


def _messages_out(source: DataFrame) -> DataFrame:
    return P.to_messages(bronze(source)).select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def _recorded_updates(source: DataFrame) -> DataFrame:
    sequence = A.update_sequence(source)
    return N.synchronise(sequence, A.snapshot_ids(sequence))


def _sources() -> dict[str, Callable[[DataFrame], DataFrame]]:
    top_60 = lambda e: B.top_bars(A.quotes(e), "60 minutes")
    active = lambda e: M.activity(A.quotes(e))
    featured = ["symbol", "window_start", *X.ENGINEERED_COLS]
    return {
        # parsing
        "parse_messages": lambda e: bronze(e),
        "parse_quarantine": lambda e: P.quarantine(parsed(e)),
        "envelope_projection": lambda e: P.envelope_text(A.envelopes(e)),
        "message_profile": lambda e: P.message_profile(bronze(e)),
        "to_messages": _messages_out,
        # staging and silver
        "dedup_latest": lambda e: S.dedup_latest(A.retried(e), ["event_id"], ["ts"]),
        "staged_quotes": lambda e: bronze(e).transform(S.stage_quotes),
        "quote_metrics": silver,
        "array_depth_totals": lambda e: S.depth_metrics(bronze(e)).select(
            "last_update_id", "event_ts", "bid_depth_total", "ask_depth_total"
        ),
        # bars
        "bars_1m": lambda e: B.depth_bars(metrics(e), "1 minute"),
        "bars_5m": lambda e: B.depth_bars(metrics(e), "5 minutes"),
        "bars_60m": hourly,
        "bars_37m": lambda e: B.depth_bars(metrics(e), "37 minutes"),
        "bars_from_messages_5m": lambda e: B.depth_bars(silver(e), "5 minutes"),
        "bars_topofbook_1m": lambda e: B.top_bars(A.quotes(e), "1 minute"),
        "bars_topofbook_60m": top_60,
        "metric_series": lambda e: B.metric_series(hourly(e)),
        # features, labels, split
        "feature_rolling_full": lambda e: X.add_features(narrow_hourly(e).drop("depth_ratio")).select(*featured),
        "feature_rolling_partial": lambda e: X.gold_features(top_60(e)),
        "engineered_features": lambda e: X.engineer_features(narrow_hourly(e)).select("symbol", "window_start", *FEATURE_COLS),
        "labels_lead_nullable": lambda e: X.add_label(mids(e)),
        "labels_dropped": lambda e: X.create_labels(mids(e)),
        "labels_by_minutes": lambda e: X.add_label(mids(e), horizon=300, mode="minutes"),
        "training_set": lambda e: X.training_set(hourly(e)),
        "training_set_no_nulls": lambda e: X.training_set(hourly(e), every_column=True),
        "time_split_counts": _time_split_counts,
        "numbered_rows": lambda e: X.numbered(hourly(e).select("symbol", "window_start")),
        "latest_per_symbol": lambda e: X.latest_per_symbol(hourly(e)),
        "tail_10": lambda e: X.newest(hourly(e), 10),
        "head_5": lambda e: X.oldest(hourly(e), 5),
        "ordered_bars": lambda e: X.in_time_order(hourly(e)),
        # book
        "book_levels": lambda e: K.explode_levels(bronze(e)),
        "book_state": lambda e: K.book_state(A.level_changes(e)),
        "book_state_text": lambda e: K.book_state(A.level_changes(e), exact_text=True),
        "book_as_of": lambda e: K.book_state(A.level_changes(e), as_of=SPOT_CHECK_ID),
        "book_from_snapshot": _snapshot_book,
        "book_top_levels": lambda e: K.top_levels(K.book_state(A.level_changes(e)), 5),
        "book_spread": lambda e: K.best_spread(K.book_state(A.level_changes(e))),
        "book_depth_ladder": lambda e: K.depth_ladder(written(K.book_state(A.level_changes(e)), "book"), band=10.0),
        "book_spot_check": _spot_check,
        "book_rebuilt_from_messages": lambda e: K.book_state(
            K.explode_levels(S.dedup_latest(bronze(e), ["symbol", "last_update_id"], ["event_ts"]))
        ),
        # sequence
        "sequence_continuity": lambda e: N.continuity(A.update_sequence(e)),
        "sequence_gap_summary": lambda e: N.gap_summary(N.continuity(A.update_sequence(e))),
        "sequence_epochs": lambda e: N.epochs(A.update_sequence(e)).select(
            "symbol", "first_update_id", "last_update_id", "epoch"
        ),
        "snapshot_anchor": lambda e: N.snapshot_anchors(A.update_sequence(e), A.snapshot_ids(A.update_sequence(e))),
        "synchronised_updates": _recorded_updates,
        # evaluation
        "roc_points": lambda e: E.roc_points(A.scores(e)),
        "best_threshold": lambda e: E.best_threshold(E.roc_points(A.scores(e))),
        "roc_auc": lambda e: E.roc_auc(A.scores(e)),
        "confusion_matrix": lambda e: E.confusion_matrix(predicted(e)),
        "class_report": lambda e: E.class_report(predicted(e)),
        "threshold_metrics": lambda e: E.evaluate(A.scores(e), SCORE_THRESHOLD),
        "feature_summary": lambda e: E.column_profile(training(e), [*FEATURE_COLS, "label"]),
        "positive_share": lambda e: E.positive_share(X.training_set(narrow_hourly(e))),
        # monitoring
        "drift_last_100": lambda e: M.drift(A.prediction_log(e)),
        "drift_per_symbol": lambda e: M.drift(A.prediction_log(e), by="symbol"),
        "top_100_newest": lambda e: M.newest_predictions(A.prediction_log(e)),
        "confidence_histogram": lambda e: M.confidence_histogram(A.prediction_log(e)),
        "predictions_by_direction": lambda e: M.predictions_by_direction(A.prediction_log(e)),
        "predictions_up": lambda e: M.predictions_of(A.prediction_log(e), "up"),
        "prediction_rate": lambda e: M.prediction_rate(A.prediction_log(e)),
        "freshness": lambda e: M.freshness(A.quotes(e), hourly(e), latest_event(e)),
        "minute_activity": active,
        "offset_growth": lambda e: M.offset_growth(active(e)),
        "stall_runs": lambda e: M.stall_runs(active(e), now=latest_event(e)),
        "stall_alerts": lambda e: M.stall_alerts(M.stall_runs(active(e), now=latest_event(e))),
        # quality
        "quality_report": _quality_report,
        "duplicate_keys": lambda e: C.duplicate_keys(bronze(e), ["symbol", "last_update_id"]),
    }


def batch_queries() -> dict[str, Query]:
    def bind(build: Callable[[DataFrame], DataFrame]) -> Query:
        return lambda spark, folder: comparable(build(A.events(spark, folder)))

    return {name: bind(build) for name, build in _sources().items()}
