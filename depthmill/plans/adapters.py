"""Order-book shaped views over the `events` table.

The sample data has no order book, so each view derives one, row by row, from every event: no row is
dropped or capped. Remainders of ids only decide what a row looks like (a missing side, a crossed book).
`plans/oracle.py` states the same derivations in SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthmill.constants import DEFAULT_SYMBOL, FEATURE_COLS
from depthmill.functions import scoring as S
from depthmill.session import prepare

LOG_THRESHOLD = 0.7013


def events(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/events.parquet")


def _millis(column: str = "ts"):
    """Event time as the exchange sends it: whole milliseconds."""
    return F.date_trunc("millisecond", F.col(column).cast("timestamp"))


def retried(source: DataFrame) -> DataFrame:
    """Every event, and once more a second later where a broker retry is played."""
    attempts = F.when(F.col("event_id") % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    copies = source.withColumn("_attempt", F.explode(attempts))
    return copies.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.col("_attempt") * 1_000_000).alias("ts"),
    )


def _bid_ask():
    """Prices with many digits; the book is crossed, locked or open by turns."""
    bid = F.lit(100.0) + F.col("value")
    return bid, bid + (F.col("event_id") % 7 - 1) * F.sqrt(F.col("value") + 1) * F.lit(0.02)


def quotes(source: DataFrame) -> DataFrame:
    """Numeric quotes with missing bids and locked or crossed books among them."""
    event_id = F.col("event_id")
    bid, ask = _bid_ask()
    bid_qty, ask_qty = F.col("value") / 3 + 1, (event_id % 4 + 1).cast("double")
    return source.select(
        F.col("event_type").alias("symbol"),
        _millis().alias("event_ts"),
        event_id.alias("first_update_id"),
        event_id.alias("last_update_id"),
        (event_id % 5 + 1).cast("int").alias("bid_count"),
        (event_id % 3).cast("int").alias("ask_count"),
        F.when(event_id % 11 != 0, bid).alias("best_bid_price"),
        bid_qty.alias("best_bid_qty"),
        ask.alias("best_ask_price"),
        ask_qty.alias("best_ask_qty"),
        F.when(event_id % 13 != 0, bid_qty + 2).alias("bid_depth_total"),
        (ask_qty + 1).alias("ask_depth_total"),
    )


def _text(value):
    return value.cast("decimal(18,8)").cast("string")


def message_text(source: DataFrame) -> DataFrame:
    """JSON depth messages: with empty and missing sides, deletions, missing symbols and broken text."""
    event_id = F.col("event_id")
    bid, ask = _bid_ask()
    bid_qty = F.when(event_id % 5 != 0, F.col("value") / 3 + 1).otherwise(F.lit(0.0))
    quoted = lambda *parts: F.concat(F.lit('["'), parts[0], F.lit('","'), parts[1], F.lit('"]'))
    bids = F.when(event_id % 10 == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("["), quoted(_text(bid), _text(bid_qty)), F.lit(',["1.00000000","0.00000000"]]'))
    )
    asks = quoted(_text(ask), _text(event_id % 4 + 1))
    when = F.when(event_id % 31 == 0, F.lit('"bad"')).otherwise(F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))
    text = F.concat(
        F.lit('{"e":"depthUpdate","E":'),
        when,
        F.when(event_id % 29 == 0, F.lit("")).otherwise(F.concat(F.lit(',"s":"'), F.col("event_type"), F.lit('"'))),
        F.lit(',"U":'),
        (event_id * 3 + 1).cast("string"),
        F.lit(',"u":'),
        (event_id * 3 + 3).cast("string"),
        F.lit(',"b":'),
        bids,
        F.when(event_id % 23 == 0, F.lit("")).otherwise(F.concat(F.lit(',"a":['), asks, F.lit("]"))),
        F.lit("}"),
    )
    return source.select("event_id", "ts", F.when(event_id % 101 == 0, F.lit("junk")).otherwise(text).alias("message"))


def envelopes(source: DataFrame) -> DataFrame:
    """The messages in broker form."""
    return message_text(source).select(
        F.lit("depth").cast("binary").alias("key"),
        F.col("message").cast("binary").alias("value"),
        F.lit("depth_updates").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def level_changes(source: DataFrame) -> DataFrame:
    """Level changes with many writes per price and zero quantities as deletions."""
    bid = F.col("user_id") % 2 == 0
    return source.select(
        F.col("event_type").alias("symbol"),
        F.col("event_id").alias("first_update_id"),
        F.col("event_id").alias("last_update_id"),
        F.when(bid, "bid").otherwise("ask").alias("side"),
        F.lit(0).alias("pos"),
        _text(F.when(bid, F.lit(60)).otherwise(F.lit(101)) + F.col("user_id") % 40).alias("price"),
        _text(F.when(F.col("event_id") % 4 != 0, F.col("value")).otherwise(F.lit(0.0))).alias("qty"),
    )


def update_sequence(source: DataFrame) -> DataFrame:
    """One long id sequence of a single symbol, with five ids lost after every 97 messages."""
    first = F.col("event_id") * 3 + 1 + F.floor(F.col("event_id") / 97) * 5
    return source.select(
        F.lit(DEFAULT_SYMBOL).alias("symbol"), first.alias("first_update_id"), (first + 2).alias("last_update_id")
    )


def snapshot_ids(sequence: DataFrame) -> DataFrame:
    """A snapshot at every thousandth id the sequence reaches."""
    at = F.floor(F.col("last_update_id") / 1000) * 1000
    return sequence.select("symbol", at.alias("snapshot_id")).distinct()


def scores(source: DataFrame) -> DataFrame:
    return source.select(F.col("value").alias("score"), (F.col("user_id") % 3 == 0).cast("int").alias("label"))


def separable_rows(source: DataFrame) -> DataFrame:
    """Labelled feature rows, one per event, whose label shows in the sign of one feature.

    A tree of depth 1 finds that sign, so a model's answers can be stated without the model.
    """
    up = F.col("event_id") % 3 == 0
    shown = F.when(up, 1.0 + F.col("event_id") % 7).otherwise(-1.0 - F.col("event_id") % 5)
    features = {c: shown if c == "spread_change" else F.lit(0.5) for c in FEATURE_COLS}
    return source.select(
        F.col("event_type").alias("symbol"),
        F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp"))).alias("window_start"),
        up.cast("int").alias("label"),
        *[value.cast("double").alias(name) for name, value in features.items()],
    )


def prediction_log(source: DataFrame) -> DataFrame:
    probability = (F.col("value") % 100) / 100
    called = S.direction(probability, LOG_THRESHOLD)
    return source.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("symbol"),
        called.alias("prediction"),
        S.confidence(probability, called).alias("confidence"),
        probability.alias("probability"),
    )
