"""JSON depth messages to bronze rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depthmill.constants import DEFAULT_SYMBOL
from depthmill.functions import quotes as Q
from depthmill.schemas import DEPTH_MESSAGE, DEPTH_RENAMED

BRONZE_COLS = [
    "event_time",
    "date",
    "symbol",
    "first_update_id",
    "last_update_id",
    "bid_count",
    "ask_count",
    "best_bid_price",
    "best_bid_qty",
    "best_ask_price",
    "best_ask_qty",
    "raw_bids",
    "raw_asks",
]


def envelope_text(df: DataFrame) -> DataFrame:
    """Broker envelope to readable text and position."""
    return df.select(
        F.col("value").cast("string").alias("raw_json"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )


def _message(text: Column) -> Column:
    """One parse for all fields.

    The cast renames the struct by position, so no name lookup ever sees the fields that differ by case
    only and the session may keep its default case rule.
    """
    parsed = F.from_json(text, DEPTH_MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unparsed"})
    return parsed.cast(DEPTH_RENAMED)


def parse_depth(df: DataFrame, value: str = "value", default_symbol: str = DEFAULT_SYMBOL) -> DataFrame:
    """Add to every message its 13 bronze columns, `event_ts` (millisecond time) and `reject_reason`.

    Works on batch and streaming frames. Every row is kept: rows that cannot be used carry a reason and go
    to `quarantine`, the others to `accepted`.
    """
    # `inline` flattens the parsed struct and also keeps later filters above it: pushed below a plain
    # projection they would parse the text once more per condition.
    text = df.select(F.col(value).cast("string").alias("raw_text"))
    message = text.select("raw_text", F.inline(F.array(_message(F.col("raw_text")))))
    event_ts = F.timestamp_millis("event_ms")
    bids, asks = F.col("raw_bids"), F.col("raw_asks")
    reason = (
        F.when(F.col("raw_text").isNull(), "empty")
        .when(F.col("unparsed").isNotNull(), "unparseable")
        .when(F.col("event_ms").isNull(), "no_event_time")
        .when(F.col("first_update_id").isNull() | F.col("last_update_id").isNull(), "no_update_id")
        .when(F.col("first_update_id") > F.col("last_update_id"), "reversed_ids")
    )
    return message.select(
        F.date_format(event_ts, "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        F.to_date(event_ts).alias("date"),
        F.coalesce("symbol", F.lit(default_symbol)).alias("symbol"),
        "first_update_id",
        "last_update_id",
        Q.level_count(bids).alias("bid_count"),
        Q.level_count(asks).alias("ask_count"),
        Q.level_field(bids, 0, 0).alias("best_bid_price"),
        Q.level_field(bids, 0, 1).alias("best_bid_qty"),
        Q.level_field(asks, 0, 0).alias("best_ask_price"),
        Q.level_field(asks, 0, 1).alias("best_ask_qty"),
        "raw_bids",
        "raw_asks",
        event_ts.alias("event_ts"),
        reason.alias("reject_reason"),
        "raw_text",
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).select(*BRONZE_COLS, "event_ts")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Messages that were not used, whole and with the reason, instead of a silent drop."""
    return parsed.where(F.col("reject_reason").isNotNull()).select("raw_text", "reject_reason")


def best_only(bronze: DataFrame) -> DataFrame:
    """Variant that keeps no level arrays: the array columns stay in the schema and are empty."""
    empty = F.lit(None)
    return bronze.withColumns(
        {name: empty.cast(bronze.schema[name].dataType) for name in ("raw_bids", "raw_asks")}
    )


def message_profile(bronze: DataFrame) -> DataFrame:
    """Per message: batched ids, and changes, deletions and inserts on each side."""
    bid_gone, ask_gone = Q.deletion_count(F.col("raw_bids")), Q.deletion_count(F.col("raw_asks"))
    return bronze.select(
        "symbol",
        "event_ts",
        "first_update_id",
        "last_update_id",
        Q.id_span(F.col("first_update_id"), F.col("last_update_id")).alias("id_span"),
        F.col("bid_count").alias("bid_changes"),
        bid_gone.alias("bid_deletions"),
        (F.col("bid_count") - bid_gone).alias("bid_inserts"),
        F.col("ask_count").alias("ask_changes"),
        ask_gone.alias("ask_deletions"),
        (F.col("ask_count") - ask_gone).alias("ask_inserts"),
    )


def to_messages(bronze: DataFrame, key: Column | None = None) -> DataFrame:
    """Bronze rows back to keyed JSON messages, ready for a broker or file sink."""
    fields = F.struct(
        F.lit("depthUpdate"),
        F.unix_millis("event_ts"),
        "symbol",
        "first_update_id",
        "last_update_id",
        "raw_bids",
        "raw_asks",
    )
    wire = T.StructType(DEPTH_MESSAGE.fields[:-1])
    return bronze.select(
        (key if key is not None else F.lower("symbol")).cast("binary").alias("key"),
        F.to_json(fields.cast(wire)).cast("binary").alias("value"),
    )
