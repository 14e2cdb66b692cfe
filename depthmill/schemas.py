"""Declared schemas; nothing in the library infers one."""

from pyspark.sql import types as T

LEVELS = T.ArrayType(T.ArrayType(T.StringType()))

# Columns of a message-broker source; file sources carry the same ones.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Wire names of a depth message differ by case only, so they live here and in one cast (operators/parse.py).
DEPTH_MESSAGE = T.StructType(
    [
        T.StructField("e", T.StringType()),
        T.StructField("E", T.LongType()),
        T.StructField("s", T.StringType()),
        T.StructField("U", T.LongType()),
        T.StructField("u", T.LongType()),
        T.StructField("b", LEVELS),
        T.StructField("a", LEVELS),
        T.StructField("_unparsed", T.StringType()),
    ]
)

# The same struct, field by field in the same order, under descriptive names.
DEPTH_RENAMED = T.StructType(
    [
        T.StructField("event_kind", T.StringType()),
        T.StructField("event_ms", T.LongType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("first_update_id", T.LongType()),
        T.StructField("last_update_id", T.LongType()),
        T.StructField("raw_bids", LEVELS),
        T.StructField("raw_asks", LEVELS),
        T.StructField("unparsed", T.StringType()),
    ]
)

SNAPSHOT = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("lastUpdateId", T.LongType()),
        T.StructField("bids", LEVELS),
        T.StructField("asks", LEVELS),
    ]
)

PREDICTION_LOG = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("prediction", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("probability", T.DoubleType()),
    ]
)
