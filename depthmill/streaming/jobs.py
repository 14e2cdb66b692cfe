"""Stateless, windowed and de-duplicating streams: the batch operators with a watermark in front."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from depthmill.operators import bars as B
from depthmill.operators import parse as P
from depthmill.operators import staging as S
from depthmill.sources import versions as V
from depthmill.sources import writers as W

LATENESS = "2 minutes"


def bronze_stream(envelopes: DataFrame, value: str = "value") -> DataFrame:
    return P.accepted(P.parse_depth(envelopes, value))


def quarantine_stream(envelopes: DataFrame, value: str = "value") -> DataFrame:
    return P.quarantine(P.parse_depth(envelopes, value))


def bars_stream(metrics: DataFrame, width: str = "1 minute", lateness: str = LATENESS, wide_ids: bool = False) -> DataFrame:
    """Bars as a stream: each bar is final once the watermark passes its end. In append mode a bar shows then, in update mode at every change."""
    return B.depth_bars(metrics.withWatermark("event_ts", lateness), width, wide_ids)


def gold_stream(envelopes: DataFrame, width: str = "1 minute", lateness: str = LATENESS, wide_ids: bool = False) -> DataFrame:
    """Messages to bars in one streaming plan: parse, de-duplicate, clean, measure, aggregate."""
    staged = S.stage_quotes_stream(bronze_stream(envelopes), lateness)
    return B.depth_bars(S.quote_metrics(staged), width, wide_ids)


def open_bars(bars: DataFrame, table: str, checkpoint: str, interval: str | None = "10 seconds") -> StreamingQuery:
    """Bars (`bars_stream`, `gold_stream`) with those that are still open: each micro-batch writes the bars it changed, as a version.

    A repeated micro-batch replaces its own version only. Read with `newest_bars`.
    """
    writer = bars.writeStream.outputMode("update").foreachBatch(W.append_once(table)).option("checkpointLocation", checkpoint)
    return W.with_trigger(writer, interval).start()


def newest_bars(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """Every bar as its newest version has it: one hash aggregation over the versions."""
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])).parquet(table)
    rest = [c for c in schema.names if c not in ("symbol", "window_start")]
    newest = stored.groupBy("symbol", "window_start").agg(F.max_by(F.struct(*rest), "batch_id").alias("bar"))
    return newest.select(*[F.col(c) if c not in rest else F.col("bar")[c].alias(c) for c in schema.names])


def fold_versions(spark: SparkSession, table: str, schema: T.StructType, target: str) -> int:
    """Put the newest version of every bar into a new version of the table at `target`, and return its number."""
    return V.publish(newest_bars(spark, table, schema), target)


def ingest(
    envelopes: DataFrame,
    table: str,
    rejects: str,
    checkpoints: str,
    fmt: str = "parquet",
    interval: str | None = "10 seconds",
) -> list[StreamingQuery]:
    """One query that reads and parses its source once: good rows to the lake table, the rest to the quarantine.

    Both are written per micro-batch (`batch_id` folders above date and symbol), so a repeated one replaces what it wrote before.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        W.spread(P.accepted(batch)).write.format(fmt).mode("overwrite").partitionBy(*W.PARTITIONS).save(f"{table}/batch_id={batch_id}")

    def set_aside(batch: DataFrame, batch_id: int) -> None:
        P.quarantine(batch).write.format(fmt).mode("overwrite").save(f"{rejects}/batch_id={batch_id}")

    return [W.batch_sink(P.parse_depth(envelopes, "value"), W.fan_out(write, set_aside), f"{checkpoints}/ingest", interval)]


def await_any(spark: SparkSession, timeout: int | None = None) -> bool | None:
    """Block until one of the session's queries ends."""
    return spark.streams.awaitAnyTermination(timeout)
