"""Registered streaming and model queries: each runs to the end of what is there and returns its result table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from depthmill.operators import model as M
from depthmill.operators import staging as S
from depthmill.plans import adapters as A
from depthmill.plans import catalog, training
from depthmill.session import prepare, work_dir
from depthmill.sources.readers import lake_table
from depthmill.streaming import gate, jobs, stalls

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
SNAPSHOT_EVERY = 50


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    return spark.readStream.schema(EVENTS).parquet(f"{folder}/events.parquet*")


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()


def _stored(rows: DataFrame, label: str) -> DataFrame:
    """Run the stream into a table and hand back the table."""
    path = work_dir(rows.sparkSession, label)
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint")
    _finish(writer.trigger(availableNow=True).start(f"{path}/table"))
    return lake_table(rows.sparkSession, f"{path}/table", schema=rows.schema)


def stream_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars that the watermark has closed."""
    ticks = A.quotes(event_stream(spark, folder)).transform(S.valid_quotes).transform(S.price_metrics)
    return catalog.comparable(_stored(jobs.bars_stream(ticks, "60 minutes"), "stream-bars"))


def _open_bars(bars: DataFrame, label: str) -> DataFrame:
    root = work_dir(bars.sparkSession, label)
    _finish(jobs.open_bars(bars, f"{root}/table", f"{root}/checkpoint", interval=None))
    return catalog.comparable(jobs.newest_bars(bars.sparkSession, f"{root}/table", bars.schema))


def stream_bars_open(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly bars with those that the watermark hasn't closed."""
    ticks = A.quotes(event_stream(spark, folder)).transform(S.valid_quotes).transform(S.price_metrics)
    return _open_bars(jobs.bars_stream(ticks, "60 minutes"), "stream-bars-open")


def wide_stream_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars of a stream whose ids fill a long."""
    ticks = A.quotes(event_stream(spark, folder)).transform(S.valid_quotes).transform(S.price_metrics)
    wide = ticks.withColumn("last_update_id", F.col("last_update_id") + F.lit(1 << 40))
    return _open_bars(jobs.bars_stream(wide, "1 day", wide_ids=True), "wide-stream-bars")


def stall_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts of a replay, with the events' own times as arrivals."""
    ticks = event_stream(spark, folder).select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("arrived"))
    return catalog.comparable(_stored(stalls.stalls_stream(ticks), "stall-stream"))


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    retried = A.retried(event_stream(spark, folder)).select(
        F.col("event_type").alias("symbol"), F.col("event_id").alias("last_update_id"), F.col("ts").alias("event_ts")
    )
    return _stored(S.dedup_stream(retried), "stream-dedup").select("symbol", "last_update_id")


def stream_bronze_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Messages through the ingest job into the partitioned table, and back."""
    messages = A.message_text(A.retried(event_stream(spark, folder)))
    root = work_dir(spark, "stream-bronze")
    for query in jobs.ingest(
        messages.withColumn("value", F.col("message")), f"{root}/bronze", f"{root}/rejects", f"{root}/checkpoints", interval=None
    ):
        _finish(query)
    schema = jobs.bronze_stream(messages, "message").schema
    return catalog.comparable(lake_table(spark, f"{root}/bronze", schema=schema).select(*schema.names))


def gate_input(source: DataFrame) -> DataFrame:
    """Diffs with lost ids, one symbol per day, and a snapshot after every fiftieth of them."""
    event_id = F.col("event_id")
    first = event_id * 3 + 1 + F.floor(event_id / 97) * 5
    level = F.concat(F.lit('[["'), F.col("price"), F.lit('","'), F.col("qty"), F.lit('"]]'))
    sided = lambda side: F.when(F.col("side") == side, level).otherwise(F.lit("[]"))
    body = F.concat(F.lit('{"raw_bids":'), sided("bid"), F.lit(',"raw_asks":'), sided("ask"), F.lit("}"))
    changes = A.level_changes(source.withColumn("event_type", F.date_format("ts", "yyyy-MM-dd")))
    rows = changes.withColumn("event_id", F.col("last_update_id")).select(
        "symbol", event_id, first.alias("first"), body.alias("levels")
    )
    diff = F.struct(
        F.lit("diff").alias("kind"),
        F.col("first").alias("first_update_id"),
        (F.col("first") + 2).alias("last_update_id"),
        F.col("levels"),
    )
    snapshot = F.struct(
        F.lit("snapshot").alias("kind"),
        (F.col("first") + 2).alias("first_update_id"),
        (F.col("first") + 2).alias("last_update_id"),
        F.lit('{"raw_bids":[["1.00000000","1.00000000"]],"raw_asks":[["999.00000000","1.00000000"]]}').alias("levels"),
    )
    taken = event_id % SNAPSHOT_EVERY == SNAPSHOT_EVERY // 2
    both = F.when(taken, F.array(diff, snapshot)).otherwise(F.array(diff))
    return rows.select("symbol", F.explode(both).alias("_r")).select("symbol", "_r.*")


def stream_gate(spark: SparkSession, folder: str) -> DataFrame:
    """What the gate says of every diff and snapshot."""
    statuses = gate.run_once(gate_input(event_stream(spark, folder)), work_dir(spark, "stream-gate"))
    return statuses.select("symbol", "kind", "first_update_id", "last_update_id", "status")


def stream_gate_one_symbol(spark: SparkSession, folder: str) -> DataFrame:
    """The same with all events under one symbol."""
    rows = gate_input(event_stream(spark, folder)).withColumn("symbol", F.lit("ALL"))
    statuses = gate.run_once(rows, work_dir(spark, "stream-gate-one"))
    return statuses.select("symbol", "kind", "first_update_id", "last_update_id", "status")


def stream_book(spark: SparkSession, folder: str) -> DataFrame:
    """The newest book of every symbol, reduced from what the gate applied."""
    statuses = gate.run_once(gate_input(event_stream(spark, folder)), work_dir(spark, "stream-book"))
    return gate.current_book(statuses).drop("epoch")


def score_model(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on the past, then the answer for every held-out bar at the best threshold."""
    trained = training.train_and_evaluate(catalog.hourly(A.events(spark, folder)))
    best = trained.description.select("optimal_threshold").scalar()
    moment = F.lit("2024-02-01").cast("timestamp")
    answers = M.predictions(trained.test, trained.model, best, moment).drop("features_used")
    return catalog.comparable(answers)


def stream_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stream_bars": stream_bars,
        "stream_bars_open": stream_bars_open,
        "wide_stream_bars": wide_stream_bars,
        "stall_stream": stall_stream,
        "stream_dedup": stream_dedup,
        "stream_bronze_roundtrip": stream_bronze_roundtrip,
        "stream_gate": stream_gate,
        "stream_gate_one_symbol": stream_gate_one_symbol,
        "stream_book": stream_book,
        "score_model": score_model,
    }
