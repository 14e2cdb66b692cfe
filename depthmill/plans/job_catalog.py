"""Registered job queries: tables and models that are stored, read back and returned."""

from collections.abc import Callable

from pyspark.errors import SparkRuntimeException as SparkException
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthmill.constants import DEFAULT_SYMBOL, METADATA_REQUIRED_KEYS, SPOT_CHECK_LEVELS
from depthmill.functions import scoring as R
from depthmill.operators import bars as B
from depthmill.operators import book as K
from depthmill.operators import model as M
from depthmill.operators import parse as P
from depthmill.operators import quality as C
from depthmill.operators import sequence as N
from depthmill.operators import staging as S
from depthmill.plans import adapters as A
from depthmill.plans import catalog, lakehouse, training
from depthmill.plans.stream_catalog import event_stream
from depthmill.session import path_exists, work_dir, written
from depthmill.sources import readers, topic_files, versions, writers
from depthmill.streaming import jobs

#: One tree of depth 1 over separable classes: leaves of -1 and 1.
STUMP = {"maxIter": 1, "maxDepth": 1}
THRESHOLD = 0.5
RUN_ID = "stump"
MIN_BARS = 5000
FIRST_DAY, LAST_DAY = "2024-01-05", "2024-01-09"


def _stump(spark: SparkSession, folder: str) -> training.Trained:
    return training.fit_and_evaluate(A.separable_rows(A.events(spark, folder)), **STUMP)


def _answers(rows: DataFrame, model) -> DataFrame:
    return M.predictions(rows, model, THRESHOLD, F.col("window_start"))


# ---- models ------------------------------------------------------------------------------------------------


def scoring_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Fit, save, load, score every row, log, and read the log."""
    root = work_dir(spark, "scoring")
    path = training.save(_stump(spark, folder), root, "v1")
    training.publish(spark, root, path)
    model, _ = training.load(spark, training.current_path(spark, root))
    rows = A.separable_rows(A.events(spark, folder))
    writers.append_log(M.log_rows(_answers(rows, model)), f"{root}/log")
    return catalog.comparable(readers.prediction_log(spark, f"{root}/log"))


def scoring_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The features behind every answer, one per row."""
    rows = A.separable_rows(A.events(spark, folder))
    answers = _answers(rows, _stump(spark, folder).model)
    return catalog.comparable(answers.select("symbol", "window_start", F.explode("features_used").alias("feature", "value")))


def scoring_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Micro-batches of feature rows scored into the log."""
    root = work_dir(spark, "scoring-stream")
    model = _stump(spark, folder).model
    rows = A.separable_rows(event_stream(spark, folder)).drop("label")
    writers.batch_sink(rows, training.scoring_batches(model, THRESHOLD, f"{root}/log"), f"{root}/checkpoint").awaitTermination()
    log = readers.prediction_log(spark, f"{root}/log")
    return catalog.comparable(log.select("symbol", "prediction", "confidence", "probability"))


def model_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """The description of a saved model, read back from its document."""
    path = training.save(_stump(spark, folder), work_dir(spark, "metadata"), "v1")
    schema = (
        "model_version string, prediction_target string, label_horizon int, feature_cols array<string>, "
        "optimal_threshold double, trained_on_rows bigint, test_metrics map<string, double>"
    )
    found = spark.read.schema(schema).json(f"{path}/description")
    return catalog.comparable(found.select("*", F.explode("test_metrics").alias("metric", "value")).drop("test_metrics"))


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Parameters and metrics of a run, through the append-only run table."""
    path = f"{work_dir(spark, 'runs')}/model_runs"
    writers.append_log(M.run_record(RUN_ID, STUMP, _stump(spark, folder).metrics), path)
    runs = spark.read.schema("run_id string, params map<string, string>, metrics map<string, double>").parquet(path)
    measured = F.transform_values("metrics", lambda _, v: F.format_string("%.4f", v))
    return runs.select("run_id", F.explode(F.map_concat("params", measured)).alias("name", "value"))


def acceptance_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the model may be published."""
    return catalog.comparable(M.acceptance(_stump(spark, folder).description))


def score_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of every answer of the boosted trees as published; a count of answers and of violations.

    The area under the curve is worked out anew from the stored scores, by another implementation than the reported one.
    """
    trained = training.train_and_evaluate(catalog.hourly(A.events(spark, folder)))
    area = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(trained.scored.withColumn("label", F.col("label").cast("double")))
    reported = trained.metrics.first()["roc_auc"]
    answers = M.predictions(trained.test, trained.model, THRESHOLD, F.col("window_start"))
    share, up = F.col("probability"), F.col("prediction") == "up"
    own = F.when(up, share).otherwise(1 - share)
    return answers.agg(
        F.count(F.lit(1)).alias("answers"),
        F.count_if(F.abs(F.col("confidence") - own) > 2e-4).alias("wrong_confidence"),
        F.count_if(up != (share >= THRESHOLD)).alias("wrong_direction"),
        F.count_if(~share.between(0, 1)).alias("outside"),
        F.lit(int(abs(area - reported) > 1e-9)).cast("long").alias("wrong_area"),
    )


# ---- stored tables -----------------------------------------------------------------------------------------


def retrain_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of a drift check: of the whole log and of its upward answers, before a gate that lets all models pass and one that none does."""
    bars, log = catalog.hourly(A.events(spark, folder)), A.prediction_log(A.events(spark, folder))
    decisions = []
    for name, answers in (("whole log", log), ("upward answers", log.where("prediction = 'up'"))):
        for minimum in (0.0, 1.5):
            root = work_dir(spark, "retrain")
            decision = training.retrain_if_drifted(bars, answers, root, minimum_auc=minimum, **STUMP)
            decisions.append((name, minimum, decision, path_exists(spark, f"{root}/current_model")))
    return spark.createDataFrame(decisions, "log string, minimum_auc double, decision string, published boolean")


def depth_tables_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Bronze to stored silver to stored five-minute bars."""
    paths = lakehouse.build_depth_tables(catalog.bronze(A.events(spark, folder)), work_dir(spark, "depth-tables"))
    return catalog.comparable(spark.read.parquet(paths["gold_features_5m"]))


def minute_tables_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The minute chain, and the row counts its writes report."""
    root = work_dir(spark, "minute-tables")
    counts = lakehouse.refresh_minute_tables(A.quotes(A.events(spark, folder)), root)
    reported = {f"{name}_rows": F.lit(rows).cast("long") for name, rows in counts.items()}
    return catalog.comparable(spark.read.parquet(f"{root}/gold_minute").withColumns(reported))


def refresh_days_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A dated table of which only some days are rebuilt; the other days stay as they were."""
    path = f"{work_dir(spark, 'days')}/bars"
    bars = catalog.hourly(A.events(spark, folder)).select("symbol", "window_start", "update_count", F.to_date("window_start").alias("date"))
    writers.refresh_days(bars.withColumn("build", F.lit(1)), path)
    writers.refresh_days(readers.days(bars, FIRST_DAY, LAST_DAY).withColumn("build", F.lit(2)), path)
    return catalog.comparable(spark.read.parquet(path))


def pruned_days(spark: SparkSession, folder: str) -> DataFrame:
    """Whole partitions of a table by date and symbol."""
    path = f"{work_dir(spark, 'lake')}/bronze"
    bronze = catalog.bronze(A.events(spark, folder)).select("date", "symbol", "first_update_id", "last_update_id", "event_time")
    writers.spread(bronze).write.partitionBy(*writers.PARTITIONS).parquet(path)
    table = readers.lake_table(spark, path, schema=bronze.schema)
    return readers.days(table, FIRST_DAY, LAST_DAY, ["click", "purchase"]).select(*bronze.columns)


def fan_out_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Two outputs from one read of each micro-batch: rows, and their counts per symbol."""
    root = work_dir(spark, "fan-out")
    rows = writers.append_once(f"{root}/rows")

    def counts(batch: DataFrame, batch_id: int) -> None:
        writers.append_once(f"{root}/counts")(batch.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")), batch_id)

    source = A.quotes(event_stream(spark, folder)).select("symbol", "last_update_id")
    writers.batch_sink(source, writers.fan_out(rows, counts), f"{root}/checkpoint").awaitTermination()
    kept = spark.read.parquet(f"{root}/rows").groupBy("symbol").agg(F.countDistinct("last_update_id").alias("ids"))
    counted = spark.read.parquet(f"{root}/counts").groupBy("symbol").agg(F.sum("rows").alias("rows"))
    return kept.join(counted, "symbol")


def _published(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """Messages as keyed files of a broker's rows, in several files."""
    sent = A.envelopes(A.events(spark, folder)).select("key", "value", "topic", "partition", "offset", "timestamp", "timestampType")
    sent.repartition(4, "offset").write.parquet(root)
    return sent


def bounded_batches_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes read a file at a time, and the batch each file came in."""
    root = work_dir(spark, "bounded")
    _published(spark, folder, f"{root}/in")
    stream = readers.envelope_stream(spark, "parquet", path=f"{root}/in", maxFilesPerTrigger="1")
    writers.batch_sink(P.envelope_text(stream), writers.append_once(f"{root}/out"), f"{root}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    return out.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("offset").alias("offsets"), F.countDistinct("batch_id").alias("batches"))


def offsets_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """An exported topic of three partitions: ranges by offset as a batch, and all of it as a stream of small batches that stops and goes on."""
    root = work_dir(spark, "offsets")
    spark.dataSource.register(topic_files.TopicFiles)
    spread = {"partition": (F.col("offset") % 3).cast("int"), "offset": F.floor(F.col("offset") / 3)}
    topic_files.export(A.envelopes(A.events(spark, folder)).withColumns(spread), f"{root}/topic", segment=1000)
    asked = {"startingOffsets": '{"0": 100, "1": -2, "2": -1}', "endingOffsets": '{"0": 1200, "1": 30, "2": -1}'}
    ranged = spark.read.format("topic_files").options(path=f"{root}/topic", offsetsPerTask="300", **asked).load()
    bounded = {"path": f"{root}/topic", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "25000", "progress": f"{root}/progress"}
    for limited in (True, False):
        stream = spark.readStream.format("topic_files").options(**bounded).load()
        query = writers.batch_sink(P.envelope_text(stream), writers.append_once(f"{root}/out"), f"{root}/checkpoint", interval="0 seconds")
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        if limited:  # what comes while nothing listens
            late = A.envelopes(A.events(spark, folder)).where("offset < 10").withColumns({"partition": F.lit(3), "offset": F.col("offset")})
            topic_files.export(late, f"{root}/topic", segment=1000)
    streamed = spark.read.parquet(f"{root}/out").drop("batch_id")
    both = P.envelope_text(ranged).withColumn("read", F.lit("range")).unionByName(streamed.withColumn("read", F.lit("stream")))
    return catalog.comparable(both)


def restart_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """An ingest that is stopped and started again: later files are added, no row comes twice."""
    root = work_dir(spark, "restart")
    schema = jobs.bronze_stream(A.message_text(A.events(spark, folder)), "message").schema
    sent = A.envelopes(A.events(spark, folder))
    for part in (F.col("offset") % 2 == 0, F.col("offset") % 2 == 1):
        sent.where(part).write.mode("append").parquet(f"{root}/in")
        stream = readers.envelope_stream(spark, "parquet", path=f"{root}/in")
        for query in jobs.ingest(stream, f"{root}/bronze", f"{root}/rejects", f"{root}/checkpoints", interval=None):
            query.awaitTermination()
    return readers.lake_table(spark, f"{root}/bronze", schema=schema).select("symbol", "first_update_id", "last_update_id", "event_time")


def view_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A named view, asked in SQL."""
    writers.as_view(catalog.hourly(A.events(spark, folder)), "hourly_bars_view")
    return catalog.comparable(spark.sql("SELECT symbol, count(*) AS bars, sum(update_count) AS updates FROM hourly_bars_view GROUP BY symbol"))


def message_files_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed messages published to files, read back as envelopes would be and parsed again."""
    path = f"{work_dir(spark, 'messages')}/topic"
    writers.publish(P.to_messages(catalog.bronze(A.events(spark, folder))), "parquet", path=path)
    back = spark.read.schema("key binary, value binary").parquet(path)
    return catalog.comparable(P.accepted(P.parse_depth(back)))


# ---- books and checks --------------------------------------------------------------------------------------


def book_per_epoch(spark: SparkSession, folder: str) -> DataFrame:
    """The book at the end of every epoch that a snapshot anchors."""
    source = A.events(spark, folder)
    sequence = A.update_sequence(source)
    ids = {c: F.col(c) for c in ("first_update_id", "last_update_id")}
    levels = A.level_changes(source).withColumn("symbol", F.lit(DEFAULT_SYMBOL)).withColumns(
        {"first_update_id": _sequence_first(), "last_update_id": _sequence_first() + 2}
    )
    found = written(N.synchronise(sequence, A.snapshot_ids(sequence)).select("symbol", *ids, "epoch", "snapshot_id", "status"), "synchronised")
    base = A.snapshot_ids(sequence).select(
        "symbol",
        "snapshot_id",
        F.col("snapshot_id").alias("first_update_id"),
        F.col("snapshot_id").alias("last_update_id"),
        F.lit("bid").alias("side"),
        F.lit(0).alias("pos"),
        F.lit("1.00000000").alias("price"),
        F.lit("5.00000000").alias("qty"),
    )
    return N.epoch_books(found, levels, base)


def _sequence_first():
    """The first id that `adapters.update_sequence` gives the event whose id a level change carries."""
    return F.col("last_update_id") * 3 + 1 + F.floor(F.col("last_update_id") / 97) * 5


def spot_check_from_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The newest book against snapshot documents of an earlier one, stored as JSON; mismatches as text."""
    path = f"{work_dir(spark, 'documents')}/snapshots"
    levels = A.level_changes(A.events(spark, folder))
    early = K.top_levels(K.book_state(levels, as_of=catalog.SPOT_CHECK_ID), SPOT_CHECK_LEVELS + 2)
    entry = F.struct("rank", F.array("price", "qty").alias("level"))
    side = lambda name: F.transform(
        F.array_sort(F.collect_list(F.when(F.col("side") == name, entry))), lambda e: e["level"]
    )
    documents = early.groupBy("symbol").agg(
        F.lit(catalog.SPOT_CHECK_ID).cast("long").alias("lastUpdateId"), side("bid").alias("bids"), side("ask").alias("asks")
    )
    documents.write.json(path)
    reference = K.first_levels(readers.book_snapshots(spark, path), SPOT_CHECK_LEVELS)
    found = K.spot_check(K.top_levels(K.book_state(levels), SPOT_CHECK_LEVELS), reference, SPOT_CHECK_LEVELS)
    each = F.transform("mismatches", lambda m: F.concat_ws(" ", m["side"], m["rank"].cast("string"), m["book_price"], m["snapshot_price"]))
    return catalog.comparable(found.withColumn("mismatches", F.array_join(F.array_sort(each), "; ")))


def display_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Prices, shares and times as a reader sees them."""
    return A.events(spark, folder).select(
        R.as_time_ms(F.col("ts").cast("timestamp")).alias("at"),
        R.as_percent((F.col("value") % 100) / 100).alias("share"),
        R.as_quantity(F.col("value")).alias("quantity"),
    )


def ladder_texts(spark: SparkSession, folder: str) -> DataFrame:
    state = written(K.book_state(A.level_changes(A.events(spark, folder))), "book")
    return K.ladder_text(K.depth_ladder(state, band=10.0)).select("symbol", "side", "price_text", "qty_text")


def stored_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Checks over stored tables: columns, files, single keys, minimum rows, metadata keys."""
    bars = written(catalog.hourly(A.events(spark, folder)), "checked-bars")
    metadata = written(_stump(spark, folder).description, "checked-metadata")
    quotes = A.quotes(A.events(spark, folder))
    reports = [
        C.run_checks(bars, [C.required_columns(["window_start", "vwap", "no_such_column"]), C.has_data_files(), C.min_rows(MIN_BARS)], "gold"),
        C.run_checks(quotes, [C.unique("last_update_id"), C.unique("symbol"), C.min_rows(100)], "quotes"),
        C.run_checks(metadata, [C.required_columns(METADATA_REQUIRED_KEYS), C.not_empty()], "metadata"),
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def refresh_while_read(spark: SparkSession, folder: str) -> DataFrame:
    """A reader that opened a table before it is rebuilt twice, once in vain, and one that opens it after."""
    path, ticks = work_dir(spark, "versions"), catalog.metrics(A.events(spark, folder))
    versions.publish(B.depth_bars(ticks, "60 minutes"), path)
    early = versions.read(spark, path)
    lost = B.depth_bars(ticks, "1 day").withColumn("symbol", F.raise_error(F.lit("lost")).cast("string"))
    try:
        versions.publish(lost, path)
        raise AssertionError("this build can't end")
    except SparkException:
        pass
    versions.publish(B.depth_bars(ticks, "1 day"), path)
    late = versions.read(spark, path)
    return catalog.comparable(early.withColumn("version", F.lit(1)).unionByName(late.withColumn("version", F.lit(2))))


def wide_daily_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars over ids that fill a long."""
    ticks = catalog.metrics(A.events(spark, folder)).withColumn("last_update_id", F.col("last_update_id") + F.lit(1 << 40))
    return catalog.comparable(B.depth_bars(ticks, "1 day", wide_ids=True))


def bad_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages without an id among others: set aside, while the book goes on."""
    texts = A.message_text(A.events(spark, folder))
    cut = F.when(F.col("event_id") % 19 == 0, F.regexp_replace("message", ',"u":[0-9]+', "")).otherwise(F.col("message"))
    parsed = P.parse_depth(texts.select(cut.alias("message")), "message")
    state = K.book_state(K.explode_levels(S.dedup_latest(P.accepted(parsed), ["symbol", "last_update_id"], ["event_ts"])))
    live = state.groupBy().agg(F.count(F.lit(1)).alias("rows")).select(F.lit("live levels").alias("what"), "rows")
    return P.quarantine(parsed).groupBy(F.col("reject_reason").alias("what")).agg(F.count(F.lit(1)).alias("rows")).unionByName(live)


def job_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        scoring_roundtrip, scoring_audit, scoring_stream, model_metadata, run_log, acceptance_gate, retrain_decisions, score_invariants,
        depth_tables_roundtrip, minute_tables_roundtrip, refresh_days_roundtrip, pruned_days, fan_out_roundtrip,
        bounded_batches_roundtrip, offsets_roundtrip, restart_roundtrip, view_roundtrip, message_files_roundtrip, book_per_epoch,
        spot_check_from_documents, display_texts, ladder_texts, stored_checks, wide_daily_bars, refresh_while_read, bad_messages,
    )
    return {f.__name__: f for f in own}
