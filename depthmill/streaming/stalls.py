"""Live stall detection on a clock of arrivals.

Silence is measured between arrivals, by event-time timers over the arrival clock: the watermark is the newest arrival of
any symbol, or heartbeat. A replay of the same arrivals gives the same alerts, however it is cut into micro-batches.
"""

from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from depthmill.constants import FAILURE_THRESHOLD
from depthmill.functions.scoring import alert_text
from depthmill.session import use_rocksdb

ALERT_ROWS = "ts timestamp, symbol string, component string, consecutive_failures bigint, message string"
_ALERT_ROW = Row("ts", "symbol", "component", "consecutive_failures", "message")


class StallWatch(StatefulProcessor):
    """Checks each symbol every interval after its last arrival; from the threshold on, each check without news raises an alert."""

    def __init__(self, interval_ms: int, threshold: int, component: str) -> None:
        self.interval, self.threshold, self.component = interval_ms, threshold, component

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.heard = handle.getValueState("heard", "last_ms bigint, failures bigint, due bigint")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        times = sorted({row.arrived_ms for row in rows})
        if key[0] is None:  # a heartbeat only moves the clock
            return
        last, failures, due = self.heard.get() or (None, 0, None)
        for at in times:
            if last is not None and at > last:
                yield from self._alerts(key, last, failures, at)
            if last is None or at > last:
                last, failures = at, 0
        self._wait(last, failures, due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, failures, _ = self.heard.get()
        now = timerValues.getCurrentWatermarkInMs()
        yield from self._alerts(key, last, failures, now)
        self._wait(last, max(failures, -(-(now - last) // self.interval) - 1), None)

    def _alerts(self, key, last: int, failures: int, until: int):
        """Checks that failed before `until`, beyond those already counted."""
        for n in range(max(failures + 1, self.threshold), -(-(until - last) // self.interval)):
            at = datetime.fromtimestamp((last + n * self.interval) / 1000, timezone.utc)
            yield _ALERT_ROW(at, key[0], self.component, n, alert_text(self.component, n))

    def _wait(self, last: int, failures: int, due: int | None) -> None:
        """The timer lies just behind the next check: news that arrive at the very moment still count."""
        if due is not None:
            self.handle.deleteTimer(due)
        due = last + (failures + 1) * self.interval + 1
        self.handle.registerTimer(due)
        self.heard.update((last, failures, due))


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from pa.Table.from_batches([batch]).group_by(["symbol", "arrived"]).aggregate([]).to_batches()


def heartbeats(spark: SparkSession) -> DataFrame:
    """One heartbeat a second, so that the clock goes on when nothing at all arrives."""
    return spark.readStream.format("rate").option("rowsPerSecond", 1).load().select(F.lit(None).cast("string").alias("symbol"), F.col("timestamp").alias("arrived"))


def stalls_stream(
    ticks: DataFrame,
    beats: DataFrame | None = None,
    interval_seconds: int = 60,
    threshold: int = FAILURE_THRESHOLD,
    component: str = "kafka",
) -> DataFrame:
    """Alert rows for every symbol that falls silent: from which nothing arrives, whatever its own clock says.

    `ticks` has symbol and arrived (without it: the time of the micro-batch); `beats`, such as `heartbeats`, has the same with a null
    symbol. The clock counts in seconds. Tasks hand on one row per symbol, second and batch of rows, so a busy symbol sends few.
    Rows that arrive behind the clock are dropped, as on an arrival clock there are none.
    """
    use_rocksdb(ticks.sparkSession)
    if "arrived" not in ticks.columns:
        ticks = ticks.withColumn("arrived", F.current_timestamp())
    seen = ticks.where("symbol is not null").select("symbol", "arrived")
    seen = seen if beats is None else seen.unionByName(beats.select("symbol", "arrived"))
    heard = seen.select("symbol", F.date_trunc("second", F.col("arrived").cast("timestamp")).alias("arrived")).mapInArrow(_distinct, "symbol string, arrived timestamp")
    heard = heard.withWatermark("arrived", "0 seconds").withColumn("arrived_ms", F.unix_millis("arrived"))
    return heard.groupBy("symbol").transformWithState(
        statefulProcessor=StallWatch(interval_seconds * 1000, threshold, component),
        outputStructType=ALERT_ROWS,
        outputMode="Append",
        timeMode="EventTime",
    )
