"""Outputs. Paths may be any URI the session's file systems know; credentials are the caller's settings."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

PARTITIONS = ("date", "symbol")


def spread(df: DataFrame, files_per_partition: int = 4, key: str = "last_update_id") -> DataFrame:
    """Gather each (date, symbol) into a few tasks before a partitioned write.

    Without it every task writes a file into every partition; with a plain hash on the partition columns
    one busy symbol would go to a single task. The salt bounds both.
    """
    salt = F.pmod(F.xxhash64(key), F.lit(files_per_partition))
    return df.repartition(*[F.col(c) for c in PARTITIONS], salt)


def with_trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """A fixed interval, or one pass over what is there when no interval is given."""
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)


def lake_sink(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    interval: str | None = "10 seconds",
    files_per_partition: int = 4,
) -> StreamingQuery:
    """Append a stream to a table partitioned by date and symbol, one commit per micro-batch."""
    writer = spread(rows, files_per_partition).writeStream.format(fmt).outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).partitionBy(*PARTITIONS)
    return with_trigger(writer, interval).start(path)


def console_sink(rows: DataFrame, interval: str | None = "5 seconds") -> StreamingQuery:
    writer = rows.writeStream.format("console").outputMode("append").option("truncate", "false")
    return with_trigger(writer, interval).start()


def memory_sink(rows: DataFrame, name: str, interval: str | None = None) -> StreamingQuery:
    """For inspection and tests only: the result lives in the driver."""
    return with_trigger(rows.writeStream.format("memory").queryName(name).outputMode("append"), interval).start()


def batch_sink(
    rows: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, interval).start()


def append_once(path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """Batch writer for `batch_sink` that may be repeated: a retried batch replaces its own folder only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    return write


def fan_out(*writers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Several outputs from one read of each micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for each in writers:
                each(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def refresh_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Full rebuild of a derived table."""
    df.write.format(fmt).mode("overwrite").save(path)


def refresh_days(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Rebuild only the dates present in `df`; all other partitions stay."""
    writer = df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").save(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count of a build taken while it is written, not by a second scan."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def publish(messages: DataFrame, sink: str = "kafka", **options: str) -> None:
    """Write keyed messages (key, value) to a broker topic or to files."""
    writer = messages.select("key", "value").write.format(sink).mode("append").options(**options)
    writer.save()
