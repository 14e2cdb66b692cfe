"""Inputs. Every reader takes a declared schema and a caller-supplied path or broker options."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depthmill.schemas import ENVELOPE, PREDICTION_LOG, SNAPSHOT


def envelope_stream(spark: SparkSession, source: str = "kafka", **options: str) -> DataFrame:
    """Unbounded envelope rows.

    `source="kafka"` subscribes to a topic and starts at the newest offset unless told otherwise; it needs
    the broker connector on the class path. Any file format reads a folder of rows with the same columns.
    Bound a micro-batch with `maxOffsetsPerTrigger` (broker) or `maxFilesPerTrigger` (files).
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        reader = reader.option("startingOffsets", "latest")
    else:
        reader = reader.schema(ENVELOPE)
    return reader.options(**options).load()


def envelope_batch(spark: SparkSession, source: str = "kafka", **options: str) -> DataFrame:
    reader = spark.read.format(source)
    if source != "kafka":
        reader = reader.schema(ENVELOPE)
    return reader.options(**options).load()


def broker_options(servers: str, topic: str, per_trigger: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def lake_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A partitioned table by path; filters on its partition columns prune folders."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def lake_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def days(table: DataFrame, first: str, last: str, symbols: list[str] | None = None) -> DataFrame:
    """Restrict to whole partitions by date, and symbol if given."""
    chosen = table.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return chosen if symbols is None else chosen.where(F.col("symbol").isin(*symbols))


def book_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Snapshot documents, one JSON object per line."""
    return spark.read.schema(SNAPSHOT).json(path)


def prediction_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PREDICTION_LOG).parquet(path)
