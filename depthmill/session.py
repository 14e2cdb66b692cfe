"""Session settings the operators rely on, and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the zone: every timestamp in the library is UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_root(spark: SparkSession) -> str:
    """The folder the cluster shares for checkpoints.

    Only a local session may do without one and gets a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="depthmill-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return root


def work_dir(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, never reused."""
    return f"{work_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system of the session."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed streaming state goes to RocksDB, so it may exceed executor memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


#: For rows of megabytes: a page ends after the row that fills it (else a file's first hundred rows are one page), and
#: zstd works through a page as a stream (Snappy keeps buffers of a whole page, off the heap, for reading and writing).
WIDE_ROWS = {"parquet.page.size.row.check.min": "1", "compression": "zstd"}


def written(df: DataFrame, label: str, wide: bool = False) -> DataFrame:
    """Write once to the shared folder and read back: for frames that several later steps scan. `wide`: rows may have megabytes.

    Unlike a cache it survives lost executors, and the plan behind it is gone for good.
    """
    path = work_dir(df.sparkSession, label)
    df.write.options(**WIDE_ROWS if wide else {}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
