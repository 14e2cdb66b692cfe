"""Table versions: a full rebuild that readers never see half done.

A version is an immutable folder of data files and a commit file that names it. A build writes its folder first and its
commit last, so a build that fails leaves nothing that a reader looks at. A reader is pinned to the folder of the version it
opened, whatever is committed meanwhile, until that version is removed by `expire`.
"""

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_END = "."  # a commit that doesn't end like this was cut off


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def versions(spark: SparkSession, path: str) -> dict[int, str]:
    """Data folder of every committed version, in order."""
    system, place = _files(spark, f"{path}/commits")
    if not system.exists(place):
        return {}
    found = {}
    for status in system.listStatus(place):
        name = re.fullmatch(r"(\d{20})", status.getPath().getName())
        if name:
            stream = system.open(status.getPath())
            try:
                text = bytes(stream.readAllBytes()).decode()
            finally:
                stream.close()
            if text.endswith(_END):
                found[int(name[1])] = f"{path}/data/{text.removesuffix(_END)}"
    return dict(sorted(found.items()))


def publish(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Write a new version of the whole table and commit it; its number.

    Two builds that end at the same time can't both have a number: the commit file must be new, and the later one takes
    the next.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    df.write.format(fmt).save(f"{path}/data/{name}")
    number = max(versions(spark, path), default=0) + 1
    while True:
        system, place = _files(spark, f"{path}/commits/{number:020d}")
        try:
            stream = system.create(place, False)
        except Exception:
            if not system.exists(place):
                raise
            number += 1
            continue
        try:
            stream.write(bytearray((name + _END).encode()))
        finally:
            stream.close()
        return number


def read(spark: SparkSession, path: str, version: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A version of the table, the newest by default, as it was committed."""
    known = versions(spark, path)
    if version is None:
        version = max(known, default=0)
    if version not in known:
        raise ValueError(f"{path} has no version {version}")
    return spark.read.format(fmt).load(known[version])


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all versions but the newest `keep`, and data that no commit names (of builds that failed, or still run: call it between builds)."""
    known = versions(spark, path)
    gone = list(known)[: max(0, len(known) - keep)]
    for number in gone:
        system, place = _files(spark, f"{path}/commits/{number:020d}")
        system.delete(place, False)
    kept = {known[n] for n in known if n not in gone}
    system, place = _files(spark, f"{path}/data")
    for status in system.listStatus(place) if system.exists(place) else []:
        if f"{path}/data/{status.getPath().getName()}" not in kept:
            system.delete(status.getPath(), True)
    return gone
