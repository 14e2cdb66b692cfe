"""Exported topics as a source with offsets: format `topic_files`, for batch and streaming reads.

An export holds a folder for each topic partition, with segments named by their first offset:
`partition=3/00000000000000100000.parquet`. Offsets are those of the broker and rise within a partition. A read takes ranges of
(partition, offset), so a segment that a range doesn't touch is never opened, and a stream goes on where it stopped.

    spark.dataSource.register(TopicFiles)
    spark.readStream.format("topic_files").option("path", p).option("startingOffsets", "earliest").load()

startingOffsets   earliest, latest, or JSON of offsets by partition, such as {"0": 17, "1": -2} (-2: earliest, -1: latest;
                  partitions that aren't named start at the earliest). Default: earliest for batch reads, latest for streams.
endingOffsets     the same for the end (exclusive) of a batch read; default latest.
maxOffsetsPerTrigger  offsets that a micro-batch takes at most, dealt evenly over partitions that have some. Needs `progress`.
progress          a folder that the cluster shares, in which a stream with a limit notes how far it has planned (after a lost driver
                  one micro-batch may hold twice the limit).
offsetsPerTask    offsets of a task at most (default 1,000,000).

A stream lists the export when it has planned all that it knew of, not for each micro-batch, and reads small segments together.
"""

import json
import re
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from depthmill.schemas import ENVELOPE

#: Offsets of a segment that `export` writes.
SEGMENT = 100_000
#: Offsets of small segments that a task of a stream reads together.
TOGETHER = 10_000
EARLIEST, LATEST = -2, -1


class Slice(InputPartition):
    """Offsets from start up to end of one segment."""

    def __init__(self, uri: str, partition: int, start: int, end: int):
        self.uri, self.partition, self.start, self.end = uri, partition, start, end


class Slices(InputPartition):
    """Slices of small segments that a task reads one after another."""

    def __init__(self, slices: list[Slice]):
        self.slices = slices


def together(slices: list[Slice], at_once: int) -> list[Slices]:
    """The slices in order, in groups of at most `at_once` offsets, at least one each."""
    groups, total = [], at_once
    for part in slices:
        size = part.end - part.start
        if total + size > at_once:
            groups.append([])
            total = 0
        groups[-1].append(part)
        total += size
    return [Slices(group) for group in groups]


class Segments:
    """What an export holds: first offset of every segment by partition."""

    def __init__(self, path: str):
        self.path = path if "://" in path else f"file://{path}"
        self.system, root = fs.FileSystem.from_uri(self.path)
        self.first: dict[int, list[int]] = {}
        for info in self.system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            name = re.search(r"/partition=(\d+)/(\d{20})\.parquet$", info.path)
            if name:
                self.first.setdefault(int(name[1]), []).append(int(name[2]))
        for starts in self.first.values():
            starts.sort()

    def uri(self, partition: int, first: int) -> str:
        return f"{self.path}/partition={partition}/{first:020d}.parquet"

    def earliest(self) -> dict[int, int]:
        return {p: starts[0] for p, starts in self.first.items()}

    def latest(self) -> dict[int, int]:
        """The offset behind the last one of every partition, from the last segment's footer."""
        out = {}
        for p, starts in self.first.items():
            system, place = fs.FileSystem.from_uri(self.uri(p, starts[-1]))
            with system.open_input_file(place) as stream:
                footer = pq.ParquetFile(stream).metadata
                at = footer.schema.names.index("offset")
                tops = [footer.row_group(g).column(at).statistics.max for g in range(footer.num_row_groups)]
            out[p] = max(tops, default=starts[-1] - 1) + 1
        return out

    def resolved(self, wanted: str) -> dict[int, int]:
        """Offsets by partition of an option's value."""
        early, late = self.earliest(), self.latest()
        if wanted in ("earliest", "latest"):
            return early if wanted == "earliest" else late
        given = {int(p): int(o) for p, o in json.loads(wanted).items()}
        return {p: {EARLIEST: early[p], LATEST: late[p]}.get(given.get(p, EARLIEST), given.get(p, EARLIEST)) for p in self.first}

    def slices(self, start: dict[int, int], end: dict[int, int], at_once: int) -> list[Slice]:
        out = []
        for p, stop in sorted(end.items()):
            starts = self.first.get(p, [])
            low = max(bisect_right(starts, start[p]) - 1, 0) if p in start else 0
            starts = starts[low : bisect_right(starts, stop - 1)]
            for first, behind in zip(starts, [*starts[1:], stop][: len(starts)], strict=True):
                low, high = max(first, start.get(p, first)), min(behind, stop)
                out += [Slice(self.uri(p, first), p, k, min(k + at_once, high)) for k in range(low, high, at_once)]
        return out


def _read(part: Slice) -> Iterator[pa.RecordBatch]:
    system, place = fs.FileSystem.from_uri(part.uri)
    names = [f.name for f in ENVELOPE.fields if f.name != "partition"]
    with system.open_input_file(place) as stream:
        file = pq.ParquetFile(stream)
        at = file.metadata.schema.names.index("offset")
        groups = []
        for g in range(file.metadata.num_row_groups):
            seen = file.metadata.row_group(g).column(at).statistics
            if seen is None or seen.max >= part.start and seen.min < part.end:
                groups.append(g)
        for batch in file.iter_batches(row_groups=groups, columns=names):
            offset = batch.column("offset")
            batch = batch.filter(pc.and_(pc.greater_equal(offset, part.start), pc.less(offset, part.end)))
            own = {n: batch.column(n) for n in names} | {"partition": pa.array([part.partition] * batch.num_rows, pa.int32())}
            own["timestamp"] = own["timestamp"].cast(pa.timestamp("us", tz="UTC"))
            yield pa.RecordBatch.from_arrays([own[f.name] for f in ENVELOPE.fields], names=ENVELOPE.names)


class TopicReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.options = options

    def partitions(self) -> Sequence[InputPartition]:
        files = Segments(self.options["path"])
        start, end = files.resolved(self.options.get("startingOffsets", "earliest")), files.resolved(self.options.get("endingOffsets", "latest"))
        return files.slices(start, end, int(self.options.get("offsetsPerTask", 1_000_000))) or [Slice("", 0, 0, 0)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        if partition.end > partition.start:
            yield from _read(partition)


class TopicStream(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        self.options = options
        self.limit = int(options.get("maxOffsetsPerTrigger", 0))
        if self.limit and "progress" not in options:
            raise ValueError("maxOffsetsPerTrigger needs a folder for progress")
        self.planned: dict[int, int] | None = None
        self.listed: tuple[Segments, dict[int, int]] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"listed": None}  # tasks don't need it

    def _listing(self, wanted: dict[int, int] | None) -> tuple[Segments, dict[int, int]]:
        """Segments and ends of the export; listed anew unless it is known to go on behind the wanted offsets."""
        if self.listed is None or wanted is None or not any(end > wanted.get(p, -1) for p, end in self.listed[1].items()):
            files = Segments(self.options["path"])
            self.listed = files, files.latest()
        return self.listed

    def initialOffset(self) -> dict:
        return self._as_offset(Segments(self.options["path"]).resolved(self.options.get("startingOffsets", "latest")))

    def latestOffset(self) -> dict:
        if self.limit and self.planned is None:
            self.planned = self._noted()
        files, late = self._listing(self.planned)
        if not self.limit:
            return self._as_offset(late)
        if self.planned is None:
            self.planned = files.resolved(self.options.get("startingOffsets", "latest"))
        early = files.earliest()
        here = {p: self.planned.get(p, early[p]) for p in late}
        # Deal the limit evenly; what a partition doesn't need goes to the others.
        left, out = self.limit, dict(here)
        for k, p in enumerate(sorted(late, key=lambda p: (late[p] - here[p], p))):
            out[p] = here[p] + min(late[p] - here[p], -(-left // (len(late) - k)))
            left -= out[p] - here[p]
        if out != self.planned:
            self._note(out)
        self.planned = out
        return self._as_offset(out)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        begin, stop = ({int(p): o for p, o in x.items()} for x in (start, end))
        if self.listed is None or any(o > self.listed[1].get(p, -1) for p, o in stop.items()):
            self._listing(None)
        at_once = int(self.options.get("offsetsPerTask", 1_000_000))
        return together(self.listed[0].slices(begin, stop, at_once), min(TOGETHER, at_once))

    def read(self, partition: Slices) -> Iterator[pa.RecordBatch]:
        for part in partition.slices:
            yield from _read(part)

    def commit(self, end: dict) -> None:
        pass

    def _note(self, offsets: dict[int, int]) -> None:
        """Before a micro-batch is planned: what is noted is never behind the stream's own checkpoint, so nothing is read twice."""
        system, root = self._progress()
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/offsets.json") as out:
            out.write(json.dumps(self._as_offset(offsets)).encode())

    def _progress(self):
        path = self.options["progress"]
        return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")

    def _noted(self) -> dict[int, int] | None:
        system, root = self._progress()
        if system.get_file_info(f"{root}/offsets.json").type == fs.FileType.NotFound:
            return None
        with system.open_input_file(f"{root}/offsets.json") as stream:
            return {int(p): o for p, o in json.loads(stream.read()).items()}

    @staticmethod
    def _as_offset(offsets: dict[int, int]) -> dict:
        return {str(p): o for p, o in sorted(offsets.items())}


class TopicFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic_files"

    def schema(self) -> StructType:
        return ENVELOPE

    def reader(self, schema: StructType) -> DataSourceReader:
        return TopicReader(self.options)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return TopicStream(self.options)


def export(envelopes: DataFrame, path: str, segment: int = SEGMENT) -> int:
    """Write envelopes as segments of at most `segment` offsets, a task for each; the number of segments."""
    root = path if "://" in path else f"file://{path}"

    def write(key: tuple, rows: pa.Table) -> pa.Table:
        partition, place = (int(x.as_py()) for x in key)
        folder = f"{root}/partition={partition}"
        system, here = fs.FileSystem.from_uri(folder)
        system.create_dir(here, recursive=True)
        rows = rows.sort_by("offset").drop_columns(["_segment", "partition"])
        with system.open_output_stream(f"{here}/{place * segment:020d}.parquet") as out:
            pq.write_table(rows, out)
        return pa.table({"partition": pa.array([partition], pa.int32())})

    placed = envelopes.select(*ENVELOPE.names).withColumn("_segment", F.floor(F.col("offset") / F.lit(segment)))
    return placed.groupBy("partition", "_segment").applyInArrow(write, "partition int").count()
