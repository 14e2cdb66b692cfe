"""Sequence gate: decides for a live stream which diffs may be applied to which snapshot.

Two streaming queries. `stage` numbers each micro-batch's diffs on the JVM: windows within (symbol, slice of ids) find runs
without a gap, levels stay in a table. `decide` keeps state per symbol and sees one row per run and snapshot: a cursor, the
runs that wait, the snapshots that wait. It answers in ranges of ids. `statuses` joins the ranges back to the staged
diffs by (symbol, batch, slice, run). Runs are cut at slice borders, so none holds more than `SLICE_IDS` diffs.

Price levels are not replayed here: the applied rows are reduced per (symbol, side, price) by `operators.book`, so a
busy symbol's levels still spread over all tasks.
"""

from bisect import bisect_left, bisect_right, insort
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from depthmill.operators.book import book_state, explode_levels
from depthmill.schemas import LEVELS
from depthmill.session import path_exists, use_rocksdb
from depthmill.sources.writers import batch_sink, with_trigger

#: Ids of a slice; a longer run is cut.
SLICE_IDS = 4096
#: How long early diffs and unused snapshots are kept.
HOLD_SECONDS = 3600

_KEY = ["symbol", "batch", "slice", "run"]
RUNS = "symbol string, kind string, first_update_id long, last_update_id long, ends binary, arrived timestamp, batch long, slice long, run long"
DECISIONS = "symbol string, epoch long, kind string, first_update_id long, last_update_id long, status string, batch long, slice long, run long"
_DIFFS = "symbol string, slice long, run long, first_update_id long, last_update_id long, superseded boolean, levels string, arrived timestamp, batch long"
_SNAPSHOTS = "symbol string, snapshot_id long, levels string, arrived timestamp, batch long"
_DECISION = Row(*[f.split()[0] for f in DECISIONS.split(", ")])

_SIDES = T.StructType([T.StructField("raw_bids", LEVELS), T.StructField("raw_asks", LEVELS)])


def diff_rows(bronze: DataFrame) -> DataFrame:
    """Parsed messages as input of the gate."""
    return bronze.select(
        "symbol",
        F.lit("diff").alias("kind"),
        "first_update_id",
        "last_update_id",
        F.to_json(F.struct("raw_bids", "raw_asks")).alias("levels"),
    )


def snapshot_rows(snapshots: DataFrame) -> DataFrame:
    """Snapshot documents as gate input."""
    return snapshots.select(
        "symbol",
        F.lit("snapshot").alias("kind"),
        F.col("lastUpdateId").alias("first_update_id"),
        F.col("lastUpdateId").alias("last_update_id"),
        F.to_json(F.struct(F.col("bids").alias("raw_bids"), F.col("asks").alias("raw_asks"))).alias("levels"),
    )


def _staged(rows: DataFrame, folder: str, batch_id: int) -> None:
    """A micro-batch's diffs with slice and run, its snapshots, and its runs, written once: a repeated batch changes nothing."""
    spark, last = rows.sparkSession, F.col("last_update_id")
    place = {name: f"{folder}/{name}/batch={batch_id}" for name in ("diffs", "snapshots", "runs")}
    if path_exists(spark, f"{place['runs']}/_SUCCESS"):
        return
    if "arrived" not in rows.columns:
        rows = rows.withColumn("arrived", F.current_timestamp())
    in_slice = Window.partitionBy("symbol", "slice").orderBy("first_update_id", F.desc("last_update_id"))
    diffs = rows.where(F.col("kind") == "diff").withColumn("slice", F.floor(F.col("first_update_id") / F.lit(SLICE_IDS)))
    # Of diffs that start at the same id the longest holds all changes of the others.
    diffs = diffs.withColumn("superseded", F.coalesce(F.lag("first_update_id").over(in_slice) == F.col("first_update_id"), F.lit(False)))
    before = F.last(F.when(~F.col("superseded"), last), ignorenulls=True).over(in_slice.rowsBetween(Window.unboundedPreceding, -1))
    starts = ~F.col("superseded") & F.coalesce(F.col("first_update_id") != before + 1, F.lit(True))
    numbered = diffs.withColumn("_starts", starts).withColumn("run", F.sum(F.col("_starts").cast("long")).over(in_slice.rowsBetween(Window.unboundedPreceding, 0)))
    numbered.select("symbol", "slice", "run", "first_update_id", "last_update_id", "superseded", "levels", "arrived").write.mode("overwrite").parquet(place["diffs"])
    snapshots = rows.where(F.col("kind") == "snapshot").select("symbol", F.col("first_update_id").alias("snapshot_id"), "levels", "arrived")
    snapshots.write.mode("overwrite").parquet(place["snapshots"])

    diffs = spark.read.schema(_DIFFS).parquet(place["diffs"]).where("not superseded")
    runs = diffs.groupBy("symbol", "slice", "run").agg(F.min("first_update_id").alias("first_update_id"), F.max("last_update_id").alias("last_update_id"), F.array_sort(F.collect_list("last_update_id")).alias("ends"), F.max("arrived").alias("arrived"))
    packed = F.to_binary(F.array_join(F.transform("ends", lambda x: F.lpad(F.hex(x), 16, "0")), ""), F.lit("hex"))
    runs = runs.select("symbol", F.lit("run").alias("kind"), "first_update_id", "last_update_id", packed.alias("ends"), "arrived", "slice", "run")
    asked = spark.read.schema(_SNAPSHOTS).parquet(place["snapshots"]).groupBy("symbol", "snapshot_id").agg(F.max("arrived").alias("arrived"))
    none = F.lit(None).cast("long")
    asked = asked.select("symbol", F.lit("snapshot").alias("kind"), F.col("snapshot_id").alias("first_update_id"), F.col("snapshot_id").alias("last_update_id"), F.lit(None).cast("binary").alias("ends"), "arrived", none.alias("slice"), none.alias("run"))
    runs.unionByName(asked).write.mode("overwrite").parquet(place["runs"])


class Run(NamedTuple):
    """Diffs without a gap: their first id, the last id of each, and where they are staged."""

    first: int
    ends: np.ndarray
    key: tuple[int, int, int]
    arrived: int

    @property
    def last(self) -> int:
        return int(self.ends[-1])

    def start(self, i: int) -> int:
        """First id of diff i."""
        return self.first if i == 0 else int(self.ends[i - 1]) + 1

    def part(self, i: int, j: int) -> "Run":
        return Run(self.start(i), self.ends[i:j], self.key, self.arrived)


class SequenceGate(StatefulProcessor):
    """Anchor, continuity and stale rules over runs, with early ones held until their turn.

    A gap is declared when more than `max_held` diffs wait behind it, when a snapshot connects beyond it, or when a diff
    overlaps the cursor. What arrived before the watermark is given up by a timer: diffs as `expired`, snapshots silently.

    State is read when a key's micro-batch begins and written when it ends: what comes and goes within one never gets there.
    """

    def __init__(self, max_held: int = 0) -> None:
        self.max_held = max_held

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cursor = handle.getValueState("cursor", "last_id bigint, epoch bigint, synced boolean")
        self.held = handle.getMapState("held", "first_id bigint, last_id bigint", "batch bigint, slice bigint, run bigint, n bigint, since bigint")
        self.held_ends = handle.getMapState("held_ends", "first_id bigint, last_id bigint", "ends binary")
        self.snapshots = handle.getMapState("snapshots", "snapshot_id bigint", "since bigint")

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        self._load()
        runs, snapshots = [], {}
        for row in rows:
            arrived = row.arrived_ms
            if row.kind == "snapshot":
                snapshots[row.first_update_id] = arrived
            else:
                runs.append(Run(row.first_update_id, np.frombuffer(row.ends, ">i8"), (row.batch, row.slice, row.run), arrived))
        # A key's whole micro-batch is put in order, so the answer doesn't hang on how many rows a batch holds.
        coming = sorted(snapshots.items(), reverse=True)
        for run in sorted(runs, key=lambda r: (r.first, r.last, r.key)):
            while coming and coming[-1][0] < run.last:
                yield from self._named(key, self._snapshot(*coming.pop()))
            yield from self._named(key, self._run(run))
        while coming:
            yield from self._named(key, self._snapshot(*coming.pop()))
        self._store(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._load()
        now = timerValues.getCurrentWatermarkInMs()
        for place in [p for p, (*_, since) in self.info.items() if since < now]:
            yield from self._named(key, self._given_up(place, "expired"))
        for snapshot_id in [s for s in self.pending if self.since[s] < now]:
            del self.since[snapshot_id]
        self.pending = [s for s in self.pending if s in self.since]
        self._store(timerValues)

    def _named(self, key, found):
        for epoch, kind, first, last, status, place in found:
            yield _DECISION(key[0], epoch, kind, first, last, status, *(place or (None, None, None)))

    def _load(self) -> None:
        self.last_id, self.epoch, self.synced = self.cursor.get() or (-1, 0, False)
        self.info = {tuple(k): tuple(v) for k, v in self.held.iterator()} if self.held.exists() else {}
        self.stored, self.ends = set(self.info), {}
        self.places = sorted(self.info)
        self.waiting = sum(v[3] for v in self.info.values())
        self.reach = max((last - first + 1 for first, last in self.places), default=0)
        self.since = {k[0]: v[0] for k, v in self.snapshots.iterator()} if self.snapshots.exists() else {}
        self.pending, self.stored_since = sorted(self.since), dict(self.since)

    def _store(self, timerValues) -> None:
        for passed in self.pending[: bisect_right(self.pending, self.last_id)]:
            del self.since[passed]
        for place in self.stored - self.info.keys():
            self.held.removeKey(place)
            self.held_ends.removeKey(place)
        for place, ends in self.ends.items():
            self.held.updateValue(place, self.info[place])
            self.held_ends.updateValue(place, (ends.astype(">i8").tobytes(),))
        for snapshot_id in self.stored_since.keys() - self.since.keys():
            self.snapshots.removeKey((snapshot_id,))
        for snapshot_id, arrived in self.since.items():
            if self.stored_since.get(snapshot_id) != arrived:
                self.snapshots.updateValue((snapshot_id,), (arrived,))
        self.cursor.update((self.last_id, self.epoch, self.synced))
        due = min([*(v[4] for v in self.info.values()), *self.since.values()], default=None)
        if due is not None:
            due = max(due, timerValues.getCurrentWatermarkInMs()) + 1
            if not any(t <= due for t in self.handle.listTimers()):
                self.handle.registerTimer(due)

    def _ends(self, place: tuple[int, int]) -> np.ndarray:
        """The last id of each diff of a held run."""
        return self.ends[place] if place in self.ends else np.frombuffer(self.held_ends.getValue(place)[0], ">i8")

    def _answer(self, run: Run, i: int, j: int, status: str):
        """One status for diffs i to j of a run."""
        if j > i:
            yield self.epoch, "diff", run.start(i), int(run.ends[j - 1]), status, run.key

    def _lost(self, first: int, last: int):
        """The book can't be continued before the diff first..last."""
        self.synced = False
        yield self.epoch, "diff", first, last, "resync", None

    def _run(self, run: Run):
        at = 0
        if self.synced:
            at = int(np.searchsorted(run.ends, self.last_id, "right"))
            yield from self._answer(run, 0, at, "stale")
            if at == len(run.ends):
                return
            if run.start(at) == self.last_id + 1:
                yield from self._apply(run, at)
                yield from self._follow()
                return
        rest = run.part(at, len(run.ends))
        base = self._connecting(rest)
        if base is None:
            yield from self._hold(rest)
            return
        anchor = int(np.searchsorted(rest.ends, base + 1))
        if anchor:
            yield from self._hold(rest.part(0, anchor))
        yield from self._anchor(base, rest, anchor)

    def _connecting(self, run: Run) -> int | None:
        """The earliest waiting snapshot whose next id lies in the run."""
        k = bisect_left(self.pending, max(run.first - 1, self.last_id + 1))
        return self.pending[k] if k < len(self.pending) and self.pending[k] < run.last else None

    def _snapshot(self, snapshot_id: int, arrived: int):
        if snapshot_id <= self.last_id or snapshot_id in self.since:
            return
        self.since[snapshot_id] = arrived
        insort(self.pending, snapshot_id)
        places = self._around(snapshot_id + 1)
        if places:
            run = self._taken(places[0])
            anchor = int(np.searchsorted(run.ends, snapshot_id + 1))
            yield from self._anchor(snapshot_id, run, anchor, held=True)

    def _hold(self, run: Run):
        place, n = (run.first, run.last), len(run.ends)
        if place in self.info:  # the same diffs once more
            yield from self._answer(run, 0, n, "superseded")
            return
        yield from self._answer(run, 0, n, "buffered")
        before = self.waiting
        self.info[place], self.ends[place] = (*run.key, n, run.arrived), run.ends
        insort(self.places, place)
        self.waiting += n
        self.reach = max(self.reach, run.last - run.first + 1)
        # A diff that overlaps the cursor can never follow it, however many more arrive.
        at = 0 if run.first <= self.last_id else self.max_held - before
        if self.synced and at < n:
            yield from self._lost(run.start(at), int(run.ends[at]))

    def _taken(self, place: tuple[int, int]) -> Run:
        """A held run, held no longer."""
        ends = self._ends(place)
        self.ends.pop(place, None)
        *key, n, arrived = self.info.pop(place)
        self.places.pop(bisect_left(self.places, place))
        self.waiting -= n
        return Run(place[0], ends, tuple(key), arrived)

    def _given_up(self, place: tuple[int, int], status: str):
        run = self._taken(place)
        yield from self._answer(run, 0, len(run.ends), status)

    def _around(self, wanted: int) -> list[tuple[int, int]]:
        """Held runs that hold an id, those that begin latest first."""
        out = []
        for k in range(bisect_right(self.places, (wanted, 1 << 62)) - 1, -1, -1):
            first, last = self.places[k]
            if first <= wanted - self.reach:
                break
            if last >= wanted:
                out.append((first, last))
        return out

    def _anchor(self, snapshot_id: int, run: Run, at: int, held: bool = False):
        if self.synced:
            yield from self._lost(run.start(at), int(run.ends[at]))
        self.epoch += 1
        yield self.epoch, "snapshot", snapshot_id, snapshot_id, "applied", None
        if held:
            yield from self._answer(run, 0, at, "stale")
        yield from self._drop(snapshot_id)
        self.synced = True
        yield from self._apply(run, at)
        yield from self._follow()

    def _apply(self, run: Run, at: int):
        self.last_id = run.last
        yield from self._answer(run, at, len(run.ends), "applied")

    def _drop(self, up_to: int):
        """Held runs that end at or before an id are stale."""
        for place in [p for p in self.places[: bisect_right(self.places, (up_to, 1 << 62))] if p[1] <= up_to]:
            yield from self._given_up(place, "stale")

    def _follow(self):
        """Held runs whose turn has come. Of several that go on at the next id, the one whose diff there is the longest."""
        while True:
            best = None
            for place in self._around(self.last_id + 1):
                ends = self._ends(place)
                at = int(np.searchsorted(ends, self.last_id, "right"))
                begins = place[0] if at == 0 else int(ends[at - 1]) + 1
                if begins == self.last_id + 1 and (best is None or ends[at] > best[0]):
                    best = ends[at], place, at
            if best is None:
                break
            run = self._taken(best[1])
            yield from self._answer(run, 0, best[2], "stale")
            yield from self._apply(run, best[2])
        yield from self._drop(self.last_id)
        if self.synced and self.waiting > self.max_held:
            yield from self._lost(self.last_id + 1, self.last_id + 1)


def stage(rows: DataFrame, folder: str, interval: str | None = None) -> StreamingQuery:
    """First query: diffs and snapshots (`diff_rows`, `snapshot_rows`) into `folder`, numbered and cut into runs.

    A column `arrived`, if there is one, is the clock by which waiting rows are given up; else it is the time of the micro-batch.
    """
    return batch_sink(rows, lambda batch, batch_id: _staged(batch, folder, batch_id), f"{folder}/checkpoints/stage", interval)


def decide(spark: SparkSession, folder: str, max_held: int = 0, hold_seconds: float = HOLD_SECONDS, interval: str | None = None) -> StreamingQuery:
    """Second query: what becomes of every staged run and snapshot, as ranges of ids.

    The watermark lies `hold_seconds` behind the newest arrival: what waits longer is given up, what arrives later is not looked at.
    """
    use_rocksdb(spark)
    runs = spark.readStream.schema(RUNS).parquet(f"{folder}/runs").withWatermark("arrived", f"{hold_seconds} seconds").withColumn("arrived_ms", F.unix_millis("arrived"))
    found = runs.groupBy("symbol").transformWithState(statefulProcessor=SequenceGate(max_held), outputStructType=DECISIONS, outputMode="Append", timeMode="EventTime")
    writer = found.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoints/decide")
    return with_trigger(writer, interval).start(f"{folder}/decisions")


def run_once(rows: DataFrame, folder: str, max_held: int = 0, hold_seconds: float = HOLD_SECONDS) -> DataFrame:
    """Both queries over what is there, then `statuses`."""
    stage(rows, folder).awaitTermination()
    decide(rows.sparkSession, folder, max_held, hold_seconds).awaitTermination()
    return statuses(rows.sparkSession, folder)


def statuses(spark: SparkSession, folder: str) -> DataFrame:
    """(symbol, epoch, kind, first_update_id, last_update_id, status, levels): what was said of every diff and snapshot, and every gap.

    Levels come with what was applied only. A diff that waited has a row for it and one for what became of it.
    """
    staged = spark.read.schema(_DIFFS).parquet(f"{folder}/diffs")
    decisions = spark.read.schema(DECISIONS).parquet(f"{folder}/decisions")
    columns = ["symbol", "epoch", "kind", "first_update_id", "last_update_id", "status"]
    ranges = decisions.where("batch is not null").select(*_KEY, "epoch", "kind", "status", F.col("first_update_id").alias("_low"), F.col("last_update_id").alias("_high"))
    diffs = staged.where("not superseded").join(ranges, _KEY).where(F.col("first_update_id").between(F.col("_low"), F.col("_high")))
    diffs = diffs.select(*columns, F.when(F.col("status") == "applied", F.col("levels")).alias("levels"))
    short = staged.where("superseded").select("symbol", F.lit(None).cast("long").alias("epoch"), F.lit("diff").alias("kind"), "first_update_id", "last_update_id", F.lit("superseded").alias("status"), F.lit(None).cast("string").alias("levels"))
    # A snapshot that came more than once is the same document.
    documents = spark.read.schema(_SNAPSHOTS).parquet(f"{folder}/snapshots").groupBy("symbol", "snapshot_id").agg(F.max("levels").alias("levels"))
    used = decisions.where("kind = 'snapshot'").join(documents.withColumnRenamed("snapshot_id", "first_update_id"), ["symbol", "first_update_id"]).select(*columns, "levels")
    gaps = decisions.where("kind = 'diff' and batch is null").select(*columns, F.lit(None).cast("string").alias("levels"))
    return diffs.unionByName(short).unionByName(used).unionByName(gaps)


def applied_levels(gate: DataFrame) -> DataFrame:
    """Level changes of applied rows, with the snapshot of each epoch as its first change."""
    applied = gate.where(F.col("status") == "applied")
    return explode_levels(applied.withColumn("_s", F.from_json("levels", _SIDES)).select(
        "symbol", "epoch", "first_update_id", "last_update_id", "_s.raw_bids", "_s.raw_asks"
    ), "epoch")


def current_book(gate: DataFrame) -> DataFrame:
    """The book of each symbol's newest epoch: levels are reduced first, then older epochs dropped."""
    books = book_state(applied_levels(gate), keys=("symbol", "epoch"))
    anchors = gate.where((F.col("status") == "applied") & (F.col("kind") == "snapshot"))
    newest = anchors.groupBy("symbol").agg(F.max("epoch").alias("epoch"))
    return books.join(newest, ["symbol", "epoch"], "left_semi")
