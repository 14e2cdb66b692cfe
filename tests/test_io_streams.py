import datetime as dt
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthmill.operators import bars as B
from depthmill.operators import parse as P
from depthmill.operators import staging as S
from depthmill.plans import adapters as A
from depthmill.plans import lakehouse
from depthmill.schemas import ENVELOPE
from depthmill.sources import readers as R
from depthmill.sources import topic_files
from depthmill.sources import versions as V
from depthmill.sources import writers as W
from depthmill.streaming import gate, jobs, stalls
from tests.replay import Replay, Resync, random_diffs
from tests.test_parse import message

SMALL = "/root/testdata/sf0.001"


def rows(df, columns=None):
    return sorted(str(tuple(r)) for r in df.select(*(columns or df.columns)).collect())


def feed(spark, path, *texts):
    """Append one file of envelopes."""
    data = [(bytearray(b"x"), bytearray(t, "utf8"), "depth", 0, i, dt.datetime(2024, 1, 1), 0) for i, t in enumerate(texts)]
    spark.createDataFrame(data, ENVELOPE).coalesce(1).write.mode("append").parquet(path)


def finish(*queries):
    for q in queries:
        q.awaitTermination()


def test_ingest_restarts_without_loss_or_duplicates(spark, folder):
    source = folder + "/in"

    def run():
        stream = R.envelope_stream(spark, "parquet", path=source)
        finish(*jobs.ingest(stream, folder + "/bronze", folder + "/bad", folder + "/cp", interval=None))

    feed(spark, source, message(), "junk", message(U=10, u=12))
    run()
    run()
    feed(spark, source, message(U=13, u=15, s="OTHER"), "{}")
    run()
    schema = P.accepted(P.parse_depth(R.envelope_batch(spark, "parquet", path=source))).schema
    stored = R.lake_table(spark, folder + "/bronze", schema=schema)
    assert sorted(r.first_update_id for r in stored.collect()) == [5, 10, 13]
    assert rows(stored, schema.names) == rows(P.accepted(P.parse_depth(R.envelope_batch(spark, "parquet", path=source))))
    assert spark.read.parquet(folder + "/bad").count() == 2


def test_partitions_prune(spark, folder):
    bronze = P.accepted(P.parse_depth(spark.createDataFrame([(message(),), (message(E=1704200000000, s="B"),)], "value string")))
    W.spread(bronze).write.partitionBy("date", "symbol").parquet(folder + "/t")
    table = R.lake_table(spark, folder + "/t", schema=bronze.schema)
    one = R.days(table, "2024-01-01", "2024-01-01", ["ETHUSDT"]).select("last_update_id")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "date" in filters.split("PartitionFilters")[1] and "symbol" in filters.split("PartitionFilters")[1]
    assert "raw_bids" not in plan.split("ReadSchema")[1]


def test_batches_are_bounded_and_writes_repeatable(spark, folder):
    for i in range(3):
        feed(spark, folder + "/in", message(U=i, u=i))
    seen = []
    stream = jobs.bronze_stream(R.envelope_stream(spark, "parquet", path=folder + "/in", maxFilesPerTrigger="1"))
    once = W.append_once(folder + "/out")

    def write(batch, batch_id):
        seen.append(batch_id)
        once(batch, batch_id)
        once(batch, batch_id)

    finish(W.batch_sink(stream, W.fan_out(write, W.append_once(folder + "/copy")), folder + "/cp"))
    assert len(seen) == 3
    assert spark.read.parquet(folder + "/out").count() == spark.read.parquet(folder + "/copy").count() == 3


def test_console_and_memory(spark, folder):
    feed(spark, folder + "/in", message())
    stream = jobs.bronze_stream(R.envelope_stream(spark, "parquet", path=folder + "/in"))
    finish(W.console_sink(stream.select("symbol"), interval=None), W.memory_sink(stream, "seen"))
    assert spark.table("seen").count() == 1


def test_broker_source_options():
    assert R.broker_options("h:1", "t", 50) == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "maxOffsetsPerTrigger": "50"}


def test_publish_and_read_back(spark, folder):
    bronze = P.accepted(P.parse_depth(spark.createDataFrame([(message(),)], "value string")))
    W.publish(P.to_messages(bronze), "parquet", path=folder + "/out")
    assert P.accepted(P.parse_depth(spark.read.parquet(folder + "/out"))).first().last_update_id == 9


def test_table_refresh(spark, folder):
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "date string, x int").withColumn("date", F.to_date("date"))
    W.refresh_days(df, folder + "/t")
    W.refresh_days(df.where("x = 2").withColumn("x", F.lit(9)), folder + "/t")
    assert sorted(r.x for r in spark.read.parquet(folder + "/t").collect()) == [1, 9]
    counted, seen = W.counted(df, "n")
    W.refresh_table(counted, folder + "/full")
    assert seen.get["rows"] == 2
    W.as_view(df, "some_view")
    assert spark.table("some_view").count() == 2


def test_table_chains(spark, folder):
    source = A.events(spark, SMALL)
    parsed = P.accepted(P.parse_depth(A.message_text(A.retried(source)), "message"))
    paths = lakehouse.build_depth_tables(parsed, folder)
    silver = spark.read.parquet(paths["silver_order_book"])
    assert silver.count() == S.stage_quotes(parsed).count()
    expected = B.depth_bars(S.quote_metrics(S.stage_quotes(parsed)), "5 minutes")
    assert spark.read.parquet(paths["gold_features_5m"]).count() == expected.count()
    counts = lakehouse.refresh_minute_tables(lakehouse.staging_of(A.envelopes(source)), folder)
    assert counts["silver_minute"] == counts["gold_minute"] == spark.read.parquet(folder + "/gold_minute").count() > 0


def test_streamed_bars_equal_batch_bars(spark, folder):
    source = A.events(spark, SMALL).withColumn("part", F.floor(F.col("event_id") / 300))
    for i in range(4):
        source.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(folder + "/in")
    stored = spark.read.parquet(folder + "/in")
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", "1").parquet(folder + "/in")

    def metrics(df):
        return A.quotes(df).transform(S.valid_quotes).transform(S.price_metrics)

    query = (
        jobs.bars_stream(metrics(stream), "60 minutes", "1 minute").writeStream.format("parquet")
        .option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start(folder + "/out")
    )
    finish(query)
    batch = B.depth_bars(metrics(stored), "60 minutes")
    closed = batch.where(F.col("window_end") <= F.lit(metrics(stored).agg(F.max("event_ts")).first()[0]) - F.expr("INTERVAL 1 MINUTE"))
    # Files are read in time order, so nothing is late and every closed bar is there.
    exact = ["window_start", "window_end", "symbol", "update_count", "mid_price_open", "mid_price_close"]
    assert rows(spark.read.parquet(folder + "/out"), exact) == rows(closed, exact)


def test_gold_stream_runs_end_to_end(spark, folder):
    first = 1704067200000
    feed(spark, folder + "/in", *[message(E=first + 20_000 * i, U=i, u=i) for i in range(60)], message(E=first, U=3, u=3))
    stream = jobs.gold_stream(R.envelope_stream(spark, "parquet", path=folder + "/in"))
    finish(stream.writeStream.format("parquet").option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start(folder + "/out"))
    bars = spark.read.parquet(folder + "/out")
    assert bars.count() > 10 and {r.update_count for r in bars.collect()} == {3}


GATE_IN = "symbol string, kind string, first_update_id long, last_update_id long, levels string, arrived timestamp"


def levels(bids, asks):
    import json

    return json.dumps({"raw_bids": bids, "raw_asks": asks})


def run_gate(spark, folder, batches, max_held, hold=gate.HOLD_SECONDS):
    """Batches one after another, a second apart; the queries restart for each, or take a file at a time of many."""
    schema = spark.createDataFrame([], GATE_IN).schema
    known = len(spark.read.parquet(folder + "/in").select("arrived").distinct().collect()) if os.path.exists(folder + "/in") else 0
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
    for i, batch in enumerate(batches):
        rows = [(*row, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=known + i)) for row in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder + "/in")
        if len(batches) <= 5:
            out = gate.run_once(stream(), folder + "/gate", max_held, hold)
    return out if len(batches) <= 5 else gate.run_once(stream(), folder + "/gate", max_held, hold)


def book_of(df):
    return {(r.side, r.price): r.qty for r in df.collect()}


def replay_book(replay):
    return {(side, p): q for side, lv in replay.sides.items() for p, q in lv.items()}


def as_diff(d):
    return ("S", "diff", d[0], d[1], levels(d[2], d[3]))


def as_snapshot(i, bids=(), asks=()):
    return ("S", "snapshot", i, i, levels(list(bids), list(asks)))


def test_gate_follows_the_rules_batch_by_batch(spark, folder):
    rng = random.Random(11)
    diffs = random_diffs(rng, 40)
    base = [["85.00000000", "4.00000000"]]
    gap_at, resumed = 25, diffs[30]
    snapshot, second = diffs[5][1], resumed[1]
    batches = [
        [as_diff(d) for d in diffs[:10]],  # buffered: no snapshot yet
        [as_snapshot(snapshot, base)],  # drains the buffer
        [as_diff(d) for d in diffs[10:gap_at]] + [as_diff(diffs[3])],  # in order, and one stale repeat
        [as_diff(d) for d in diffs[27:]],  # two diffs lost
        [as_snapshot(second, base)],  # fresh snapshot inside what was buffered
    ]
    out = run_gate(spark, folder, batches, max_held=0)
    applied = sorted(r.first_update_id for r in out.where("status = 'applied' AND kind = 'diff'").collect())
    assert applied == [d[0] for d in diffs[6:gap_at] + diffs[31:]]
    assert out.where("status = 'resync'").count() == 1
    assert diffs[3][0] in [r.first_update_id for r in out.where("status = 'stale'").collect()]
    replay = Replay()
    replay.load(second, base, [])
    for d in diffs[28:]:
        replay.apply(*d)
    assert book_of(gate.current_book(out)) == replay_book(replay)


@pytest.mark.parametrize("seed", [1, 2])
def test_gate_reorders_early_diffs(spark, folder, seed):
    rng = random.Random(seed)
    diffs = random_diffs(rng, 60)
    shuffled = diffs[:]
    for i in range(0, 60, 6):
        part = shuffled[i : i + 6]
        rng.shuffle(part)
        shuffled[i : i + 6] = part
    thirds = [shuffled[i : i + 7] for i in range(0, 60, 7)]
    batches = [[as_snapshot(0)] + [as_diff(d) for d in thirds[0]]] + [[as_diff(d) for d in t] for t in thirds[1:]]
    out = run_gate(spark, folder, batches, max_held=10)
    replay = Replay()
    replay.load(0, [], [])
    for d in diffs:
        replay.apply(*d)
    assert out.where("status = 'applied' AND kind = 'diff'").count() == 60
    assert out.where("status = 'resync'").count() == 0
    assert book_of(gate.current_book(out)) == replay_book(replay)


@pytest.mark.parametrize("parts", [1, 3, 30])
def test_gate_does_not_depend_on_the_size_of_a_batch(spark, folder, parts):
    count = 30_000
    diffs = [("S", "diff", i + 1, i + 1, levels([], [])) for i in range(count)]
    random.Random(parts).shuffle(diffs)
    step = count // parts
    batches = [[as_snapshot(0)] + diffs[:step], *(diffs[k : k + step] for k in range(step, count, step))]
    out = run_gate(spark, folder, batches, max_held=count)
    final = out.where("kind = 'diff' AND status <> 'buffered'").groupBy("status").agg(F.count("*").alias("n"), F.countDistinct("first_update_id").alias("ids")).collect()
    assert [tuple(r) for r in final] == [("applied", count, count)]
    seen = spark.read.schema(gate.RUNS).parquet(folder + "/gate/runs").where("kind = 'run'").count()
    if parts == 1:
        assert seen <= count // gate.SLICE_IDS + 1  # one row for each run, not for each diff


def test_gate_gives_up_what_waits_too_long(spark, folder):
    none = levels([], [])
    early = [[as_snapshot(0)] + [("S", "diff", i, i, none) for i in (1, 2, 5, 6, 9)]]
    out = run_gate(spark, folder, [*early, [("T", "diff", 1, 1, none)], [("T", "diff", 2, 2, none)], [("T", "diff", 3, 3, none)]], max_held=10, hold=2)
    assert sorted((r.symbol, r.first_update_id) for r in out.where("status = 'expired'").collect()) == [("S", 5), ("S", 6), ("S", 9)]
    out = run_gate(spark, folder, [[("S", "diff", 3, 4, none), ("S", "diff", 5, 5, none)]], max_held=10, hold=2)
    assert sorted(r.first_update_id for r in out.where("status = 'applied' AND symbol = 'S' AND kind = 'diff'").collect()) == [1, 2, 3, 5]


def test_gate_runs_that_overlap(spark, folder):
    """Repeats across batches, a run whose turn comes in its middle, and a diff that straddles the cursor."""
    diff = lambda a, b: ("S", "diff", a, b, levels([], []))
    batches = [
        [as_snapshot(0), diff(1, 2), diff(3, 4)],
        [diff(7, 8), diff(9, 10), diff(11, 12)],  # early
        [diff(9, 10), diff(11, 12), diff(13, 14)],  # overlaps what waits
        [diff(5, 6)],
        [diff(3, 4), diff(5, 6), diff(15, 16)],  # mostly old
        [diff(16, 18), diff(19, 20)],  # straddles 16
        [as_snapshot(18)],
    ]
    out = run_gate(spark, folder, batches, max_held=100).where("kind = 'diff'")
    by = lambda status: sorted((r.first_update_id, r.last_update_id) for r in out.where(F.col("status") == status).collect())
    assert by("applied") == [(i, i + 1) for i in range(1, 17, 2)] + [(19, 20)]
    assert by("resync") == [(16, 18)] and (16, 18) in by("stale") and by("superseded") == []
    assert [x for x in by("stale") if x[0] < 15] == [(3, 4), (5, 6), (9, 10), (11, 12)]


def test_gate_keeps_the_longer_of_two_diffs_and_announces_every_gap(spark, folder):
    same = [("S", "diff", 1, 3, levels([], [])), ("S", "diff", 1, 5, levels([], []))]
    later = [("S", "diff", i, i, levels([], [])) for i in (8, 9)]
    out = run_gate(spark, folder, [same + later, [as_snapshot(0)]], max_held=0)
    found = {(r.status, r.first_update_id, r.last_update_id) for r in out.where("kind = 'diff'").collect()}
    assert ("superseded", 1, 3) in found and ("applied", 1, 5) in found and ("resync", 6, 6) in found


class _State(dict):
    """A map or value state that counts the calls which change it."""

    calls = 0
    exists = dict.__len__
    get = lambda self: dict.get(self, None)
    getValue = dict.__getitem__  # noqa: N815

    def iterator(self):
        return iter(list(self.items()))

    def update(self, value):
        self[None] = value

    def updateValue(self, key, value):  # noqa: N802
        _State.calls, self[key] = _State.calls + 1, value

    def removeKey(self, key):  # noqa: N802
        _State.calls += 1
        del self[key]


def test_gate_stores_only_what_outlives_a_batch():
    """State is behind a socket: 500 snapshots and 1,000 runs that come and go within a batch don't touch it."""
    states = {}

    def state(name, *_):
        return states.setdefault(name, _State())

    handle = type("Handle", (), {"getValueState": staticmethod(state), "getMapState": staticmethod(state), "listTimers": staticmethod(lambda: [0]), "registerTimer": staticmethod(lambda at: None)})
    timers = type("Timers", (), {"getCurrentWatermarkInMs": staticmethod(lambda: 0)})
    row = type("Row", (), {})

    def coming(kind, first, last):
        out = row()
        out.kind, out.first_update_id, out.last_update_id, out.arrived_ms = kind, first, last, 7
        out.batch, out.slice, out.run, out.ends = 0, 0, first, np.arange(first, last + 1, dtype=">i8").tobytes()
        return out

    processor = gate.SequenceGate()
    processor.init(handle)
    rows = [coming("run", 10 * i, 10 * i + 7) for i in range(1000)] + [coming("snapshot", 20 * i + 3, 20 * i + 3) for i in range(500)]
    _State.calls = 0
    said = list(processor.handleInputRows(("S",), iter(rows), timers))
    assert sum(r.status == "applied" and r.kind == "snapshot" for r in said) == 500
    assert _State.calls == 2  # the last run waits, in two maps, for no snapshot connects to it
    assert list(states["held"]) == [(9990, 9997)] and not states["snapshots"]
    # What waits is found again in the next batch, and leaves the state with it.
    said = list(processor.handleInputRows(("S",), iter([coming("snapshot", 9992, 9992)]), timers))
    assert [(r.first_update_id, r.last_update_id) for r in said if r.kind == "diff" and r.status == "applied"] == [(9993, 9997)]
    assert not states["held"] and not states["held_ends"] and not states["snapshots"]


def test_replay_model_raises_on_gaps():
    replay = Replay()
    replay.load(0, [], [])
    replay.apply(1, 2, [], [])
    with pytest.raises(Resync):
        replay.apply(4, 5, [], [])


def test_gate_input_builders(spark):
    bronze = P.accepted(P.parse_depth(spark.createDataFrame([(message(),)], "value string")))
    snapshots = spark.createDataFrame([("S", 7, [["1.0", "2.0"]], [])], "symbol string, lastUpdateId long, bids array<array<string>>, asks array<array<string>>")
    both = gate.diff_rows(bronze).unionByName(gate.snapshot_rows(snapshots))
    assert sorted((r.kind, r.first_update_id) for r in both.collect()) == [("diff", 5), ("snapshot", 7)]
    as_gate = both.withColumns({"epoch": F.lit(1).cast("long"), "status": F.lit("applied")})
    assert gate.applied_levels(as_gate).count() == 5


def alerts_of(spark, folder, parts):
    """Alerts of (symbol, second) arrivals, a part after another."""
    kind = "symbol string, arrived timestamp"
    for part in parts:
        rows = [(s, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=t)) for s, t in part]
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(folder + "/in")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
    alerts = stalls.stalls_stream(stream.where("symbol <> 'beat'"), stream.where("symbol = 'beat'").withColumn("symbol", F.lit(None).cast("string")), interval_seconds=10, threshold=2)
    finish(alerts.writeStream.format("parquet").option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start(folder + "/out"))
    found = spark.read.schema(alerts.schema).parquet(folder + "/out").collect()
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()
    return sorted((r.symbol, int(r.ts.replace(tzinfo=dt.timezone.utc).timestamp() - start), r.consecutive_failures) for r in found)


def test_silence_raises_the_same_alerts_in_any_batches(spark, tmp_path):
    arrivals = sorted([("X", t) for t in (0, 1, 35, 36, 100)] + [("Y", t) for t in range(0, 100, 9)] + [("Z", 5)] + [("beat", 130)], key=lambda x: x[1])
    want = [("X", 21, 2), ("X", 31, 3), ("X", 56, 2), ("X", 66, 3), ("X", 76, 4), ("X", 86, 5), ("X", 96, 6), ("X", 120, 2), ("Y", 119, 2), ("Y", 129, 3)]
    want += [("Z", 5 + 10 * n, n) for n in range(2, 13)]
    whole = alerts_of(spark, str(tmp_path / "one"), [arrivals])
    assert whole == sorted(want)
    assert alerts_of(spark, str(tmp_path / "many"), [arrivals[k : k + 7] for k in range(0, len(arrivals), 7)]) == whole


def test_open_bars_take_the_newest_version(spark, folder):
    source = A.events(spark, SMALL).withColumn("part", F.col("event_id") % 3)  # every part changes most bars
    for i in range(3):
        source.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(folder + "/in")
    stored = spark.read.parquet(folder + "/in")
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", "1").parquet(folder + "/in")

    def metrics(df):
        return A.quotes(df).transform(S.valid_quotes).transform(S.price_metrics)

    bars = jobs.bars_stream(metrics(stream), "60 minutes", "60 days")
    finish(jobs.open_bars(bars, folder + "/bars", folder + "/cp", interval=None))
    exact = ["window_start", "window_end", "symbol", "update_count", "mid_price_open", "mid_price_close"]
    newest = jobs.newest_bars(spark, folder + "/bars", bars.schema)
    assert rows(newest, exact) == rows(B.depth_bars(metrics(stored), "60 minutes"), exact)
    assert spark.read.parquet(folder + "/bars").count() > newest.count()
    assert jobs.fold_versions(spark, folder + "/bars", bars.schema, folder + "/folded") == 1
    assert rows(V.read(spark, folder + "/folded"), exact) == rows(newest, exact)


def test_versions_outlive_rebuilds(spark, folder):
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    with pytest.raises(ValueError):
        V.read(spark, folder + "/t")
    assert V.publish(frame(1), folder + "/t") == 1
    early = V.read(spark, folder + "/t")
    with pytest.raises(Exception):
        V.publish(frame(2).withColumn("id", F.raise_error(F.lit("lost")).cast("int")), folder + "/t")
    assert V.publish(frame(3, 4), folder + "/t") == 2
    open(folder + "/t/commits/00000000000000000009", "w").write("cut o")  # a commit that never ended
    assert rows(early) == ["(1,)"] and rows(V.read(spark, folder + "/t")) == ["(3,)", "(4,)"] and rows(V.read(spark, folder + "/t", 1)) == ["(1,)"]
    assert V.publish(frame(5), folder + "/t") == 3
    assert V.expire(spark, folder + "/t", keep=2) == [1] and list(V.versions(spark, folder + "/t")) == [2, 3]
    assert len(os.listdir(folder + "/t/data")) == 2 and rows(V.read(spark, folder + "/t")) == ["(5,)"]


def test_a_number_that_is_taken_is_not_taken_again(spark, folder, monkeypatch):
    V.publish(spark.range(1), folder + "/t")
    monkeypatch.setattr(V, "versions", lambda spark, path: {})  # what a build sees that started at the same time
    assert V.publish(spark.range(2), folder + "/t") == 2


def topic(spark, path, *offsets):
    """(partition, offset) envelopes of two offsets a segment."""
    data = [(None, bytearray(f"{p}-{o}", "utf8"), "t", p, o, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=o), 0) for p, o in offsets]
    return topic_files.export(spark.createDataFrame(data, ENVELOPE), path, segment=2)


def test_topic_files_give_ranges_of_offsets(spark, folder):
    spark.dataSource.register(topic_files.TopicFiles)
    read = lambda **options: sorted((r.partition, r.offset) for r in spark.read.format("topic_files").options(path=folder + "/t", **options).load().collect())
    assert read() == []
    every = [(0, o) for o in range(7)] + [(1, o) for o in (3, 4, 9)]  # offsets may have holes
    assert topic(spark, folder + "/t", *every) == 7
    assert read() == every and read(offsetsPerTask="1") == every
    assert read(startingOffsets="latest") == []
    assert read(startingOffsets='{"0": 5, "1": -2}', endingOffsets='{"0": -1, "1": 9}') == [(0, 5), (0, 6), (1, 3), (1, 4)]
    whole = spark.read.format("topic_files").option("path", folder + "/t").load()
    assert whole.schema == ENVELOPE and {(r.partition, r.offset, bytes(r.value).decode(), r.timestamp.second) for r in whole.collect()} == {(p, o, f"{p}-{o}", o) for p, o in every}
    parts = topic_files.TopicReader({"path": folder + "/t", "startingOffsets": '{"0": 4, "1": -1}'}).partitions()
    assert [(x.partition, x.start, x.end) for x in parts] == [(0, 4, 6), (0, 6, 7)]  # other segments aren't opened


def test_topic_stream_goes_on_where_it_stopped(spark, folder):
    spark.dataSource.register(topic_files.TopicFiles)
    topic(spark, folder + "/t", *[(p, o) for p in (0, 1) for o in range(6)])

    def run(**options):
        stream = spark.readStream.format("topic_files").options(path=folder + "/t", **options).load()
        query = W.batch_sink(stream, W.append_once(folder + "/out"), folder + "/cp", interval="0 seconds")
        query.processAllAvailable()
        query.stop()
        out = spark.read.parquet(folder + "/out").select("batch_id", "partition", "offset").collect()
        return sorted((r.partition, r.offset) for r in out), max(len([1 for r in out if r.batch_id == b]) for b in {r.batch_id for r in out})

    limited = {"startingOffsets": '{"0": 2, "1": -2}', "maxOffsetsPerTrigger": "4", "progress": folder + "/progress"}
    want = [(0, o) for o in range(2, 6)] + [(1, o) for o in range(6)]
    assert run(**limited) == (want, 4)
    topic(spark, folder + "/t", (0, 6), (0, 7), (2, 0))
    assert run(**limited) == (sorted([*want, (0, 6), (0, 7), (2, 0)]), 4)
    with pytest.raises(ValueError, match="progress"):
        topic_files.TopicStream({"path": folder, "maxOffsetsPerTrigger": "1"})
    assert topic_files.TopicStream({"path": folder + "/t"}).initialOffset() == {"0": 8, "1": 6, "2": 1}


def test_topic_stream_lists_once_and_reads_small_segments_together(spark, folder, monkeypatch):
    topic(spark, folder + "/t", *[(p, o) for p in (0, 1) for o in range(20)])
    listed, whole = [], topic_files.Segments
    monkeypatch.setattr(topic_files, "Segments", lambda path: listed.append(path) or whole(path))
    stream = topic_files.TopicStream({"path": folder + "/t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "8", "progress": folder + "/progress"})
    at, seen = stream.initialOffset(), []
    listed.clear()
    for _ in range(5):
        end = stream.latestOffset()
        tasks = stream.partitions(at, end)
        assert len(tasks) == 1  # four segments of two offsets
        seen += [(x.partition, o) for task in tasks for x in task.slices for o in range(x.start, x.end)]
        at = end
    assert sorted(seen) == [(p, o) for p in (0, 1) for o in range(20)] and len(listed) == 1
    topic(spark, folder + "/t", (0, 20))
    assert stream.latestOffset() == {"0": 21, "1": 20} and len(listed) == 2
    assert [len(x.slices) for x in topic_files.together(whole(folder + "/t").slices({}, {0: 6}, 100), 4)] == [2, 1]
    assert whole(folder + "/t").slices({}, {0: 0}, 100) == []
