import random

import pytest
from pyspark.sql import functions as F

from depthmill.operators import book as K
from depthmill.operators import sequence as N
from tests.replay import Replay, Resync, random_diffs

DIFFS = "symbol string, first_update_id long, last_update_id long, raw_bids array<array<string>>, raw_asks array<array<string>>"
SNAPSHOTS = "symbol string, lastUpdateId long, bids array<array<string>>, asks array<array<string>>"


def diffs_frame(spark, by_symbol):
    rows = [(s, *d) for s, diffs in by_symbol.items() for d in diffs]
    return spark.createDataFrame(rows, DIFFS).repartition(4)


def state_of(df):
    return {(r.symbol, r.side, r.price): r.qty for r in df.collect()}


def replayed(symbol, diffs, snapshot=(0, [], [])):
    book = Replay()
    book.load(*snapshot)
    for diff in diffs:
        book.apply(*diff)
    return {(symbol, side, p): q for side, levels in book.sides.items() for p, q in levels.items()}


@pytest.mark.parametrize("exact", [False, True])
def test_book_equals_replay(spark, exact):
    by_symbol = {f"S{i}": random_diffs(random.Random(i), 150) for i in range(4)}
    expected = {k: v for s, d in by_symbol.items() for k, v in replayed(s, d).items()}
    levels = K.explode_levels(diffs_frame(spark, by_symbol))
    assert state_of(K.book_state(levels, exact_text=exact)) == expected


def test_snapshot_plus_later_diffs(spark):
    diffs = random_diffs(random.Random(8), 120)
    cut = diffs[60][1]
    snapshot = (cut, [["85.00000000", "1.00000000"], ["70.00000000", "2.00000000"]], [["130.00000000", "3.00000000"]])
    later = diffs[61:]
    base = K.snapshot_levels(spark.createDataFrame([("S", *snapshot)], SNAPSHOTS))
    got = state_of(K.book_state(K.explode_levels(diffs_frame(spark, {"S": later})), base=base))
    assert got == replayed("S", later, snapshot)


def test_as_of(spark):
    diffs = random_diffs(random.Random(3), 80)
    levels = K.explode_levels(diffs_frame(spark, {"S": diffs}))
    for i in (0, 10, 40):
        assert state_of(K.book_state(levels, as_of=diffs[i][1])) == replayed("S", diffs[: i + 1])


def test_later_position_wins_and_absent_deletion_is_harmless(spark):
    diff = (1, 1, [["9.0", "1.00000000"], ["9.0", "2.00000000"], ["8.0", "0.00000000"]], [])
    got = state_of(K.book_state(K.explode_levels(diffs_frame(spark, {"S": [diff]}))))
    assert got == {("S", "bid", "9.0"): "2.00000000"}


def test_price_text_is_the_key_and_its_value_the_order(spark):
    diff = (1, 1, [["71000.0", "1.00000000"], ["71000.00000000", "2.00000000"], ["9000.0", "3.00000000"]], [])
    state = K.book_state(K.explode_levels(diffs_frame(spark, {"S": [diff]})))
    assert state.count() == 3
    top = {r.rank: r.price for r in K.top_levels(state, 5).collect()}
    assert top[3] == "9000.0"


def test_only_the_exact_zero_deletes_in_text_mode(spark):
    diff = (1, 1, [["9.0", "0.0"], ["8.0", "0.00000000"]], [])
    levels = K.explode_levels(diffs_frame(spark, {"S": [diff]}))
    assert state_of(K.book_state(levels, exact_text=True)) == {("S", "bid", "9.0"): "0.0"}
    assert state_of(K.book_state(levels)) == {}


def test_small_and_unreadable_quantities(spark):
    diff = (1, 1, [["9.0", "0.000000001"], ["8.0", "much"], ["7.0", "2.0"]], [])
    levels = K.explode_levels(diffs_frame(spark, {"S": [diff, (2, 2, [["7.0", None]], [])]}))
    assert state_of(K.book_state(levels)) == {("S", "bid", "9.0"): "0.000000001", ("S", "bid", "7.0"): "2.00000000"}
    assert sorted(r.price for r in K.unreadable_levels(levels).collect()) == ["7.0", "8.0"]


def test_wide_ids_give_the_same_book(spark):
    diffs = random_diffs(random.Random(5), 60)
    levels = K.explode_levels(diffs_frame(spark, {"S": diffs}))
    assert state_of(K.book_state(levels, wide_ids=True)) == state_of(K.book_state(levels))
    far = levels.withColumn("last_update_id", F.col("last_update_id") + F.lit(1 << 62))
    assert state_of(K.book_state(far, wide_ids=True)) == state_of(K.book_state(levels))
    with pytest.raises(Exception, match="too large"):
        K.book_state(far).collect()
    with pytest.raises(Exception, match="no update id"):
        K.book_state(levels.withColumn("last_update_id", F.lit(None).cast("long"))).collect()


def test_numeric_book_is_a_hash_aggregation(spark):
    levels = K.explode_levels(diffs_frame(spark, {"S": random_diffs(random.Random(1), 5)}))
    plan = K.book_state(levels)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_top_levels_spread_and_ladder(spark):
    diffs = random_diffs(random.Random(5), 200)
    state = K.book_state(K.explode_levels(diffs_frame(spark, {"S": diffs})))
    book = Replay()
    book.load(0, [], [])
    for d in diffs:
        book.apply(*d)
    for side in ("bid", "ask"):
        rows = K.top_levels(state, 4).where(F.col("side") == side).orderBy("rank").collect()
        assert [r.price for r in rows] == book.top(side, 4)
    best = K.best_spread(state).first()
    assert float(best.spread) == pytest.approx(float(book.top("ask", 1)[0]) - float(book.top("bid", 1)[0]))
    for band in (1.0, 5.0, 1000.0):
        for side in ("bid", "ask"):
            total = 0.0
            got = {r.price: r.cumulative_qty for r in K.depth_ladder(state, band).where(F.col("side") == side).collect()}
            for price in book.top(side, 100):
                total += float(book.sides[side][price])
                assert got[price] == pytest.approx(total)
    text = K.ladder_text(K.depth_ladder(state)).first()
    assert text.qty_text.count(".") == 1 and len(text.qty_text.split(".")[1]) == 8


def test_one_sided_book_has_no_spread(spark):
    state = K.book_state(K.explode_levels(diffs_frame(spark, {"S": [(1, 1, [["9.0", "1.0"]], [])]})))
    assert K.best_spread(state).first().spread is None


def test_spot_check(spark):
    book = K.book_state(K.explode_levels(diffs_frame(spark, {"S": [(1, 1, [[f"{90 - i}.0", "1.0"] for i in range(6)], [[f"{100 + i}.0", "1.0"] for i in range(3)])]})))
    snapshots = spark.createDataFrame([("S", 5, [["90.0", "7.0"], ["88.0", "1.0"], ["87.0", "1.0"]], [["100.0", "1.0"], ["101.0", "1.0"], ["102.5", "1.0"]])], SNAPSHOTS)
    row = K.spot_check(K.top_levels(book, 5), K.first_levels(snapshots, 5)).first()
    assert (row.matched, row.total, row.pct) == (3, 10, 30.0)
    assert [(m.side, m["rank"]) for m in row.mismatches] == [("ask", 3), ("bid", 2), ("bid", 3)]


def gapped(rng, runs=6, per_run=25):
    """Contiguous runs with lost ids between them."""
    out, start = [], 1
    for _ in range(runs):
        run = random_diffs(rng, per_run, start=start)
        out.append(run)
        start = run[-1][1] + 1 + rng.choice([1, 50])
    return out


def test_continuity_and_epochs(spark):
    runs = gapped(random.Random(2))
    flat = [d for run in runs for d in run]
    df = diffs_frame(spark, {"A": flat, "B": flat[:10]})
    for width in (4, 64, 1 << 18):
        checked = [r for r in N.continuity(df, width).where("symbol = 'A'").orderBy("first_update_id").collect()]
        for previous, row in zip(flat, checked[1:]):
            assert row.prev_update_id == previous[1] and row.gap == row.first_update_id - previous[1] - 1
            assert row.result == ("PASS" if row.gap == 0 else "FAIL")
        assert checked[0].result is None and checked[0].gap is None
        epoch = {r.first_update_id: r.epoch for r in N.epochs(df, width).where("symbol = 'A'").collect()}
        assert epoch == {d[0]: i for i, run in enumerate(runs) for d in run}
    summary = {r.symbol: r for r in N.gap_summary(N.continuity(df)).collect()}
    lost = sum(b[0][0] - a[-1][1] - 1 for a, b in zip(runs, runs[1:]))
    assert (summary["A"].transitions, summary["A"].failures, summary["A"].lost_ids) == (len(flat) - 1, 5, lost)
    assert (summary["B"].failures, summary["B"].lost_ids) == (0, 0)


def test_overlap_counts_as_failure(spark):
    df = spark.createDataFrame([("A", 1, 5), ("A", 4, 8), ("A", 9, 9)], "symbol string, first_update_id long, last_update_id long")
    rows = N.continuity(df).orderBy("first_update_id").collect()
    assert [(r.gap, r.result) for r in rows] == [(None, None), (-2, "FAIL"), (0, "PASS")]
    assert N.gap_summary(N.continuity(df)).first().lost_ids == 0


def test_anchors_equal_brute_force(spark):
    flat = [d for run in gapped(random.Random(4), 8, 30) for d in run]
    ids = list(range(0, flat[-1][1] + 5, 3))
    df = diffs_frame(spark, {"A": flat})
    snapshots = spark.createDataFrame([("A", i) for i in ids], "symbol string, snapshot_id long")
    expected = sorted((d[0], i) for d in flat for i in ids if d[0] <= i + 1 <= d[1])
    for width in (1, 5, 4096):
        got = N.snapshot_anchors(df.select("symbol", "first_update_id", "last_update_id"), snapshots, width)
        assert sorted((r.first_update_id, r.snapshot_id) for r in got.collect()) == expected


def test_messages_are_read_once(spark):
    """Continuity, epochs and statuses from one read, whatever they need of it."""
    flat = [d for run in gapped(random.Random(9), 5, 40) for d in run]
    df = diffs_frame(spark, {"A": flat, "B": flat[:30]}).select("symbol", "first_update_id", "last_update_id")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = df.mapInArrow(counted, df.schema)
    snapshots = spark.createDataFrame([("A", flat[3][1]), ("B", flat[7][1])], "symbol string, snapshot_id long")
    for job in (lambda: N.epochs(source, 16), lambda: N.synchronise(source, snapshots, 16)):
        seen.value = 0
        assert job().count() == df.count() == seen.value


def test_a_message_with_a_wrong_first_id_takes_no_anchor(spark):
    """One that claims to start at 0 spans everything; nothing is listed per id, and the others keep what they hold."""
    rows = [("A", i, i + 4) for i in range(1_000_000, 1_000_100, 5)] + [("A", 0, 2_000_000), ("B", 7, 9)]
    messages = spark.createDataFrame(rows, "symbol string, first_update_id long, last_update_id long")
    snapshots = spark.createDataFrame([("A", 1_000_011), ("A", 1_000_099), ("A", 5), ("A", 1_500_000), ("B", 6), ("B", 9), ("C", 1)], "symbol string, snapshot_id long")
    for width in (7, N.SLICE_IDS):
        got = N.snapshot_anchors(messages, snapshots, width)
        found = sorted((r.symbol, r.first_update_id, r.snapshot_id) for r in got.collect())
        assert found == [("A", 0, 5), ("A", 1_000_010, 1_000_011), ("B", 7, 6)]
        assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()


def test_synchronise_equals_replay(spark):
    runs = gapped(random.Random(6))
    flat = [d for run in runs for d in run]
    ids = [runs[0][3][1], runs[1][-1][1], runs[2][0][0] - 1, runs[2][9][1], runs[4][7][1]]
    expected = {}
    for run in runs:
        usable = [i for i in ids if any(d[0] <= i + 1 <= d[1] for d in run)]
        book = Replay()
        if usable:
            book.load(min(usable), [], [])
        for d in run:
            if not usable:
                expected[d[0]] = "unanchored"
                continue
            try:
                expected[d[0]] = "applied" if book.apply(*d) else "stale"
            except Resync:
                raise AssertionError("a run is gap-free")
    got = N.synchronise(diffs_frame(spark, {"A": flat}), spark.createDataFrame([("A", i) for i in ids], "symbol string, snapshot_id long"), 16)
    assert {r.first_update_id: r.status for r in got.collect()} == expected
