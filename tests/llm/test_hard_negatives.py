"""Hard negatives against all scores, and the certainty of the intervals that leave scores out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthmill.llm import hard_negatives, queries
from tests.oracle_check import compare, connect

KIND = "vec_id long, embedding array<float>, label int, score string, uid string"


def plain(rows, anchor=100):
    """Contract rows from (id, vector, label) by scoring everything in Python integers."""
    usable = []
    for k, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) or abs(x) >= hard_negatives.LARGEST for x in v):
            continue
        usable.append((k, i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for k, i, v, label in usable:
        if i is None or i % anchor:
            continue
        all_scores = [(-sum(x * y for x, y in zip(v, w)), j is None, j or 0, m, j, other) for m, j, w, other in usable if m != k]
        all_scores.sort()
        for s, _, _, _, j, _ in [x for x in all_scores if x[5] == label][:5]:
            fits = [x for x in all_scores if x[5] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, rank, x[4], -s, -x[0]) for rank, x in enumerate(fits, 1)]
    return out


def in_order(rows):
    return sorted((tuple(-1 if x is None else x for x in r) for r in rows))


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, label, "clash", "clash") for i, v, label in rows], KIND)


def clustered(seed, count, size):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, size))
    rows = []
    for i in range(count):
        label = int(rng.integers(0, 5))
        v = 0.2 * (centres[label if rng.random() < 0.7 else 5] + 0.5 * rng.normal(size=size))
        rows.append((i, v.astype(np.float32).tolist(), label))
    return rows


@pytest.mark.parametrize("at_once", [hard_negatives.ANCHORS, 3])
def test_all_scores(spark, at_once):
    rows = clustered(1, 400, 40)
    copies = [(1000 + k, rows[20][1], 3 if k % 2 else rows[20][2]) for k in range(40)]  # ties far beyond what is returned
    got = hard_negatives.mined(frame_of(spark, rows + copies).repartition(5), F.col("vec_id") % 20 == 0, anchors_at_once=at_once)
    assert in_order(got.collect()) == in_order(plain(rows + copies, 20))
    assert got.count() > 500


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = clustered(2, 60, 5)
    odd = [
        (0, None, 1), (100, [1.0, 2.0], None), (100, [1.0, nan, 2.0], 1), (200, [1.0, inf], 1), (300, [None, 1.0], 1), (400, [1e30], 1), (None, good[0][1], good[0][2]), (None, good[3][1], 9),
        (500, [], 2), (600, [0.0] * 70, 2), (700, [0.5, 0.25], 2), (700, [0.5, 0.25], 2), (700, [0.25, 0.5], 3), (701, [-0.001] * 70, 3), (-100, [0.5], 2), (800, [3.0] * 70, 4),
    ]
    got = hard_negatives.mined(frame_of(spark, good + odd), F.col("vec_id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert in_order(got.collect()) == in_order(plain(good + odd))
    for none in (frame_of(spark, []), frame_of(spark, good[1:3])):
        assert hard_negatives.mined(none, F.col("vec_id") % 100 == 0).collect() == []


def test_intervals_hold_every_score_and_leave_scores_out():
    rng = np.random.default_rng(3)
    for size, spread in ((64, 1.0), (128, 30.0)):
        centres = rng.normal(size=(8, size))
        rows = np.floor(40 * (centres[rng.integers(0, 8, 600)] + 0.3 * rng.normal(size=(600, size))) * spread).astype(np.int64)
        rows[5] = 0
        codes, along, rest = hard_negatives.coded(rows)
        low, high = hard_negatives.Planes(rows[:50]).interval(codes, along, rest, np.arange(50))
        exact = rows @ rows[:50].T
        assert (low <= exact).all() and (exact <= high).all()
        fifth = np.partition(exact, -5, axis=0)[-5]
        assert (high < fifth).mean() > 0.3  # what can't be among an anchor's first five isn't scored


def test_rotation_keeps_products():
    rows = np.random.default_rng(4).normal(size=(20, 128))
    turned = hard_negatives.rotated(rows)
    assert turned @ turned.T == pytest.approx(rows @ rows.T)


def test_registered_hard_negatives(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.1"):
        assert compare(spark, connect(folder), folder, queries.op11_hard_negatives, hard_negatives.ORACLE_SQL) is None
