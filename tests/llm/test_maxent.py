"""Log shares of many contexts at a time, and the features of words."""

import random
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from depthmill.llm import maxent
from depthmill.session import work_root, written


def test_log_shares_hold_few_logits_at_a_time():
    rng = np.random.default_rng(3)
    weights, bias = rng.normal(size=(2 * maxent.CLASSES + maxent.BUCKETS, maxent.CLASSES)), rng.normal(size=maxent.CLASSES)
    every = np.arange(maxent.CLASSES**2)
    tracemalloc.start()
    found = maxent.log_shares(weights, bias, every // maxent.CLASSES, every % maxent.CLASSES)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * found.nbytes
    assert np.allclose(np.exp(found).sum(axis=1), 1)
    for k in (0, 511, 512, 16_383):
        one, two = every[k : k + 1] // maxent.CLASSES, every[k : k + 1] % maxent.CLASSES
        logits = bias + weights[one] + weights[maxent.CLASSES + two] + weights[maxent.pair_rows(one, two)]
        logits[:, maxent.START] = -np.inf
        assert np.allclose(found[k], logits[0] - np.log(np.exp(logits).sum()))


def word_model(rng, rows=64, singles=()):
    start = maxent.word_start(rng.normal(size=(2 * maxent.CLASSES + maxent.BUCKETS, maxent.CLASSES)), rng.normal(size=maxent.CLASSES), rng.integers(0, 9, (maxent.CLASSES, maxent.GROUPS)))
    weights = [rng.normal(size=(maxent.KINDS * rows, width)).astype("<f4") for width in maxent.WIDTHS]
    return maxent.WordModel(np.array(singles, np.uint64), start, rows, weights)


def pieces_of(texts, held):
    rows = pa.record_batch([pa.array(range(len(texts))), pa.array(texts), pa.array(held)], names=["id", "text", "held"])
    return list(maxent._pieces([rows]))


def plain_steps(model, piece):
    """(softmax, rows, distribution, choice) of each token, one at a time."""
    cls, mask = piece.classes(model.singles), (1 << 64) - 1
    mark = [int(x) for x in maxent.mix(piece.words)]
    at = 0
    for length in piece.lengths.tolist():
        words = piece.tokens[at : at + length].tolist()
        at += length
        for k, w in enumerate(words):
            one, two = (words[k - d] if k >= d else None for d in (1, 2))
            one_class, two_class = (maxent.START if x is None else int(cls[x]) for x in (one, two))
            first, second = (maxent.START if x is None else mark[x] for x in (one, two))
            chosen_set, member = divmod(int(cls[w]), maxent.MEMBERS)
            context = one_class * maxent.CLASSES + two_class
            steps = [(0, context, 0, chosen_set), (1, context * maxent.SETS + chosen_set, 1 + chosen_set, member)]
            if cls[w] >= 2 + maxent.SINGLES:
                steps.append((2, cls[w], 1 + maxent.SETS + int(cls[w]), int(piece.words[w]) >> (64 - maxent.GROUP_BITS)))
            out = []
            for level, place, chosen, choice in steps:
                salt = (chosen + 1) * 0xD6E8FEB86659FD93
                hashes = np.array([(first + salt) & mask, ((second ^ mask) + salt) & mask, (first * 0x9E3779B97F4A7C15 + second + salt) & mask], np.uint64)
                rows = [int(h) % model.rows + kind * model.rows for kind, h in enumerate(maxent.mix(hashes))]
                logits = model.start[level][place].astype(float) + sum(model.weights[level][r].astype(float) for r in rows)
                out.append((level, rows, np.exp(logits) / np.exp(logits).sum(), choice))
            yield out


TEXTS = ["the cat sat on the mat.", "", "the dog sat; the cat ran", "a", "the the the dog"]


def test_shares_of_words_equal_plain_ones():
    piece = next(maxent.Piece.of(pieces_of(TEXTS, [False] * 5)))[0]
    for singles in ((), sorted(int(h) for h in piece.words if h != maxent.END_HASH)[:3]):
        model = word_model(np.random.default_rng(5), singles=singles)
        want = [sum(np.log(p[choice]) for _, _, p, choice in steps) for steps in plain_steps(model, piece)]
        assert model.log_shares(piece) == pytest.approx(want, rel=1e-4, abs=1e-5)


def test_counts_of_words_features_equal_plain_ones():
    """Observed and expected counts come from the words before, of training texts alone."""
    held = [False, False, True, False, False]
    rows = pieces_of(TEXTS, held)
    piece, model = next(maxent.Piece.of(rows))[0], word_model(np.random.default_rng(6))
    want = {(seen, level): np.zeros((maxent.KINDS * model.rows, width)) for seen in (True, False) for level, width in enumerate(maxent.WIDTHS)}
    for steps, trained in zip(plain_steps(model, piece), piece.training(), strict=True):
        for level, where, p, choice in steps if trained else []:
            want[False, level][where] += p
            want[True, level][where, choice] += 1
    for batch in maxent._word_counts(model, True)(iter(rows)):
        for r in batch.to_pylist():
            cells = np.frombuffer(r["cells"], "<f4").reshape(-1, maxent.WIDTHS[r["level"]])
            assert np.allclose(want[r["seen"], r["level"]][r["row"] : r["row"] + len(cells)], cells, rtol=1e-4, atol=1e-5)
            want[r["seen"], r["level"]][r["row"] : r["row"] + len(cells)] -= cells
    assert all(np.allclose(x, 0, atol=1e-4) for x in want.values())


def test_words_before_of_one_class_are_told_apart(spark):
    """`zzon` and `yyon` are in one class, as are what follows them; only the words themselves tell what comes next."""
    rng = random.Random(2)
    frequent = [f"w{i}q" for i in range(maxent.SINGLES)]
    after = {"zzon": ["able", "cable"], "yyon": ["table", "fable"]}
    pairs = [(a, b) for a, found in after.items() for b in found]
    rows = [(i, " ".join([*(rng.choice(frequent) for _ in range(400)), *(f"{a} {b}" for a, b in rng.choices(pairs, k=20))])) for i in range(30)]
    tests = [(100 + k, f"w1q {a} {b}") for k, (a, b) in enumerate((a, b) for a in after for found in after.values() for b in found)]
    frame = spark.createDataFrame([*rows, *tests], "doc_id long, text string")
    score = {r.id: r.score for r in maxent.scored(frame, F.col("doc_id") >= 100).collect()}
    of = lambda a, b: score[next(i for i, t in tests if t == f"w1q {a} {b}")]
    right = sum(of(a, b) for a, found in after.items() for b in found)
    assert right > sum(of(a, b) for a in after for found in after.values() for b in found if b not in after[a]) + 0.4


def test_rows_follow_the_vocabulary():
    assert [maxent.rows_of(n) for n in (0, 10**6, 4 * 10**6, 8 * 10**6, 10**10)] == [2048, 2048, 4096, 8192, 16384]


def test_pieces_are_written_a_row_or_so_a_page(spark):
    """Readers and writers hold a page at a time beside the heap: rows of megabytes must not share one."""
    rng = np.random.default_rng(8)
    rows = spark.createDataFrame([(bytearray(rng.bytes(1 << 20)),) for _ in range(8)], "tokens binary").coalesce(1)
    path = Path(written(rows, "wide", wide=True).inputFiles()[0].removeprefix("file://"))
    assert path.read_bytes().count(b"\x28\xb5\x2f\xfd") >= 8  # every page is a frame of its own
    root = Path(work_root(spark).removeprefix("file://"))
    before = set(root.glob("pieces-*"))
    maxent.scored(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), F.lit(False)).count()
    files = [f for folder in set(root.glob("pieces-*")) - before for f in folder.glob("*.parquet")]
    kinds = {pq.read_metadata(f).row_group(0).column(k).compression for f in files if pq.read_metadata(f).num_rows for k in range(7)}
    assert kinds == {"ZSTD"}
