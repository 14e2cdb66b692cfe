"""Near copies by exact similarity of five-word shingles, against all pairs."""

import random

import corpus_pipeline
import numpy as np
import pytest

from depthmill.llm import fingerprints, similar
from tests.llm import brute
from tests.llm.test_dedup import KIND, SMALL, odd_rows


def by_row(found):
    return sorted(((r.id, r.component) for r in found.collect()), key=lambda x: (x[0] is not None, x))


def edited_rows():
    """A base, its copies with one word changed, copies of copies, and texts below the similarity."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for k in range(60):
        w = list(base)
        for at in rng.sample(range(5, 55), 1 + k % 3):
            w[at] = f"x{k}-{at}"
        rows.append((100 + k, " ".join(w)))
    w = list(base)
    for k in range(12):
        w[4 * k + 2] = f"y{k}"
        rows.append((300 + k, " ".join(w)))
    return [*rows, (400, " ".join(base).upper()), (401, " ".join(base))]


@pytest.mark.parametrize("tile_texts", [similar.TILE_TEXTS, 7])
def test_edited_copies(spark, tile_texts):
    rows = edited_rows()
    got = similar.similar_copies(spark.createDataFrame(rows, "doc_id long, text string"), tile_texts=tile_texts)
    assert by_row(got) == sorted(zip([i for i, _ in rows], brute.similar_classes(rows), strict=True))
    assert len(set(brute.similar_classes(rows))) > 1


def test_similar_odd_rows(spark):
    rows = odd_rows()
    got = similar.similar_copies(spark.createDataFrame(rows, KIND))
    want = zip([r[0] for r in rows], brute.similar_classes([(r[0], r[1]) for r in rows]), strict=True)
    assert by_row(got) == sorted(want, key=lambda x: (x[0] is not None, x))
    empty = spark.createDataFrame([], KIND)
    assert similar.similar_copies(empty).count() == 0 and similar.keep_first(empty).count() == 0


def test_stage_finds_edited_copies_of_the_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept = corpus_pipeline.keep_distinct(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in brute.similar_classes(rows)})


def test_recall_of_bands():
    rng = random.Random(4)
    missed = 0
    for _ in range(300):
        n = 200 + rng.randrange(400)
        shared = [rng.getrandbits(64) for _ in range(n)]
        more = n // 8
        one, two = ([*shared, *(rng.getrandbits(64) for _ in range(more))] for _ in range(2))
        one, two = (similar.bands(np.array(x, np.uint64)) for x in (one, two))
        missed += not (one == two).any()
    assert missed <= 1


@pytest.mark.parametrize("keep", [similar.keep_first, fingerprints.keep_first])
def test_rows_that_repeat_an_id_are_judged_one_by_one(spark, keep):
    """The copy goes and the unique text stays, in whatever order the rows come; no column name gets in the way."""
    one, two = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(2, one, "x", 1), (5, one, "x", 1), (5, two, "y", 2), (5, two, "z", 3), (7, two, "y", 2), (None, one, "n", 4), (None, one, "n", 4), (9, None, "e", 5), (8, "", "e", 6)]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "doc_id long, text string, _keep string, `id` int").repartition(3)
        got = keep(frame)
        assert got.columns == frame.columns
        got = sorted(map(tuple, got.collect()), key=str)
        third = {r for r in got if r[0] == 5}
        assert third <= {(5, two, "y", 2), (5, two, "z", 3)} and len(third) == 1
        assert sorted(set(got) - third, key=str) == sorted({(2, one, "x", 1), (None, one, "n", 4), (8, "", "e", 6)}, key=str) and len(got) == 5
        first = third if seed == 0 else first
        assert third == first


def test_trees_find_candidates_without_bands(spark, monkeypatch):
    """Fingerprints in the trees link what no band holds; exact sets refuse what isn't similar."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(3000)]
    rows = [(1, " ".join(base))]
    for k in range(4):
        w = list(base)
        w[rng.randrange(3000)] = f"x{k}"
        rows.append((10 + k, " ".join(w)))
    rows += [(50, "one two three"), (51, "four five six"), (52, "one two three"), (60, None), (61, "")]
    monkeypatch.setattr(similar, "bands", lambda found: found[:0])
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = similar.similar_copies(frame, radius=4)
    assert by_row(got) == sorted(zip([i for i, _ in rows], brute.similar_classes(rows), strict=True))
    assert {c for i, c in by_row(got) if i < 50} == {1}
    far = [(1, " ".join(base)), (2, " ".join(f"c{i}" for i in range(50)))]
    wide = similar.similar_copies(spark.createDataFrame(far, "doc_id long, text string"), radius=64)
    assert by_row(wide) == [(1, 1), (2, 2)]


def test_stage_asks_the_trees(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(similar, "links", lambda found, radius: asked.append(radius) or fingerprints.links(found, radius))
    frame = spark.createDataFrame(edited_rows(), "doc_id long, text string")
    corpus_pipeline.keep_distinct(spark, frame, "").count()
    assert asked == [fingerprints.RADIUS]
