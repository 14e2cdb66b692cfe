"""Near copies, substring de-duplication and decontamination against plain versions."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from depthmill.llm import fingerprints, leaks, queries, repeats
from depthmill.llm.components import components
from depthmill.llm.texts import Words, blocks, grams
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
KIND = "doc_id long, text string, fp string, n_words string, row int"


def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, and clashing extra columns."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two"), (6, "one two"), (None, "one two"), (7, long), (8, long + " end")]
    rows += [(9, "a b " + passage + " c"), (10, "x\n" + passage + "\ny z"), (10, "x\n" + passage + "\ny z"), (11, "UPPER Case É words"), (12, "upper case É words"), (13, "und " * 200)]
    return [(i, t, "clash", None, k) for k, (i, t) in enumerate(rows)]


def test_words_and_grams():
    words = Words([b"ab cd  ef", b"", b"\n", b"ab cd ef gh"])
    h = words.hashes()
    assert words.counts.tolist() == [3, 0, 0, 4] and len(set(h.tolist())) == 4
    assert h[0] == h[3] and words.code_points().tolist() == [6, 0, 0, 8]
    for n in (1, 2, 3, 5, 7):
        g = grams(np.concatenate([h, h]), n)
        assert len(g) == 14 - n + 1 and (n > 7 or g[0] == g[7])
    assert len(grams(h, 8)) == 0


def test_blocks_hold_whole_texts():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["aaaa", None, "bbbbbbbbbb", "c", ""]})
    parts = [b.column("text").to_pylist() for b in blocks([batch], "text", limit=5)]
    assert parts == [["aaaa", None], ["bbbbbbbbbb"], ["c", ""]]
    assert list(blocks([batch.slice(0, 0)], "text")) == []


def test_fingerprints_of_odd_rows(spark):
    rows = odd_rows()
    got = fingerprints.near_copies(spark.createDataFrame(rows, KIND)).collect()
    want = brute.classes([(r[0], r[1]) for r in rows])
    key = lambda x: (x[0] is not None, x)
    assert sorted(((r.id, r.fp & (2**64 - 1), r.component) for r in got), key=key) == sorted(want, key=key)
    empty = spark.createDataFrame([], KIND)
    assert fingerprints.near_copies(empty).count() == 0 and fingerprints.keep_first(empty).count() == 0


def test_registered_near_copies(spark):
    got = sorted((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in queries.op9_near_copies(spark, SMALL).collect())
    assert got == sorted(brute.classes(texts(spark)))


@pytest.mark.parametrize("shard_rows", [40, 100_000])
def test_tree_search_finds_every_link(spark, shard_rows):
    rng = random.Random(5)
    points = [rng.getrandbits(64) for _ in range(400)]
    points += [p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for p in points[:250] for _ in range(2)]
    ball = rng.getrandbits(64)
    points = list({*points, *(ball ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a))})
    signed = [p - 2**64 if p >= 2**63 else p for p in points]
    links = fingerprints.links(spark.createDataFrame([(p,) for p in signed], "fp long"), shard_rows=shard_rows)
    got = {r.node: r.root for r in components(links).collect()}
    parent = {p: p for p in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(points):
        for j in range(i):
            if (a ^ points[j]).bit_count() <= 2:
                x, y = find(signed[i]), find(signed[j])
                parent[max(x, y)] = min(x, y)
    want = {p: find(p) for p in signed}
    alone = {p for p in signed if list(want.values()).count(want[p]) == 1}
    assert got == {p: r for p, r in want.items() if p not in alone}
    assert links.count() <= 8 * len(points)  # spanning links, not pairs


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


@pytest.mark.parametrize("group_rows", [repeats.GROUP_ROWS, 1])
def test_repeats_of_odd_rows(spark, group_rows):
    rows = odd_rows()
    got = repeats.without_repeats(spark.createDataFrame(rows, KIND), group_rows=group_rows)
    assert got.columns == ["doc_id", "text", "fp", "row", "n_words", "n_removed", "kept_sha256"]
    want = brute.repeats([(r[4], r[1]) for r in rows])
    for r, (_, n, kept) in zip(sorted(got.collect(), key=lambda r: r.row), want, strict=True):
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, n - len(kept), brute.kept_hash(kept))
        assert (r.text is None) == (rows[r.row][1] is None) and brute.words(r.text) == kept
    assert repeats.without_repeats(spark.createDataFrame([], KIND)).count() == 0


def test_registered_repeats(spark):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op6_substring_dedup(spark, SMALL).collect()}
    assert got == {i: (n, n - len(k), brute.kept_hash(k)) for i, n, k in brute.repeats(texts(spark))}


def test_deep_nodes_are_the_repeats():
    rng = random.Random(1)
    h = np.array([rng.randrange(2) for _ in range(400)], np.uint64)
    order, common = repeats.suffix_array(h, 8)
    assert sorted(order.tolist()) == list(range(400)) and common.min() >= 0
    found = repeats.deep_nodes(h, 8)
    windows = [tuple(h[i : i + 8]) for i in range(393)]
    assert found[:393].tolist() == [windows.count(w) > 1 for w in windows] and not found[393:].any()


def digest(names):
    return hashlib.sha256(",".join(names).encode()).hexdigest()


@pytest.mark.parametrize("block_words", [leaks.BLOCK_WORDS, 40])
def test_leaks_of_odd_rows(spark, block_words):
    passage = [f"p{i}" for i in range(60)]
    items = [(1, " ".join(passage[5:30])), (2, "Case: É"), (2, "one"), (3, None), (4, ""), (5, "?!"), (None, "two"), (6, " ".join(passage[29:45])), (7, "und " * 12)]
    rows = odd_rows()
    got = leaks.leaked(spark.createDataFrame(rows, KIND), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
    want = brute.leaks([(r[4], r[1]) for r in rows], items)
    for r, (_, n, hit, names) in zip(sorted(got.collect(), key=lambda r: r.row), want, strict=True):
        assert (r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) == (n, hit, len(names), names, hit > 0)
        assert sum(x.n_words for x in r.spans) == hit and max((x.longest_match for x in r.spans), default=0) == r.longest_match
        assert r.text == rows[r.row][1]
    longest = {r.row: r.longest_match for r in got.collect()}
    assert longest[9] == 25 and longest[14] >= 10 and longest[0] == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks.leaked(spark.createDataFrame(rows, KIND), none).where("contaminated").count() == 0
    assert leaks.decontaminated(spark.createDataFrame([], KIND), none).count() == 0


def longest_from(words, items):
    """For every place the longest match with any item from there on, by trying all."""
    out = []
    for i in range(len(words)):
        best = 0
        for item in items:
            for j in range(len(item)):
                n = 0
                while i + n < len(words) and j + n < len(item) and words[i + n] == item[j + n]:
                    n += 1
                best = max(best, n)
        out.append(best)
    return out


def test_longest_matches_equal_trying_all():
    rng = random.Random(8)
    for _ in range(30):
        texts, items = ([" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 25))) for _ in range(4)] for _ in range(2))
        block = leaks.TestBlock(items, [x.encode() for x in items], 3)
        own = leaks.item_words([x.encode() for x in texts])
        left = np.repeat(own.first[1:], own.counts) - np.arange(len(own.hashes()))
        got = leaks.longest_matches(own.hashes(), left, np.arange(len(left)), block)
        assert got.tolist() == [n for t in texts for n in longest_from(t.split(), [x.split() for x in items])]


def test_spans_locate_the_passages(spark):
    items = [("a", " ".join(f"a{i}" for i in range(30))), ("b", " ".join(f"b{i}" for i in range(12)))]
    text = "x y " + items[0][1][: items[0][1].index(" a20")] + " z " + items[1][1] + " end"
    r = leaks.leaked(spark.createDataFrame([(text, 1)], "text string, spans int"), spark.createDataFrame(items, "item_id string, text string")).first()
    assert [tuple(x) for x in r.spans] == [(2, 20, 20), (23, 12, 12)] and r["items"] == ["a", "b"]


def test_items_that_share_a_passage_cost_no_more():
    """A thousand items with one instruction in common, and a hundred documents that hold it."""
    shared = " ".join(f"w{i}" for i in range(60))
    items = [f"{shared} item{k} tail{k}" for k in range(1000)]
    block = leaks.TestBlock([str(k) for k in range(1000)], [x.encode() for x in items], leaks.WINDOW)
    own = leaks.item_words([f"before {shared} behind{k}".encode() for k in range(100)])
    found = leaks.find(own.hashes(), own.first, block)
    assert sum(len(p) for _, p, _ in found) == 100 * 51
    assert block.items_of(found[0][0], found[0][2][:1]) == set(range(1000))


def test_registered_leaks(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in queries.op10_leaks(spark, SMALL).collect()}
    assert got == {i: (n, hit, len(names), digest(names)) for i, n, hit, names in brute.leaks(texts(spark), items)}
    assert queries.op10_leaks(spark, SMALL).where(F.col("contaminated") != (F.col("n_hit") > 0)).count() == 0
