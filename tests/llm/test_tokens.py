"""Packing, token files and scores: exact round trips and held-out gain."""

import math
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from depthmill.llm import bpe, curve_packing, maxent, queries, token_files
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
ODD = [
    (None, "x"), (5000, None), (5001, ""), (5002, " a  b\n\nc\td's it's. foo_bar 12.5  x  "), (5003, "don't... 'tis (yes), ABC's ẞtraße İstanbul ½x x² 3rd \n end"),
    (5004, "naïve café’s “quoted” — dash… nbsp line"), (5005, "<|endoftext|> a<|startoftext|>b"), (5006, "word " * 9000), (5006, "word " * 9000), (5007, "...\n,,,"), (5008, "<|ENDOFTEXT|> x <|StartOfText|>"),
]


def reference(path, rows, end):
    tokenizer = Tokenizer.from_file(path)
    return [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]) for i, t in rows]


def rows_of(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()] + ODD


@pytest.mark.parametrize("path", [queries.WORD_BPE, queries.BYTE_BPE])
def test_encoder_gives_the_tokenizers_ids(spark, path):
    rows = rows_of(spark)
    encoder = bpe.Encoder(path)
    for _ in range(2):  # with an empty and a filled memory
        got = encoder.encode([(t or "").encode() for _, t in rows])
        assert [np.frombuffer(x, np.uint32).tolist() for x in got] == [ids[:-1] for _, ids in reference(path, rows, 0)]


def test_packing_round_trip(spark):
    rows = rows_of(spark)
    frame = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, offset int").withColumn("row", F.col("offset"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in curve_packing.packed(frame, queries.WORD_BPE).collect():
        pieces[r.row].append(r)
        sequences[r.sequence_id].append(r)
    for k, (i, ids) in enumerate(reference(queries.WORD_BPE, rows, 1)):
        own = sorted(pieces[k], key=lambda r: r.start)
        assert [x for r in own for x in np.frombuffer(r.ids, "<u4").tolist()] == ids
        assert all((r.doc_id, r.doc_tokens, r.length) == (i, len(ids), len(r.ids) // 4) for r in own)
        assert [r.start for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        used = sum(r.length for r in own)
        assert used <= 2048 and used & (used - 1) == 0  # no padding
    assert curve_packing.packed(frame.limit(0), queries.WORD_BPE).count() == 0


def test_registered_packing(spark):
    ids = dict(reference(queries.WORD_BPE, rows_of(spark)[: -len(ODD)], 1))
    rows = queries.op1_curve_packing(spark, SMALL).collect()
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])


def test_hilbert_curve_visits_every_cell_next_to_the_last():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.array(list(np.ndindex(*[1 << bits] * dims)))
        keys = curve_packing.hilbert(grid, bits)
        assert sorted(keys.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("kind", ["small", "wide", "outliers", "equal", "empty"])
def test_blocks_round_trip(kind):
    rng = np.random.default_rng(2)
    ids = {
        "small": rng.integers(0, 50_257, 3000),
        "wide": rng.integers(0, 1 << 32, 700),
        "outliers": np.where(rng.random(5000) < 0.04, rng.integers(0, 1 << 31, 5000), rng.integers(0, 9, 5000)),
        "equal": np.full(1000, 7),
        "empty": np.zeros(0),
    }[kind].astype(np.uint32)
    found = token_files.pack_blocks(ids)
    starts = np.cumsum([0, *map(len, found)])[:-1].astype(np.int64)
    back = token_files.unpack_blocks(np.frombuffer(b"".join(found), np.uint8), starts) if found else ids
    assert back[: len(ids)].tolist() == ids.tolist()
    if kind == "outliers":
        assert sum(map(len, found)) < len(ids)  # the few large values don't widen the rest


@pytest.mark.parametrize("file_ids", [1, 5000, token_files.FILE_IDS])
def test_token_files_round_trip(spark, file_ids):
    rows = rows_of(spark)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    manifest = token_files.write_files(frame, queries.BYTE_BPE, file_ids=file_ids)
    got = sorted(map(tuple, token_files.read_digests(manifest).collect()), key=lambda r: r[1])
    want = sorted(reference(queries.BYTE_BPE, rows, 0), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for g, (i, ids) in zip(got, want, strict=True):
        assert g == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    first = manifest.orderBy("start").first()
    assert sum(len(ids) for _, ids in token_files.read_file(first.path)) == first.n_ids
    assert token_files.read_digests(token_files.write_files(frame.limit(0), queries.BYTE_BPE)).count() == 0


def test_registered_token_files(spark):
    start, ids = 0, dict(reference(queries.BYTE_BPE, rows_of(spark)[: -len(ODD)], 0))
    for r in sorted(queries.op2_token_files(spark, SMALL).collect()):
        assert tuple(r) == (r.doc_id, start, len(ids[r.doc_id]), zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes()))
        start += r.n_tokens


def held(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 7 == 2


def check_scores(rows, got):
    tokens = [(i, [*brute.words(t, low=True), None]) for i, t in rows]
    counts = Counter(w for i, own in tokens if not held(i) for w in own)
    n, size = sum(counts.values()), len(counts)
    want = sorted(((i is not None, i), held(i), len(own), sum(counts[w] > 0 for w in own), n, sum(math.log10((counts[w] + 1) / (n + size + 1)) for w in own)) for i, own in tokens)
    rows = sorted(((r[0] is not None, r[0]), *r[1:]) for r in map(tuple, got))
    for g, w in zip(rows, want, strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] <= 0
    return rows


def test_registered_scores_beat_the_base(spark):
    got = check_scores(rows_of(spark)[: -len(ODD)], queries.op3_maxent(spark, SMALL).collect())
    own = [r for r in got if r[1]]
    assert sum(r[6] for r in own) > 0.95 * sum(r[5] for r in own)


def test_scores_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b a"), (3, "A b  c"), (3, "A b  c"), (5, "word " * 30_000), (6, "é É x.")]
    frame = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, score string")
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    check_scores(rows, maxent.scored(frame, out, rounds=2).collect())
    assert maxent.scored(frame.limit(0), out, rounds=1).count() == 0
    nothing = maxent.scored(frame, F.lit(True), rounds=1).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score <= 0 for r in nothing)


def test_scores_are_probabilities(spark):
    """The shares of all known words and of the unseen word of each class sum to one after any context."""
    weights = np.random.default_rng(0).normal(size=(2 * maxent.CLASSES + maxent.BUCKETS, maxent.CLASSES))
    shares = np.exp(maxent.log_shares(weights, np.zeros(maxent.CLASSES), np.array([0, 5]), np.array([0, 9])))
    assert shares.sum(axis=1) == pytest.approx([1, 1]) and (shares[:, maxent.START] == 0).all()
    counts, discount = np.array([5, 1, 1, 3]), 0.5
    assert ((counts - discount).sum() + discount * len(counts)) / counts.sum() == pytest.approx(1)
    assert re.fullmatch("[0-9]+", str(maxent.CLASSES))


@pytest.mark.parametrize("path", [queries.WORD_BPE, queries.BYTE_BPE])
def test_words_of_latin_letters_have_the_tokenizers_ids(path):
    encoder = bpe.Encoder(path, held=5)
    letters = [chr(c) for c in range(0x100) if chr(c).isalpha()]
    words = ["".join(letters[(i * 7 + k * k) % len(letters)] for k in range(1 + i % 13)) for i in range(600)] + letters
    for text in (" ".join(words), "\n".join(words), ", ".join(words), "Ωmega ĳ ŉ İstanbul Straße ÀÉÎ ªº µ"):
        for _ in range(2):
            assert np.frombuffer(encoder.encode([text.encode()])[0], np.uint32).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing_gives_up_the_encoders_of_the_step_before(monkeypatch):
    monkeypatch.setattr(curve_packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.record_batch({"row": pa.array([{"c0": 1}, {"c0": 2}]), "text": pa.array(["one two", None])})
    encoded = list(curve_packing._encode(queries.WORD_BPE, 1, 2)(iter([batch])))
    assert bpe.encoder.cache_info().currsize
    pieces = [r for out in curve_packing._pack(2048, 2)(iter(encoded)) for r in out.to_pylist()]
    assert not bpe.encoder.cache_info().currsize
    want = [i for _, ids in reference(queries.WORD_BPE, [(1, "one two"), (2, None)], 1) for i in ids]
    assert np.frombuffer(b"".join(r["ids"] for r in pieces), np.uint32).tolist() == want
