"""Alignment of two vocabularies' tokens, against a plain version that looks at whole texts."""

import hashlib
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from depthmill.llm import aligned_tokens, queries

SMALL = "/root/testdata/sf0.001"
ODD = [
    (None, "x y"), (5000, None), (5001, ""), (5002, " a  b\n\nc\td's it's. foo_bar 12.5  x  "), (5003, "don't... 'tis (yes), ABC's ẞtraße İstanbul ½x x² 3rd \n end"),
    (5004, "naïve café’s “quoted” — dash… nbsp line​日本語 😀"), (5005, "<|endoftext|> a<s>b </s><unk><0x41>"), (5006, "word " * 9000 + "end"), (5006, "word " * 9000 + "end"), (5007, "...\n,,,"),
    (5008, "a piece ▁mark that one vocabulary can't give back"), (5009, "one\ntwo three\nfour, five.\nsix"), (5010, "fine words ▁"), (5011, "\x00\x01 control\rreturn;\r x"), (5012, " "), (5013, "\n"), (5014, "y" * 3000),
]


def byte_table():
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in shown}
    for b in range(256):
        if b not in shown:
            table[chr(256 + len(table) - len(shown))] = b
    return table


def plain(rows):
    """Rows as the contract says them, by looking at every byte of every text."""
    a_model, b_model, table = Tokenizer.from_file(queries.BYTE_BPE), SentencePieceProcessor(model_file=queries.PIECE_BPE), byte_table()
    a_model.encode_special_tokens = True
    found = []
    for i, text in rows:
        if not text:
            found.append((i, [], [], [], []))
            continue
        whole = (" " + text).encode()
        a = [(x, bytes(table[c] for c in a_model.id_to_token(x))) for x in a_model.encode(" " + text, add_special_tokens=False).ids]
        b = [(x, bytes([int(p[3:5], 16)]) if b_model.is_byte(x) else p.replace("▁", " ").encode()) for x in b_model.encode(text) for p in [b_model.id_to_piece(x)]]
        if b"".join(y for _, y in a) != whole or b"".join(y for _, y in b) != whole:
            found.append((i, [], [], [], []))
            continue
        owner_a, owner_b = ([k for k, (_, y) in enumerate(side) for _ in y] for side in (a, b))
        links = [(a[p][0], b[q][0]) for p, q in sorted(set(zip(owner_a, owner_b, strict=True)))]
        ends = [k for k in range(1, len(whole) + 1) if k == len(whole) or owner_a[k] != owner_a[k - 1] and owner_b[k] != owner_b[k - 1]]
        cut = [(0, 0), *((owner_a[k - 1] + 1, owner_b[k - 1] + 1) for k in ends)]
        groups = [f"{','.join(str(x) for x, _ in a[p:r])}|{','.join(str(x) for x, _ in b[q:s])}" for (p, q), (r, s) in zip(cut, cut[1:])]
        found.append((i, a, b, groups, links))
    counts = Counter(x for *_, links in found for x in links)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (i, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), ";".join(groups))
        for i, a, b, groups, links in found
    ]


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r))


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("frequent", [aligned_tokens.FREQUENT, 40, 0])
def test_alignment_equals_plain(spark, rows, frequent):
    everything = rows + ODD
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in everything], "doc_id long, text string, n_a int, block string").repartition(3)
    got = by_id(aligned_tokens.aligned(frame, queries.BYTE_BPE, queries.PIECE_BPE, frequent=frequent).collect())
    want = by_id(plain(everything))
    assert got == want
    zero = {r[0] for r in want if r[1] == 0}
    assert {5000, 5001, 5008, 5010} <= zero and 5005 not in zero
    assert frame.sparkSession.createDataFrame([], frame.schema).transform(lambda d: aligned_tokens.aligned(d, queries.BYTE_BPE, queries.PIECE_BPE, frequent=frequent)).count() == 0


def test_small_blocks_and_memories_give_the_same(spark, rows, monkeypatch):
    """Pairs handed on early and a worker that forgets change nothing."""
    batch = spark.createDataFrame(rows[:60] + ODD, "id long, text string").toArrow().to_batches()
    paths = queries.BYTE_BPE, queries.PIECE_BPE
    monkeypatch.setattr(aligned_tokens.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 3})()))

    def counted():
        total = Counter()
        written = list(aligned_tokens._align_blocks(*paths)(iter(batch)))
        for found in aligned_tokens._count(paths)(iter(written)):
            total.update(dict(zip(found.column("pair").to_pylist(), found.column("n").to_pylist(), strict=True)))
        return total, len(written)

    once = counted()
    monkeypatch.setattr(aligned_tokens, "BLOCK", 5000)
    monkeypatch.setattr(aligned_tokens, "GATHERED", 300)
    monkeypatch.setattr(aligned_tokens.aligner(*paths), "held", 10)
    again = counted()
    assert again[0] == once[0] and again[1] > once[1]


def test_registered_alignment(spark, rows):
    got = by_id(tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in queries.op13_aligned_tokens(spark, SMALL).collect())
    assert got == by_id((*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "") for r in plain(rows))


def test_reading_blocks_gives_up_what_encoding_remembered():
    tool = aligned_tokens.aligner(queries.BYTE_BPE, queries.PIECE_BPE)
    assert tool.ids([b"some", b"words"]) and tool.known and tool.a.parts
    assert list(aligned_tokens._read(iter([]), (queries.BYTE_BPE, queries.PIECE_BPE))) == []
    assert not tool.known and not tool.a.parts and not tool.a.tails


def test_groups_are_found_some_parts_at_a_time(monkeypatch):
    paths = queries.BYTE_BPE, queries.PIECE_BPE
    monkeypatch.setattr(aligned_tokens.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 3})()))
    text = " ".join(f"w{i}q{i % 7}," for i in range(40_000))
    batch = pa.record_batch([pa.array([1, 2, 3]), pa.array([text, "", "w1q1, w2q2,"])], names=["id", "text"])
    block = next(aligned_tokens._read(aligned_tokens._align_blocks(*paths)(iter([batch])), paths))
    peaks, found = [], []
    for size in (1 << 20, aligned_tokens.PARTS_AT_ONCE, 1000):
        monkeypatch.setattr(aligned_tokens, "PARTS_AT_ONCE", size, raising=False)
        block.groups()  # remembers what it may
        tracemalloc.start()
        n, texts = block.groups()
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        found.append((n.tolist(), texts))
    assert found[0] == found[1] == found[2]
    assert peaks[1] < peaks[0] / 2
