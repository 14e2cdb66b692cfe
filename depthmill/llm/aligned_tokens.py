"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes of a text.

Cumulative byte ends of both id lists go into dictionaries from end to index; the ends both hold, sorted, cut the lists
into groups, and the tokens of a group that overlap are links. Both tokenizers surely cut at a single space or line feed
between other characters, so a text is aligned part by part, and a part that comes again (a word) is aligned once per
block of texts; a text that can't be cut is one part. Blocks hold ids of distinct parts and the order of parts in texts.

Counts of linked id pairs are summed over the corpus. The `frequent` most linked pairs are sent to the tasks, the rest
is joined: parts name the pairs they lack, and their counts come back per block of documents.
"""

from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthmill.llm.bpe import encoder
from depthmill.llm.texts import blocks, encoded
from depthmill.session import written

#: Bytes of text in a block (a longer text is a block by itself).
BLOCK = 3 << 20
#: Parts that a worker remembers, some 250 bytes each.
PARTS_HELD = 200_000
#: Parts of a block whose groups are looked for at a time.
PARTS_AT_ONCE = 1 << 13
#: Id pairs whose counts are sent to every task, 17 bytes each; the others are joined.
FREQUENT = 1 << 17
#: Pairs that a task gathers before it hands counts on.
GATHERED = 1 << 21
#: Bounds of counts from which the frequent pairs are chosen, per power of two.
_STEPS = 8

_BLOCKS = "block long, doc_id array<long>, words array<long>, at binary, ids_a binary, ids_b binary, count_a binary, count_b binary"
_ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str, held: int = PARTS_HELD) -> "Aligner":
    """One per worker, kept between tasks."""
    return Aligner(path_a, path_b, held)


class Aligner:
    """Both encoders: vocabulary A is a byte-level file of the tokenizers library, B a sentencepiece model."""

    def __init__(self, path_a: str, path_b: str, held: int = PARTS_HELD):
        from sentencepiece import SentencePieceProcessor

        self.a = encoder(path_a, held // 4, True)
        self.b = SentencePieceProcessor(model_file=path_b)
        names = (self.a.tokenizer.id_to_token(i) or "" for i in range(self.a.vocabulary))
        self.a_bytes = [bytes(map(_byte_of, map(ord, name))) for name in names]
        self.b_bytes = [_piece_bytes(self.b, i) for i in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.blank = self.b.piece_to_id("▁")
        self.b_cuts = self.blank >= 0 and not any("▁" in (name := self.b.id_to_piece(i)).lstrip("▁") or "\n" in name for i in range(self.b.get_piece_size()))
        self.names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.singles: dict[int, str] = {}
        self.held = held
        self.known: dict[bytes, tuple[bytes, bytes] | None] = {}

    def forget(self) -> None:
        """Give up what was remembered for encoding: reading blocks doesn't need it."""
        if self.known or self.a.parts:
            self.known, self.a.parts, self.a.tails = {}, {}, {}
            pa.default_memory_pool().release_unused()

    def parts(self, texts: list[bytes]) -> list[list[bytes]]:
        """Each text's parts; a text that can't be cut is one part, marked by a leading space."""
        cut = self.a.after_space(texts) if self.b_cuts else [None] * len(texts)
        return [([b" " + t] if t else []) if p is None else p for t, p in zip(texts, cut, strict=True)]

    def ids(self, parts: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        """Unsigned 32-bit ids of A and of B for each part, or None where their bytes differ from the part's."""
        if len(self.known) > self.held:  # keep what is asked for now
            self.known = {p: self.known[p] for p in parts if p in self.known}
        words = [p for p in parts if p not in self.known and p[:1] != b" "]
        found = self._checked([p if p[:1] == b"\n" else b" " + p for p in words], self.a.part_ids(words), self.b.encode([p.decode() for p in words], num_threads=1) if words else [])
        self.known.update(zip(words, found, strict=True))
        texts = [p for p in parts if p[:1] == b" "]
        wholes = dict(zip(texts, self._checked(texts, [self.a.whole_ids(p) for p in texts], [self.b.encode(p[1:].decode()) for p in texts]), strict=True))
        return [wholes[p] if p[:1] == b" " else self.known[p] for p in parts]

    def _checked(self, parts: list[bytes], a: list[bytes], b: list[list[int]]) -> list[tuple[bytes, bytes] | None]:
        """Ids of both sides; None where the bytes of one of them aren't the part's."""
        # B adds a space; what begins with a line feed doesn't stand after one.
        b = [(ids[1:] if ids[:1] == [self.blank] else []) if p[:1] == b"\n" else ids for p, ids in zip(parts, b, strict=True)]
        sizes = np.array([len(p) for p in parts], np.int64)
        ids_a, ids_b = np.frombuffer(b"".join(a), np.uint32).tolist(), list(chain.from_iterable(b))
        same = b"".join(map(self.a_bytes.__getitem__, ids_a)) == b"".join(parts) == b"".join(map(self.b_bytes.__getitem__, ids_b))
        for ids, table, counts in ((ids_a, self.a_sizes, [len(x) // 4 for x in a]), (ids_b, self.b_sizes, [len(x) for x in b])):
            total = np.concatenate([[0], np.cumsum(table[np.array(ids, np.int64)])])
            same = same and np.array_equal(total[np.cumsum(counts, dtype=np.int64)], np.cumsum(sizes))
        found = [(x, array("I", y).tobytes()) for x, y in zip(a, b, strict=True)]
        if same:
            return found
        as_bytes = lambda table, ids: b"".join(map(table.__getitem__, ids))
        return [x if as_bytes(self.a_bytes, np.frombuffer(x[0], np.uint32).tolist()) == p == as_bytes(self.b_bytes, y) else None for p, x, y in zip(parts, found, b, strict=True)]


_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_UNWRITTEN = {256 + i: b for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def _byte_of(code: int) -> int:
    """The byte that a byte-level vocabulary writes as this code point."""
    return code if code in _PRINTED else _UNWRITTEN.get(code, 0)


def _piece_bytes(model, i: int) -> bytes:
    name = model.id_to_piece(i)
    return bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()


def _pack(values: np.ndarray) -> bytes:
    """Integers in as few bytes each as the largest needs; the first byte says how many."""
    size = next(n for n in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << 8 * n)
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _align_blocks(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_id, tool = TaskContext.get().partitionId(), aligner(path_a, path_b)
        for seq, batch in enumerate(blocks(batches, "text", BLOCK)):
            index: dict[bytes, int] = {}
            at = [np.array([index.setdefault(p, len(index)) for p in tool.parts([t])[0]], np.uint32) for t in encoded(batch.column("text"))]
            found = tool.ids(list(index))
            bad = np.array([x is None for x in found], bool)
            if bad.any():  # one part that differs takes its whole text out
                at = [x[:0] if bad[x].any() else x for x in at]
            ids = [[b"" if x is None else x[k] for x in found] for k in (0, 1)]
            columns = [np.concatenate([np.zeros(0, np.uint32), *at])]
            columns += [np.frombuffer(b"".join(x), np.uint32) for x in ids]
            columns += [np.array([len(x) // 4 for x in own], np.int64) for own in ids]
            row = [[part_id << 32 | seq], [batch.column("id").to_pylist()], [[len(x) for x in at]], *([_pack(x)] for x in columns)]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(row, kinds, strict=True)], names=[f.split()[0] for f in _BLOCKS.split(", ")])

    return run


class _Block:
    """A written block: its distinct parts' tokens one after another, as byte ends, and the links between them."""

    def __init__(self, row: dict, tool: Aligner):
        self.name, self.row, self.names, self.singles = row["block"], row, tool.names, tool.singles
        #: (pair, n, best) of the linked pairs that weren't sent.
        self.more: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self.at, self.ids_a, self.ids_b = (_unpack(row[c]) for c in ("at", "ids_a", "ids_b"))
        self.count_a, self.count_b = _unpack(row["count_a"]), _unpack(row["count_b"])
        self.ends_a, self.ends_b = np.cumsum(tool.a_sizes[self.ids_a]), np.cumsum(tool.b_sizes[self.ids_b])
        self.part_ends = np.concatenate([[0], self.ends_a])[np.cumsum(self.count_a)]
        # Between two neighbouring ends of either side lies one overlap.
        is_a, is_b = (np.zeros(self.part_ends[-1] + 1 if len(self.part_ends) else 1, bool) for _ in range(2))
        is_a[self.ends_a], is_b[self.ends_b] = True, True
        ends = np.flatnonzero(is_a | is_b)
        self.links = self.ids_a[(np.cumsum(is_a) - is_a)[ends]] << 32 | self.ids_b[(np.cumsum(is_b) - is_b)[ends]]
        self.link_ends = np.cumsum(is_a | is_b)[self.part_ends]

    def per_part(self, value: np.ndarray) -> np.ndarray:
        """Sums over each part's links."""
        return np.diff(np.concatenate([[0], np.cumsum(value)])[self.link_ends], prepend=0)

    def per_doc(self, value: np.ndarray) -> np.ndarray:
        """Sums of a part's value over each document's words."""
        return np.diff(np.concatenate([[0], np.cumsum(value[self.at])])[np.cumsum(self.row["words"], dtype=np.int64)], prepend=0)

    def uses(self) -> np.ndarray:
        """How often each link's part stands in the block."""
        return np.repeat(np.bincount(self.at, minlength=len(self.part_ends)), np.diff(self.link_ends, prepend=0))

    def groups(self) -> tuple[np.ndarray, list[str]]:
        """(groups of each part, groups' text of each document)."""
        to_a, to_b = np.cumsum(self.count_a), np.cumsum(self.count_b)
        counts, parts, a, b = [np.zeros(0, np.int64)], [], 0, 0
        for k in range(0, len(to_a), PARTS_AT_ONCE):
            own = slice(k, k + PARTS_AT_ONCE)
            next_a, next_b = int(to_a[own][-1]), int(to_b[own][-1])
            n, texts = self._part_groups(slice(a, next_a), slice(b, next_b), self.part_ends[own])
            counts.append(n)
            parts += texts
            a, b = next_a, next_b
        ends = np.cumsum(self.row["words"], dtype=np.int64)
        out = [";".join(map(parts.__getitem__, self.at[end - n : end].tolist())) for n, end in zip(self.row["words"], ends.tolist(), strict=True)]
        return np.concatenate(counts), out

    def _part_groups(self, own_a: slice, own_b: slice, part_ends: np.ndarray) -> tuple[np.ndarray, list[str]]:
        """(groups, groups' text) of some neighbouring parts, given their tokens of either side; groups never cross parts."""
        ids_a, ids_b, ends_a, ends_b = self.ids_a[own_a], self.ids_b[own_b], self.ends_a[own_a], self.ends_b[own_b]
        index_a = dict(zip(ends_a.tolist(), range(1, len(ends_a) + 1), strict=True))
        index_b = dict(zip(ends_b.tolist(), range(1, len(ends_b) + 1), strict=True))
        common = sorted(index_a.keys() & index_b.keys())
        to_i, to_j = (np.fromiter(map(index.__getitem__, common), np.int64, len(common)) for index in (index_a, index_b))
        from_i, from_j = (np.concatenate([[0], x[:-1]]) if len(x) else x for x in (to_i, to_j))
        # Most groups are a token on either side: their texts are remembered by id pair.
        if len(self.singles) > FREQUENT:
            self.singles.clear()
        code = (ids_a[from_i] << 32 | ids_b[from_j]).tolist() if len(common) else []
        texts = list(map(self.singles.get, code))
        more = np.flatnonzero((to_i - from_i > 1) | (to_j - from_j > 1))
        name = self.names.__getitem__
        for k, i, to_i_, j, to_j_ in zip(more.tolist(), from_i[more].tolist(), to_i[more].tolist(), from_j[more].tolist(), to_j[more].tolist(), strict=True):
            texts[k] = f"{','.join(map(name, ids_a[i:to_i_].tolist()))}|{','.join(map(name, ids_b[j:to_j_].tolist()))}"
        for k in [k for k, text in enumerate(texts) if text is None]:
            texts[k] = self.singles[code[k]] = f"{name(code[k] >> 32)}|{name(code[k] & 0xFFFFFFFF)}"
        cuts = np.searchsorted(np.array(common, np.int64), part_ends, "right")
        bounds = [0, *cuts.tolist()]
        return np.diff(cuts, prepend=0), [";".join(texts[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]


def _read(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[_Block]:
    tool = aligner(*paths)
    tool.forget()
    for batch in batches:
        more = batch.column("more") if "more" in batch.schema.names else None
        plain = batch.select([f.split()[0] for f in _BLOCKS.split(", ")])
        for i in range(batch.num_rows):
            block = _Block(plain.slice(i, 1).to_pylist()[0], tool)
            if more is not None and more[i].is_valid:
                block.more = tuple(x.to_numpy(zero_copy_only=False) for x in more.slice(i, 1).flatten().flatten())
            yield block


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of linked pairs, summed over a task's blocks as far as `GATHERED` allows."""
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for block in _read(batches, paths):
            keys.append(block.links)
            counts.append(block.uses())
            if sum(map(len, keys)) > GATHERED:
                pair, total = _summed(keys, counts)
                if len(pair) > GATHERED // 2:
                    yield _counts(pair, total)
                    pair, total = pair[:0], total[:0]
                keys, counts = [pair], [total]
        yield _counts(*_summed(keys, counts))

    return run


def _counts(pair: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    used = total > 0
    return pa.RecordBatch.from_arrays([pa.array(pair[used]), pa.array(total[used])], names=["pair", "n"])


def linked_pairs(parts: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """(pair, n, best) of the blocks: links that hold an id pair, and whether no other pair of its B id has more. A pair is A id x 2^32 + B id."""
    counts = written(parts.mapInArrow(_count(paths), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "linked-pairs")
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    # One row for each id of B: bounded by its vocabulary.
    most = counts.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), b_id == F.col("b_id")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent(pairs: DataFrame, limit: int) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], bool]:
    """The most linked pairs, at most `limit` of them, as (pair in order, n, best); and whether they are all."""
    step = F.floor(F.log2("n") * _STEPS).cast("int")
    bins = sorted((r["step"], r["size"]) for r in pairs.groupBy(step.alias("step")).agg(F.count("*").alias("size")).collect())
    total, least = 0, None
    for at, size in reversed(bins):
        if total + size > limit:
            break
        total, least = total + size, at
    rows = pairs.where(step >= least).toPandas() if least is not None else None
    if rows is None:
        return (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)), not bins
    rows = rows.sort_values("pair")
    return (rows["pair"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), rows["best"].to_numpy(bool)), least == bins[0][0]


def _find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of keys in the sorted `known`, flags of those that are there)."""
    place = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
    return place, known[place] == keys if len(known) else np.zeros(len(keys), bool)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row.

    Space + text is encoded by A, text by B, special tokens' strings as plain text. `groups` reads `a1,a2|b1;a3|b2,b3`.
    Links are the A and B tokens of a group that overlap; a pair's count is the links that hold it in the whole table.
    n_best: links whose count is the highest of their B id (ties count); count_sum: the links' counts added up.

    Null and empty texts, and texts that one of the vocabularies can't give back byte by byte, have zeros and empty
    groups, and add nothing to the counts. Long texts are never cut up beyond their parts. Repeated rows and null ids are
    rows like any other; an empty table gives an empty result. Other columns are ignored.
    """
    spark, paths = docs.sparkSession, (path_a, path_b)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    parts = written(source.mapInArrow(_align_blocks(*paths), _BLOCKS), "aligned-parts", wide=True)
    pairs = written(linked_pairs(parts, paths), "pair-counts")
    known, all_known = _frequent(pairs, frequent)
    sent = spark.sparkContext.broadcast(known)

    def missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read(batches, paths):
            links = np.unique(block.links)
            links = links[~_find(sent.value[0], links)[1]]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(links), block.name)), pa.array(links)], names=["block", "pair"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read(batches, paths):
            tables = [sent.value]
            if block.more:
                order = np.argsort(block.more[0])
                tables.append(tuple(x[order] for x in block.more))
            counts, tops = np.zeros((2, len(block.links)), np.int64)
            for keys, n, best in tables:
                place, there = _find(keys, block.links)
                counts[there], tops[there] = n[place[there]], best[place[there]]
            n_groups, groups = block.groups()
            sums = [block.count_a, block.count_b, n_groups, block.per_part(np.ones_like(counts)), block.per_part(tops), block.per_part(counts)]
            columns = [pa.array(block.row["doc_id"], pa.int64()), *(pa.array(block.per_doc(x)) for x in sums), pa.array(groups, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in _ROWS.split(", ")])

    if not all_known:
        answers = parts.mapInArrow(missing, "block long, pair long").join(pairs, "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("more"))
        parts = parts.join(answers, "block", "left")
    return parts.mapInArrow(rows, _ROWS)
