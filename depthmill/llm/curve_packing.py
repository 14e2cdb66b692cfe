"""Packing along a space-filling curve: documents that lie close together share sequences.

1. Encode. A document's ids, with an end id, and its vector: the mean of fixed random rows that its ids hash to, in
   `DIMS` dimensions.
2. Curve. Coordinates are standardised by their mean and deviation over all documents, cut to a grid and turned into a
   Hilbert key. Rows are range-sorted by (key, id), so a task holds a stretch of the curve; copies spread by id.
3. Pack. A task lays its documents end to end and cuts every `length` ids. What is left at its end is cut into sequences
   of a power of two each, which need no padding.

Ids are moved once (the range sort); nothing is gathered but the moments of the coordinates (one row).
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthmill.llm.bpe import PIECE, encoder, forget
from depthmill.llm.texts import blocks, encoded
from depthmill.session import written

LENGTH = 2048
END_ID = 1
DIMS, BITS = 4, 12
_ROWS = np.random.default_rng(7).standard_normal((1 << 14, DIMS)).astype(np.float32)


def vectors(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Mean of the rows that each document's ids hash to; a document has one id at least."""
    rows = _ROWS[(ids.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(18)]
    starts = np.cumsum(lengths) - lengths
    return np.add.reduceat(rows, starts, axis=0, dtype=np.float64) / lengths[:, None]


def hilbert(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of integer points (rows), as signed longs: dimensions times bits stay below 63."""
    x = [grid[:, i].astype(np.int64) for i in range(grid.shape[1])]
    n = len(x)
    # Undo excess work from the highest bit down, then Gray-code; bits of all axes are then interleaved.
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] = x[i] ^ swap if i else x[0]
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ turn) >> bit) & 1)
    return key


def _encode(path: str, end_id: int, width: int):
    kind = np.uint16 if width == 2 else np.uint32

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], np.uint32).tobytes()
        for batch in blocks(batches, "text", PIECE):
            found = [x + end for x in encoder(path).encode(encoded(batch.column("text")))]
            lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
            ids = np.frombuffer(b"".join(found), np.uint32)
            points = vectors(ids, lengths)
            small, steps = ids.astype(kind).tobytes(), (width * np.append(0, np.cumsum(lengths))).tolist()
            packed = pa.array([small[a:b] for a, b in zip(steps, steps[1:], strict=False)], pa.binary())
            arrays = [batch.column("row"), pa.array(lengths), packed, *(pa.array(points[:, i]) for i in range(DIMS))]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "n", "ids", *(f"p{i}" for i in range(DIMS))])

    return encode


class Packer:
    """Lays documents end to end and yields pieces (row index, start, length, sequence, offset) of full sequences."""

    def __init__(self, length: int, base: int):
        self.length, self.sequence = length, base
        self.open: list[tuple] = []
        self.used = 0

    def add(self, document, size: int) -> list[tuple]:
        done, start = [], 0
        while start < size:
            take = min(self.length - self.used, size - start)
            self.open.append((document, start, take, self.sequence, self.used))
            start, self.used = start + take, self.used + take
            if self.used == self.length:
                done += self.open
                self.open, self.used, self.sequence = [], 0, self.sequence + 1
        return done

    def finish(self) -> list[tuple]:
        """The pieces left, cut anew into sequences of falling powers of two."""
        rest, done, left, used = self.open, [], self.used, 0
        room = 1 << (left.bit_length() - 1) if left else 0
        for document, start, size, _, _ in rest:
            while size:
                take = min(size, room - used)
                done.append((document, start, take, self.sequence, used))
                start, size, used, left = start + take, size - take, used + take, left - take
                if used == room:
                    room, used, self.sequence = 1 << (left.bit_length() - 1) if left else 0, 0, self.sequence + 1
        self.open, self.used = [], 0
        return done


def _pack(length: int, width: int):
    kind = np.uint16 if width == 2 else np.uint32

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        packer = Packer(length, TaskContext.get().partitionId() << 40)

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            ids = [np.frombuffer(d[2], kind)[start : start + size].astype("<u4").tobytes() for d, start, size, _, _ in pieces]
            columns = list(zip(*[(d[1], start, size, sequence, offset) for d, start, size, sequence, offset in pieces], strict=True))
            held = pa.concat_arrays([d[0] for d, *_ in pieces])
            names = ["row", "doc_tokens", "start", "length", "sequence_id", "offset", "ids"]
            return pa.RecordBatch.from_arrays([held, *(pa.array(x, pa.int64()) for x in columns), pa.array(ids, pa.binary())], names=names)

        for batch in blocks(batches, "ids", PIECE):
            row, sizes, ids = batch.column("row"), batch.column("n").to_pylist(), batch.column("ids").to_pylist()
            done: list[tuple] = []
            for i, size in enumerate(sizes):
                done += packer.add((row.slice(i, 1), size, ids[i]), size)
            if done:
                yield rows(done)
        if left := packer.finish():
            yield rows(left)

    return pack


def packed(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """Pieces of sequences: the columns of `docs` but the text, then doc_tokens, start, length, sequence_id, offset, ids.

    `length` is a power of two. A null or empty text is its end id alone. Repeated rows are packed as often as they
    stand; rows without an id come first among equal keys. An empty table gives no pieces. Columns of `docs` whose names
    clash with those added are left out. `ids` are little-endian unsigned 32-bit integers.
    """
    if length & (length - 1):
        raise ValueError("the length of a sequence is a power of two")
    added = ("doc_tokens", "start", "length", "sequence_id", "offset", "ids")
    rest = [c for c in docs.columns if c != text_col and c not in added]
    width = 2 if max(encoder(tokenizer).vocabulary, end_id + 1) <= 1 << 16 else 4
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]) if rest else F.struct(F.lit(0).alias("c0"))
    source = docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    axes = [f"p{i}" for i in range(DIMS)]
    points = written(source.mapInArrow(_encode(tokenizer, end_id, width), f"row {kind}, n long, ids binary, " + ", ".join(f"{p} double" for p in axes)), "encoded")
    moments = points.agg(*[f(p).alias(f"{k}{p}") for p in axes for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()

    @F.pandas_udf("long")
    def key(p0: pd.Series, p1: pd.Series, p2: pd.Series, p3: pd.Series) -> pd.Series:
        points = np.stack([p0, p1, p2, p3], axis=1)
        spread = (points - center) / deviation / 3  # three deviations reach the border of the grid
        grid = np.clip((spread + 1) * (1 << (BITS - 1)), 0, (1 << BITS) - 1).astype(np.int64)
        return pd.Series(hilbert(grid, BITS))

    center = np.array([moments[f"m{p}"] or 0.0 for p in axes])
    deviation = np.array([moments[f"s{p}"] or 1.0 for p in axes])
    place = [F.col(f"row.c{rest.index(id_col)}")] if id_col in rest else []
    keyed = points.select("row", "n", "ids", key(*axes).alias("key"))
    along = keyed.repartitionByRange("key", *place).sortWithinPartitions("key", *place).select("row", "n", "ids")
    pieces = along.mapInArrow(_pack(length, width), f"row {kind}, doc_tokens long, start long, length long, sequence_id long, offset long, ids binary")
    return pieces.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(rest)], *added)
