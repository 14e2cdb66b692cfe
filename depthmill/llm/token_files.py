"""Token files: ids in patched frame-of-reference blocks, one file per stretch of documents.

A file holds blocks of `BLOCK` ids, then the documents (id, whether it has one, length), then the place of every block,
then a trailer of fixed size. A block holds its minimum, a width and its exceptions' count; the differences to the minimum
packed at that width; and for the values that don't fit the position and the bits beyond the width. The width is that
of a percentile of the differences, so a few large ids don't widen the rest.

Documents are range-sorted by id; a task writes its stretch in files of bounded size, under names that no other attempt
uses, and returns a manifest row for each. Only files in the manifest count, so lost executors and repeated attempts
leave at most files that nobody reads. Files lie in the shared folder, through any file system Arrow knows.
"""

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depthmill.llm.bpe import PIECE, encoder
from depthmill.llm.texts import blocks, encoded
from depthmill.session import work_dir, written

BLOCK = 256
PERCENTILE = 90
END_ID = 0
#: Ids after which a file is closed (a document isn't cut).
FILE_IDS = 1 << 22
#: Parts of texts that a worker remembers.
PARTS_HELD = 1_200_000
#: Tasks that read files.
READERS = 10_000
MAGIC = b"PFORIDS1"
_HEAD = 7  # minimum u32, width u8, exceptions u16
_TRAILER = struct.Struct("<QQQQ8s")  # documents, blocks, ids, place of the footer, magic
_ROW = "part int, seq int, path string, n_docs long, n_ids long"


def _holder(width: int) -> np.dtype:
    """The smallest kind of integer that packed values of `width` bits are taken from and put into."""
    return np.dtype("<u1" if width <= 8 else "<u2" if width <= 16 else "<u4")


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of at most BLOCK ids; the last is filled up with its own last id."""
    count = -(-len(ids) // BLOCK)
    if not count:
        return []
    table = np.full(count * BLOCK, ids[-1], np.uint32)
    table[: len(ids)] = ids
    table = table.reshape(count, BLOCK)
    least = table.min(axis=1)
    rest = table - least[:, None]
    rank = min(BLOCK - 1, BLOCK * PERCENTILE // 100)
    width = np.ceil(np.log2(np.partition(rest, rank, axis=1)[:, rank].astype(np.float64) + 1)).astype(np.int64)
    beyond = rest >> width[:, None].astype(np.uint32)
    beyond[width == 32] = 0
    out: list[bytes] = [b""] * count
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        kind = _holder(w)
        bits = np.unpackbits(rest[own].astype(kind).view(np.uint8).reshape(len(own), BLOCK, kind.itemsize), axis=2, bitorder="little")
        body = np.packbits(bits[:, :, :w].reshape(len(own), -1), axis=1, bitorder="little")
        for k, i in enumerate(own.tolist()):
            at = np.flatnonzero(beyond[i])
            out[i] = struct.pack("<IBH", least[i], w, len(at)) + body[k].tobytes() + at.astype(np.uint8).tobytes() + beyond[i][at].astype("<u4").tobytes()
    return out


def unpack_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at `starts`, BLOCK each."""
    head = np.ascontiguousarray(data[starts[:, None] + np.arange(_HEAD)])
    least = head[:, :4].copy().view("<u4").ravel()
    width, extra = head[:, 4].astype(np.int64), head[:, 5:7].copy().view("<u2").ravel().astype(np.int64)
    out = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        size = BLOCK * w // 8
        if size:
            bits = np.unpackbits(data[starts[own][:, None] + _HEAD + np.arange(size)], axis=1, bitorder="little").reshape(len(own), BLOCK, w)
            kind = _holder(w)
            wide = np.zeros((len(own), BLOCK, 8 * kind.itemsize), np.uint8)
            wide[:, :, :w] = bits
            out[own] = np.packbits(wide, axis=2, bitorder="little").reshape(len(own), -1).view(kind)
    owner = np.repeat(np.arange(len(starts)), extra)
    if len(owner):
        k = np.arange(len(owner)) - np.repeat(np.cumsum(extra) - extra, extra)
        base = starts[owner] + _HEAD + BLOCK * width[owner] // 8
        at = data[base + k].astype(np.int64)
        high = np.ascontiguousarray(data[(base + extra[owner] + 4 * k)[:, None] + np.arange(4)]).view("<u4").ravel()
        out[owner, at] |= high << width[owner].astype(np.uint32)
    return (out + least[:, None]).ravel()


class Writer:
    """One token file, written block by block."""

    def __init__(self, folder: str):
        self.system, root = fs.FileSystem.from_uri(folder)
        self.name = f"ids-{uuid.uuid4().hex}.pfor"
        self.system.create_dir(root, recursive=True)
        self.stream = self.system.open_output_stream(f"{root}/{self.name}")
        self.stream.write(MAGIC)
        self.place, self.starts, self.n_ids = len(MAGIC), [], 0
        self.docs: list[int | None] = []
        self.lengths: list[int] = []
        self.held: list[np.ndarray] = []
        self.held_ids = 0

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.held_ids += len(ids)
        self.n_ids += len(ids)
        if self.held_ids >= 1 << 18:
            whole = np.concatenate(self.held)
            cut = len(whole) // BLOCK * BLOCK
            self._write(whole[:cut])
            self.held, self.held_ids = [whole[cut:]], len(whole) - cut

    def _write(self, ids: np.ndarray) -> None:
        for block in pack_blocks(ids):
            self.starts.append(self.place)
            self.stream.write(block)
            self.place += len(block)

    def close(self) -> tuple[str, int, int]:
        """(name, documents, ids)."""
        if self.held_ids:
            self._write(np.concatenate(self.held))
        footer = [np.array([d or 0 for d in self.docs], "<i8"), np.array([d is not None for d in self.docs], np.uint8), np.array(self.lengths, "<u4"), np.array(self.starts, "<u8")]
        self.stream.write(b"".join(x.tobytes() for x in footer) + _TRAILER.pack(len(self.docs), len(self.starts), self.n_ids, self.place, MAGIC))
        self.stream.close()
        return self.name, len(self.docs), self.n_ids


def read_file(path: str, at_once: int = 2048) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, ids) in the order of the file; blocks are decoded a stretch at a time."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_file(place) as stream:
        data = np.frombuffer(stream.read(), np.uint8)
    n_docs, n_blocks, n_ids, footer, magic = _TRAILER.unpack(data[-_TRAILER.size :].tobytes())
    if magic != MAGIC or data[: len(MAGIC)].tobytes() != MAGIC:
        raise ValueError(f"{path} is no token file")
    part = lambda kind, n, at: (np.frombuffer(data, kind, n, at), at + n * np.dtype(kind).itemsize)
    docs, at = part("<i8", n_docs, footer)
    named, at = part("u1", n_docs, at)
    lengths, at = part("<u4", n_docs, at)
    starts, _ = part("<u8", n_blocks, at)
    held, block, left = np.zeros(0, np.uint32), 0, n_ids
    for doc, known, length in zip(docs.tolist(), named.tolist(), lengths.tolist(), strict=True):
        parts = [held]
        have = len(held)
        while have < length:
            step = starts[block : block + at_once].astype(np.int64)
            ids = unpack_blocks(data, step)[:left]
            block, left = block + len(step), left - len(ids)
            parts.append(ids)
            have += len(ids)
        whole = np.concatenate(parts) if len(parts) > 1 else held
        yield (doc if known else None), whole[:length]
        held = whole[length:]


def _write(folder: str, tokenizer: str, end_id: int, file_ids: int, parts_held: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, writer = TaskContext.get().partitionId(), 0, None
        end = np.array([end_id], np.uint32).tobytes()

        def row(seq: int, writer: Writer) -> pa.RecordBatch:
            name, n_docs, n_ids = writer.close()
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [f"{folder}/{name}"], "n_docs": [n_docs], "n_ids": [n_ids]})

        for batch in blocks(batches, "text", PIECE):
            for doc, ids in zip(batch.column("id").to_pylist(), encoder(tokenizer, parts_held).encode(encoded(batch.column("text"))), strict=True):
                writer = writer or Writer(folder)
                writer.add(doc, np.frombuffer(ids + end, np.uint32))
                if writer.n_ids >= file_ids:
                    yield row(seq, writer)
                    seq, writer = seq + 1, None
        if writer:
            yield row(seq, writer)

    return write


def write_files(docs: DataFrame, tokenizer: str, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID, file_ids: int = FILE_IDS, parts_held: int = PARTS_HELD) -> DataFrame:
    """Write all documents in ascending id order; the manifest (part, seq, path, n_docs, n_ids, start), start being the ids before a file.

    A null or empty text is its end id alone. Rows without an id come first; rows that repeat an id follow each other,
    ordered by text. An empty table has an empty manifest. Other columns are not stored.
    """
    folder = folder or work_dir(docs.sparkSession, "token-files")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = source.repartitionByRange("id").sortWithinPartitions("id", "text")
    manifest = written(ordered.mapInArrow(_write(folder, tokenizer, end_id, file_ids, parts_held), _ROW), "token-manifest")
    # One row per file: a running sum over the manifest is small.
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            rows: list[tuple] = []
            for doc, ids in read_file(path):
                rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                start += len(ids)
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def read_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files. A file is one task's work."""
    # A number of its own: the manifest is so small that its rows would else be put into one task.
    spread = manifest.select("path", "start").repartition(max(1, min(manifest.count(), READERS)), "path")
    return spread.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
