"""Words of many texts at once, as numpy arrays.

Executors get Arrow batches; `blocks` cuts them into pieces of bounded size, `Words` splits a piece into words and
hashes them without a Python object for each word. A text is never cut: a piece holds whole texts.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space: tab, line feed, vertical tab, form feed, carriage return, space.
SPACES = b"\t\n\x0b\x0c\r "
#: Bytes of texts that one piece holds (a longer text is a piece by itself).
PIECE = 4 << 20

#: Bytes that are hashed at a time.
_STRETCH = 1 << 17

_rng = np.random.default_rng(20_240_817)
_BYTES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(1, 1 << 63, 1 << 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def byte_mask(values: bytes) -> np.ndarray:
    """256 flags, true for the given bytes."""
    mask = np.zeros(256, bool)
    mask[list(values)] = True
    return mask


IS_SPACE = byte_mask(SPACES)


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * _TWO
    h = (h ^ (h >> np.uint64(29))) * _ONE
    return h ^ (h >> np.uint64(32))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, at the place of the first; empty when there are fewer than n."""
    if len(h) < n:
        return h[:0]
    width = 1
    while width * 2 <= n:
        h = mix(h[:-width] * _ONE + (h[width:] ^ _TWO))
        width *= 2
    rest = n - width
    return mix(h[:-rest] * _TWO + h[rest:]) if rest else h


def encoded(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null is an empty text."""
    return [t or b"" for t in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most `limit` bytes of `column`, at least one row each."""
    for batch in batches:
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
        start, total = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


class Words:
    """Words of a list of texts: `starts`, `ends` (byte places in `joined`), `first` (index of each text's first word, one more at the end)."""

    def __init__(self, texts: list[bytes], space: np.ndarray = IS_SPACE):
        self.joined = b"\n".join(texts) + b"\n"
        self.buffer = np.frombuffer(self.joined, np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        gap = space[self.buffer]
        if len(gap):
            gap[self.bounds[1:] - 1] = True  # also when a line feed is no space in this alphabet
        before = np.concatenate([[True], gap[:-1]])
        self.starts = np.flatnonzero(~gap & before)
        self.ends = np.flatnonzero(gap & ~before)
        self.first = np.searchsorted(self.starts, self.bounds)
        self._gap = gap

    @property
    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """Index of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes; worked out a stretch of the buffer at a time."""
        size = len(self.starts)
        out = np.zeros(size, np.uint64)
        cuts = np.unique(np.append(np.searchsorted(self.starts, np.arange(0, len(self.buffer), _STRETCH)), [0, size])).tolist()
        for i, j in zip(cuts, cuts[1:], strict=False):
            begin, end = self.starts[i], self.starts[j] if j < size else len(self.buffer)
            values = _BYTES[self.buffer[begin:end]]
            values[self._gap[begin:end]] = 0
            own = self.starts[i:j] - begin
            place = np.arange(end - begin, dtype=np.int64)
            place -= np.repeat(own, np.diff(np.append(own, end - begin)))
            values *= _OFFSETS[place & 0xFFFF]
            out[i:j] = np.add.reduceat(values, own)
        return mix(out + (self.ends - self.starts).astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.joined[self.starts[i] : self.ends[i]]

    def code_points(self) -> np.ndarray:
        """Code points within words, of each text."""
        return self.flagged(~self._gap & ((self.buffer & 0xC0) != 0x80))

    def flagged(self, flags: np.ndarray) -> np.ndarray:
        """Flags of bytes that are set in each text; nothing wider than a byte is made of them."""
        return np.add.reduceat(flags, self.bounds[:-1], dtype=np.int64)

    def with_flag(self, flags: np.ndarray) -> np.ndarray:
        """Whether each word has a byte whose flag is set; white space must have none."""
        return np.logical_or.reduceat(flags, self.starts)


def covered(marks: np.ndarray, width: int, size: int) -> np.ndarray:
    """Flags of the words that a window of `width` words covers which starts at a marked word."""
    edge = np.zeros(size + 1, np.int64)
    at = np.flatnonzero(marks)
    np.add.at(edge, at, 1)
    np.add.at(edge, np.minimum(at + width, size), -1)
    return np.cumsum(edge[:-1]) > 0


def fits(first: np.ndarray, size: int, n: int) -> np.ndarray:
    """Flags of the words at which n words of the same text begin."""
    ends = np.repeat(first[1:], np.diff(first))
    return np.arange(size) + n <= ends
