"""Token ids of many texts, with a memory for parts that come again.

Tokenizers split a text into parts before they merge anything, so a text's ids are those of its parts in order. Cuts
are made only where the tokenizer itself cuts for certain: at a single space or line feed between other characters, and
between a run of letters and the ASCII punctuation after it. A text with other white space, or with the string of a
special token that the tokenizer finds in texts, is encoded whole. Words of Latin letters go straight to the merges, as the steps before them change nothing else there. The memory is bounded; its
size changes the time taken, never the ids.
"""

import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

#: Parts that a worker remembers.
PARTS_HELD = 500_000
#: Bytes of text that are best encoded at a time.
PIECE = 2 << 20
#: ASCII punctuation without the apostrophe (which may begin a contraction).
PUNCTUATION = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'
_PLAIN_TAIL = re.compile("[" + re.escape(PUNCTUATION.decode()) + "]+")
_OTHER_ASCII = b"\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
#: White space beyond ASCII, as UTF-8.
_OTHER_WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_UNITS_AT_ONCE = 4096
#: Bytes that byte-level vocabularies write as themselves; the others are written as code points from 256 on, in order.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_WRITTEN = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_SPACE = chr(_WRITTEN[0x20])


@lru_cache(maxsize=4)
def encoder(path: str, held: int = PARTS_HELD, plain: bool = False) -> "Encoder":
    """The encoder of a vocabulary file; one per worker, kept between tasks. It remembers about `held` parts, some 200 bytes each."""
    return Encoder(path, held, plain)


def forget() -> None:
    """Give up this worker's encoders with all they remember, for steps that don't encode."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        pa.default_memory_pool().release_unused()


class Encoder:
    """`plain`: the strings of special tokens are ordinary text; else they become their ids, as in the tokenizer as loaded."""

    def __init__(self, path: str, held: int = PARTS_HELD, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.special = [] if plain else [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, self.held = self.tokenizer.model, held
        self.parts: dict[bytes, bytes] = {}
        self.tails: dict[str, bytes] = {}
        # Which of the two kinds of vocabulary: does white space live in the tokens, or do words carry an end mark?
        self.drops_space = self._ids(" ") == b""
        if self.drops_space:
            size = self.tokenizer.get_vocab_size()
            self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        else:
            self.feed = np.frombuffer(self._ids("\n"), np.uint32)

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size()

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text as little-endian unsigned 32-bit integers."""
        if len(self.parts) > self.held:
            self.parts.clear()
            self.tails.clear()
        cut = [self._cut(t) for t in texts]
        self._learn(set().union(*(parts for parts in cut if parts is not None)).difference(self.parts))
        get = self.parts.__getitem__
        skip = 0 if self.drops_space else 4 * len(self.feed)
        return [self._ids(t.decode()) if parts is None else b"".join(map(get, parts))[skip if t else 0 :] for t, parts in zip(texts, cut, strict=True)]

    def after_space(self, texts: list[bytes]) -> list[list[bytes] | None]:
        """Parts of space + text for each text (for vocabularies that keep spaces); each follows one space or begins with its line feed. None: can't be cut."""
        cut = [self._cut(t) for t in texts]
        return [[parts[0][1:], *parts[1:]] if parts else parts for parts in cut]

    def part_ids(self, parts: list[bytes]) -> list[bytes]:
        """Ids of parts as `after_space` gives them."""
        if len(self.parts) > self.held:
            self.parts.clear()
            self.tails.clear()
        self._learn(set(parts).difference(self.parts))
        return [self.parts[p] for p in parts]

    def whole_ids(self, text: bytes) -> bytes:
        """Ids of a text that isn't cut."""
        return self._ids(text.decode())

    def _cut(self, text: bytes) -> list[bytes] | None:
        if self.drops_space:
            text = text.lower()  # a part in lower case could become a special token that the text doesn't hold
        for name in self.special:
            if name in text:
                return None
        if self.drops_space:
            return text.split()  # lower case of ASCII letters comes before the tokenizer's own, and changes nothing
        if not text:
            return []
        if b"  " in text or b" \n" in text or b"\n " in text or b"\n\n" in text or text[:1].isspace() or text[-1:].isspace():
            return None
        if len(text.translate(None, _OTHER_ASCII)) < len(text) or _OTHER_WIDE.search(text):
            return None
        # A part without a line feed follows a space. The text itself begins like a line.
        return (b"\n" + text).replace(b"\n", b" \n").split(b" ")[1:]

    def _learn(self, missing: set[bytes]) -> None:
        """Ids of new parts; letters followed by punctuation are put together from both."""
        whole: dict[bytes, None] = {}
        tails: dict[str, None] = {}
        composed: list[tuple[bytes, bytes, str]] = []
        for part in missing:
            stem = part.rstrip(PUNCTUATION)
            if len(stem) < len(part) and stem.decode().removeprefix("\n").isalpha():
                tail = part[len(stem) :].decode()
                composed.append((part, stem, tail))
                if stem not in self.parts:
                    whole[stem] = None
                if tail not in self.tails:
                    tails[tail] = None
            else:
                whole[part] = None
        self.tails.update(self._encode_all(list(tails)))
        names = list(whole)
        for k in range(0, len(names), _UNITS_AT_ONCE):
            some = names[k : k + _UNITS_AT_ONCE]
            if self.drops_space:
                found = self._encode_all([p.decode() for p in some])
                self.parts.update((p, found[p.decode()]) for p in some)
            else:
                units = [p[1:].decode() if p[:1] == b"\n" else " " + p.decode() for p in some]
                found = self._encode_all(units)
                feed = self.feed.tobytes()
                self.parts.update((p, feed + found[u] if p[:1] == b"\n" else found[u]) for p, u in zip(some, units, strict=True))
        for part, stem, tail in composed:
            self.parts[part] = self.parts[stem] + self.tails[tail]

    def _merged(self, name: str) -> bytes | None:
        """Ids of a word of Latin letters (after one space, in vocabularies that keep it), by the merges alone; else None."""
        word = name if self.drops_space else name.removeprefix(" ")
        if not word.isalpha() or not word.isascii() and max(word) > "\xff":
            return None
        unit = name.lower() if self.drops_space else name
        unit = unit.replace(" ", _SPACE) if word.isascii() else unit.encode().decode("latin-1").translate(_WRITTEN)
        return array("I", [t.id for t in self.model.tokenize(unit)]).tobytes()

    def _encode_all(self, names: list[str]) -> dict[str, bytes]:
        """Ids of many units in one call: they are joined by what surely parts them, and the ids are cut there again."""
        found = {n: ids for n in names if (ids := self._merged(n)) is not None}
        names = [n for n in names if n not in found]
        if self.drops_space:
            whole = [n for n in names if n.isalpha() or _PLAIN_TAIL.fullmatch(n)]  # a single word each for the tokenizer
            joined, mark = " ".join(whole), None
        else:
            whole = [n for n in names if n]
            joined, mark = "\n".join(whole), self.feed
        if len(whole) > 1 and (mark is None or len(mark) == 1):
            ids = np.array(self.tokenizer.encode(joined, add_special_tokens=False).ids, np.uint32)
            # Byte places at which the ids of a unit begin and end.
            if mark is None:
                last = 4 * (np.flatnonzero(self.ends[ids]) + 1)
                first = np.append(0, last[:-1])
            else:
                at = 4 * np.flatnonzero(ids == mark[0])
                first, last = np.append(0, at + 4), np.append(at, 4 * len(ids))
            if len(first) == len(whole):
                raw = ids.tobytes()
                found.update((n, raw[a:b]) for n, a, b in zip(whole, first.tolist(), last.tolist(), strict=True))
        rest = [n for n in names if n not in found]
        for name, one in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else [], strict=True):
            found[name] = np.array(one.ids, np.uint32).tobytes()
        return found
