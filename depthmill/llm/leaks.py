"""Benchmark decontamination: verbatim passages of test items in documents, by suffix arrays.

A shard is a piece of the documents (whole texts, a few megabytes). Its suffix array holds the places at which a test
item could match: those whose first words are the first words of some test window. Equal test windows are one class, with a
list of its items; every class is searched in the array by bisection, and the range found holds all its locations. So a
place has one hit for each window width at most, however many items share a passage. Its longest verbatim match comes
from the test block's own suffix array: it is that of one of the two neighbours there.

The test set is a table of blocks of bounded size in the shared folder, never whole in one place: each round sends one
block to the tasks and passes the documents through. Documents aren't shuffled.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthmill.llm.texts import Words, blocks, byte_mask, encoded, grams
from depthmill.session import written

WINDOW = 10
#: Words of a test block, at 8 bytes each.
BLOCK_WORDS = 1 << 20
#: First words by which places are chosen for a shard's array.
HEAD = 4

#: An item's word holds digits, letters and any byte beyond ASCII; everything else parts words.
_PARTS = byte_mask(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))

_HITS = "struct<spans:array<struct<first_word:int,n_words:int,longest_match:int>>,items:array<string>>"


def item_words(texts: list[bytes]) -> Words:
    return Words([t.translate(_LOWER) for t in texts], _PARTS)


class TestBlock:
    """Windows of some test items, ready to be searched: classes of equal windows, their items, and the suffix array of all words."""

    __test__ = False

    def __init__(self, names: list[str | None], texts: list[bytes], window: int):
        words = item_words(texts)
        self.words = words.hashes()
        self.names = names
        counts = words.counts
        width = np.minimum(window, counts)
        owner = words.owner()
        self.left = words.first[owner + 1] - np.arange(len(owner))
        at = np.flatnonzero(self.left >= width[owner])
        self.classes = []  # (window width, a place of each class, start of its items in `items`, `items`)
        for n in np.unique(width[width > 0]).tolist():
            own = at[width[owner[at]] == n]
            hashed = window_hashes(self.words, n)[own]
            order = np.lexsort((owner[own], hashed))
            own, hashed = own[order], hashed[order]
            first = np.flatnonzero(np.concatenate([[True], hashed[1:] != hashed[:-1]]))
            self.classes.append((n, own[first], np.append(first, len(own)), owner[own]))
        self.order = suffix_order(self.words, self.left)

    def items_of(self, which: int, found: np.ndarray) -> set[int]:
        """Items of classes of one width."""
        _, _, first, items = self.classes[which]
        return set(np.unique(np.concatenate([items[first[c] : first[c + 1]] for c in found.tolist()])).tolist())


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n words from each place on; meaningless where fewer are left."""
    out = np.zeros(len(h), np.uint64)
    found = grams(h, n)
    out[: len(found)] = found
    return out


def suffix_order(h: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Places in the order of the texts' suffixes, by doubling; a suffix that ends comes before those that go on."""
    _, rank = np.unique(h, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    step = 1
    place = np.arange(len(h))
    while len(h):
        behind = np.where(left > step, np.concatenate([rank[step:], np.zeros(min(step, len(h)), np.int64)])[: len(h)], 0)
        order = np.lexsort((behind, rank))
        new = np.concatenate([[0], np.cumsum((np.diff(rank[order]) != 0) | (np.diff(behind[order]) != 0))]) + 1
        rank = np.empty(len(h), np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == len(h) or step >= int(left.max()):
            return order
    return place


def common_words(h: np.ndarray, left: np.ndarray, at: np.ndarray, block: TestBlock, other: np.ndarray, known: np.ndarray) -> np.ndarray:
    """How many words the suffixes at `at` share with the block's suffixes at `other`, of which `known` are sure."""
    length = known.copy()
    going = np.arange(len(at))
    while len(going):
        x, y = at[going] + length[going], other[going] + length[going]
        inside = (length[going] < left[at[going]]) & (length[going] < block.left[other[going]])
        going = going[inside]
        going = going[h[x[inside]] == block.words[y[inside]]]
        length[going] += 1
    return length


def longest_matches(h: np.ndarray, left: np.ndarray, at: np.ndarray, block: TestBlock) -> np.ndarray:
    """The longest match of each place with any suffix of the block: bisection, in which bounds remember what they share."""
    low, high = np.full(len(at), -1), np.full(len(at), len(block.order))
    share_low, share_high = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    while (open_ := high - low > 1).any():
        k = np.flatnonzero(open_)
        middle = (low[k] + high[k]) // 2
        other = block.order[middle]
        length = common_words(h, left, at[k], block, other, np.minimum(share_low[k], share_high[k]))
        ends = length >= left[at[k]]  # the place's text ends first: it comes before
        goes_on = ~ends & (length < block.left[other])
        x, y = np.where(goes_on, at[k] + length, 0), np.where(goes_on, other + length, 0)
        behind = ~ends & (~goes_on | (h[x] > block.words[y]))
        low[k], high[k] = np.where(behind, middle, low[k]), np.where(behind, high[k], middle)
        share_low[k], share_high[k] = np.where(behind, length, share_low[k]), np.where(behind, share_high[k], length)
    return np.maximum(share_low, share_high)


def columns(h: np.ndarray, at: np.ndarray, left: np.ndarray, depth: int, fill: int = 0) -> np.ndarray:
    """The first `depth` words of suffixes as rows of bytes that sort by words; `fill` past their end."""
    place = at[:, None] + np.arange(depth)
    inside = np.arange(depth) < left[:, None]
    table = np.where(inside, h[np.where(inside, place, 0)], np.uint64(fill))
    return np.ascontiguousarray(table.astype(">u8")).view(f"S{8 * depth}").ravel() if len(at) else np.zeros(0, f"S{8 * depth}")


def find(h: np.ndarray, first: np.ndarray, block: TestBlock) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the width, places, classes): every occurrence of a window of the block in the shard."""
    out = []
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(h))
    for which, (width, reps, _, _) in enumerate(block.classes):
        head = min(HEAD, width)
        if len(h) < width:
            continue
        known = np.unique(window_hashes(block.words, head)[reps])
        g = grams(h, head)
        seen = np.zeros(1 << 20, bool)
        seen[(known & np.uint64(0xFFFFF)).astype(np.int64)] = True
        at = np.flatnonzero(seen[(g & np.uint64(0xFFFFF)).astype(np.int64)])
        at = at[(left[at] >= width)]
        at = at[np.isin(g[at], known)]
        if not len(at):
            continue
        rows = columns(h, at, np.full(len(at), width), width)
        order = np.argsort(rows, kind="stable")
        array, rows = at[order], rows[order]
        # All suffixes of the shard that begin with the window lie between two bounds.
        asked = columns(block.words, reps, np.full(len(reps), width), width)
        low, high = np.searchsorted(rows, asked, "left"), np.searchsorted(rows, asked, "right")
        many = high - low
        if many.any():
            found = np.repeat(np.arange(len(reps)), many)
            out.append((which, array[np.repeat(low, many) + np.arange(len(found)) - np.repeat(np.cumsum(many) - many, many)], found))
    return out


def _merged(old: list[dict], at: np.ndarray, width: np.ndarray, longest: np.ndarray) -> list[dict]:
    """Passages of hit words, in order: overlapping windows are one."""
    rows = [(s["first_word"], s["first_word"] + s["n_words"], s["longest_match"]) for s in old]
    rows = sorted([*rows, *zip(at.tolist(), (at + width).tolist(), longest.tolist(), strict=True)])
    out: list[list[int]] = []
    for begin, end, most in rows:
        if out and begin <= out[-1][1]:
            out[-1][1], out[-1][2] = max(out[-1][1], end), max(out[-1][2], most)
        else:
            out.append([begin, end, most])
    return [{"first_word": a, "n_words": b - a, "longest_match": m} for a, b, m in out]


def _search(block, last: bool):
    """Search a block; with the last one count the words too."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = block.value
        for batch in blocks(batches, "text"):
            words = item_words(encoded(batch.column("text")))
            hits = batch.column("hits").to_pylist()
            h = words.hashes()
            left = np.repeat(words.first[1:], words.counts) - np.arange(len(h))
            found = find(h, words.first, held)
            if found:
                place = np.concatenate([p for _, p, _ in found])
                width = np.concatenate([np.full(len(p), held.classes[w][0]) for w, p, _ in found])
                kind = np.concatenate([np.full(len(p), w) for w, p, _ in found])
                which = np.concatenate([c for _, _, c in found])
                places, back = np.unique(place, return_inverse=True)
                longest = longest_matches(h, left, places, held)[back]
                owner = np.searchsorted(words.first, place, "right") - 1
                order = np.argsort(owner, kind="stable")
                cuts = np.flatnonzero(np.diff(owner[order], prepend=-1))
                for own in np.split(order, cuts[1:]):
                    i = int(owner[own[0]])
                    old = hits[i] or {"spans": [], "items": []}
                    items = set().union(*(held.items_of(w, np.unique(which[own][kind[own] == w])) for w in np.unique(kind[own]).tolist()))
                    names = {held.names[k] for k in items} - {None}
                    hits[i] = {"spans": _merged(old["spans"], place[own] - words.first[i], width[own], longest[own]), "items": sorted({*old["items"], *names})}
            kept = [batch.column("row"), batch.column("text")]
            hits = pa.array(hits, batch.schema.field("hits").type)
            if last:
                yield pa.RecordBatch.from_arrays([*kept, hits, pa.array(words.counts)], names=["row", "text", "hits", "n_words"])
            else:
                yield pa.RecordBatch.from_arrays([*kept, hits], names=["row", "text", "hits"])

    return search


def _block_table(items: DataFrame, id_col: str, text_col: str, block_words: int) -> tuple[DataFrame, int]:
    """(items with the number of their block, number of blocks), in the shared folder. An item is never cut."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = items.select(F.col(id_col).cast("string").alias("item"), text.alias("text")).where(F.length("text") > 0)
    size = source.agg(F.sum(F.floor(F.octet_length("text") / 2) + 1).alias("n")).first()["n"] or 0
    count = max(1, -(-size // block_words))
    return written(source.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count))), "test-blocks"), count


def leaked(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs` with n_words, n_hit, n_items, spans, items, longest_match and contaminated.

    `spans` are the passages of hit words (first_word, n_words, longest_match: words that one item has on end from some place of
    the passage on), `items` the ids of the items with windows in the text, sorted.

    Null texts have no words; a test item without words matches nothing; one of fewer words than a window is a window
    by itself. Items that repeat an id count once; an item without an id hits words but isn't listed. Repeated rows
    are judged each by itself; an empty table on either side gives no hits. Texts are searched whole, whatever their length. Other
    columns pass through, whatever their names (those that are added are replaced).
    """
    added = ("n_words", "n_hit", "n_items", "spans", "items", "longest_match", "contaminated")
    rest = [c for c in docs.columns if c != text_col and c not in added]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]) if rest else F.struct(F.lit(0).alias("c0"))
    frame = docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"), F.lit(None).cast(_HITS).alias("hits"))
    kind = frame.schema["row"].dataType.simpleString()
    table, count = _block_table(items, item_id, item_text, block_words)
    for number in range(count):
        found = table.where(F.col("block") == number).select("item", "text").collect()  # bounded by block_words
        sent = docs.sparkSession.sparkContext.broadcast(TestBlock([r.item for r in found], [r.text.encode() for r in found], window))
        if number < count - 1:
            frame = written(frame.mapInArrow(_search(sent, False), f"row {kind}, text string, hits {_HITS}"), "searched")
            sent.unpersist()
        else:
            frame = frame.mapInArrow(_search(sent, True), f"row {kind}, text string, hits {_HITS}, n_words long")
    placed = {c: F.col(f"row.c{i}").alias(c) for i, c in enumerate(rest)} | {text_col: F.col("text").alias(text_col)}
    spans, names = F.coalesce("hits.spans", F.array().cast("array<struct<first_word:int,n_words:int,longest_match:int>>")), F.coalesce("hits.items", F.array().cast("array<string>"))
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["n_words"])
    longest = F.coalesce(F.array_max(F.transform(spans, lambda s: s["longest_match"])), F.lit(0)).cast("long")
    facts = ["n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"), spans.alias("spans"), names.alias("items"), longest.alias("longest_match"), (F.size(spans) > 0).alias("contaminated")]
    return frame.select(*[placed[c] for c in docs.columns if c in placed], *facts)


def decontaminated(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """The rows of `docs` without a verbatim window of a test item."""
    return leaked(docs, items, **settings).where("not contaminated").select(*[F.col(f"`{c}`") for c in docs.columns])
