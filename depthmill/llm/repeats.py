"""Substring de-duplication: passages of `width` words that occur more than once, by prefix-partitioned suffix trees.

1. Anchors. Every window of `width` words has an anchor, the least k-gram inside it by a hash order. Equal windows have
   equal anchors at equal places, so only suffixes that start at an anchor need to be grouped (about one word in 14).
   Consecutive windows with one anchor form a run.
2. Prefixes. Suffixes are dealt by their first `GRAM` words. A prefix that occurs once cannot begin a repeat and is
   dropped. Runs that agree in all their words are collapsed into one with a count, before anything is gathered.
3. Groups that would outgrow a task take longer prefixes: the whole window, where a group is a single counted row.
   All others are short enough for a task.
4. Trees. A task sorts the suffixes of its groups and takes the common prefix of neighbours; the intervals of that
   array are the internal nodes of the suffix tree. A node at least `width` words deep is a repeat of its leaves.

Words are compared by 64-bit hashes. Words, runs and windows are judged on the input, not on what is left.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthmill.llm.texts import Words, blocks, covered, encoded, fits, grams, mix
from depthmill.session import written

WIDTH = 35
#: Words of the shortest prefix.
GRAM = 8
#: Different runs with one prefix that a task takes; prefixes with more are lengthened.
GROUP_ROWS = 20_000

_RUN = "key long, g long, s long, a int, lo int, hi int"


def anchors(h: np.ndarray, first: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, anchor of each, hashes of the k-grams) of texts given by their word hashes."""
    g = grams(h, gram)
    starts = np.flatnonzero(fits(first, len(h), width))
    if not len(starts):
        return starts, starts, g
    # Sliding minimum by doubling; of equal grams the leftmost stays, wherever the text stands.
    order, at = mix(g), np.arange(len(g))
    span, step = width - gram + 1, 1
    while step < span:
        shift = min(step, span - step)
        later = order[shift:] < order[:-shift]
        order, at = np.where(later, order[shift:], order[:-shift]), np.where(later, at[shift:], at[:-shift])
        step += shift
    return starts, at[starts], g


def runs(words: Words, width: int, gram: int) -> dict[str, np.ndarray]:
    """Runs of windows that share an anchor: owner, anchor, first and last window, hash of the prefix and of the whole run."""
    h = words.hashes()
    starts, at, g = anchors(h, words.first, width, gram)
    if not len(starts):
        return {k: starts for k in ("owner", "a", "s1", "s2")} | {"g": g[:0], "s": g[:0], "h": h}
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    s1, s2, a = starts[new], starts[np.append(new[1:], len(starts)) - 1], at[new]
    # A run's hash: its first window, its last window and its length cover all its words.
    w = grams(h, width)
    s = mix(w[s1] ^ mix(w[s2] + (s2 - s1).astype(np.uint64)))
    return {"owner": np.searchsorted(words.first, a, "right") - 1, "a": a, "s1": s1, "s2": s2, "g": g[a], "s": s, "h": h}


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _scan(width: int, gram: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            words = Words(encoded(batch.column("text")))
            r = runs(words, width, gram)
            begin = words.first[r["owner"]]
            arrays = [batch.column("key").take(pa.array(r["owner"])), _signed(r["g"]), _signed(r["s"])]
            arrays += [pa.array((x).astype(np.int32)) for x in (r["a"] - begin, r["a"] - r["s2"], r["a"] - r["s1"])]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "g", "s", "a", "lo", "hi"])

    return scan


def _places(words: Words, h: np.ndarray, lists: pa.Array, gram: int) -> tuple[pa.Array, np.ndarray]:
    """Entries of a list column (structs with g and a) and the word each anchor stands at.

    An entry of another text with the same key (a hash) is left out: its prefix isn't found there.
    """
    flat = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
    if not len(flat):
        return flat, np.zeros(0, np.int64)
    at = words.first[owner] + _longs(flat, "a")
    g = grams(h, gram)
    inside = at + gram <= words.first[owner + 1]
    inside &= g[np.where(inside, at, 0)] == _longs(flat, "g").view(np.uint64) if len(g) else False
    return flat.filter(pa.array(inside)), at[inside]


def _longs(structs: pa.Array, name: str) -> np.ndarray:
    return structs.field(name).to_numpy(zero_copy_only=False).astype(np.int64)


_SUFFIX = "prefix long, g long, s long, n long, lo int, hi int, words binary"


def _fetch(width: int, gram: int):
    """Suffixes of the wanted runs: the words of a run under its short prefix, or each window as a long prefix."""

    def rows(prefix: np.ndarray, flat: pa.Array, index: np.ndarray, lo: np.ndarray, hi: np.ndarray, blobs: pa.Array) -> pa.RecordBatch:
        take = pa.array(index)
        arrays = [pa.array(prefix), *(flat.field(k).take(take) for k in ("g", "s", "n")), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), blobs]
        return pa.RecordBatch.from_arrays(arrays, names=["prefix", "g", "s", "n", "lo", "hi", "words"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in blocks(batches, "text"):
            keys = batch.column("key").to_pylist()
            new = [k != before for k, before in zip(keys, [last, *keys], strict=False)]  # copies of one text stand together
            last = keys[-1]
            batch = batch.filter(pa.array(new))
            words = Words(encoded(batch.column("text")))
            h = words.hashes()
            flat, at = _places(words, h, batch.column("wanted"), gram)
            if not len(flat):
                continue
            lo, hi, long = _longs(flat, "lo"), _longs(flat, "hi"), _longs(flat, "long") == 1
            short = np.flatnonzero(~long)
            blobs = pa.array([h[at[i] - hi[i] : at[i] - lo[i] + width].tobytes() for i in short], pa.binary())
            yield rows(_longs(flat, "g")[short], flat, short, lo[short], hi[short], blobs)
            index = np.flatnonzero(long)
            if len(index):
                each = hi[index] - lo[index] + 1
                spread = np.repeat(index, each)
                d = lo[spread] + np.arange(len(spread)) - np.repeat(np.cumsum(each) - each, each)
                yield rows(grams(h, width)[at[spread] - d].view(np.int64), flat, spread, d, d, pa.nulls(len(spread), pa.binary()))

    return fetch


def suffix_array(h: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes by their first `depth` words or more, and the common prefix of neighbours (up to that depth).

    Ranks of 1, 2, 4, ... words, each from pairs of the last; a text is its own alphabet of ranks.
    """
    rank = np.unique(h, return_inverse=True)[1].astype(np.int64)
    levels, width = [rank], 1
    while width < depth:
        pair = levels[-1] * (len(h) + 1)
        pair[:-width] += levels[-1][width:] + 1
        levels.append(np.unique(pair, return_inverse=True)[1].astype(np.int64))
        width *= 2
    order = np.argsort(levels[-1], kind="stable")
    one, two = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(one), np.int64)
    size = len(h)
    for level in range(len(levels) - 1, -1, -1):
        inside = (one + common < size) & (two + common < size)
        x, y = np.where(inside, one + common, 0), np.where(inside, two + common, 0)
        same = inside & (levels[level][x] == levels[level][y])
        common += np.where(same, 1 << level, 0)
    return order, common


def deep_nodes(h: np.ndarray, width: int) -> np.ndarray:
    """Flags of the suffixes below an internal node at least `width` words deep."""
    order, common = suffix_array(h, width)
    inside = common >= width
    found = np.zeros(len(h), bool)
    found[order[:-1][inside]] = True
    found[order[1:][inside]] = True
    return found


#: Words of the runs that share a tree.
TREE_WORDS = 1 << 20


def masks_of(group: pd.DataFrame, width: int) -> pd.DataFrame:
    """(g, s, mask): the repeated windows of the runs of whole prefix groups."""
    group = group.drop_duplicates(["g", "s"])
    lengths = group["words"].str.len().to_numpy(np.int64) // 8
    lo, hi, n = (group[k].to_numpy(np.int64) for k in ("lo", "hi", "n"))
    # A mark of its own ends each run, so that no suffix runs on into the next one.
    ends = np.cumsum(lengths + 1)
    text = np.empty(ends[-1], np.uint64)
    closing = np.zeros(len(text), bool)
    closing[ends - 1] = True
    text[~closing] = np.frombuffer(b"".join(group["words"]), np.uint64)
    text[closing] = mix(np.arange(len(ends), dtype=np.uint64) + (np.uint64(1) << np.uint64(40)))
    found = deep_nodes(text, width)
    begin = ends - 1 - lengths
    mask = np.zeros(len(group), np.int64)
    for d in range(int(lo.min()), int(hi.max()) + 1):
        inside = (lo <= d) & (d <= hi)
        at = np.where(inside, begin + hi - d, 0)
        mask |= np.where(inside & (found[at] | (n > 1)), np.int64(1) << d, 0)
    return pd.DataFrame({"g": group["g"], "s": group["s"], "mask": mask})


def _subtrees(width: int):
    """Trees over rows that come sorted by prefix; a tree holds whole prefixes, and several small ones."""

    def trees(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for frame in frames:
            held.append(frame)
            size += int(frame["words"].str.len().sum()) // 8
            if size < TREE_WORDS:
                continue
            rows = pd.concat(held, ignore_index=True)
            whole = rows["prefix"] != rows["prefix"].iloc[-1]
            if whole.any():
                yield masks_of(rows[whole], width)
            held = [rows[~whole]]
            size = int(held[0]["words"].str.len().sum()) // 8
        if held and sum(map(len, held)):
            yield masks_of(pd.concat(held, ignore_index=True), width)

    return trees


def removed_words(words: Words, h: np.ndarray, marks: pa.Array, width: int, gram: int) -> np.ndarray:
    """Flags of the words that a repeated window covers."""
    flat, at = _places(words, h, marks, gram)
    begin = np.zeros(len(h), bool)
    if len(flat):
        mask = _longs(flat, "mask")
        for d in range(width - gram + 1):
            begin[at[(mask >> d & 1) == 1] - d] = True
    return covered(begin, width, len(h))


def _rest(width: int, gram: int):
    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            texts = encoded(batch.column("text"))
            words = Words(texts)
            marks = batch.column("marks")
            gone = removed_words(words, words.hashes() if marks.null_count < len(marks) else np.zeros(len(words.starts), np.uint64), marks, width, gram)
            total = np.concatenate([[0], np.cumsum(gone)])
            removed = total[words.first[1:]] - total[words.first[:-1]]
            out, digests = [], []
            for i, text in enumerate(texts):
                own = gone[words.first[i] : words.first[i + 1]]
                kept = text.split()
                if removed[i]:
                    kept = [w for w, lost in zip(kept, own.tolist(), strict=True) if not lost]
                    # Stretches of kept words keep the white space between them; a line feed stands for a cut.
                    edge = np.diff(np.concatenate([[True], own, [True]]).astype(np.int8))
                    begins, ends = np.flatnonzero(edge == -1) + words.first[i], np.flatnonzero(edge == 1) - 1 + words.first[i]
                    text = b"\n".join(words.joined[a:b] for a, b in zip(words.starts[begins].tolist(), words.ends[ends].tolist(), strict=True))
                out.append(text)
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            cut = pa.array(out, pa.binary()).cast(pa.string())
            arrays = [batch.column("row"), pc.if_else(batch.column("text").is_null(), pa.scalar(None, pa.string()), cut)]
            arrays += [pa.array(words.counts), pa.array(removed), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["row", "text", "n_words", "n_removed", "kept_sha256"])

    return rest


def repeated_windows(keyed: DataFrame, width: int = WIDTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(key, marks): for each text that has any, its anchors with a mask of the repeated windows (bit d: the window that starts d words before)."""
    if not 0 < gram <= width or width - gram > 61:
        raise ValueError("a window's mask has 62 bits, and a prefix is no longer than a window")
    found = written(keyed.mapInArrow(_scan(width, gram), _RUN), "runs")
    # Written, so that the join below has a plain shuffle on both sides and a hot prefix can be split.
    twice = written(found.groupBy("g").agg(F.count("*").alias("all")).where("all > 1").select("g"), "common-prefixes")
    again = written(found.join(twice, "g", "left_semi"), "repeated-prefixes")
    same = again.groupBy("g", "s").agg(F.count("*").alias("n"), F.min(F.struct("key", "a", "lo", "hi")).alias("at"))
    same = written(same, "distinct-runs")
    kinds = written(same.groupBy("g").agg(F.count("*").alias("kinds")), "prefix-kinds")
    every = F.expr("shiftleft(1L, at.hi + 1) - shiftleft(1L, at.lo)")
    sized = same.join(kinds, "g")
    alone = sized.where("kinds = 1").select("g", "s", every.alias("mask"))
    asked = sized.where("kinds > 1").select("at.key", F.struct("g", "s", "n", "at.a", "at.lo", "at.hi", (F.col("kinds") > group_rows).alias("long")).alias("one"))
    wanted = asked.groupBy("key").agg(F.collect_list("one").alias("wanted"))
    texts = keyed.join(wanted, "key").select("key", "text", "wanted")
    suffixes = written(texts.mapInArrow(_fetch(width, gram), _SUFFIX), "suffixes")
    # Short prefixes: subtrees. Those that share a tree don't disturb each other: equal windows have equal prefixes.
    dealt = suffixes.where("words is not null").repartition("prefix").sortWithinPartitions("prefix")
    trees = dealt.mapInPandas(_subtrees(width), "g long, s long, mask long")
    # Whole windows as prefixes: a node with two leaves or more is a count.
    leaves = suffixes.where("words is null").groupBy("prefix", "g", "s", "lo").agg(F.max("n").alias("n"))
    nodes = leaves.groupBy("prefix", "g").agg(F.sum("n").alias("n")).where("n > 1").select("prefix", "g")
    long = leaves.join(nodes, ["prefix", "g"], "left_semi").groupBy("g", "s").agg(F.expr("bit_or(shiftleft(1L, lo))").alias("mask"))
    masks = alone.unionByName(trees).unionByName(long).where("mask <> 0")
    marks = again.select("key", "a", "g", "s").distinct().join(masks, ["g", "s"]).select("key", F.struct("a", "g", "mask").alias("one"))
    return marks.groupBy("key").agg(F.collect_list("one").alias("marks"))


def without_repeats(docs: DataFrame, text_col: str = "text", width: int = WIDTH, gram: int = GRAM, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The rows of `docs` with repeated passages cut from the text, and n_words, n_removed, kept_sha256.

    Rows of equal text are occurrences of each other. A null text has no words and stays null; an empty one stays empty;
    texts shorter than a window are left alone. Nothing is removed from a text without repeats, not even white space.
    Every other column passes through, whatever its name (but for the three that are added, which are replaced).
    """
    rest = [c for c in docs.columns if c not in (text_col, "n_words", "n_removed", "kept_sha256")]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]) if rest else F.struct(F.lit(0).alias("c0"))
    source = docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    source = source.withColumn("key", F.xxhash64("text"))
    marks = repeated_windows(source.select("key", "text"), width, gram, group_rows)
    joined = source.join(marks, "key", "left").select("row", "text", "marks")
    kind = source.schema["row"].dataType.simpleString()
    out = joined.mapInArrow(_rest(width, gram), f"row {kind}, text string, n_words long, n_removed long, kept_sha256 string")
    back = [F.col(f"row.c{i}").alias(c) for i, c in enumerate(rest)]
    placed = {c: x for c, x in zip(rest, back, strict=True)} | {text_col: F.col("text").alias(text_col)}
    return out.select(*[placed[c] for c in docs.columns if c in placed], "n_words", "n_removed", "kept_sha256")
