"""Near copies by SimHash fingerprints: exact search in vantage-point trees, sharded by an upper tree.

Fingerprints that differ in `radius` bits at most are linked. Equal fingerprints are collapsed first, so only distinct
ones are searched. An upper vantage-point tree, fitted on a bounded sample, cuts the space into shards: every
fingerprint belongs to one shard and is also asked in every other shard that its ball reaches (triangle bounds), so no
link is lost at a border. Each shard is searched by a tree of its own; what it finds is reduced to one link per
fingerprint (to the smallest of its local component), never all pairs. Links are then joined across shards.

A ball of Hamming radius 4 holds 679,121 fingerprints of 64 bits at most, which bounds a shard that cannot be cut.
"""

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depthmill.llm.components import components
from depthmill.llm.texts import Words, blocks, encoded
from depthmill.session import written

SEED = 42
RADIUS = 2
#: Distinct fingerprints a shard should own.
SHARD_ROWS = 8192
#: Distinct fingerprints the upper tree is fitted on; every fingerprint is indexed.
SAMPLE_ROWS = 32_768
#: Below so many comparisons a tree node is searched directly.
DIRECT = 1 << 18
PAIRS_HELD = 1 << 21


def simhash(texts: list[bytes], size: int = 3) -> np.ndarray:
    """64-bit fingerprints: a bit is 1 if set in over half the shingle hashes. No words: zero."""
    words = Words([t.lower() for t in texts])
    out = np.zeros(len(texts), np.uint64)
    hashes, lengths, kept = [], [], []
    digest = xxhash.xxh64_intdigest
    plain = [b" ".join(words.joined[a:b].split()) for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True)]
    for i, text in enumerate(plain):
        n = int(words.counts[i])
        if not n:
            continue
        if n <= size:
            found = [digest(text, SEED)]
        else:
            own = slice(words.first[i], words.first[i + 1])
            steps = np.cumsum(words.ends[own] - words.starts[own] + 1)
            ends = (steps[size - 1 :] - 1).tolist()
            begins = [0, *steps[: n - size].tolist()]
            found = [digest(text[a:b], SEED) for a, b in zip(begins, ends, strict=True)]
        hashes += found
        lengths.append(len(found))
        kept.append(i)
    if kept:
        out[kept] = majority(np.array(hashes, np.uint64), np.array(lengths))
    return out


def majority(hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bitwise majority of consecutive runs of hashes. Eight counters share a word; a run is summed in parts of up to 255."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    parts = (lengths + 254) // 255
    run = np.repeat(np.arange(len(lengths)), parts)
    within = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
    cuts = starts[run] + 255 * within
    out = np.zeros(len(lengths), np.uint64)
    lanes = np.uint64(0x0101010101010101)
    run_starts = np.cumsum(parts) - parts
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, cuts)
        each = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), run_starts, axis=0)
        high = each * 2 > lengths[:, None]
        for lane in range(8):
            out |= high[:, lane].astype(np.uint64) << np.uint64(8 * lane + bit)
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text"):
        prints = simhash(encoded(batch.column("text"))).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("own"), pa.array(prints)], names=["id", "own", "fp"])


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, own, text): `own` tells the texts of rows that repeat an id apart."""
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("own"), text.alias("text"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, own, fp): the fingerprint of every row, as a signed long. A null text has no words."""
    return keyed_texts(docs, id_col, text_col).mapInArrow(_fingerprint_batches, "id long, own long, fp long")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def fit_tree(sample: np.ndarray, leaves: int) -> list[tuple[int, int, int, int]]:
    """Upper tree as (vantage point, bound, near child, far child) per node; a child below zero is leaf -child - 1.

    The near child holds distances up to the bound. Without a node the only leaf is 0.
    """
    nodes: list[tuple[int, int, int, int]] = []
    made = [0]

    def leaf() -> int:
        made[0] += 1
        return -made[0]

    def grow(points: np.ndarray, parts: int) -> int:
        if parts < 2 or len(points) < 8:
            return leaf()
        vantage = points[int(mixed(points).argmin())]
        away = distance(points, vantage)
        bound = int(np.median(away))
        near = away <= bound
        if near.all() or not near.any():
            bound -= 1
            near = away <= bound
        if near.all() or not near.any():
            return leaf()
        at = len(nodes)
        nodes.append((0, 0, 0, 0))
        one = grow(points[near], parts // 2)
        two = grow(points[~near], parts - parts // 2)
        nodes[at] = (int(vantage), bound, one, two)
        return at

    grow(np.unique(sample), leaves)
    return nodes


def mixed(points: np.ndarray) -> np.ndarray:
    """A fixed pseudo-random order of fingerprints."""
    return (points ^ (points >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)


def route(points: np.ndarray, nodes: list[tuple[int, int, int, int]], radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, indexes of points whose ball reaches it, flags of those it owns)."""
    todo = [(0 if nodes else -1, np.arange(len(points)), np.ones(len(points), bool))]
    while todo:
        at, index, own = todo.pop()
        if not len(index):
            continue
        if at < 0:
            yield -at - 1, index, own
            continue
        vantage, bound, near, far = nodes[at]
        away = distance(points[index], np.uint64(vantage)).astype(np.int64)
        reach = away - radius <= bound
        todo.append((near, index[reach], own[reach] & (away[reach] <= bound)))
        reach = away + radius > bound
        todo.append((far, index[reach], own[reach] & (away[reach] > bound)))


def local_components(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of `size` nodes over the links a-b."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new


def search(points: np.ndarray, own: np.ndarray, radius: int) -> np.ndarray:
    """Smallest index linked to each point, through pairs of which one at least is owned.

    A vantage-point tree over the owned points, walked by all points together: a query follows a branch only if the
    triangle inequality allows a partner there.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []
    label = np.arange(len(points))
    count = 0

    def fold() -> None:
        nonlocal label, held, count
        a = np.concatenate([np.arange(len(points)), *(x for x, _ in held)])
        b = np.concatenate([label, *(y for _, y in held)])
        label, held, count = local_components(len(points), a, b), [], 0

    todo = [(np.flatnonzero(own), np.arange(len(points)))]
    while todo:
        base, ask = todo.pop()
        if not len(base) or not len(ask):
            continue
        split = None
        if len(base) > 48 and len(base) * len(ask) > DIRECT:
            values = points[base]
            vantage = values[int(mixed(values).argmax())]
            away, far = distance(values, vantage).astype(np.int64), distance(points[ask], vantage).astype(np.int64)
            bound = int(np.median(away))
            if not (away <= bound).all():
                split = bound
            elif (away < bound).any():
                split = bound - 1
        if split is not None:
            near, reach_near, reach_far = away <= split, far - radius <= split, far + radius > split
            todo.append((base[near], ask[reach_near]))
            todo.append((base[~near], ask[reach_far]))
            continue
        step = max(1, (4 * DIRECT) // len(base))
        for k in range(0, len(ask), step):
            part = ask[k : k + step]
            i, j = np.nonzero(distance(points[part][:, None], points[base][None, :]) <= radius)
            if len(i):
                held.append((part[i], base[j]))
                count += len(i)
                if count > PAIRS_HELD:
                    fold()
    fold()
    return label


def links(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp), as spanning stars of each shard's components."""
    total = distinct.count()
    leaves = min(max(1, -(-total // shard_rows)), sample_rows // 8)
    nodes: list[tuple[int, int, int, int]] = []
    if leaves > 1:
        # A uniform pseudo-random sample of bounded size: every fingerprint below a hash bound.
        spread = F.xxhash64("fp")
        bound = int(min(1.0, 0.9 * sample_rows / total) * 2.0**64) - 2**63
        rows = distinct.where(spread < F.lit(min(bound, 2**63 - 1))).limit(sample_rows).toPandas()["fp"].to_numpy(np.int64)
        nodes = fit_tree(rows.view(np.uint64), leaves)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for leaf, index, own in route(values, nodes, radius):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(index), leaf, np.int32)), pa.array(values[index].view(np.int64)), pa.array(own)], names=["leaf", "fp", "own"])

    def find(group: pd.DataFrame) -> pd.DataFrame:
        values = group["fp"].to_numpy(np.int64).view(np.uint64)
        label = search(values, group["own"].to_numpy(bool), radius)
        linked = label != np.arange(len(values))
        return pd.DataFrame({"a": values[linked].view(np.int64), "b": values[label[linked]].view(np.int64)})

    return distinct.mapInArrow(assign, "leaf int, fp long, own boolean").groupBy("leaf").applyInPandas(find, "a long, b long")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """(id, own, fp, component): each row's fingerprint and the smallest id that links reach; `own` is a hash of its text.

    Null text: no words, fingerprint zero, linked like any other. Null ids never are the smallest unless nothing else
    is there (then null). Repeated rows stay. An empty table gives an empty result. Other columns are ignored.
    """
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    return named(prints, distinct, components(links(distinct.select("fp"), radius)))


def named(prints: DataFrame, distinct: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, own, fp, component) from (id, own, fp), (fp, least id) and the roots of linked fingerprints."""
    known = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    known = written(known.join(least, "root").select("fp", "component"), "fingerprint-components")
    return prints.join(known, "fp", "left").select("id", "own", "fp", "component")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of `docs` for each component: see `first_of`."""
    return first_of(docs, near_copies(docs, id_col, text_col, radius), id_col, text_col)


def first_of(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of every component in `found` the row of `docs` with the smallest id, and all rows without an id.

    Rows are told apart by id and text: of rows that repeat an id, each one's own component decides. Of a component's rows
    with its smallest id the one whose text hashes lowest stays, of equal texts the one whose other columns do.
    """
    first = found.where(F.col("id") == F.col("component")).groupBy("id").agg(F.min("own").alias("own"))
    name = {c: f"_{uuid.uuid4().hex}" for c in ("row", "id", "own", "order")}  # no column of `docs` has such a name
    text = F.xxhash64(F.col(f"`{text_col}`").cast("string"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name["row"]), F.col(f"`{id_col}`").cast("long").alias(name["id"]), text.alias(name["own"]))
    kept = rows.join(first, (rows[name["id"]] == first["id"]) & (rows[name["own"]] == first["own"]), "left_semi")
    hashed = [F.col(name["row"])[f.name] for f in docs.schema if not re.search("map|variant", f.dataType.simpleString())]
    place = F.row_number().over(Window.partitionBy(name["id"], name["own"]).orderBy(F.xxhash64(*hashed)))
    kept = kept.withColumn(name["order"], place).where(F.col(name["order"]) == 1).select(name["row"])
    nameless = rows.where(F.col(name["id"]).isNull()).select(name["row"])
    every = kept.unionByName(nameless)
    return every.select(*[F.col(name["row"])[c].alias(c) for c in docs.columns])


def hexadecimal(fp: str = "fp"):
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
