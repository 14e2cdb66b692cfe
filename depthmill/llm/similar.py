"""Near copies by Jaccard similarity of word shingles: fingerprints and MinHash bands find candidates, exact sets decide.

Two texts are linked if their sets of hashed shingles reach the similarity. Texts with equal sets are collapsed first.
SimHash fingerprints of the sets within `radius` bits, searched in `fingerprints`' vantage-point trees, are candidates: a
star for each local component. The trees prune at a small radius only, and a pair at 0.8 differs in some 10 bits of 64, so
bands find the rest: texts that share a band's bucket. A bucket's members are held against its smallest. What stars link
is settled with one pair a member. Where that leaves more than one component in a bucket, every pair across
components is compared, in tiles of bounded size, so no group makes rows for all its pairs in one task.

A pair of similarity s shares none of `BANDS` bands of `ROWS` hashes with probability (1 - s^ROWS)^BANDS: 5e-5 at 0.8.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthmill.llm.components import components
from depthmill.llm.fingerprints import RADIUS, first_of, keyed_texts, links, local_components, majority, named
from depthmill.llm.texts import Words, blocks, encoded, grams, mix
from depthmill.session import written

SIZE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
#: Texts and shingles of a tile.
TILE_TEXTS, TILE_SHINGLES = 128, 500_000

_rng = np.random.default_rng(1_618)
_FLIPS = _rng.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)
_FACTORS = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text, in lower case. Up to `size` words are one shingle; no words, none."""
    words = Words([t.lower() for t in texts])
    h = words.hashes()
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        own = h[a:b]
        out.append(np.unique(grams(own, min(size, b - a)) if b > a else own))
    return out


def set_hash(found: np.ndarray) -> int:
    """A hash of a set of shingles; zero for none."""
    return int(mix(np.array([mix(found).sum(dtype=np.uint64) + np.uint64(len(found))]))[0]) if len(found) else 0


def simhashes(sets: list[np.ndarray]) -> np.ndarray:
    """64-bit fingerprints: a bit is 1 if set in over half a set's hashes. An empty set: zero."""
    out, kept = np.zeros(len(sets), np.uint64), [i for i, found in enumerate(sets) if len(found)]
    if kept:
        out[kept] = majority(np.concatenate([sets[i] for i in kept]), np.array([len(sets[i]) for i in kept]))
    return out


def bands(found: np.ndarray) -> np.ndarray:
    """A bucket key for every band."""
    low = np.array([((found ^ flip) * factor).min() for flip, factor in zip(_FLIPS, _FACTORS, strict=True)], np.uint64).reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in low.T:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + column)
    return out


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    values = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))


def _prints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            sets = shingles(encoded(batch.column("text")), size)
            fp = np.array([set_hash(s) for s in sets], np.uint64).view(np.int64)
            keys = _lists([bands(s) if len(s) else s for s in sets])
            counts = pa.array([len(s) for s in sets], pa.int64())
            simhash = pa.array(simhashes(sets).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("own"), pa.array(fp), counts, simhash, keys], names=["id", "own", "fp", "n", "simhash", "bands"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, "text"):
            sets = shingles(encoded(batch.column("text")), size)
            fp = np.array([set_hash(s) for s in sets], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(fp), _lists(sets)], names=["fp", "grams"])

    return run


def tile_links(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Smallest index that links reach from each set, of all pairs."""
    sizes = np.array([len(s) for s in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    flag = np.zeros(int(codes.max()) + 1, np.int32)
    one, two = [], []
    for i in range(len(sets) - 1):
        own = codes[starts[i] : starts[i] + sizes[i]]
        flag[own] = 1
        common = np.add.reduceat(flag[codes[starts[i + 1] :]], starts[i + 1 :] - starts[i + 1])
        flag[own] = 0
        hit = np.flatnonzero(common >= similarity * (sizes[i] + sizes[i + 1 :] - common) - 1e-9) + i + 1
        one.append(np.full(len(hit), i))
        two.append(hit)
    return local_components(len(sets), np.concatenate(one), np.concatenate(two))


def _tiles(similarity: float):
    def run(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy()
        lists = table.column("grams").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        values, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        order = np.argsort(fp)
        if len(fp) < 2:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        label = tile_links([values[ends[i] : ends[i + 1]] for i in order], similarity)
        linked = label != np.arange(len(label))
        return pa.table({"a": fp[order][linked], "b": fp[order][label[linked]]})

    return run


def tree_pairs(distinct: DataFrame, radius: int) -> DataFrame:
    """(lead, fp): candidates among sets of shingles by their fingerprints (fp, n, simhash), a star for each group that the trees link.

    Sets with equal fingerprints hang on the smallest of them, the smallest of each fingerprint on that of the one it is linked to.
    """
    marked = distinct.where("n > 0").select("fp", "simhash")
    leads = written(marked.groupBy("simhash").agg(F.min("fp").alias("lead")), "simhash-leads")
    near = links(leads.select(F.col("simhash").alias("fp")), radius)
    near = near.join(leads.select(F.col("simhash").alias("a"), F.col("lead").alias("fp")), "a").join(leads.select(F.col("simhash").alias("b"), "lead"), "b")
    return written(marked.join(leads, "simhash").where("fp <> lead").select("lead", "fp").union(near.select("lead", "fp")).distinct(), "tree-pairs")


def similar_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, similarity: float = SIMILARITY, tile_texts: int = TILE_TEXTS, radius: int = RADIUS) -> DataFrame:
    """(id, own, fp, component): a hash of each row's text and shingles, and the smallest id that links reach; rows as in `near_copies`."""
    source = keyed_texts(docs, id_col, text_col)
    prints = written(source.mapInArrow(_prints(size), "id long, own long, fp long, n long, simhash long, bands array<long>"), "shingle-prints")
    distinct = written(prints.groupBy("fp").agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("simhash").alias("simhash"), F.first("bands").alias("bands")), "distinct-shingles")
    near = tree_pairs(distinct, radius)
    every = distinct.select("fp", "n", F.explode("bands").alias("key"))
    mark = F.xxhash64("fp").cast("decimal(38,0)")
    buckets = every.groupBy("key").agg(F.min("fp").alias("lead"), F.count("*").alias("texts"), F.sum("n").alias("total"), F.sum(mark).alias("mark")).where("texts > 1")
    # Buckets with the same members are one.
    buckets = written(buckets.groupBy("lead", "texts", "total", "mark").agg(F.min("key").alias("key")), "buckets")
    members = written(every.join(buckets, "key").select("key", "lead", "fp", "n"), "bucket-members")
    asked = written(members.select("fp").union(near.select("fp")).union(near.select("lead")).distinct(), "asked-shingles")
    wanted = asked.join(distinct.select("fp", "least"), "fp").select("least").distinct()
    texts = source.join(wanted, F.col("id").eqNullSafe(F.col("least")), "left_semi").select("text")
    sets = texts.mapInArrow(_sets(size), "fp long, grams array<long>")
    sets = written(sets.join(asked, "fp", "left_semi").groupBy("fp").agg(F.first("grams").alias("grams")), "shingle-sets")

    common = F.size(F.array_intersect("x", "y"))
    pairs = members.where("fp <> lead").select("lead", "fp").union(near).distinct()
    held = pairs.join(sets.select("fp", F.col("grams").alias("y")), "fp").join(sets.select(F.col("fp").alias("lead"), F.col("grams").alias("x")), "lead")
    held = held.select("lead", "fp", common.alias("common"), (F.size("x") + F.size("y")).alias("both"))
    stars = written(held.where(F.col("common") >= similarity * (F.col("both") - F.col("common")) - 1e-9).select(F.col("fp").alias("a"), F.col("lead").alias("b")), "star-links")
    roots = written(components(stars), "star-roots")

    root = members.join(roots, members.fp == roots.node, "left").select("key", "lead", "fp", "n", F.coalesce("root", "fp").alias("root"))
    root = written(root, "member-roots")
    first = F.max(F.when(F.col("fp") == F.col("lead"), F.col("root"))).alias("core")
    several = root.groupBy("key").agg(first, F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key", "core")
    rest = root.join(several, "key").withColumn("inside", F.col("root") == F.col("core"))
    shares = rest.groupBy("key").agg(*[
        F.ceil(F.greatest(F.sum(F.when(side, 1).otherwise(0)) / tile_texts, F.sum(F.when(side, F.col("n")).otherwise(0)) / TILE_SHINGLES)).cast("int").alias(name)
        for name, side in (("inner", F.col("inside")), ("outer", ~F.col("inside")))
    ])
    rest = rest.join(shares, "key")
    # Tiles of the other components come first; tiles of the core aren't compared with each other.
    spread = F.pmod(F.xxhash64("fp"), F.when(F.col("inside"), F.col("inner")).otherwise(F.col("outer"))).cast("int")
    rest = rest.withColumn("tile", spread + F.when(F.col("inside"), F.col("outer")).otherwise(0))
    partners = F.when(F.col("inside"), F.sequence(F.lit(0), F.col("outer") - 1)).otherwise(F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1))
    rest = rest.join(sets, "fp").select("key", "fp", "tile", F.explode(partners).alias("other"), "grams")
    rest = rest.select("key", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "fp", "grams")
    found = written(rest.groupBy("key", "i", "j").applyInArrow(_tiles(similarity), "a long, b long"), "tile-links")
    if not found.isEmpty():
        roots = components(stars.union(found))
    return named(prints.select("id", "own", "fp"), distinct.select("fp", "least"), roots)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, similarity: float = SIMILARITY) -> DataFrame:
    """One row of `docs` for each component: see `first_of`."""
    return first_of(docs, similar_copies(docs, id_col, text_col, size, similarity), id_col, text_col)
