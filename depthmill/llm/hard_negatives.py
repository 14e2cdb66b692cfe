"""Hard negatives by one-bit codes: rows of another label that score close below an anchor's positives.

Vectors are rotated (sign flips and Walsh-Hadamard steps, exactly orthogonal) and kept as one sign bit per dimension,
with two lengths: along the code's direction, and the residual across it. An anchor's rotated vector is quantised to
bit planes, so its product with a code is a few popcounts. By Cauchy-Schwarz the residual moves a score by no more than
its length times the anchor's part across the code: a certain interval, not a likely one. Rows whose interval
can't reach what an anchor still needs are dropped; the others are scored in integers.

Anchors come in blocks of bounded size, a round each; a round scans all rows twice (positives, then negatives), and a task
hands on only its best few per anchor. Nothing else of the table passes through the driver.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthmill.session import written

POSITIVES, NEGATIVES = 5, 10
#: Bounds of 100 x a negative's score, in positive scores.
LEAST, MOST = 30, 90
#: Anchors of a round.
ANCHORS = 4096
#: Bit planes of an anchor.
PLANES = 6
#: Components beyond this aren't scored: sums of products of scaled components stay far within 64 bits.
LARGEST = 65_536.0
#: Pairs of a row and an anchor looked at together, and scored together.
TILE, SCORED = 1 << 19, 1 << 15

_ROW = "uid long, id long, label int, scaled binary, code binary, along double, rest double"
_FOUND = "anchor long, slot int, anchor_id long, positive_id long, positive_score long, id long, uid long, score long"
_NO_ID = np.iinfo(np.int64).max


def rotated(vectors: np.ndarray, seed: int = 11) -> np.ndarray:
    """Rows turned by a fixed rotation; their number of columns is a power of two."""
    out, rng = vectors.astype(np.float64), np.random.default_rng(seed)
    size = out.shape[1]
    for _ in range(3):
        out = out * (1.0 - 2.0 * rng.integers(0, 2, size))
        step = 1
        while step < size:
            pairs = out.reshape(len(out), -1, 2, step)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), size)
            step *= 2
        out /= np.sqrt(size)
    return out


def coded(scaled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes as 64-bit words, length along the code, residual's length) of each row."""
    turned = rotated(scaled)
    along = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    rest = np.sqrt(np.maximum((turned * turned).sum(axis=1) - along * along, 0))
    return np.packbits(turned >= 0, axis=1, bitorder="little").view(np.uint64), along, rest


class Planes:
    """Anchors as bit planes."""

    def __init__(self, scaled: np.ndarray):
        turned = rotated(scaled)
        low, high = turned.min(axis=1), turned.max(axis=1)
        self.low, self.step = low, np.maximum(high - low, 1e-12) / ((1 << PLANES) - 1)
        steps = np.clip(np.rint((turned - low[:, None]) / self.step[:, None]), 0, (1 << PLANES) - 1).astype(np.int64)
        near = low[:, None] + self.step[:, None] * steps
        self.error = np.sqrt(((turned - near) ** 2).sum(axis=1))
        self.total, self.square = near.sum(axis=1), (turned * turned).sum(axis=1)
        self.bits = [np.packbits(steps >> b & 1, axis=1, bitorder="little").view(np.uint64) for b in range(PLANES)]
        self.size = turned.shape[1]

    def interval(self, codes: np.ndarray, along: np.ndarray, rest: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the score of every row (down) with each of the anchors `which` (across)."""
        weighed = np.zeros((len(codes), len(which)), np.int64)
        for b, bits in enumerate(self.bits):
            own = bits[which]
            for w in range(codes.shape[1]):
                weighed += np.bitwise_count(codes[:, w, None] & own[None, :, w]).astype(np.int64) << b
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        product = (2 * (self.low[which] * ones[:, None] + self.step[which] * weighed) - self.total[which]) / np.sqrt(self.size)
        error = self.error[which]
        across = np.sqrt(np.maximum(self.square[which] - np.maximum(np.abs(product) - error, 0) ** 2, 0))
        middle = along[:, None] * product
        # The last terms cover what floating point may lose.
        width = along[:, None] * error + rest[:, None] * across
        width += 1e-9 * (along + rest)[:, None] * np.sqrt(self.square[which]) + 1e-6
        return middle - width, middle + width


def scored(rows: np.ndarray, anchors: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer products of rows i with anchors j."""
    out = np.zeros(len(i), np.int64)
    for k in range(0, len(i), SCORED):
        out[k : k + SCORED] = np.einsum("ij,ij->i", rows[i[k : k + SCORED]], anchors[j[k : k + SCORED]])
    return out


class Best:
    """The best `size` of (score, id, uid) for each of `slots`: higher scores first, then smaller ids; no id comes last."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.score = np.full((slots, size), np.iinfo(np.int64).min)
        self.id, self.uid = (np.full((slots, size), _NO_ID) for _ in range(2))
        self.count = np.zeros(slots, np.int64)

    def least(self) -> np.ndarray:
        """The score that a slot's next entry must reach; the lowest integer as long as there is room."""
        return self.score[:, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray, uid: np.ndarray) -> None:
        touched = np.unique(slot)
        if not len(touched):
            return
        have = np.arange(self.size)[None, :] < self.count[touched][:, None]
        slot = np.concatenate([slot, np.repeat(touched, self.count[touched])])
        score, ids, uid = (np.concatenate([x, own[touched][have]]) for x, own in ((score, self.score), (ids, self.id), (uid, self.uid)))
        order = np.lexsort((uid, ids, -score, slot))
        slot, score, ids, uid = (x[order] for x in (slot, score, ids, uid))
        first = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - first
        kept = place < self.size
        slot, place = slot[kept], place[kept]
        self.score[slot, place], self.id[slot, place], self.uid[slot, place] = score[kept], ids[kept], uid[kept]
        self.count[touched] = np.minimum(np.bincount(np.searchsorted(touched, slot), minlength=len(touched)), self.size)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(slot, score, id, uid) of all entries."""
        slot, place = np.nonzero(np.arange(self.size)[None, :] < self.count[:, None])
        return slot, self.score[slot, place], self.id[slot, place], self.uid[slot, place]


class Rows:
    """Coded rows of a batch, as arrays."""

    def __init__(self, batch: pa.RecordBatch, size: int):
        take = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        self.uid, self.label, self.along, self.rest = take("uid"), take("label"), take("along"), take("rest")
        self.id = batch.column("id").fill_null(_NO_ID).to_numpy()
        self.scaled = np.frombuffer(b"".join(batch.column("scaled").to_pylist()), np.int32).reshape(-1, size).astype(np.int64)
        self.code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint64).reshape(-1, size // 64)

    def __len__(self) -> int:
        return len(self.uid)


class Anchors:
    """A round's anchors: their vectors, labels and planes."""

    def __init__(self, rows: Rows):
        self.uid, self.id, self.label, self.scaled = rows.uid, rows.id, rows.label, rows.scaled
        self.planes = Planes(self.scaled)

    def tiles(self, rows: Rows, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, anchors) of the same label, or of different ones, in tiles of bounded size."""
        for label in np.unique(self.label).tolist():
            which = np.flatnonzero(self.label == label)
            own = np.flatnonzero((rows.label == label) == same)
            step = max(1, TILE // len(which))
            for k in range(0, len(own), step):
                yield own[k : k + step], which


def _positives(anchors: Anchors, size: int, wanted: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchors.uid), wanted)
        for batch in batches:
            rows = Rows(batch, size)
            for own, which in anchors.tiles(rows, True):
                low, high = anchors.planes.interval(rows.code[own], rows.along[own], rows.rest[own], which)
                other = rows.uid[own][:, None] != anchors.uid[which][None, :]
                need = best.least()[which].astype(np.float64)
                if len(own) > wanted:  # so many of these rows reach this for certain; one more, as the anchor may be among them
                    need = np.maximum(need, np.partition(low, len(own) - wanted - 1, axis=0)[len(own) - wanted - 1])
                i, j = np.nonzero((high >= need) & other)
                score = scored(rows.scaled, anchors.scaled, own[i], which[j])
                best.add(which[j], score, rows.id[own[i]], rows.uid[own[i]])
        slot, score, ids, uid = best.rows()
        yield _found(anchors.uid[slot], np.zeros(len(slot), np.int32), anchors.id[slot], ids, score, ids, uid, score)

    return run


def _negatives(anchors: Anchors, size: int, wanted: int, positive_id: np.ndarray, positive_score: np.ndarray, known: np.ndarray):
    """`positive_*`, `known`: an anchor's positives, one row each."""
    slots = known.shape[1]
    lowest = -((-LEAST * positive_score) // 100)
    highest = MOST * positive_score // 100
    open_ = known & (lowest <= highest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(known.size, wanted)
        for batch in batches:
            rows = Rows(batch, size)
            for own, which in anchors.tiles(rows, False):
                low, high = anchors.planes.interval(rows.code[own], rows.along[own], rows.rest[own], which)
                need = np.maximum(lowest, best.least().reshape(known.shape))[which]
                least = np.where(open_[which], need, _NO_ID).min(axis=1)
                most = np.where(open_[which], highest[which], np.iinfo(np.int64).min).max(axis=1)
                i, j = np.nonzero((high >= least) & (low <= most))
                score = scored(rows.scaled, anchors.scaled, own[i], which[j])
                for s in range(slots):
                    fits = open_[which[j], s] & (score >= need[j, s]) & (score <= highest[which[j], s])
                    best.add(which[j][fits] * slots + s, score[fits], rows.id[own[i[fits]]], rows.uid[own[i[fits]]])
        place, score, ids, uid = best.rows()
        at, slot = place // slots, place % slots
        yield _found(anchors.uid[at], slot.astype(np.int32), anchors.id[at], positive_id[at, slot], positive_score[at, slot], ids, uid, score)

    return run


def _found(*columns: np.ndarray) -> pa.RecordBatch:
    names = [f.split()[0] for f in _FOUND.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, mask=c == _NO_ID) if name.endswith("id") and name != "uid" else pa.array(c) for name, c in zip(names, columns, strict=True)], names=names)


def _code(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                some = batch.slice(k, 4096)
                scaled = np.zeros((some.num_rows, size), np.int64)
                lists = some.column("scaled")
                counts = np.diff(np.asarray(lists.offsets))
                owner = np.repeat(np.arange(len(counts)), counts)
                scaled[owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)] = lists.flatten().to_numpy()
                codes, along, rest = coded(scaled)
                blobs = [pa.array([x.tobytes() for x in table], pa.binary()) for table in (scaled.astype(np.int32), codes)]
                yield pa.RecordBatch.from_arrays([some.column("uid"), some.column("id"), some.column("label"), *blobs, pa.array(along), pa.array(rest)], names=[f.split()[0] for f in _ROW.split(", ")])

    return run


def coded_rows(vectors: DataFrame, id_col: str, label: Column, vector_col: str) -> tuple[DataFrame, int]:
    """(rows that take part, coded; the width of their vectors: 64 or a power of two beyond)."""
    vector = F.col(vector_col)
    usable = vectors.where(vector.isNotNull() & label.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < LARGEST, F.lit(False))))
    longest = usable.agg(F.max(F.size(vector))).first()[0] or 1
    size = max(64, 1 << (longest - 1).bit_length())
    source = usable.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"), label.cast("int").alias("label"), F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("int")).alias("scaled")
    )
    return written(source.mapInArrow(_code(size), _ROW), "coded-vectors"), size


def _first(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mined(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES, anchors_at_once: int = ANCHORS
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every row where `is_anchor` (over the id) holds.

    Components are floor(256 x); scores are integer products, higher first, ties by smaller id. An anchor's positives
    are its first other rows of the same label; a pair's negatives are the first rows of another label that score from 30 % to
    90 % of the positive (none if that is not above zero, or zero itself).

    Rows with a null label or vector, or a component that is null, not finite or of 65,536 and more, take no part. A
    shorter vector counts as filled up with zeros. Rows without an id are no anchors, and come last among equal scores. Rows
    that repeat an id are rows of their own. An empty table, or one without anchors, gives an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows, size = coded_rows(vectors, id_col, F.col("label") if label is None else label, vector_col)
    chosen = rows.where(F.col("id").isNotNull()).withColumnRenamed("id", id_col).where(is_anchor).withColumnRenamed(id_col, "id")
    rounds = max(1, -(-chosen.count() // anchors_at_once))
    results = []
    for turn in range(rounds):
        block = chosen.where(F.pmod(F.xxhash64("uid"), F.lit(rounds)) == turn).toArrow().combine_chunks()
        batch = block.to_batches()[0] if block.num_rows else None
        if batch is None:
            continue
        anchors = Anchors(Rows(batch, size))
        # Bounded: `positives` rows for each anchor of the round.
        firsts = _first(rows.mapInArrow(_positives(anchors, size, positives), _FOUND), ["anchor"], positives).select("anchor", "rank", "id", "score").toPandas()
        place = {uid: k for k, uid in enumerate(anchors.uid.tolist())}
        shape = (len(anchors.uid), positives)
        known, ids, score = np.zeros(shape, bool), np.full(shape, _NO_ID), np.zeros(shape, np.int64)
        for uid, rank, i, s in firsts.itertuples(index=False):
            at = place[uid], rank - 1
            known[at], score[at] = True, s
            if i == i and i is not None:
                ids[at] = int(i)
        found = rows.mapInArrow(_negatives(anchors, size, negatives, ids, score, known), _FOUND)
        results.append(written(_first(found, ["anchor", "slot"], negatives).select("anchor_id", "positive_id", F.col("rank").cast("int"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "hard-negatives"))
    if not results:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id AS id, v.label = a.label AS same, list_inner_product(a.e, v.e)::BIGINT AS score
  FROM v AS a JOIN v ON a.vec_id % 100 = 0 AND a.vec_id <> v.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS r
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 10
"""
