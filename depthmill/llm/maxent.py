"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

log p(word | before) = log p(class | before) + log p(group | class, before) + log p(word | group). Frequent words are classes
of their own; all others fall into classes by their ending and there into groups by their hash, which a word never seen has
too. Classes come in sets, so a word is reached by three narrow softmaxes: set, class in the set, group in the class. Each adds
rows of hashed weights of the words themselves: the word before (n-gram), the one before that (skip) and both together (n-gram),
each together with the set or class chosen so far. What they start from is, for classes, a softmax over hashed features of the
classes before, and for groups their share of the class. Within a group, words have their discounted share, and what the
discount leaves is the share of any word not seen.

1. Pieces. Texts become rows of word numbers, a few megabytes of text each, with the words' hashes beside them.
2. Counts. Words are counted per piece, then over all training texts, by one aggregation over hashes.
3. Contexts. Each task sums its (class context, class) counts; they are added up by the class before.
4. Training. Every round computes the gradient where the context counts lie; rows of the gradient are summed and the weights go
   out again. Then the words' rows: a task sums observed and expected counts of its tokens by row, Spark adds the tasks' rows
   up, and the weights go out again. The rows follow the vocabulary, up to a bound.
5. Scores. A piece sums its texts' shares of classes and groups; the counts of its words are joined back to it for the rest.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthmill.llm.texts import Words, blocks, byte_mask, encoded, mix
from depthmill.session import written

#: Classes: START, END, frequent words of their own, then classes by ending.
SINGLES, ENDINGS = 62, 64
START, END = 0, 1
CLASSES = 2 + SINGLES + ENDINGS
#: Rows of weights that pairs of classes hash to.
BUCKETS = 4096
ROUNDS, RATE, SMOOTH = 12, 0.7, 2.0
#: Classes of a set, sets, and groups of a class: the widths of the softmaxes over words' features.
MEMBERS, GROUP_BITS = 8, 4
SETS, GROUPS = CLASSES // MEMBERS, 1 << GROUP_BITS
WIDTHS = (SETS, MEMBERS, GROUPS)
#: Kinds of word contexts (before, before that, both), each with its own rows: one for so many words, within bounds.
KINDS, ROW_WORDS, ROWS_LEAST, ROWS_MOST = 3, 1024, 1 << 11, 1 << 14
WORD_ROUNDS, WORD_RATE, WORD_SMOOTH = 2, 0.5, 5.0
#: Tokens whose logits are held at a time, and rows of the words' table that are added up together.
TOKENS, ROW_SLICE = 1 << 14, 2048
#: Contexts whose logits are held at a time.
CONTEXTS = 512
#: A word's place in its piece and its count share a long.
COUNT_BITS = 40
#: Hash of the end of a text, as a token.
END_HASH = np.uint64(0x5851F42D4C957F2D)
_MARKS = byte_mask(b"!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~")

_PIECE = "piece long, ids array<long>, held array<boolean>, lengths array<int>, tokens binary, words binary, endings binary"


def ending_classes(words: Words) -> np.ndarray:
    """Class of each word by its last two bytes before a closing mark, and whether it has one."""
    last = words.ends - 1
    marked = _MARKS[words.buffer[last]] & (last > words.starts)
    last = last - marked
    before = np.where(last > words.starts, words.buffer[np.maximum(last - 1, 0)], 0).astype(np.uint64)
    pair = mix(words.buffer[last].astype(np.uint64) * np.uint64(256) + before + np.uint64(1))
    return (2 + SINGLES + (pair % np.uint64(ENDINGS // 2)).astype(np.int64) * 2 + marked).astype(np.uint8)


def planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as four planes of bytes; the high planes are nearly constant and so nearly free."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text"):
        words = Words([t.lower() for t in encoded(batch.column("text"))])
        known, where = np.unique(words.hashes(), return_index=True)
        ending = ending_classes(words)[where]
        # The end of a text is one more word of the piece.
        place = int(np.searchsorted(known, END_HASH))
        known, ending = np.insert(known, place, END_HASH), np.insert(ending, place, END)
        tokens = planes(np.insert(np.searchsorted(known, words.hashes()), words.first[1:], place))
        columns = [
            pa.array([uuid.uuid4().int >> 65], pa.int64()),
            pa.array([batch.column("id").to_pylist()], pa.list_(pa.int64())),
            pa.array([batch.column("held").to_pylist()], pa.list_(pa.bool_())),
            pa.array([(words.counts + 1).tolist()], pa.list_(pa.int32())),
            *(pa.array([x], pa.binary()) for x in (tokens, known.tobytes(), ending.tobytes())),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["piece", "ids", "held", "lengths", "tokens", "words", "endings"])


@dataclass
class Piece:
    """One row of the table of pieces, as arrays; a column that wasn't selected is None."""

    name: int
    ids: list
    held: np.ndarray
    lengths: np.ndarray
    tokens: np.ndarray
    words: np.ndarray | None
    endings: np.ndarray | None

    @staticmethod
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple["Piece", dict]]:
        for batch in batches:
            for i in range(len(batch)):
                row = {k: batch.column(k)[i] for k in batch.schema.names}
                array = lambda k, kind: np.frombuffer(row[k].as_buffer(), kind) if k in row else None  # noqa: E731, B023
                yield Piece(row["piece"].as_py(), row["ids"].as_py(), np.array(row["held"].as_py(), bool), np.array(row["lengths"].as_py(), np.int64), numbers(row["tokens"].as_buffer()), array("words", np.uint64), array("endings", np.uint8)), row

    def classes(self, singles: np.ndarray) -> np.ndarray:
        """Class of each word of the piece; `singles` are the sorted hashes of frequent words."""
        out = self.endings.astype(np.int64)
        if len(singles):
            at = np.minimum(np.searchsorted(singles, self.words), len(singles) - 1)
            out = np.where((singles[at] == self.words) & (out != END), 2 + at, out)
        return out

    def before(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the word before each token and of the one before that; the start of a text is one place more."""
        start = len(self.words)
        begin = np.cumsum(self.lengths) - self.lengths
        one = np.concatenate([[start], self.tokens[:-1]])
        one[begin] = start
        two = np.concatenate([[start], one[:-1]])
        two[begin] = start
        return one, two

    def contexts(self, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(class before, class before that, own class) of each token."""
        one, two = self.before()
        known = np.append(cls, START)
        return known[one], known[two], cls[self.tokens]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text's tokens."""
        starts = np.cumsum(self.lengths) - self.lengths
        return np.add.reduceat(values, starts) if len(starts) else values[:0]

    def training(self) -> np.ndarray:
        return np.repeat(~self.held, self.lengths)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, class by ending, count in training texts, piece, place) of the words of a piece."""
    for piece, _ in Piece.of(batches):
        count = np.bincount(piece.tokens[piece.training()], minlength=len(piece.words))
        place = np.arange(len(piece.words), dtype=np.int32)
        arrays = [pa.array(piece.words.view(np.int64)), pa.array(piece.endings.astype(np.int16)), pa.array(count.astype(np.int64)), pa.array(np.full(len(place), piece.name, np.int64)), pa.array(place)]
        yield pa.RecordBatch.from_arrays(arrays, names=["word", "ending", "n", "piece", "place"])


def _context_counts(singles: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES**3, np.int64)
        for piece, _ in Piece.of(batches):
            one, two, own = piece.contexts(piece.classes(singles))
            total += np.bincount(((one * CLASSES + two) * CLASSES + own)[piece.training()], minlength=len(total))
        for one, table in enumerate(total.reshape(CLASSES, -1)):
            at = np.flatnonzero(table)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([one], pa.int32()), pa.array([at.astype("<u4").tobytes()], pa.binary()), pa.array([table[at].astype("<i8").tobytes()], pa.binary())], names=["one", "cells", "counts"])

    return count


def _add_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per class before: its rows are added up as they come."""
    totals: dict[int, np.ndarray] = {}
    for frame in frames:
        for one, cells, counts in zip(frame["one"], frame["cells"], frame["counts"], strict=True):
            table = totals.setdefault(int(one), np.zeros(CLASSES * CLASSES, np.int64))
            table[np.frombuffer(cells, "<u4")] += np.frombuffer(counts, "<i8")
    for one, table in totals.items():
        yield pd.DataFrame({"one": [one], "table": [table.astype("<f8").tobytes()]})


def pair_rows(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Row of weights that a pair of classes hashes to."""
    return 2 * CLASSES + (mix((one * CLASSES + two).astype(np.uint64) + np.uint64(77)) % np.uint64(BUCKETS)).astype(np.int64)


def log_shares(weights: np.ndarray, bias: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """log p(class | one, two) of each context, a row each; worked out some contexts at a time."""
    out = np.empty((len(one), CLASSES))
    for k in range(0, len(one), CONTEXTS):
        first, second = one[k : k + CONTEXTS], two[k : k + CONTEXTS]
        logits = bias + weights[first] + weights[CLASSES + second] + weights[pair_rows(first, second)]
        logits[:, START] = -np.inf  # never comes
        top = logits.max(axis=1, keepdims=True)
        out[k : k + CONTEXTS] = logits - top - np.log(np.exp(logits - top).sum(axis=1, keepdims=True))
    return out


def _gradient(weights: np.ndarray, bias: np.ndarray):
    """Observed and expected counts of every (feature, class) that the rows of a task touch."""

    def gradient(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        two = np.arange(CLASSES)
        for frame in frames:
            for first, table in zip(frame["one"], frame["table"], strict=True):
                seen = np.frombuffer(table, "<f8").reshape(CLASSES, CLASSES)
                one = np.full(CLASSES, first)
                both = np.stack([seen, seen.sum(axis=1, keepdims=True) * np.exp(log_shares(weights, bias, one, two))], axis=1)
                for rows in (one, CLASSES + two, pair_rows(one, two)):
                    for row, values in zip(rows.tolist(), both, strict=True):
                        if values[0].any():
                            sums[row] = sums[row] + values if row in sums else values
        if sums:
            yield pd.DataFrame({"row": list(sums), "values": [v.astype("<f4").tobytes() for v in sums.values()]})

    return gradient


def train(counts: DataFrame, bias: np.ndarray, rounds: int) -> np.ndarray:
    """Weights after some rounds of scaled gradient steps; the driver holds the weights and one gradient."""
    weights = np.zeros((2 * CLASSES + BUCKETS, CLASSES))
    for _ in range(rounds):
        sums = np.zeros((len(weights), 2, CLASSES))
        for row in counts.mapInPandas(_gradient(weights, bias), "row int, values binary").toLocalIterator():
            sums[row["row"]] += np.frombuffer(row["values"], "<f4").reshape(2, CLASSES)
        seen, expected = sums[:, 0], sums[:, 1]
        weights += RATE * (seen - expected) / (np.maximum(seen, expected) + SMOOTH)
    return weights


def groups(words: np.ndarray) -> np.ndarray:
    """Group of each word in its class."""
    return (words >> np.uint64(64 - GROUP_BITS)).astype(np.int64)


def rows_of(vocabulary: int) -> int:
    """Rows of each kind of word context: a power of two that follows the vocabulary."""
    rows = ROWS_LEAST
    while rows < min(vocabulary / ROW_WORDS, ROWS_MOST):
        rows *= 2
    return rows


def word_rows(one: np.ndarray, two: np.ndarray, chosen: np.ndarray, rows: int) -> list[np.ndarray]:
    """Row of each kind that the hashes of the words before, with what is chosen so far, fall into."""
    salt = (chosen.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    kinds = one + salt, ~two + salt, one * np.uint64(0x9E3779B97F4A7C15) + two + salt
    return [(mix(h) & np.uint64(rows - 1)).astype(np.int64) + k * rows for k, h in enumerate(kinds)]


def word_start(class_weights: np.ndarray, bias: np.ndarray, group_tokens: np.ndarray) -> list[np.ndarray]:
    """Logits without words' features: of sets and of classes in a set by the classes before, of groups by class."""
    every = np.arange(CLASSES**2)
    shares = log_shares(class_weights, bias, every // CLASSES, every % CLASSES)
    sets = np.log(np.exp(shares).reshape(-1, SETS, MEMBERS).sum(axis=2))
    return [sets.astype("<f4"), shares.astype("<f4").reshape(-1, MEMBERS), np.log(group_tokens + 0.5).astype("<f4")]


@dataclass
class WordModel:
    """The softmaxes over words' features: what they start from, and a table of weights each (None: all zero)."""

    singles: np.ndarray
    start: list[np.ndarray]
    rows: int
    weights: list[np.ndarray] | None = None

    def steps(self, piece: Piece, wanted: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]]:
        """(softmax, places, rows of each kind, logits in columns, choice) of the wanted tokens, some at a time."""
        cls, group = piece.classes(self.singles), groups(piece.words)
        marks, known = np.append(mix(piece.words), np.uint64(START)), np.append(cls, START)
        before, second = piece.before()
        for k in range(0, len(wanted), TOKENS):
            at = wanted[k : k + TOKENS]
            one, two, own = before[at], second[at], piece.tokens[at]
            context, label = known[one] * CLASSES + known[two], cls[own]
            inner = np.flatnonzero(label >= 2 + SINGLES)  # a frequent word is alone in its class
            for level, part, place, chosen, choice in (
                (0, slice(None), context, np.zeros_like(label), label // MEMBERS),
                (1, slice(None), context * SETS + label // MEMBERS, 1 + label // MEMBERS, label % MEMBERS),
                (2, inner, label[inner], 1 + SETS + label[inner], group[own[inner]]),
            ):
                rows = word_rows(marks[one[part]], marks[two[part]], chosen, self.rows)
                logits = self.start[level].take(place, axis=0)
                if self.weights is not None:
                    for own_rows in rows:
                        logits += self.weights[level].take(own_rows, axis=0)
                logits = np.ascontiguousarray(logits.T)
                logits -= logits.max(axis=0)
                yield level, at[part], rows, logits, choice

    def log_shares(self, piece: Piece) -> np.ndarray:
        """log p(class | before) + log p(group | class, before) of each token."""
        out = np.zeros(len(piece.tokens))
        for _, at, _, logits, choice in self.steps(piece, np.arange(len(piece.tokens))):
            out[at] += logits[choice, np.arange(len(at))] - np.log(np.exp(logits).sum(axis=0))
        return out


def _word_counts(model: WordModel, with_seen: bool):
    """Counts of every (row, choice) in a task's training tokens: as the model expects them, and as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = KINDS * model.rows
        expected, seen = ([np.zeros((width, KINDS, model.rows)) for width in WIDTHS] for _ in range(2))
        some = False
        for piece, _ in Piece.of(batches):
            found: list[list[np.ndarray]] = [[] for _ in range(KINDS * len(WIDTHS))]
            for level, _, rows, logits, choice in model.steps(piece, np.flatnonzero(piece.training())):
                some = True
                np.exp(logits, out=logits)
                share = np.divide(logits, logits.sum(axis=0), dtype=float)
                for k, own in enumerate(rows):
                    own -= k * model.rows
                    for column, values in enumerate(share):
                        expected[level][column, k] += np.bincount(own, values, model.rows)
                    if with_seen:
                        found[level * KINDS + k].append((choice * model.rows + own).astype(np.int32))
            for at, cells in enumerate(found if with_seen else []):
                level, k = divmod(at, KINDS)
                if cells:
                    seen[level][:, k] += np.bincount(np.concatenate(cells), minlength=WIDTHS[level] * model.rows).reshape(WIDTHS[level], -1)
                    cells.clear()
        for is_seen, tables in ((False, expected), (True, seen if with_seen else [])):
            for level, table in enumerate(tables if some else []):
                for k in range(0, size, ROW_SLICE):
                    cells = np.ascontiguousarray(table.reshape(-1, size)[:, k : k + ROW_SLICE].T).astype("<f4").tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in ((is_seen, pa.bool_()), (level, pa.int32()), (k, pa.int32()), (cells, pa.binary()))], names=["seen", "level", "row", "cells"])

    return run


def _add_cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per slice of a table: its cells are added up as they come."""
    totals: dict[tuple, np.ndarray] = {}
    for frame in frames:
        for seen, level, row, cells in zip(frame["seen"], frame["level"], frame["row"], frame["cells"], strict=True):
            values = np.frombuffer(cells, "<f4").astype(float)
            key = bool(seen), int(level), int(row)
            totals[key] = totals[key] + values if key in totals else values
    for (seen, level, row), values in totals.items():
        yield pd.DataFrame({"seen": [seen], "level": [level], "row": [row], "cells": [values.astype("<f4").tobytes()]})


def train_words(pieces: DataFrame, model: WordModel, rounds: int) -> WordModel:
    """The model with weights after some rounds of scaling towards the observed counts; the driver holds weights and counts."""
    schema, size = "seen boolean, level int, row int, cells binary", KINDS * model.rows
    seen = [np.zeros((size, width), "<f4") for width in WIDTHS]
    for k in range(rounds):
        expected = [np.zeros((size, width), "<f4") for width in WIDTHS]
        counts = pieces.mapInArrow(_word_counts(model, k == 0), schema)
        for r in counts.repartition("seen", "level", "row").mapInPandas(_add_cells, schema).toLocalIterator():
            cells = np.frombuffer(r["cells"], "<f4").reshape(-1, WIDTHS[r["level"]])
            (seen if r["seen"] else expected)[r["level"]][r["row"] : r["row"] + len(cells)] = cells
        steps = [np.float32(WORD_RATE) * np.log((a + WORD_SMOOTH) / (b + WORD_SMOOTH), dtype="<f4") for a, b in zip(seen, expected, strict=True)]
        weights = steps if model.weights is None else [a + b for a, b in zip(model.weights, steps, strict=True)]
        model = WordModel(model.singles, model.start, model.rows, weights)
    return model


@dataclass
class Model:
    """What a score needs besides the shares of classes and groups and the counts of a piece's words; tables by class and group."""

    cell_tokens: np.ndarray
    cell_words: np.ndarray
    discount: np.ndarray
    tokens: int
    words: int

    def score(self, piece: Piece, cell: np.ndarray, counts: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, known tokens, base score, score) of each text of a piece, by the cell and count of its words and its shares."""
        discount, held = self.discount[cell // GROUPS], self.cell_tokens[cell]
        total = np.maximum(held, 1)
        seen = np.maximum(counts - discount, 1e-9) / total
        fresh = np.where(held > 0, np.maximum(discount * self.cell_words[cell], 1e-9) / total, 1.0)
        within = np.log(np.where(counts > 0, seen, fresh))
        within[cell < (2 + SINGLES) * GROUPS] = 0.0  # alone in its class
        base = np.log10((counts + 1) / (self.tokens + self.words + 1))[piece.tokens]
        add = piece.per_text
        return piece.lengths, add((counts > 0)[piece.tokens].astype(np.int64)), add(base), (shares + add(within[piece.tokens])) / np.log(10)


def _with_shares(model: WordModel):
    """The pieces with the class and group of each word in place of the word, and the texts' shares of classes and groups."""

    def exchange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, row in Piece.of(batches):
            kept = ["piece", "ids", "held", "lengths", "tokens"]
            cells = (piece.classes(model.singles) * GROUPS + groups(piece.words)).astype("<u2").tobytes()
            shares = piece.per_text(model.log_shares(piece)).tobytes()
            yield pa.RecordBatch.from_arrays([*(pa.array([row[k].as_py()], row[k].type) for k in kept), *(pa.array([x], pa.binary()) for x in (cells, shares))], names=[*kept, "cells", "shares"])

    return exchange


def _score(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, row in Piece.of(batches):
            cell = np.frombuffer(row["cells"].as_buffer(), "<u2").astype(np.int64)
            counts = np.zeros(len(cell), np.int64)
            if row["counted"].is_valid:
                found = np.asarray(row["counted"].values)
                counts[found >> COUNT_BITS] = found & ((1 << COUNT_BITS) - 1)
            n, known, base, each = model.score(piece, cell, counts, np.frombuffer(row["shares"].as_buffer(), float))
            arrays = [pa.array(piece.ids, pa.int64()), pa.array(piece.held), pa.array(n), pa.array(known), pa.array(np.full(len(n), model.tokens, np.int64)), pa.array(base), pa.array(each)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def scored(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, word_rounds: int = WORD_ROUNDS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, learned from those not held out.

    Scores are log10 probabilities: `base_score` by add-one counts, `score` by the model. A null or empty text is the end
    token alone. Repeated rows count as often as they stand; ids may be null. Without any training text every word is
    new and `train_tokens` is 0. An empty table gives an empty result. Other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held"))
    pieces = written(source.mapInArrow(_pieces, _PIECE), "pieces", wide=True)
    entries = pieces.mapInArrow(_entries, "word long, ending short, n long, piece long, place int")
    vocabulary = written(entries.groupBy("word").agg(F.sum("n").alias("n"), F.min("ending").alias("ending")).where("n > 0"), "vocabulary")
    frequent = vocabulary.where(F.col("ending") != END).orderBy(F.desc("n"), "word").limit(SINGLES).collect()
    singles = np.sort(np.array([r["word"] for r in frequent], np.int64).view(np.uint64))
    alone = F.col("word").isin([int(x) for x in singles.view(np.int64)]) if len(singles) else F.lit(False)
    group = F.shiftrightunsigned("word", 64 - GROUP_BITS).cast("int").alias("group")
    cell_tokens, cell_words, once = np.zeros((3, CLASSES, GROUPS))
    for r in vocabulary.where(~alone).groupBy("ending", group).agg(F.sum("n").alias("tokens"), F.count("*").alias("words"), F.count_if(F.col("n") == 1).alias("once")).collect():
        for table, k in ((cell_tokens, "tokens"), (cell_words, "words"), (once, "once")):
            table[r["ending"], r["group"]] = r[k]
    amount = {r["word"]: r["n"] for r in frequent}
    for at, word in enumerate(singles.view(np.int64).tolist()):
        cell_tokens[2 + at, 0], cell_words[2 + at, 0] = amount[word], 1
    class_tokens, class_words, once = cell_tokens.sum(axis=1), cell_words.sum(axis=1), once.sum(axis=1)
    # The share of words not yet seen is that of words seen once.
    discount = np.clip(once / np.maximum(class_words, 1), 0.05, 0.95)
    bias = np.log((class_tokens + 1) / (class_tokens.sum() + CLASSES))
    parts = pieces.mapInArrow(_context_counts(singles), "one int, cells binary, counts binary")
    counts = written(parts.repartition("one").mapInPandas(_add_counts, "one int, table binary"), "context-counts")
    weights = train(counts, bias, rounds)
    size = int(class_words.sum())
    words = WordModel(singles, word_start(weights, bias, cell_tokens), rows_of(size))
    if size:
        words = train_words(pieces.select("piece", "ids", "held", "lengths", "tokens", "words", "endings"), words, word_rounds)
    model = Model(cell_tokens.ravel(), cell_words.ravel(), discount, int(class_tokens.sum()), size)
    back = entries.select("word", "piece", "place").join(vocabulary.select("word", "n"), "word")
    packed = F.shiftleft(F.col("place").cast("long"), COUNT_BITS) + F.col("n")
    counted = back.groupBy("piece").agg(F.collect_list(packed).alias("counted"))
    slim = pieces.mapInArrow(_with_shares(words), "piece long, ids array<long>, held array<boolean>, lengths array<int>, tokens binary, cells binary, shares binary")
    joined = slim.join(counted, "piece", "left")
    return joined.mapInArrow(_score(model), "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
