"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule says good (1), bad (-1) or nothing (0) about a document. A rule's accuracy isn't known (the chance that it
votes good on a good document, and bad on a bad one), and documents have a hidden class. EM estimates both from the votes of
all documents, which are counted by pattern first (3^rules patterns at most, whatever the number of documents). A
document's posterior probability of being good follows from its votes and the accuracies, as a plain column expression,
and decides. A bad vote never speaks for a document, a good one never against it.
"""

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthmill.llm.texts import Words, blocks, byte_mask, covered, encoded, fits, grams, mix
from depthmill.session import written

#: Words of a repeated window, and the symbols counted.
REPEAT, SYMBOLS = 8, b"#*$%&|<>"
#: Bytes of texts that are counted at a time.
COUNTED = 1 << 20
#: Hard limits that hold beside the votes.
LEAST_WORDS, REPEAT_PERCENT = 20, 30
ROUNDS = 60
#: Where EM starts, and how many pseudo-votes hold it there: a good document passes most rules, a bad one fails some.
ON_GOOD, ON_BAD, HOLD = 0.95, 0.4, 10.0

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words", "n_ended_lines", "n_capitals", "n_letters", "n_symbol_words")


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def _per_word(name: str) -> Column:
    return F.col(name) / F.greatest(F.col("n_words"), F.lit(1))



def rules() -> dict[str, Column]:
    """Name and vote of every rule, over the columns of `features`."""
    length = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    ended = F.when(F.col("n_lines") > 0, F.col("n_ended_lines") / F.col("n_lines"))
    capitals = F.when(F.col("n_letters") > 20, F.col("n_capitals") / F.col("n_letters"))
    letters = F.when(F.col("n_words") > 0, F.col("n_letters") / (F.col("n_letters") + F.col("n_symbols") + F.col("n_words") - F.col("n_letter_words")))
    dup_lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "enough_words": _vote(F.col("n_words") >= 40, F.col("n_words") < 20),
        "word_length": _vote(length.between(3.5, 9), (length < 2.5) | (length > 12)),
        "few_symbols": _vote(_per_word("n_symbols") <= 0.02, _per_word("n_symbols") > 0.1),
        "few_repeated_lines": _vote((dup_lines <= 0.05) & (F.col("n_lines") > 1), (dup_lines > 0.3) & (F.col("n_dup_lines") >= 3)),
        "few_repeated_words": _vote((_per_word("n_repeat_words") <= 0.05) & (F.col("n_words") > 50), _per_word("n_repeat_words") > 0.3),
        "ended_lines": _vote(ended >= 0.5, ended < 0.2),
        "calm_case": _vote(capitals <= 0.2, capitals > 0.5),
        "plain_words": _vote(_per_word("n_symbol_words") <= 0.05, _per_word("n_symbol_words") > 0.3),
        "mostly_letters": _vote(letters >= 0.85, letters < 0.7),
        "words_of_letters": _vote(_per_word("n_letter_words") >= 0.9, _per_word("n_letter_words") < 0.6),
    }


_LETTER = np.ones(256, bool)
_LETTER[:0x41] = _LETTER[0x5B:0x61] = _LETTER[0x7B:0x80] = False
_IS_SYMBOL = byte_mask(SYMBOLS)
_IS_CAPITAL = byte_mask(bytes(range(0x41, 0x5B)))
#: What a sentence may end with.
ENDS = (b".", b"!", b"?", b":", b'"', b")", "”".encode(), "»".encode(), "…".encode(), "。".encode())


def count_features(texts: list[bytes]) -> list[np.ndarray]:
    """FEATURES of each text."""
    words = Words(texts)
    edges = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    between = lambda sums, at: sums[at[1:]] - sums[at[:-1]]
    per_word = lambda flags: between(edges(words.with_flag(flags)), words.first)
    symbol, letter = _IS_SYMBOL[words.buffer], _LETTER[words.buffer]
    symbols, letters, capitals = (words.flagged(x) for x in (symbol, letter, _IS_CAPITAL[words.buffer]))
    duplicate, lines, ended = [], [], []
    for text in texts:
        full = [x for x in text.split(b"\n") if x and not x.isspace()]
        lines.append(len(full))
        ended.append(sum(x.rstrip().endswith(ENDS) for x in full))
        duplicate.append(len(full) - len(set(full)))
    h = words.hashes()
    starts = np.flatnonzero(fits(words.first, len(h), REPEAT))
    marks = np.zeros(len(h), bool)
    if len(starts):
        own = grams(h, REPEAT)[starts] ^ mix(words.owner()[starts].astype(np.uint64))
        order = np.argsort(own, kind="stable")
        same = own[order][1:] == own[order][:-1]
        marks[starts[order[1:][same]]] = True
        marks[starts[order[:-1][same]]] = True
    repeated = between(edges(covered(marks, REPEAT, len(h))), words.first)
    counted = [words.counts, words.code_points(), symbols, duplicate, repeated, lines, per_word(letter), ended, capitals, letters, per_word(symbol)]
    return [np.asarray(x, np.int64) for x in counted]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text", COUNTED):
        found = [pa.array(x) for x in count_features(encoded(batch.column("text")))]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), *found], names=["row", "text", *FEATURES])


@dataclass(frozen=True)
class Opinion:
    """What EM found: the share of good documents, and per rule the chance of a good vote on good ones and of a bad vote on bad ones."""

    good: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def posterior(self, votes: dict[str, Column]) -> Column:
        """Probability that a document is good, by its votes."""
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for name, vote in votes.items():
            a, b = self.on_good[name], self.on_bad[name]
            odds = odds + F.when(vote == 1, math.log(a / (1 - b))).when(vote == -1, math.log((1 - a) / b)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def estimate(votes: DataFrame, names: list[str], rounds: int = ROUNDS) -> Opinion:
    """EM over the vote patterns of all rows. Without any row, everything stays where it starts."""
    found = votes.groupBy(*names).agg(F.count("*").alias("n")).collect()  # 3^rules rows at most
    table = np.array([[r[k] for k in names] for r in found], float).reshape(-1, len(names))
    n = np.array([r["n"] for r in found], float)
    yes, no = (table == 1).astype(float), (table == -1).astype(float)
    a, b = np.full(len(names), ON_GOOD), np.full(len(names), ON_BAD)
    good = 0.8
    for _ in range(rounds if len(n) else 0):
        odds = math.log(good / (1 - good)) + yes @ np.log(a / (1 - b)) + no @ np.log((1 - a) / b)
        p = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        a = (((n * p) @ yes) + HOLD * ON_GOOD) / ((n * p) @ (yes + no) + HOLD)
        b = (((n * (1 - p)) @ no) + HOLD * ON_BAD) / ((n * (1 - p)) @ (yes + no) + HOLD)
        a = np.clip(a, 0.6, 0.999)
        b = np.clip(b, 1.01 - a, 0.95)
        good = float(np.clip((n @ p + 8) / (n.sum() + 10), 0.05, 0.98))
    return Opinion(good, dict(zip(names, map(float, a), strict=True)), dict(zip(names, map(float, b), strict=True)))


def judged(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` with FEATURES, base_failed, quality (posterior) and kept.

    A null or empty text has no words and fails. Repeated rows count as often as they stand. An empty table gives an
    empty result. Other columns pass through, whatever their names (those that are added are replaced).
    """
    added = (*FEATURES, "base_failed", "quality", "kept")
    rest = [c for c in docs.columns if c != text_col and c not in added]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]) if rest else F.struct(F.lit(0).alias("c0"))
    source = docs.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = source.schema["row"].dataType.simpleString()
    counted = written(source.mapInArrow(_count, f"row {kind}, text string, " + ", ".join(f"{k} long" for k in FEATURES)), "quality-features")
    votes = rules()
    opinion = estimate(counted.select(*[v.alias(k) for k, v in votes.items()]), list(votes))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    quality = opinion.posterior(votes)
    placed = {c: F.col(f"row.c{i}").alias(c) for i, c in enumerate(rest)} | {text_col: F.col("text").alias(text_col)}
    back = [placed[c] for c in docs.columns if c in placed]
    return counted.select(*back, *FEATURES, failed.alias("base_failed"), quality.alias("quality"), (~failed & (quality >= 0.5)).alias("kept"))
