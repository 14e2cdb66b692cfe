"""Classifier evaluation as relations: ROC points, AUC, best threshold, reports, column profiles."""

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depthmill.functions.quotes import ratio
from depthmill.functions.scoring import predicted_class
from depthmill.operators.ordered import running_totals
from depthmill.session import written


#: Distinct scores of a range.
BAND_ROWS = 1 << 20


def score_counts(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score; a score shared by many rows is combined map-side."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives")
    )


def _cumulative(counts: DataFrame, band_rows: int = BAND_ROWS) -> DataFrame:
    """Counts at or above every distinct score, highest score first.

    Prefix sums over range partitions: as many ranges of scores as there are `band_rows` distinct ones, one total for each, offsets
    added back. `counts` is stored, so that finding the ranges doesn't count again.
    """
    bands = max(1, -(-counts.count() // band_rows))
    ranged = counts.repartitionByRange(bands, "score").withColumn("_band", F.spark_partition_id().cast("long"))
    sums = {"tp": F.col("positives"), "fp": F.col("negatives")}
    return running_totals(written(ranged, "score-ranges"), [], [F.desc("score")], -F.col("_band"), sums).drop("_band")


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, tpr, fpr) per distinct score, plus the start (0, 0) whose threshold is NULL.

    The input is read once; everything after the first group-by works on distinct scores. Rates are NULL when a class is absent.
    """
    counts = written(score_counts(df, label, score), "score-counts")
    totals = counts.agg(F.struct(F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives")))
    points = _cumulative(counts).withColumn("_all", totals.scalar()).select(
        F.col("score").alias("threshold"),
        ratio(F.col("tp").cast("double"), F.col("_all.positives").cast("double")).alias("tpr"),
        ratio(F.col("fp").cast("double"), F.col("_all.negatives").cast("double")).alias("fpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr")
    )
    return points.unionByName(start)


def best_threshold(points: DataFrame) -> DataFrame:
    """The point with the largest tpr - fpr; the highest threshold among equals, NULL if none beats chance."""
    gain = (F.col("tpr") - F.col("fpr")).alias("youden_j")
    # The start point sorts first among equals: its threshold stands for "above every score".
    ordered = points.select("threshold", "tpr", "fpr", gain).orderBy(
        F.desc_nulls_last("youden_j"), F.desc_nulls_first("threshold")
    )
    return ordered.limit(1)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area by the rank statistic; NULL when a class is absent."""
    cumulative = _cumulative(written(score_counts(df, label, score), "score-counts"))
    # Pairs won by positives: each negative loses to the positives above it and halves its ties.
    above = F.col("tp") - F.col("positives")
    won = F.sum(F.col("negatives").cast("double") * (above + F.col("positives") / 2.0))
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    return cumulative.agg(ratio(won, pairs).alias("roc_auc"))


def with_prediction(df: DataFrame, threshold: float | Column = 0.5, score: str = "score") -> DataFrame:
    return df.withColumn("prediction", predicted_class(F.col(score), threshold))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows are true classes, columns predicted ones."""
    counts = df.groupBy(F.col(label).alias("label")).pivot(prediction, [0, 1]).count()
    return counts.select(
        "label", *[F.coalesce(F.col(str(c)), F.lit(0)).alias(f"predicted_{c}") for c in (0, 1)]
    )


def _outcomes(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )


def _share(part: Column, whole: Column) -> Column:
    """Share with 0 for an empty whole."""
    return F.coalesce(ratio(part.cast("double"), whole.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, precision, recall and F1 from one aggregate of four counts."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return _outcomes(df, label, prediction).select(
        _share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_report(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    names: Sequence[str] = ("down", "up"),
) -> DataFrame:
    """precision, recall, F1 and support per class, then accuracy, macro and support-weighted means."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def row(name, hit, wrong, missed):
        return F.struct(
            F.lit(name).alias("class"),
            _share(hit, hit + wrong).alias("precision"),
            _share(hit, hit + missed).alias("recall"),
            _share(2 * hit, 2 * hit + wrong + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    views = _outcomes(df, label, prediction).select(
        row(names[0], tn, fn, fp).alias("neg"), row(names[1], tp, fp, fn).alias("pos"), "tp", "tn"
    )

    def mean(name, combine):
        return F.struct(
            F.lit(name).alias("class"),
            *[combine(m).alias(m) for m in ("precision", "recall", "f1")],
            (F.col("neg.support") + F.col("pos.support")).alias("support"),
        )

    def macro(m):
        return (F.col(f"neg.{m}") + F.col(f"pos.{m}")) / 2.0

    def weighted(m):
        parts = F.col(f"neg.{m}") * F.col("neg.support") + F.col(f"pos.{m}") * F.col("pos.support")
        return _share(parts, F.col("neg.support") + F.col("pos.support"))

    def accuracy(_):
        return _share(F.col("tp") + F.col("tn"), F.col("neg.support") + F.col("pos.support"))

    lines = F.array(
        F.col("neg"), F.col("pos"), mean("accuracy", accuracy), mean("macro avg", macro), mean("weighted avg", weighted)
    )
    return views.select(F.inline(lines))


def evaluate(df: DataFrame, threshold: float | Column, label: str = "label", score: str = "score") -> DataFrame:
    """All metrics of one threshold, with the threshold-free AUC, in one row."""
    predicted = with_prediction(df, threshold, score)
    return binary_metrics(predicted, label).withColumn("roc_auc", roc_auc(df, label, score).scalar())


def positive_share(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.avg(label).alias("positive_share"))


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
#: So few values of a bracket are looked at one by one.
BRACKET = 4096
#: Size of a quantile sketch, and how far about a rank its guess reaches, in shares of the rows.
SKETCH, REACH = 2048, 1 / 128


class Places(NamedTuple):
    """Places in a column's order that lie between two of its values: `below` values come before, `inside` are from low to high."""

    column: int
    places: tuple[int, ...]
    low: float
    high: float
    below: int
    inside: int
    guess: tuple[float, float, float] | None


def _guess(value: Column, places: Column) -> Column:
    sketch = F.kll_sketch_agg_double(value, SKETCH)
    return F.when(F.count(value) > 0, F.kll_sketch_get_quantile_double(sketch, places))


def _ranks(places: Sequence[int], below: int, inside: int) -> list[float]:
    """Ranks before, at and behind the places."""
    first, last = ((p - below + 0.5) / inside for p in (min(places), max(places)))
    return [max(0.0, first - REACH), first, min(1.0, last + REACH)]


def order_statistics(values: DataFrame, wanted: list[Places], bracket: int = BRACKET) -> dict[tuple[int, int], float]:
    """The value at each wanted place, exactly, by narrowing: {(column, place): value}. Columns of `values` are `_0`, `_1`, ...

    A pass counts the values before, inside and behind a guess that a mergeable sketch gave, and sketches the inside; the places
    go on in the part they lie in, until it holds one value or at most `bracket` rows. Each pass is one scan and one aggregate
    with partial rows of a fixed size; a bracket shrinks about sixtyfold in one, so their number grows with the
    logarithm of the rows, and nothing is shuffled per value.
    """
    found: dict[tuple[int, int], float] = {}
    todo = wanted
    while todo:
        asked = []
        for k, t in enumerate(todo):
            c = F.col(f"_{t.column}")
            inside = F.when(c.between(t.low, t.high) & ~F.isnan(c), c)
            if t.inside <= bracket:
                asked.append(F.struct(F.array_sort(F.collect_list(inside)).alias("values")).alias(f"a{k}"))
            elif t.guess is None:
                asked.append(F.struct(_guess(inside, F.array(*map(F.lit, _ranks(t.places, t.below, t.inside)))).alias("guess")).alias(f"a{k}"))
            else:
                # Where a guess spans all that is there (few values with many rows each), the place's own value parts it.
                low, high = (t.guess[0], t.guess[2]) if t.guess[0] > t.low or t.guess[2] < t.high else (t.guess[1], t.guess[1])
                parts = [F.when(inside < low, inside), F.when(inside.between(low, high), inside), F.when(inside > high, inside)]
                sums = [F.struct(F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high")) for x in parts]
                asked.append(F.struct(F.array(*sums).alias("parts"), _guess(parts[1], F.array(*[F.lit(r / 128) for r in range(129)])).alias("table")).alias(f"a{k}"))
        row, now = values.agg(*asked).first(), todo
        todo = []
        for k, t in enumerate(now):
            answer = row[f"a{k}"]
            if t.inside <= bracket:
                found.update({(t.column, p): answer["values"][p - t.below] for p in t.places})
            elif t.guess is None:
                todo.append(t._replace(guess=tuple(answer["guess"])))
            else:
                below = t.below
                for which, part in enumerate(answer["parts"]):
                    own = tuple(p for p in t.places if below <= p < below + part["n"])
                    if own and part["low"] == part["high"]:
                        found.update({(t.column, p): part["low"] for p in own})
                    elif own:
                        at = [round(128 * r) for r in _ranks(own, below, part["n"])]
                        guess = tuple(answer["table"][min(128, max(0, x))] for x in at) if which == 1 else None
                        todo.append(Places(t.column, own, part["low"], part["high"], below, part["n"], guess))
                    below += part["n"]
    return found


def column_profile(df: DataFrame, columns: Sequence[str], bracket: int = BRACKET) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per column. NULLs don't count; NaN is above all numbers.

    Quartiles interpolate between the two neighbouring order statistics. A column without values has no row.
    """
    values = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    summaries = []
    for i in range(len(columns)):
        c = F.col(f"_{i}")
        number = F.when(~F.isnan(c), c)
        n = F.count(number)
        ends = [F.count(c).alias("count"), n.alias("numbers"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"), F.min(number).alias("low"), F.max(number).alias("high")]
        guess = _guess(number, F.array(*[F.lit(x) for share in QUARTILES.values() for x in (share - REACH, share, share + REACH)]))
        summaries.append(F.struct(*ends, guess.alias("guess")).alias(f"_{i}"))
    basic = values.agg(*summaries).first()
    places, wanted = {}, []
    for i in range(len(columns)):
        own = basic[f"_{i}"]
        for k, (name, share) in enumerate(QUARTILES.items()):
            place = (own["count"] - 1) * share
            places[i, name] = place
            numbers = tuple(p for p in {math.floor(place), math.ceil(place)} if 0 <= p < own["numbers"])
            if numbers:
                wanted.append(Places(i, numbers, own["low"], own["high"], 0, own["numbers"], tuple(own["guess"][3 * k : 3 * k + 3])))
    found = order_statistics(values, wanted, bracket)
    rows = []
    for i, c in enumerate(columns):
        own, quartiles = basic[f"_{i}"], []
        for name in QUARTILES:
            low, high = (found.get((i, p), math.nan) for p in (math.floor(places[i, name]), math.ceil(places[i, name])))
            quartiles.append(low + (high - low) * (places[i, name] - math.floor(places[i, name])))
        if own["count"]:
            rows.append((c, own["count"], own["mean"], own["std"], own["min"], *quartiles, own["max"]))
    kinds = ["column string", "count long", *[f"{n} double" for n in ("mean", "std", "min", *QUARTILES, "max")]]
    return df.sparkSession.createDataFrame(rows, ", ".join(kinds))
