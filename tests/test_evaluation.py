import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from depthmill.operators import evaluation as E


def scored(spark, seed=0, n=400, digits=2):
    rng = np.random.default_rng(seed)
    label = rng.integers(0, 2, n)
    score = np.clip(rng.normal(0.45 + 0.1 * label, 0.2), 0, 1).round(digits)
    rows = [(int(a), float(b)) for a, b in zip(label, score)]
    return spark.createDataFrame(rows, "label int, score double").repartition(4), label, score


def curve(label, score):
    points = [(None, 0.0, 0.0)]
    for t in sorted(set(score), reverse=True):
        hit = score >= t
        points.append((float(t), (hit & (label == 1)).sum() / (label == 1).sum(), (hit & (label == 0)).sum() / (label == 0).sum()))
    return points


def test_roc_auc_and_threshold(spark):
    for seed, digits in ((1, 1), (2, 2), (3, 6)):
        df, label, score = scored(spark, seed, digits=digits)
        want = curve(label, score)
        points = E.roc_points(df)
        got = sorted(((r.threshold, r.tpr, r.fpr) for r in points.collect()), key=lambda p: -(p[0] if p[0] is not None else 9))
        assert [p[0] for p in got] == [p[0] for p in want]
        np.testing.assert_allclose([p[1:] for p in got], [p[1:] for p in want])
        pos, neg = score[label == 1], score[label == 0]
        pairs = (pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2
        assert E.roc_auc(df).first().roc_auc == pytest.approx(pairs)
        best = max(want, key=lambda p: (p[1] - p[2], 9 if p[0] is None else p[0]))
        row = E.best_threshold(points).first()
        assert row.threshold == best[0] and row.youden_j == pytest.approx(best[1] - best[2])


def test_no_score_beats_chance(spark):
    df = spark.createDataFrame([(0, 0.9), (1, 0.1)], "label int, score double")
    row = E.best_threshold(E.roc_points(df)).first()
    assert row.threshold is None and row.youden_j == 0.0


def test_one_class_only(spark):
    df = spark.createDataFrame([(0, 0.9), (0, 0.1)], "label int, score double")
    assert E.roc_auc(df).first().roc_auc is None
    row = E.binary_metrics(E.with_prediction(df)).first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (0.5, 0.0, 0.0, 0.0)


def test_one_score_for_all_rows(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("label"), F.lit(0.5).alias("score"))
    assert E.roc_auc(df).first().roc_auc == 0.5
    assert E.roc_points(df).count() == 2


def test_reports(spark):
    df, label, score = scored(spark, 5)
    predicted = (score >= 0.5).astype(int)
    matrix = {r.label: (r.predicted_0, r.predicted_1) for r in E.confusion_matrix(E.with_prediction(df, 0.5)).collect()}
    for y in (0, 1):
        assert matrix[y] == tuple(int(((label == y) & (predicted == p)).sum()) for p in (0, 1))
    report = {r["class"]: r for r in E.class_report(E.with_prediction(df, 0.5)).collect()}
    for name, cls in (("down", 0), ("up", 1)):
        hit = ((label == cls) & (predicted == cls)).sum()
        assert report[name].precision == pytest.approx(hit / (predicted == cls).sum())
        assert report[name].recall == pytest.approx(hit / (label == cls).sum())
        assert report[name].support == (label == cls).sum()
    assert report["macro avg"].f1 == pytest.approx((report["down"].f1 + report["up"].f1) / 2)
    weights = [report[c].support / len(label) for c in ("down", "up")]
    assert report["weighted avg"].recall == pytest.approx(weights[0] * report["down"].recall + weights[1] * report["up"].recall)
    row = E.evaluate(df, 0.5).first()
    assert row.accuracy == pytest.approx((label == predicted).mean()) == report["accuracy"].precision
    assert E.positive_share(df).first().positive_share == pytest.approx(label.mean())


def test_prefix_sums_over_many_ranges(spark, monkeypatch):
    """Ranges of seven scores give the same points and area as one, and the input is read once."""
    rng = np.random.default_rng(6)
    rows = [(float(x), int(y)) for x, y in zip(rng.integers(0, 90, 400) / 7, rng.integers(0, 2, 400))]
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, "score double, label int").mapInArrow(counted, "score double, label int")
    whole = sorted(map(tuple, E.roc_points(df).collect()), key=str)
    assert seen.value == len(rows)
    area = E.roc_auc(df).first().roc_auc
    small = lambda counts, band_rows=7, cumulative=E._cumulative: cumulative(counts, band_rows)
    monkeypatch.setattr(E, "_cumulative", small)
    assert sorted(map(tuple, E.roc_points(df).collect()), key=str) == whole
    assert E.roc_auc(df).first().roc_auc == pytest.approx(area)
    assert area == pytest.approx(roc_auc_plain(rows))


def roc_auc_plain(rows):
    up, down = ([s for s, y in rows if y == c] for c in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in up for b in down) / (len(up) * len(down))


@pytest.mark.parametrize("bracket", [1, 7])
def test_quartiles_by_narrowing(spark, bracket):
    """Brackets that take several passes, values that hold most rows, and neighbours that part."""
    rng = np.random.default_rng(5)
    n = 20_002
    columns = {
        "smooth": rng.normal(size=n), "few": rng.integers(0, 3, n).astype(float), "one": np.full(n, 7.0), "parted": np.repeat([0.0, 1.0], n // 2),
        "heavy": np.where(rng.random(n) < 0.7, 5.0, rng.normal(size=n)), "nan": np.where(rng.random(n) < 0.4, np.nan, rng.normal(size=n)),
    }
    pdf = pd.DataFrame(columns)
    df = spark.createDataFrame([tuple(map(float, r)) for r in pdf.itertuples(index=False)], ", ".join(f"{c} double" for c in columns)).repartition(3)
    for row in E.column_profile(df, list(columns), bracket).collect():
        values = np.sort(columns[row["column"]])  # NaN comes last
        for name, share in E.QUARTILES.items():
            place = (n - 1) * share
            low, high = values[int(np.floor(place))], values[int(np.ceil(place))]
            np.testing.assert_allclose(row[name], low + (high - low) * (place - np.floor(place)))
    assert E.column_profile(df.limit(0), ["few"]).count() == 0


def test_profile_equals_pandas(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=501), "b": rng.integers(0, 4, 501).astype(float), "c": rng.exponential(9, 501)})
    df = spark.createDataFrame([tuple(map(float, r)) for r in pdf.itertuples(index=False)], "a double, b double, c double").repartition(4)
    df = df.unionByName(spark.createDataFrame([(None, 1.0, None)], df.schema))
    pdf.loc[len(pdf)] = [np.nan, 1.0, np.nan]
    want = pdf.describe()
    for row in E.column_profile(df, ["a", "b", "c"]).collect():
        col = want[row["column"]]
        got = [row["count"], row["mean"], row["std"], row["min"], row.p25, row.p50, row.p75, row["max"]]
        np.testing.assert_allclose(got, col.values)
