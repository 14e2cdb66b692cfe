import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from depthmill.operators.ordered import (
    running_totals,
    sliced_window,
    with_neighbours,
    without_neighbours,
)


def frame(spark, seed, rows=300, keys=3):
    rng = random.Random(seed)
    data = []
    for key in [None, *[f"k{i}" for i in range(keys)]]:
        for at in sorted(rng.sample(range(5000), rows // (keys + 1))):
            data.append((key, at, rng.choice([None, rng.randrange(100)])))
    return spark.createDataFrame(data, "k string, at long, v long").repartition(5)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_sliced_windows_equal_whole_windows(spark):
    for seed, width in ((1, 7), (2, 100), (3, 100_000)):
        df = frame(spark, seed)
        whole = Window.partitionBy("k").orderBy("at")

        def columns(w):
            return {
                "back1": F.lag("v", 1).over(w),
                "back4": F.lag("at", 4).over(w),
                "ahead5": F.lead("at", 5).over(w),
                "sum5": F.sum("v").over(w.rowsBetween(-4, 0)),
                "count5": F.count("v").over(w.rowsBetween(-4, 0)),
            }

        near = with_neighbours(df, ["k"], ["at"], F.floor(F.col("at") / width), before=4, after=5)
        sliced = without_neighbours(near.withColumns(columns(sliced_window(["k"], ["at"]))))
        assert rows(sliced) == rows(df.withColumns(columns(whole)))


def test_rows_without_an_order_value_come_first(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", 1, 2), ("k", 40, 3)], "k string, at long, v long")
    near = with_neighbours(df, ["k"], ["at"], F.floor(F.col("at") / 10), before=1, after=1)
    window = sliced_window(["k"], ["at"])
    out = without_neighbours(near.withColumns({"p": F.lag("v").over(window), "n": F.lead("v").over(window)}))
    assert [(r.p, r.n) for r in out.orderBy("v").collect()] == [(None, 2), (1, 3), (2, None)]


def test_running_totals_equal_whole_window(spark):
    for width in (3, 250, 10**6):
        df = frame(spark, 5)
        whole = Window.partitionBy("k").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
        expected = df.withColumns({"n": F.count(F.lit(1)).over(whole), "s": F.sum(F.coalesce("v", F.lit(0))).over(whole)})
        sums = {"n": F.lit(1), "s": F.coalesce("v", F.lit(0))}
        assert rows(running_totals(df, ["k"], ["at"], F.floor(F.col("at") / width), sums)) == rows(expected)


def test_running_totals_descending_without_keys(spark):
    df = spark.range(500).select(F.col("id").alias("x"))
    got = running_totals(df, [], [F.desc("x")], -F.floor(F.col("x") / 40), {"n": F.lit(1)})
    assert got.where(F.col("n") != 500 - F.col("x")).count() == 0


def test_no_window_spans_a_whole_key_of_rows(spark):
    """The wide window is keyed by slice; only slice edges meet in a per-key window."""
    df = frame(spark, 1)
    near = with_neighbours(df, ["k"], ["at"], F.floor(F.col("at") / 10), before=1)
    plan = without_neighbours(near.withColumn("p", F.lag("v").over(sliced_window(["k"], ["at"]))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text
    per_key = [line for line in text.splitlines() if "hashpartitioning(k#" in line and "_slice" not in line]
    assert len(per_key) == 1


def test_times_and_structs_survive_the_copies(spark):
    day = dt.datetime(2024, 1, 1)
    data = [("a", day + dt.timedelta(hours=7 * i), (i, "x")) for i in range(20)]
    df = spark.createDataFrame(data, "symbol string, t timestamp, s struct<n:int,c:string>")
    near = with_neighbours(df, ["symbol"], ["t"], F.to_date("t"), before=2, after=2)
    out = without_neighbours(near.withColumn("prev", F.lag("s.n", 2).over(sliced_window(["symbol"], ["t"]))))
    assert out.columns == ["symbol", "t", "s", "prev"]
    assert [r.prev for r in out.orderBy("t").collect()] == [None, None, *range(18)]
