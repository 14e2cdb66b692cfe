"""Ordered work without one task per key.

A window over a whole symbol puts every row of that symbol in one task. The helpers here cut each key's
timeline into slices, run the window inside (key, slice), and carry only what crosses a slice border:
a few edge rows for row-offset windows, one total per slice for running sums. The summary relation has a
handful of rows per slice, so the one window over it stays small however many rows a slice holds.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "_slice"
COPY = "_copy"


def _edges(sliced: DataFrame, keys: list[str], order: list[str], rows: int, ascending: bool) -> DataFrame:
    """The first or last `rows` rows of every slice; a rank filter, so tasks trim before the shuffle."""
    direction = [F.asc(c) if ascending else F.desc(c) for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*direction))
    return sliced.withColumn("_rank", rank).where(F.col("_rank") <= rows).drop("_rank")


def _carried(sliced: DataFrame, keys: list[str], order: list[str], rows: int, earlier: bool) -> DataFrame:
    """Copies of the `rows` rows beside each slice, tagged with the slice that needs them."""
    names = sliced.columns
    timeline = Window.partitionBy(*keys).orderBy(*[F.asc(c) for c in order])
    row = F.struct(*[F.col(c) for c in names])
    if earlier:
        edges = _edges(sliced, keys, order, rows, ascending=False)
        beside = F.collect_list(row).over(timeline.rowsBetween(-rows, -1))
        border = F.lag(SLICE).over(timeline)
    else:
        edges = _edges(sliced, keys, order, rows, ascending=True)
        beside = F.collect_list(row).over(timeline.rowsBetween(1, rows))
        border = F.lead(SLICE).over(timeline)
    # Among edge rows only, the rows beside a slice's outermost one are exactly its nearest outside rows.
    at_border = edges.select(F.col(SLICE).alias("_home"), beside.alias("_beside"), border.alias("_next")).where(
        (F.size("_beside") > 0) & ~F.col("_next").eqNullSafe(F.col("_home"))
    )
    copies = at_border.select("_home", F.explode("_beside").alias("_row"))
    return copies.select(*[F.col("_home" if c == SLICE else f"_row.{c}").alias(c) for c in names])


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Add to each (keys, slice) group copies of the rows just outside it, marked in `_copy`.

    Any window that looks at most `before` rows back and `after` rows ahead gives the same result over
    `sliced_window` as over the whole key. `slice_by` must rise with `order`. Drop the copies with
    `without_neighbours`.
    """
    keys, order = list(keys), list(order)
    sliced = df.withColumn(SLICE, slice_by)
    parts = [sliced.withColumn(COPY, F.lit(False))]
    if before:
        parts.append(_carried(sliced, keys, order, before, earlier=True).withColumn(COPY, F.lit(True)))
    if after:
        parts.append(_carried(sliced, keys, order, after, earlier=False).withColumn(COPY, F.lit(True)))
    return reduce(DataFrame.unionByName, parts)


def sliced_window(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys, SLICE).orderBy(*[F.asc(c) for c in order])


def without_neighbours(df: DataFrame) -> DataFrame:
    return df.where(~F.col(COPY)).drop(SLICE, COPY)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    slice_by: Column,
    sums: dict[str, Column],
) -> DataFrame:
    """Inclusive running sums per key in `order`, as one column per entry of `sums`.

    Rows must be unique in (keys, order). `slice_by` must rise with `order`. Two levels: totals per slice
    (one row each) give every slice its starting value, a window inside the slice adds the rest.
    """
    keys = list(keys)
    inputs = {f"_in_{name}": value for name, value in sums.items()}
    sliced = df.withColumn(SLICE, slice_by).withColumns(inputs)
    totals = sliced.groupBy(*keys, SLICE).agg(*[F.sum(name).alias(name) for name in inputs])
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    # One opening row per slice carries the total of all earlier slices into that slice's own window.
    opening = totals.select(
        *keys, SLICE, *[F.sum(name).over(earlier).alias(name) for name in inputs], F.lit(True).alias(COPY)
    )
    rows = sliced.withColumn(COPY, F.lit(False)).unionByName(opening, allowMissingColumns=True)
    inside = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(F.desc(COPY), *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.withColumns({name: F.sum(f"_in_{name}").over(inside) for name in sums})
    return summed.where(~F.col(COPY)).select(*df.columns, *sums)


def running_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_by: Column, name: str, value: Column) -> DataFrame:
    """Add `name`: the newest `value` that is not NULL among a key's rows up to each row, in `order`.

    `slice_by` must rise with `order`. Two levels, as in `running_totals`: the newest value of each slice opens the next ones.
    """
    keys, order = list(keys), list(order)
    sliced = df.withColumn(SLICE, slice_by).withColumn(name, value)
    newest = sliced.groupBy(*keys, SLICE).agg(F.max_by(name, F.when(F.col(name).isNotNull(), F.struct(*order))).alias(name))
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    opening = newest.select(*keys, SLICE, F.last(name, ignorenulls=True).over(earlier).alias(name), F.lit(True).alias(COPY))
    rows = sliced.withColumn(COPY, F.lit(False)).unionByName(opening, allowMissingColumns=True)
    inside = Window.partitionBy(*keys, SLICE).orderBy(F.desc(COPY), *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = rows.withColumn(name, F.last(name, ignorenulls=True).over(inside))
    return known.where(~F.col(COPY)).select(*df.columns, name)
