"""Declarative data checks: each one yields a row (check, failed_rows, status)."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One of: `violation` marks bad rows, `keys` must not repeat, `at_least` rows must be there, `state` counts faults without reading rows."""

    name: str
    violation: Column | None = None
    keys: tuple[str, ...] = ()
    null_keys: bool = True
    at_least: int | None = None
    state: Callable[[DataFrame], int] | None = None


def not_null(column: str) -> Check:
    return Check(f"not_null({column})", F.col(column).isNull())


def non_negative(column: str) -> Check:
    return Check(f"non_negative({column})", F.col(column) < 0)


def accepted_values(column: str, values: Sequence[str]) -> Check:
    known = F.col(column).isin(*values)
    return Check(f"accepted_values({column})", F.coalesce(~known, F.lit(True)))


def in_range(column: str, low: float, high: float) -> Check:
    """NULL passes; presence is another check."""
    return Check(f"in_range({column})", ~F.col(column).between(low, high))


def null_only_when(column: str, condition: Column) -> Check:
    return Check(f"null_only_when({column})", F.col(column).isNull() != F.coalesce(condition, F.lit(False)))


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count; NULL keys count as values."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > 1)
    return counts.withColumnRenamed("_rows", "n")


def unique_combination(columns: Sequence[str]) -> Check:
    """NULL keys count as values."""
    return Check(f"unique({', '.join(columns)})", keys=tuple(columns))


def unique(column: str) -> Check:
    """NULLs are not duplicates of each other here."""
    return Check(f"unique({column})", keys=(column,), null_keys=False)


def min_rows(rows: int) -> Check:
    """Fails by the number of missing rows; by itself it reads no more than `rows` rows."""
    return Check(f"min_rows({rows})", at_least=rows)


def not_empty() -> Check:
    return Check("not_empty", at_least=1)


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def required_columns(required: Sequence[str]) -> Check:
    return Check("required_columns", state=lambda df: len(missing_columns(df, required)))


def has_data_files() -> Check:
    return Check("has_data_files", state=lambda df: 0 if df.inputFiles() else 1)


def _one_pass(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failed rows of every check as one row, from one scan: every row names the checks it violates, its keys, and itself, and all
    these are counted by one aggregate, partial in every task; a second, small one sums up by check."""
    columns = sorted({c for check in checks for c in check.keys})
    none = {c: F.lit(None).cast(df.schema[c].dataType) for c in columns}

    def marked(number: int, own: Sequence[str] = ()) -> Column:
        return F.struct(F.lit(number).alias("number"), *[(F.col(c) if c in own else none[c]).alias(f"key_{i}") for i, c in enumerate(columns)])

    marks = []
    for number, check in enumerate(checks):
        if check.violation is not None:
            marks.append(F.when(check.violation, marked(number)))
        elif check.keys:
            known = F.lit(True) if check.null_keys else F.col(check.keys[0]).isNotNull()
            marks.append(F.when(known, marked(number, check.keys)))
    if any(check.at_least is not None for check in checks):
        marks.append(marked(-1))
    named = df.select(F.explode(F.array_compact(F.array(*marks))).alias("mark")).select("mark.*")
    counted = named.groupBy("number", *[f"key_{i}" for i in range(len(columns))]).agg(F.count(F.lit(1)).alias("rows"))
    of = lambda number: F.coalesce(F.sum(F.when(F.col("number") == number, F.col("rows"))), F.lit(0))
    failed = []
    for number, check in enumerate(checks):
        if check.keys:
            found = F.count_if((F.col("number") == number) & (F.col("rows") > 1))
        else:
            found = of(number) if check.violation is not None else F.greatest(F.lit(0), F.lit(check.at_least) - of(-1))
        failed.append(found.cast("long").alias(f"_{number}"))
    return counted.agg(*failed)


def run_checks(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """All checks that read rows in one scan of the table, whatever their number; the others without reading it."""
    reading = [c for c in checks if c.state is None]
    if not reading:
        counts = df.sparkSession.range(1).select(F.lit(0).alias("_none"))
    elif all(c.violation is not None for c in reading):
        counts = df.agg(*[F.count_if(c.violation).alias(f"_{i}") for i, c in enumerate(reading)])
    elif all(c.at_least is not None for c in reading):
        rows = df.limit(max(c.at_least for c in reading)).agg(F.count(F.lit(1)).alias("rows"))
        counts = rows.select(*[F.greatest(F.lit(0), F.lit(c.at_least) - F.col("rows")).cast("long").alias(f"_{i}") for i, c in enumerate(reading)])
    else:
        counts = _one_pass(df, reading)
    place = {id(c): i for i, c in enumerate(reading)}
    lines = [F.struct(F.lit(c.name).alias("check"), (F.lit(c.state(df)).cast("long") if c.state else F.col(f"_{place[id(c)]}")).alias("failed_rows")) for c in checks]
    status = F.when(F.col("failed_rows") == 0, "pass").otherwise("fail")
    return counts.select(F.inline(F.array(*lines))).select(F.lit(table).alias("table"), "check", "failed_rows", status.alias("status"))


def failures(report: DataFrame) -> DataFrame:
    return report.where(F.col("status") == "fail")


def staging_checks() -> list[Check]:
    present = ["last_update_id", "event_ts", "symbol", "best_bid_price", "best_ask_price"]
    return [*[not_null(c) for c in present], unique_combination(["symbol", "last_update_id"])]


def silver_checks() -> list[Check]:
    present = ["mid_price", "spread", "spread_bps", "symbol"]
    no_changes = (F.col("bid_count") + F.col("ask_count")) == 0
    return [
        *[not_null(c) for c in present],
        non_negative("spread"),
        in_range("order_imbalance", -1.0, 1.0),
        null_only_when("order_imbalance", no_changes),
    ]


def gold_checks() -> list[Check]:
    present = ["window_start", "symbol", "mid_price_open", "mid_price_close", "vwap"]
    return [*[not_null(c) for c in present], unique_combination(["window_start", "symbol"]), not_empty()]


def prediction_checks() -> list[Check]:
    return [accepted_values("prediction", ["up", "down"]), in_range("confidence", 0.0, 1.0)]
