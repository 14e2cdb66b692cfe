"""Decision rules and display formats."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def direction(probability: Column, threshold: float | Column) -> Column:
    return F.when(probability >= threshold, "up").when(probability.isNotNull(), "down")


def predicted_class(probability: Column, threshold: float | Column = 0.5) -> Column:
    return (probability >= threshold).cast("int")


def confidence(probability: Column, prediction: Column) -> Column:
    """Certainty in the direction that was called, not always the probability of a rise."""
    return F.when(prediction == "up", probability).otherwise(F.lit(1.0) - probability)


def rounded(value: Column, digits: int) -> Column:
    """Half-even rounding."""
    return F.bround(value, digits)


def age_seconds(now: Column, moment: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(moment)) / F.lit(1e6)


def feature_map(columns: list[str], digits: int = 6) -> Column:
    """Name to rounded value, kept with a prediction for audit."""
    pairs = [part for name in columns for part in (F.lit(name), rounded(F.col(name), digits))]
    return F.create_map(*pairs)


def as_percent(share: Column, digits: int = 2) -> Column:
    return F.concat(F.format_number(share * 100, digits), F.lit("%"))


def as_price(value: Column) -> Column:
    return F.format_number(value, 2)


def as_quantity(value: Column) -> Column:
    return F.format_string("%.8f", value)


def as_time_ms(moment: Column) -> Column:
    return F.concat(F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit(" UTC"))


def alert_text(component: str, checks: int | str) -> str:
    """What a stall alert says."""
    return f"{component} is silent: nothing new in {checks} checks"
