"""Quote and level arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from depthmill.constants import DELETED_QTY

# Plain decimal notation only: rules out type suffixes such as "1.5d" and the words nan and inf.
_NUMBER = r"^\s*[+-]?[0-9.]+([eE][+-]?[0-9]+)?\s*$"


def safe_double(text: Column) -> Column:
    """Text to double, NULL for anything that is not a plain number."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0).cast("double"))


def mid_price(bid: Column, ask: Column) -> Column:
    return (bid + ask) / F.lit(2.0)


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def spread_bps(bid: Column, ask: Column) -> Column:
    return ratio(spread(bid, ask), mid_price(bid, ask)) * F.lit(10000.0)


def imbalance(bid: Column, ask: Column) -> Column:
    """Signed pressure in [-1, 1]; takes counts or quantities."""
    bid, ask = bid.cast("double"), ask.cast("double")
    return ratio(bid - ask, bid + ask)


def count_ratio(bid_count: Column, ask_count: Column) -> Column:
    return ratio(bid_count.cast("double"), ask_count.cast("double"))


def vwap_gap(vwap: Column, mid: Column, scale: float = 1.0) -> Column:
    """Distance of the weighted price from the mid: a ratio, or basis points with scale 10000."""
    gap = ratio(vwap - mid, mid)
    return gap if scale == 1.0 else gap * F.lit(scale)


def level_count(levels: Column) -> Column:
    """Number of levels, 0 for a missing side."""
    return F.coalesce(F.size(levels), F.lit(0))


def level_field(levels: Column, position: int, field: int) -> Column:
    """Price (field 0) or quantity (field 1) of one level, NULL when absent."""
    return F.get(F.get(levels, F.lit(position)), F.lit(field))


def depth_total(levels: Column) -> Column:
    """Sum of the positive quantities of one side; NULL, not zero, when there are none."""
    kept = F.filter(
        F.transform(levels, lambda level: safe_double(F.get(level, F.lit(1)))),
        lambda qty: qty > 0,
    )
    return F.when(F.size(kept) > 0, F.aggregate(kept, F.lit(0.0), lambda total, qty: total + qty))


def deletion_count(levels: Column) -> Column:
    return level_count(F.filter(levels, lambda level: F.get(level, F.lit(1)) == DELETED_QTY))


def id_span(first_id: Column, last_id: Column) -> Column:
    return last_id - first_id + F.lit(1)


def price_number(price: Column) -> Column:
    """Ordering value of a text price; equality stays on the text."""
    return price.try_cast("decimal(28,8)")
