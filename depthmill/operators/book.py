"""The order book as a keyed relation: (symbol, side, price) -> quantity."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from depthmill.constants import DELETED_QTY, SPOT_CHECK_LEVELS, TOP_LEVELS
from depthmill.functions import quotes as Q
from depthmill.functions import scoring as S
from depthmill.operators.ordered import running_totals


def explode_levels(messages: DataFrame, *extra: str) -> DataFrame:
    """One row per changed level: symbol, side, price, qty, ids and position in its array."""
    sides = F.array(
        F.struct(F.lit("bid").alias("side"), F.col("raw_bids").alias("levels")),
        F.struct(F.lit("ask").alias("side"), F.col("raw_asks").alias("levels")),
    )
    base = ["symbol", *extra, "first_update_id", "last_update_id"]
    by_side = messages.select(*base, F.explode(sides).alias("_side"))
    levels = by_side.select(*base, F.col("_side.side").alias("side"), F.posexplode("_side.levels").alias("pos", "_level"))
    return levels.select(
        *base,
        "side",
        "pos",
        F.get("_level", F.lit(0)).alias("price"),
        F.get("_level", F.lit(1)).alias("qty"),
    )


def snapshot_levels(snapshots: DataFrame) -> DataFrame:
    """Snapshot documents to levels, dated at the snapshot id and placed before any later diff."""
    documents = snapshots.select(
        "symbol",
        F.col("lastUpdateId").alias("first_update_id"),
        F.col("lastUpdateId").alias("last_update_id"),
        F.col("bids").alias("raw_bids"),
        F.col("asks").alias("raw_asks"),
    )
    return explode_levels(documents)


def _write_order(wide: bool) -> Column:
    """(update id, array position) in one long, where a value that does not fit stops the job, or in a decimal for any."""
    update, pos = F.col("last_update_id"), F.col("pos")
    missing = F.when(update.isNull() | pos.isNull(), F.raise_error(F.lit("a level change has no update id or position")))
    if wide:
        packed = update.cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + pos.cast("decimal(10,0)")
        return F.coalesce(missing.cast("decimal(32,0)"), packed)
    fits = (update >= 0) & (update < F.lit(1 << 47)) & (pos < (1 << 16))
    packed = F.shiftleft(update, 16).bitwiseOR(pos.cast("long"))
    problem = F.raise_error(F.lit("update id or level position too large: call with wide_ids=True"))
    return F.coalesce(missing.cast("long"), F.when(fits, packed).otherwise(problem.cast("long")))


def _amount() -> Column:
    """A level's quantity as a number, by value; NULL when it cannot be read."""
    return F.col("qty").try_cast("decimal(38,18)")


def _amount_text(amount: Column) -> Column:
    """Eight digits, and more only where the value has them."""
    short = amount.cast("decimal(28,8)")
    return F.when(amount == short, short.cast("string")).otherwise(F.regexp_replace(amount.cast("string"), "0+$", ""))


def unreadable_levels(levels: DataFrame) -> DataFrame:
    """Level changes whose quantity is not a number; `book_state` leaves them out."""
    return levels.where(_amount().isNull())


def book_state(
    levels: DataFrame,
    base: DataFrame | None = None,
    as_of: int | None = None,
    keys: tuple[str, ...] = ("symbol",),
    exact_text: bool = False,
    wide_ids: bool = False,
) -> DataFrame:
    """Book after all level changes up to `as_of`: the last write per price wins, deletions vanish.

    No serial replay: each (symbol, side, price) is reduced on its own, map-side first, so a busy symbol
    or a busy price leaves every task as one row. `base` adds snapshot levels under the later diffs.
    Quantities travel as decimals with 18 digits, which keeps this a hash aggregation; `exact_text` keeps
    their text, takes only the exchange's own zero for a deletion, and sorts. Changes whose quantity cannot be
    read are no writes (`unreadable_levels`). Ids from 2^47 on need `wide_ids`, with equal results.
    """
    changes = levels if as_of is None else levels.where(F.col("last_update_id") <= as_of)
    if base is not None:
        changes = base.unionByName(changes)
    group = [*keys, "side", "price"]
    if exact_text:
        last = F.struct("last_update_id", "pos", "qty")
        kept = changes.groupBy(*group).agg(F.max(last).alias("_last"))
        state = kept.select(*group, "_last.qty", "_last.last_update_id")
        return state.where(F.coalesce(F.col("qty") != DELETED_QTY, F.lit(True)))
    kept = changes.where(_amount().isNotNull()).groupBy(*group).agg(
        F.max_by(_amount(), _write_order(wide_ids)).alias("_qty"), F.max("last_update_id").alias("last_update_id")
    )
    return kept.where(F.col("_qty") != 0).select(*group, _amount_text(F.col("_qty")).alias("qty"), "last_update_id")


def _best_first(side: Column, price: Column) -> Column:
    """Rising for both sides from the best price outward."""
    return F.when(side == "bid", -price).otherwise(price)


def _depth_order() -> Column:
    return _best_first(F.col("side"), Q.price_number(F.col("price")))


def top_levels(state: DataFrame, n: int = TOP_LEVELS, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """The best `n` levels of each side with their rank; text prices are compared as numbers.

    The rank filter trims to `n` rows per side in every task before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(*keys, "side").orderBy("_order", "price"))
    ranked = state.withColumn("_order", _depth_order()).withColumn("rank", rank)
    return ranked.where(F.col("rank") <= n).drop("_order")


def best_spread(state: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Best bid, best ask and their distance to two digits; NULL when a side is empty."""
    price = Q.price_number(F.col("price"))
    best = state.groupBy(*keys).agg(
        F.max(F.when(F.col("side") == "bid", price)).alias("best_bid"),
        F.min(F.when(F.col("side") == "ask", price)).alias("best_ask"),
        F.max("last_update_id").alias("last_update_id"),
    )
    return best.withColumn("spread", F.bround(F.col("best_ask") - F.col("best_bid"), 2))


def depth_ladder(state: DataFrame, band: float = 1000.0, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Every level with the quantity accumulated from the best price outward, in bands of `band` price units."""
    ordered = state.withColumn("_order", _depth_order())
    slices = F.floor(F.col("_order").cast("double") / F.lit(band))
    quantity = {"cumulative_qty": Q.safe_double(F.col("qty"))}
    return running_totals(ordered, [*keys, "side"], ["_order", "price"], slices, quantity).drop("_order")


def ladder_text(ladder: DataFrame) -> DataFrame:
    """Display form of the ladder."""
    return ladder.select(
        "symbol",
        "side",
        S.as_price(Q.safe_double(F.col("price"))).alias("price_text"),
        S.as_quantity(Q.safe_double(F.col("qty"))).alias("qty_text"),
        S.as_quantity(F.col("cumulative_qty")).alias("cumulative_text"),
    )


def first_levels(snapshots: DataFrame, n: int = SPOT_CHECK_LEVELS) -> DataFrame:
    """The leading `n` entries of each snapshot array, ranked as delivered (best first)."""
    trimmed = snapshots.withColumns({c: F.slice(c, 1, n) for c in ("bids", "asks")})
    return snapshot_levels(trimmed).withColumn("rank", F.col("pos") + 1)


def spot_check(book: DataFrame, reference: DataFrame, n: int = SPOT_CHECK_LEVELS) -> DataFrame:
    """Rank-by-rank price comparison of two top-`n` relations, per symbol.

    Prices are compared as text and quantities are ignored. The total is always 2n; ranks missing on one
    side count as neither match nor mismatch.
    """
    ours = book.select("symbol", "side", "rank", F.col("price").alias("book_price"))
    theirs = reference.select("symbol", "side", "rank", F.col("price").alias("snapshot_price"))
    pairs = ours.join(theirs, ["symbol", "side", "rank"])
    same = F.col("book_price") == F.col("snapshot_price")
    # At most 2n entries per symbol.
    wrong = F.collect_list(F.when(~same, F.struct("side", "rank", "book_price", "snapshot_price")))
    return pairs.groupBy("symbol").agg(F.count_if(same).alias("matched"), F.array_sort(wrong).alias("mismatches")).select(
        "symbol",
        "matched",
        F.lit(2 * n).alias("total"),
        F.bround(F.col("matched") / F.lit(2 * n) * 100, 1).alias("pct"),
        "mismatches",
    )
