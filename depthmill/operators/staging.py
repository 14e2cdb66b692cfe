"""Bronze rows to clean quotes, and quotes to per-message metrics."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from depthmill.functions import quotes as Q

PRICE_COLS = ["best_bid_price", "best_bid_qty", "best_ask_price", "best_ask_qty"]


def dedup_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key: the newest. Rows whose key is NULL form one group.

    The rank-1 filter is applied in every task before the shuffle (WindowGroupLimit), so a key with very
    many copies leaves each task as one row.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in newest]))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def dedup_stream(df: DataFrame, lateness: str = "2 minutes") -> DataFrame:
    """Streaming counterpart: the first arrival per key wins, state is dropped after `lateness`."""
    return df.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark(["symbol", "last_update_id"])


def to_numbers(df: DataFrame) -> DataFrame:
    return df.withColumns({c: Q.safe_double(F.col(c)) for c in PRICE_COLS})


def valid_quotes(df: DataFrame) -> DataFrame:
    """Both prices present and positive, bid strictly below ask (locked and crossed books go).

    A positive bid below the ask implies the rest; comparisons with NULL drop the row.
    """
    bid, ask = F.col("best_bid_price"), F.col("best_ask_price")
    return df.where((bid > 0) & (bid < ask))


def stage_quotes(bronze: DataFrame) -> DataFrame:
    """Batch staging: de-duplicate, cast, filter."""
    latest = dedup_latest(bronze, ["symbol", "last_update_id"], ["event_ts", "first_update_id"])
    return latest.transform(to_numbers).transform(valid_quotes)


def stage_quotes_stream(bronze: DataFrame, lateness: str = "2 minutes") -> DataFrame:
    return dedup_stream(bronze, lateness).transform(to_numbers).transform(valid_quotes)


def price_metrics(staged: DataFrame) -> DataFrame:
    bid, ask = F.col("best_bid_price"), F.col("best_ask_price")
    return staged.withColumns(
        {
            "mid_price": Q.mid_price(bid, ask),
            "spread": Q.spread(bid, ask),
            "spread_bps": Q.spread_bps(bid, ask),
            "order_imbalance": Q.imbalance(F.col("bid_count"), F.col("ask_count")),
        }
    )


def depth_metrics(staged: DataFrame) -> DataFrame:
    return staged.withColumns(
        {
            "bid_depth_total": Q.depth_total(F.col("raw_bids")),
            "ask_depth_total": Q.depth_total(F.col("raw_asks")),
        }
    )


def quote_metrics(staged: DataFrame) -> DataFrame:
    """Silver: six derived columns per message. Row-local, so it is the same for batch and stream."""
    return staged.transform(price_metrics).transform(depth_metrics)
