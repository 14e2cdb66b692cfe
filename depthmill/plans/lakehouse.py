"""The two published table chains as whole jobs."""

from pyspark.sql import DataFrame

from depthmill.operators import bars as B
from depthmill.operators import features as X
from depthmill.operators import parse as P
from depthmill.operators import staging as S
from depthmill.sources import writers as W


def build_depth_tables(bronze: DataFrame, folder: str, widths: dict[str, str] | None = None) -> dict[str, str]:
    """Bronze to silver, then bars of each width from the stored silver ticks (never bars from bars)."""
    widths = widths or {"gold_features_1m": "1 minute", "gold_features_5m": "5 minutes"}
    paths = {"silver_order_book": f"{folder}/silver_order_book"}
    silver = bronze.transform(S.stage_quotes).transform(S.quote_metrics)
    W.spread(silver).write.mode("overwrite").partitionBy("date", "symbol").parquet(paths["silver_order_book"])
    stored = bronze.sparkSession.read.schema(silver.schema).parquet(paths["silver_order_book"])
    for name, width in widths.items():
        paths[name] = f"{folder}/{name}"
        W.refresh_table(B.depth_bars(stored, width), paths[name])
    return paths


def refresh_minute_tables(staging: DataFrame, folder: str) -> dict[str, int]:
    """Full refresh of the minute chain; row counts come from the writes themselves."""
    bars, bar_count = W.counted(B.top_bars(staging, "1 minute"), "silver_rows")
    W.refresh_table(bars, f"{folder}/silver_minute")
    stored = staging.sparkSession.read.schema(bars.schema).parquet(f"{folder}/silver_minute")
    gold, gold_count = W.counted(X.gold_features(stored), "gold_rows")
    W.refresh_table(gold, f"{folder}/gold_minute")
    return {"silver_minute": bar_count.get["rows"], "gold_minute": gold_count.get["rows"]}


def staging_of(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """Staging of the minute chain: parsed numbers, no de-duplication, no price filter, no level arrays."""
    return P.accepted(P.parse_depth(envelopes, value)).transform(P.best_only).transform(S.to_numbers)
