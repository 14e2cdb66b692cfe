"""Values that are part of the data contract."""

# The exchange message format and the published table contract.
DEFAULT_SYMBOL = "BTCUSDT"
PREDICTION_TARGET = "price_direction_5min"
MODEL_VERSION = "v1"
DELETED_QTY = "0.00000000"
FEATURE_COLS = [
    "vwap",
    "spread_bps_avg",
    "imbalance_avg",
    "depth_ratio",
    "mid_price_avg",
    "spread_change",
    "imbalance_change",
    "vwap_vs_mid",
    "rolling_spread_mean",
    "rolling_imbalance_std",
]
LABEL_HORIZON = 5
ROLLING_ROWS = 5
MIN_TRAINING_ROWS = 100
TEST_FRACTION = 0.2
DRIFT_LAST = 100
DRIFT_SHARE = 0.8
FAILURE_THRESHOLD = 3
SPOT_CHECK_LEVELS = 5
TOP_LEVELS = 10
CONFIDENCE_BOUNDS = [0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.99, 1.0]
MODEL_GATE_AUC = 0.70
GOLD_REQUIRED_COLS = [
    "window_start",
    "mid_price_avg",
    "spread_bps_avg",
    "imbalance_avg",
    "depth_ratio",
    "vwap",
]
METADATA_REQUIRED_KEYS = [
    "model_version",
    "optimal_threshold",
    "feature_cols",
    "test_metrics",
]

# Bars of any width are aligned to this instant (Monday 2000-01-03 00:00 UTC), in epoch seconds.
BUCKET_ORIGIN_SECONDS = 946857600
