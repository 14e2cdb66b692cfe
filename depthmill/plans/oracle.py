"""SQL twins of the registered queries, written independently of the Spark code.

Views are joined into WITH chains; every query ends in an explicit column list with doubles at six digits.
"""

from depthmill.constants import CONFIDENCE_BOUNDS, DEFAULT_SYMBOL, FEATURE_COLS
from depthmill.plans.adapters import LOG_THRESHOLD
from depthmill.plans.catalog import DIGITS, SCORE_THRESHOLD, SPOT_CHECK_ID, TIE_OFFSET

# name -> (views it reads, SQL)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, *reads: str):
    def add(sql: str) -> None:
        VIEWS[name] = (reads, sql)

    return add


def _chain(names: tuple[str, ...], seen: dict[str, str]) -> dict[str, str]:
    for name in names:
        if name not in seen:
            reads, sql = VIEWS[name]
            _chain(reads, seen)
            seen[name] = sql
    return seen


def query(*reads: str, body: str) -> str:
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in _chain(reads, {}).items())
    return f"WITH {ctes}\n{body}" if ctes else body


def six(value: str) -> str:
    """A double as both sides print it: see `catalog.comparable`."""
    return f"round({value} + {TIE_OFFSET}, {DIGITS}) + 0.0"


def r(names: str) -> str:
    return ", ".join(f"{six(n)} AS {n}" for n in names.split())


# ---- input views -------------------------------------------------------------------------------------------

view("retried")(
    """
    SELECT event_id, user_id, event_type, value, ts + to_seconds(attempt) AS ts
    FROM (SELECT *, unnest(CASE WHEN event_id % 17 = 0 THEN [0, 1] ELSE [0] END) AS attempt FROM events)
    """
)

view("quotes")(
    """
    SELECT event_type AS symbol, date_trunc('milliseconds', ts) AS event_ts,
           event_id AS first_update_id, event_id AS last_update_id,
           CAST(event_id % 5 + 1 AS INTEGER) AS bid_count, CAST(event_id % 3 AS INTEGER) AS ask_count,
           CASE WHEN event_id % 11 = 0 THEN NULL ELSE 100.0::DOUBLE + value END AS best_bid_price,
           value / 3 + 1 AS best_bid_qty,
           100.0::DOUBLE + value + (event_id % 7 - 1) * sqrt(value + 1) * 0.02::DOUBLE AS best_ask_price,
           CAST(event_id % 4 + 1 AS DOUBLE) AS best_ask_qty,
           CASE WHEN event_id % 13 = 0 THEN NULL ELSE value / 3 + 3 END AS bid_depth_total,
           CAST(event_id % 4 + 2 AS DOUBLE) AS ask_depth_total
    FROM events
    """
)


def _dec(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,8)) AS VARCHAR)"


view("messages", "retried")(
    f"""
    SELECT event_id, CASE WHEN event_id % 101 = 0 THEN 'junk' ELSE
        '{{"e":"depthUpdate","E":' || CASE WHEN event_id % 31 = 0 THEN '"bad"' ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END
        || CASE WHEN event_id % 29 = 0 THEN '' ELSE ',"s":"' || event_type || '"' END
        || ',"U":' || CAST(event_id * 3 + 1 AS VARCHAR) || ',"u":' || CAST(event_id * 3 + 3 AS VARCHAR)
        || ',"b":' || CASE WHEN event_id % 10 = 0 THEN '[]' ELSE
            '[["' || {_dec('100.0::DOUBLE + value')} || '","' || {_dec('CASE WHEN event_id % 5 = 0 THEN 0.0 ELSE value / 3 + 1 END')} || '"],["1.00000000","0.00000000"]]' END
        || CASE WHEN event_id % 23 = 0 THEN '' ELSE
            ',"a":[["' || {_dec('100.0::DOUBLE + value + (event_id % 7 - 1) * sqrt(value + 1) * 0.02::DOUBLE')} || '","' || {_dec('event_id % 4 + 1')} || '"]]' END
        || '}}' END AS message
    FROM retried
    """
)

view("parsed", "messages")(
    """
    SELECT message, json_valid(message) AS valid,
           CASE WHEN json_valid(message) THEN CAST(message AS JSON) END AS j
    FROM messages
    """
)

view("decoded", "parsed")(
    """
    SELECT message, valid, TRY_CAST(json_extract_string(j, '$.E') AS BIGINT) AS ms,
           json_extract_string(j, '$.s') AS s,
           CAST(json_extract_string(j, '$.U') AS BIGINT) AS first_update_id,
           CAST(json_extract_string(j, '$.u') AS BIGINT) AS last_update_id,
           CAST(json_extract(j, '$.b') AS VARCHAR[][]) AS raw_bids,
           CAST(json_extract(j, '$.a') AS VARCHAR[][]) AS raw_asks
    FROM parsed
    """
)

view("bronze", "decoded")(
    f"""
    SELECT strftime(make_timestamp(ms * 1000), '%Y-%m-%d %H:%M:%S') AS event_time,
           CAST(make_timestamp(ms * 1000) AS DATE) AS date, coalesce(s, '{DEFAULT_SYMBOL}') AS symbol,
           first_update_id, last_update_id,
           CAST(coalesce(len(raw_bids), 0) AS INTEGER) AS bid_count,
           CAST(coalesce(len(raw_asks), 0) AS INTEGER) AS ask_count,
           raw_bids[1][1] AS best_bid_price, raw_bids[1][2] AS best_bid_qty,
           raw_asks[1][1] AS best_ask_price, raw_asks[1][2] AS best_ask_qty,
           raw_bids, raw_asks, make_timestamp(ms * 1000) AS event_ts
    FROM decoded WHERE valid AND ms IS NOT NULL
    """
)

view("latest_bronze", "bronze")(
    """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY symbol, last_update_id ORDER BY event_ts DESC) AS rn FROM bronze)
    WHERE rn = 1
    """
)

view("staged", "latest_bronze")(
    """
    SELECT * FROM (
        SELECT * REPLACE (TRY_CAST(best_bid_price AS DOUBLE) AS best_bid_price, TRY_CAST(best_bid_qty AS DOUBLE) AS best_bid_qty,
                          TRY_CAST(best_ask_price AS DOUBLE) AS best_ask_price, TRY_CAST(best_ask_qty AS DOUBLE) AS best_ask_qty)
        FROM latest_bronze)
    WHERE best_bid_price > 0 AND best_ask_price > 0 AND best_bid_price < best_ask_price
    """
)


def _depth(side: str) -> str:
    return f"list_sum(list_filter(list_transform({side}, lambda x: TRY_CAST(x[2] AS DOUBLE)), lambda q: q > 0))"


_METRICS = """
    (best_bid_price + best_ask_price) / 2.0::DOUBLE AS mid_price,
    best_ask_price - best_bid_price AS spread,
    (best_ask_price - best_bid_price) / nullif((best_bid_price + best_ask_price) / 2.0::DOUBLE, 0) * 10000 AS spread_bps,
    CAST(bid_count - ask_count AS DOUBLE) / nullif(bid_count + ask_count, 0) AS order_imbalance
"""

view("silver", "staged")(
    f"SELECT *, {_METRICS}, {_depth('raw_bids')} AS bid_depth_total, {_depth('raw_asks')} AS ask_depth_total FROM staged"
)
view("raw_metrics", "quotes")(f"SELECT *, {_METRICS} FROM quotes")
view("metrics", "raw_metrics")(
    """
    SELECT * FROM raw_metrics
    WHERE best_bid_price IS NOT NULL AND best_ask_price IS NOT NULL AND best_bid_price > 0 AND best_ask_price > 0
      AND best_bid_price < best_ask_price
    """
)


def depth_bars(source: str, width: str) -> str:
    return f"""
    SELECT *, window_start + INTERVAL '{width}' AS window_end, mid_price_close - mid_price_open AS mid_price_change,
           bid_depth_avg / nullif(ask_depth_avg, 0) AS depth_ratio
    FROM (SELECT time_bucket(INTERVAL '{width}', event_ts) AS window_start, symbol, count(*) AS update_count,
                 arg_min(mid_price, (event_ts, last_update_id)) AS mid_price_open,
                 arg_max(mid_price, (event_ts, last_update_id)) AS mid_price_close,
                 avg(mid_price) AS mid_price_avg, stddev_samp(mid_price) AS mid_price_stddev,
                 sum(mid_price * (bid_depth_total + ask_depth_total))
                   / nullif(sum(bid_depth_total + ask_depth_total), 0) AS vwap,
                 avg(spread_bps) AS spread_bps_avg, min(spread_bps) AS spread_bps_min,
                 avg(order_imbalance) AS imbalance_avg,
                 avg(bid_depth_total) AS bid_depth_avg, avg(ask_depth_total) AS ask_depth_avg
          FROM {source} GROUP BY ALL)
    """


def top_bars(width: str) -> str:
    return f"""
    SELECT time_bucket(INTERVAL '{width}', event_ts) AS window_start, symbol,
           avg((best_bid_price + best_ask_price) / 2.0::DOUBLE) AS mid_price_avg,
           avg((best_ask_price - best_bid_price) / nullif((best_bid_price + best_ask_price) / 2.0::DOUBLE, 0) * 10000) AS spread_bps_avg,
           avg((best_bid_qty - best_ask_qty) / nullif(best_bid_qty + best_ask_qty, 0)) AS imbalance_avg,
           avg(CAST(bid_count AS DOUBLE) / nullif(ask_count, 0)) AS depth_ratio,
           sum((best_bid_price + best_ask_price) / 2.0::DOUBLE * (best_bid_qty + best_ask_qty))
             / nullif(sum(best_bid_qty + best_ask_qty), 0) AS vwap,
           avg(best_ask_price - best_bid_price) AS spread_avg, count(*) AS tick_count
    FROM quotes WHERE best_bid_price IS NOT NULL AND best_ask_price IS NOT NULL GROUP BY ALL
    """


view("hourly", "metrics")(depth_bars("metrics", "60 minutes"))
view("top_hourly", "quotes")(top_bars("60 minutes"))

BAR_COLS = (
    "window_start, window_end, symbol, update_count, "
    + r("mid_price_open mid_price_close mid_price_change mid_price_avg mid_price_stddev vwap spread_bps_avg")
    + ", "
    + r("spread_bps_min imbalance_avg bid_depth_avg ask_depth_avg depth_ratio")
)
TOP_COLS = "window_start, symbol, tick_count, " + r(
    "mid_price_avg spread_bps_avg imbalance_avg depth_ratio vwap spread_avg"
)
ENGINEERED = "spread_change imbalance_change vwap_vs_mid rolling_spread_mean rolling_imbalance_std"

view("featured", "hourly")(
    """
    SELECT *, spread_bps_avg - lag(spread_bps_avg) OVER w AS spread_change,
           imbalance_avg - lag(imbalance_avg) OVER w AS imbalance_change,
           (vwap - mid_price_avg) / nullif(mid_price_avg, 0) AS vwap_vs_mid,
           CASE WHEN count(spread_bps_avg) OVER w5 = 5 THEN avg(spread_bps_avg) OVER w5 END AS rolling_spread_mean,
           CASE WHEN count(imbalance_avg) OVER w5 = 5 THEN stddev_samp(imbalance_avg) OVER w5 END AS rolling_imbalance_std
    FROM hourly
    WINDOW w AS (PARTITION BY symbol ORDER BY window_start),
           w5 AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
    """
)
view("complete", "featured")(
    "SELECT * FROM featured WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FEATURE_COLS)
)
view("no_nulls", "complete")("SELECT * FROM complete WHERE mid_price_stddev IS NOT NULL")


def _labelled(source: str) -> str:
    return f"""
    SELECT * EXCLUDE (future), CAST(future > mid_price_avg AS INTEGER) AS label
    FROM (SELECT *, lead(mid_price_avg, 5) OVER (PARTITION BY symbol ORDER BY window_start) AS future FROM {source})
    """


view("hourly_labels", "hourly")(_labelled("hourly"))
view("training", "complete")(f"SELECT * FROM ({_labelled('complete')}) WHERE label IS NOT NULL")
view("training_no_nulls", "no_nulls")(f"SELECT * FROM ({_labelled('no_nulls')}) WHERE label IS NOT NULL")

view("level_changes")(
    f"""
    SELECT event_type AS symbol, event_id AS last_update_id, CASE WHEN user_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side,
           {_dec('CASE WHEN user_id % 2 = 0 THEN 60 ELSE 101 END + user_id % 40')} AS price,
           {_dec('CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE value END')} AS qty
    FROM events
    """
)


def state(source: str, order: str = "last_update_id", keep: str = "CAST(qty AS DECIMAL(18,8)) <> 0") -> str:
    return f"""
    SELECT * FROM (SELECT symbol, side, price, arg_max(qty, {order}) AS qty, max(last_update_id) AS last_update_id
                   FROM {source} GROUP BY ALL)
    WHERE {keep}
    """


def ranked(source: str) -> str:
    return f"""
    SELECT *, CAST(row_number() OVER (PARTITION BY symbol, side
        ORDER BY CASE WHEN side = 'bid' THEN -CAST(price AS DECIMAL(18,8)) ELSE CAST(price AS DECIMAL(18,8)) END) AS INTEGER) AS rank
    FROM {source}
    """


view("book", "level_changes")(state("level_changes"))
view("early_book", "level_changes")(state(f"(SELECT * FROM level_changes WHERE last_update_id <= {SPOT_CHECK_ID})"))
view("ranked_book", "book")(ranked("book"))
view("ranked_early", "early_book")(ranked("early_book"))

view("message_levels", "bronze")(
    """
    SELECT symbol, first_update_id, last_update_id, side, CAST(i - 1 AS INTEGER) AS pos, levels[i][1] AS price, levels[i][2] AS qty
    FROM (SELECT symbol, first_update_id, last_update_id, event_ts, side, levels, unnest(range(1, len(levels) + 1)) AS i
          FROM (SELECT *, 'bid' AS side, raw_bids AS levels FROM bronze UNION ALL
                SELECT *, 'ask' AS side, raw_asks AS levels FROM bronze))
    """
)

view("sequence")(
    f"""
    SELECT '{DEFAULT_SYMBOL}' AS symbol, event_id * 3 + 1 + event_id // 97 * 5 AS first_update_id,
           event_id * 3 + 3 + event_id // 97 * 5 AS last_update_id
    FROM events
    """
)
view("checked", "sequence")(
    """
    SELECT *, prev_update_id + 1 AS expected_id, first_update_id - (prev_update_id + 1) AS gap,
           CASE WHEN first_update_id = prev_update_id + 1 THEN 'PASS' WHEN prev_update_id IS NOT NULL THEN 'FAIL' END AS result
    FROM (SELECT *, lag(last_update_id) OVER (PARTITION BY symbol ORDER BY first_update_id) AS prev_update_id FROM sequence)
    """
)
view("epochs", "checked")(
    """
    SELECT symbol, first_update_id, last_update_id,
           CAST(sum(CASE WHEN gap <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY symbol ORDER BY first_update_id) AS BIGINT) AS epoch
    FROM checked
    """
)
view("snapshots", "sequence")("SELECT DISTINCT symbol, last_update_id // 1000 * 1000 AS snapshot_id FROM sequence")
view("anchors", "epochs", "snapshots")(
    """
    SELECT e.*, s.snapshot_id FROM epochs e JOIN snapshots s
      ON e.symbol = s.symbol AND s.snapshot_id + 1 BETWEEN e.first_update_id AND e.last_update_id
    """
)

view("scores")("SELECT value AS score, CAST(user_id % 3 = 0 AS INTEGER) AS label FROM events")
view("predicted", "scores")(f"SELECT *, CAST(score >= {SCORE_THRESHOLD} AS INTEGER) AS prediction FROM scores")
view("roc", "scores")(
    """
    SELECT threshold, CAST(sum(pos) OVER w AS DOUBLE) / sum(pos) OVER () AS tpr,
           CAST(sum(neg) OVER w AS DOUBLE) / sum(neg) OVER () AS fpr
    FROM (SELECT score AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM scores GROUP BY score)
    WINDOW w AS (ORDER BY threshold DESC)
    UNION ALL SELECT NULL, 0.0, 0.0
    """
)
view("auc", "scores")(
    """
    SELECT (sum(rnk) FILTER (label = 1) - any_value(p) * (any_value(p) + 1) / 2.0::DOUBLE) / (any_value(p) * any_value(n)) AS roc_auc
    FROM (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rnk,
                 CAST(sum(label) OVER () AS DOUBLE) AS p, CAST(sum(1 - label) OVER () AS DOUBLE) AS n FROM scores)
    """
)
view("outcomes", "predicted")(
    """
    SELECT CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
           CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
           CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn,
           CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn
    FROM predicted
    """
)
view("by_class", "outcomes")(
    """
    SELECT 'down' AS class, coalesce(tn / nullif(tn + fn, 0), 0) AS precision, coalesce(tn / nullif(tn + fp, 0), 0) AS recall,
           coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f1, tn + fp AS support FROM outcomes
    UNION ALL
    SELECT 'up', coalesce(tp / nullif(tp + fp, 0), 0), coalesce(tp / nullif(tp + fn, 0), 0),
           coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), tp + fn FROM outcomes
    """
)

view("log")(
    f"""
    SELECT ts, symbol, prediction, CASE WHEN prediction = 'up' THEN probability ELSE 1.0::DOUBLE - probability END AS confidence, probability
    FROM (SELECT *, CASE WHEN probability >= {LOG_THRESHOLD}::DOUBLE THEN 'up' ELSE 'down' END AS prediction
          FROM (SELECT ts, event_type AS symbol, (value % 100) / 100 AS probability FROM events))
    """
)

view("active", "quotes")(
    """
    SELECT symbol, time_bucket(INTERVAL '1 minute', event_ts) AS window_start, max(last_update_id) AS max_offset, count(*) AS messages
    FROM quotes GROUP BY ALL
    """
)
# One check a minute from a symbol's first minute to the last whole one, as a watchdog would count them.
view("watch", "active")(
    """
    SELECT g.symbol, g.minute, a.symbol IS NULL AS silent FROM (
        SELECT symbol, unnest(generate_series(min(window_start),
            (SELECT time_bucket(INTERVAL '1 minute', max(ts)) - INTERVAL 1 MINUTE FROM events), INTERVAL 1 MINUTE)) AS minute
        FROM active GROUP BY symbol) g
    LEFT JOIN active a ON a.symbol = g.symbol AND a.window_start = g.minute
    """
)
view("stalls", "active", "watch")(
    """
    SELECT s.symbol, s.stall_start, a.window_start AS recovered_at, s.consecutive_failures FROM (
        SELECT symbol, min(minute) AS stall_start, count(*) AS consecutive_failures
        FROM (SELECT *, count(*) FILTER (NOT silent) OVER (PARTITION BY symbol ORDER BY minute) AS heard FROM watch)
        WHERE silent GROUP BY symbol, heard HAVING count(*) >= 3) s
    LEFT JOIN active a ON a.symbol = s.symbol AND a.window_start = s.stall_start + to_minutes(s.consecutive_failures)
    """
)


def _drift(by: str) -> str:
    order = "ORDER BY ts DESC, probability DESC"
    key = f"{by}, " if by else ""
    partition = f"PARTITION BY {by} " if by else ""
    return f"""
    SELECT {key}CASE WHEN total_predictions = 0 THEN 'no_data' WHEN up_ratio > 0.8 OR down_ratio > 0.8 THEN 'drift_detected' ELSE 'ok' END AS status,
           total_predictions, {r('up_ratio down_ratio')}, 0.8::DOUBLE AS drift_threshold
    FROM (SELECT {key}count(*) AS total_predictions,
                 round_even(count(*) FILTER (prediction = 'up') / CAST(nullif(count(*), 0) AS DOUBLE), 4) AS up_ratio,
                 round_even(count(*) FILTER (prediction = 'down') / CAST(nullif(count(*), 0) AS DOUBLE), 4) AS down_ratio
          FROM (SELECT *, row_number() OVER ({partition}{order}) AS rn FROM log) WHERE rn <= 100 {"GROUP BY " + by if by else ""})
    """


def _profile() -> str:
    parts = [
        f"""
        SELECT '{c}' AS "column", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min,
               quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50,
               quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM training
        """
        for c in [*FEATURE_COLS, "label"]
    ]
    return f'SELECT "column", count, {r("mean std min p25 p50 p75 max")} FROM (' + " UNION ALL ".join(parts) + ")"


def _checks(table: str, source: str, rules: dict[str, str], keys: dict[str, str], extra: str = "") -> list[str]:
    status = "CASE WHEN failed_rows = 0 THEN 'pass' ELSE 'fail' END AS status"
    found = [f"SELECT '{n}' AS \"check\", count(*) FILTER ({rule}) AS failed_rows FROM {source}" for n, rule in rules.items()]
    found += [
        f"SELECT '{n}', count(*) FROM (SELECT {k} FROM {source} GROUP BY {k} HAVING count(*) > 1)" for n, k in keys.items()
    ]
    if extra:
        found.append(extra)
    return [f"SELECT '{table}' AS \"table\", \"check\", failed_rows, {status} FROM ({' UNION ALL '.join(found)})"]


def _present(columns: str) -> dict[str, str]:
    return {f"not_null({c})": f"{c} IS NULL" for c in columns.split()}


def _quality() -> str:
    silver_rules = {
        **_present("mid_price spread spread_bps symbol"),
        "non_negative(spread)": "spread < 0",
        "in_range(order_imbalance)": "order_imbalance NOT BETWEEN -1 AND 1",
        "null_only_when(order_imbalance)": "(order_imbalance IS NULL) <> (bid_count + ask_count = 0)",
    }
    parts = [
        *_checks("bronze", "bronze", _present("last_update_id event_ts symbol best_bid_price best_ask_price"),
                 {"unique(symbol, last_update_id)": "symbol, last_update_id"}),
        *_checks("unfiltered", "raw_metrics", silver_rules, {}),
        *_checks("silver", "metrics", silver_rules, {}),
        *_checks("gold", "hourly", _present("window_start symbol mid_price_open mid_price_close vwap"),
                 {"unique(window_start, symbol)": "window_start, symbol"},
                 "SELECT 'not_empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END::BIGINT FROM hourly"),
        *_checks("predictions", "log", {
            "accepted_values(prediction)": "prediction IS NULL OR prediction NOT IN ('up', 'down')",
            "in_range(confidence)": "confidence NOT BETWEEN 0 AND 1"}, {}),
    ]
    return " UNION ALL ".join(parts)


BRONZE_TEXT = "* REPLACE (CAST(to_json(raw_bids) AS VARCHAR) AS raw_bids, CAST(to_json(raw_asks) AS VARCHAR) AS raw_asks)"
STAGED_NUMBERS = (
    "event_time, date, symbol, first_update_id, last_update_id, bid_count, ask_count, event_ts, "
    "CAST(to_json(raw_bids) AS VARCHAR) AS raw_bids, CAST(to_json(raw_asks) AS VARCHAR) AS raw_asks, "
    + r("best_bid_price best_bid_qty best_ask_price best_ask_qty")
)
TRAINING_COLS = BAR_COLS + ", label, " + r(ENGINEERED)
LABEL_COLS = "symbol, window_start, label, " + r("mid_price_avg")


def batch_oracle() -> dict[str, str]:
    deleted = "CAST(len(list_filter({0}, lambda x: x[2] = '0.00000000')) AS INTEGER)"
    bid_gone, ask_gone = (f"coalesce({deleted.format(c)}, 0)" for c in ("raw_bids", "raw_asks"))
    bounds = " UNION ALL ".join(
        [f"SELECT '{b}' AS le, count(*) FILTER (confidence <= {b}::DOUBLE) AS observations FROM log" for b in CONFIDENCE_BOUNDS]
        + ["SELECT '+Inf', count(confidence) FROM log"]
    )
    return {
        "parse_messages": query("bronze", body=f"SELECT {BRONZE_TEXT} FROM bronze"),
        "parse_quarantine": query(
            "decoded", body="SELECT message AS raw_text, 'unparseable' AS reject_reason FROM decoded WHERE NOT valid OR ms IS NULL"
        ),
        "envelope_projection": query(
            body="SELECT m.message AS raw_json, 'depth_updates' AS topic, 0 AS partition, e.event_id AS \"offset\", e.ts AS kafka_timestamp "
            "FROM events e JOIN (SELECT DISTINCT ON (event_id) event_id, message FROM ("
            + VIEWS["messages"][1].replace("FROM retried", "FROM events")
            + ")) m ON m.event_id = e.event_id"
        ),
        "message_profile": query(
            "bronze",
            body=f"""SELECT symbol, event_ts, first_update_id, last_update_id, last_update_id - first_update_id + 1 AS id_span,
            bid_count AS bid_changes, {bid_gone} AS bid_deletions, bid_count - {bid_gone} AS bid_inserts,
            ask_count AS ask_changes, {ask_gone} AS ask_deletions, ask_count - {ask_gone} AS ask_inserts FROM bronze""",
        ),
        "to_messages": query(
            "bronze",
            body="""SELECT lower(symbol) AS key, '{"e":"depthUpdate","E":' || epoch_ms(event_ts) || ',"s":"' || symbol || '","U":' || first_update_id
            || ',"u":' || last_update_id || ',"b":' || CAST(to_json(raw_bids) AS VARCHAR)
            || CASE WHEN raw_asks IS NULL THEN '' ELSE ',"a":' || CAST(to_json(raw_asks) AS VARCHAR) END || '}' AS value FROM bronze""",
        ),
        "dedup_latest": query(
            "retried",
            body=f"""SELECT event_id, user_id, event_type, ts, {r('value')} FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS rn FROM retried) WHERE rn = 1""",
        ),
        "staged_quotes": query("staged", body=f"SELECT {STAGED_NUMBERS} FROM staged"),
        "quote_metrics": query(
            "silver",
            body=f"SELECT {STAGED_NUMBERS}, {r('mid_price spread spread_bps order_imbalance bid_depth_total ask_depth_total')} FROM silver",
        ),
        "array_depth_totals": query(
            "bronze",
            body=f"""SELECT last_update_id, event_ts, {six(_depth('raw_bids'))} AS bid_depth_total,
            {six(_depth('raw_asks'))} AS ask_depth_total FROM bronze""",
        ),
        "bars_1m": query("metrics", body=f"SELECT {BAR_COLS} FROM ({depth_bars('metrics', '1 minute')})"),
        "bars_5m": query("metrics", body=f"SELECT {BAR_COLS} FROM ({depth_bars('metrics', '5 minutes')})"),
        "bars_60m": query("hourly", body=f"SELECT {BAR_COLS} FROM hourly"),
        "bars_37m": query("metrics", body=f"SELECT {BAR_COLS} FROM ({depth_bars('metrics', '37 minutes')})"),
        "bars_from_messages_5m": query("silver", body=f"SELECT {BAR_COLS} FROM ({depth_bars('silver', '5 minutes')})"),
        "bars_topofbook_1m": query("quotes", body=f"SELECT {TOP_COLS} FROM ({top_bars('1 minute')})"),
        "bars_topofbook_60m": query("top_hourly", body=f"SELECT {TOP_COLS} FROM top_hourly"),
        "metric_series": query(
            "hourly",
            body=" UNION ALL ".join(
                f"SELECT symbol, window_start, '{m}' AS metric, {six(m)} AS value FROM hourly"
                for m in ("mid_price_avg", "spread_bps_avg", "imbalance_avg", "depth_ratio")
            ),
        ),
        "feature_rolling_full": query("featured", body=f"SELECT symbol, window_start, {r(ENGINEERED)} FROM featured"),
        "feature_rolling_partial": query(
            "top_hourly",
            body=f"""SELECT {TOP_COLS}, label, {r(ENGINEERED)} FROM (
            SELECT *, spread_bps_avg - lag(spread_bps_avg) OVER w AS spread_change,
                   imbalance_avg - lag(imbalance_avg) OVER w AS imbalance_change,
                   (vwap - mid_price_avg) / nullif(mid_price_avg, 0) * 10000 AS vwap_vs_mid,
                   avg(spread_bps_avg) OVER w5 AS rolling_spread_mean, stddev_samp(imbalance_avg) OVER w5 AS rolling_imbalance_std,
                   CAST(lead(mid_price_avg, 5) OVER w > mid_price_avg AS INTEGER) AS label
            FROM top_hourly
            WINDOW w AS (PARTITION BY symbol ORDER BY window_start),
                   w5 AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))""",
        ),
        "engineered_features": query(
            "complete", body=f"SELECT symbol, window_start, {r(' '.join(FEATURE_COLS))} FROM complete"
        ),
        "labels_lead_nullable": query("hourly_labels", body=f"SELECT {LABEL_COLS} FROM hourly_labels"),
        "labels_dropped": query("hourly_labels", body=f"SELECT {LABEL_COLS} FROM hourly_labels WHERE label IS NOT NULL"),
        "labels_by_minutes": query(
            "hourly",
            body=f"""SELECT a.symbol, a.window_start, CAST(b.mid_price_avg > a.mid_price_avg AS INTEGER) AS label,
            {six('a.mid_price_avg')} AS mid_price_avg
            FROM hourly a LEFT JOIN hourly b ON a.symbol = b.symbol AND b.window_start = a.window_start + INTERVAL 300 MINUTE""",
        ),
        "training_set": query("training", body=f"SELECT {TRAINING_COLS} FROM training"),
        "training_set_no_nulls": query("training_no_nulls", body=f"SELECT {TRAINING_COLS} FROM training_no_nulls"),
        "time_split_counts": query(
            "training",
            body="""SELECT is_test, count(*) AS rows, min(window_start) AS first_window, max(window_start) AS last_window FROM (
            SELECT window_start, row_number() OVER (ORDER BY window_start, symbol)
                   > floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) AS is_test FROM training) GROUP BY is_test""",
        ),
        "numbered_rows": query(
            "hourly",
            body="SELECT symbol, window_start, row_number() OVER (PARTITION BY symbol ORDER BY window_start) - 1 AS row_index FROM hourly",
        ),
        "latest_per_symbol": query(
            "hourly",
            body=f"SELECT {BAR_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY window_start DESC) AS rn FROM hourly) WHERE rn = 1",
        ),
        "tail_10": query("hourly", body=f"SELECT {BAR_COLS} FROM (SELECT * FROM hourly ORDER BY window_start DESC, symbol LIMIT 10)"),
        "head_5": query("hourly", body=f"SELECT {BAR_COLS} FROM (SELECT * FROM hourly ORDER BY window_start, symbol LIMIT 5)"),
        "ordered_bars": query("hourly", body=f"SELECT {BAR_COLS} FROM hourly ORDER BY symbol, window_start"),
        "book_levels": query("message_levels", body="SELECT * FROM message_levels"),
        "book_state": query("book", body="SELECT * FROM book"),
        "book_state_text": query("level_changes", body=state("level_changes", keep="qty <> '0.00000000'")),
        "book_as_of": query("early_book", body="SELECT * FROM early_book"),
        "book_from_snapshot": query("book", body="SELECT symbol, side, price, qty FROM book"),
        "book_top_levels": query("ranked_book", body="SELECT * FROM ranked_book WHERE rank <= 5"),
        "book_spread": query(
            "book",
            body="""SELECT symbol, CAST(best_bid AS VARCHAR) AS best_bid, CAST(best_ask AS VARCHAR) AS best_ask, last_update_id,
            CAST(round(best_ask - best_bid, 2) AS DOUBLE) AS spread FROM (
            SELECT symbol, max(CAST(price AS DECIMAL(18,8))) FILTER (side = 'bid') AS best_bid,
                   min(CAST(price AS DECIMAL(18,8))) FILTER (side = 'ask') AS best_ask, max(last_update_id) AS last_update_id
            FROM book GROUP BY symbol)""",
        ),
        "book_depth_ladder": query(
            "ranked_book",
            body=f"""SELECT symbol, side, price, qty, last_update_id,
            {six('sum(CAST(qty AS DOUBLE)) OVER (PARTITION BY symbol, side ORDER BY rank)')} AS cumulative_qty FROM ranked_book""",
        ),
        "book_spot_check": query(
            "ranked_book",
            "ranked_early",
            body="""SELECT symbol, matched, 10 AS total, round(matched / 10.0::DOUBLE * 100, 1) AS pct FROM (
            SELECT a.symbol, count(*) FILTER (a.price = b.price) AS matched FROM ranked_book a
            JOIN ranked_early b ON a.symbol = b.symbol AND a.side = b.side AND a.rank = b.rank AND a.rank <= 5 GROUP BY a.symbol)""",
        ),
        "book_rebuilt_from_messages": query(
            "message_levels",
            body="""SELECT * FROM (SELECT symbol, side, price, arg_max(qty, (last_update_id, pos)) AS qty, max(last_update_id) AS last_update_id
            FROM message_levels GROUP BY symbol, side, price) WHERE CAST(qty AS DECIMAL(18,8)) <> 0""",
        ),
        "sequence_continuity": query("checked", body="SELECT * FROM checked"),
        "sequence_gap_summary": query(
            "checked",
            body="""SELECT symbol, count(gap) AS transitions, count(*) FILTER (result = 'FAIL') AS failures,
            CAST(coalesce(sum(gap) FILTER (gap > 0), 0) AS BIGINT) AS lost_ids FROM checked GROUP BY symbol""",
        ),
        "sequence_epochs": query("epochs", body="SELECT * FROM epochs"),
        "snapshot_anchor": query("anchors", body="SELECT symbol, first_update_id, last_update_id, snapshot_id FROM anchors"),
        "synchronised_updates": query(
            "anchors",
            body="""SELECT e.symbol, e.epoch, e.first_update_id, e.last_update_id, b.snapshot_id,
            CASE WHEN b.snapshot_id IS NULL THEN 'unanchored' WHEN e.last_update_id <= b.snapshot_id THEN 'stale' ELSE 'applied' END AS status
            FROM epochs e LEFT JOIN (SELECT symbol, epoch, min(snapshot_id) AS snapshot_id FROM anchors GROUP BY ALL) b
              ON e.symbol = b.symbol AND e.epoch = b.epoch""",
        ),
        "roc_points": query("roc", body=f"SELECT {r('threshold tpr fpr')} FROM roc"),
        "best_threshold": query(
            "roc",
            body=f"""SELECT {r('threshold tpr fpr youden_j')} FROM (
            SELECT *, tpr - fpr AS youden_j FROM roc ORDER BY youden_j DESC NULLS LAST, threshold DESC NULLS FIRST LIMIT 1)""",
        ),
        "roc_auc": query("auc", body=f"SELECT {r('roc_auc')} FROM auc"),
        "confusion_matrix": query(
            "predicted",
            body="""SELECT label, count(*) FILTER (prediction = 0) AS predicted_0, count(*) FILTER (prediction = 1) AS predicted_1
            FROM predicted GROUP BY label""",
        ),
        "class_report": query(
            "by_class",
            body=f"""SELECT class, CAST(support AS BIGINT) AS support, {r('precision recall f1')} FROM (
            SELECT * FROM by_class
            UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM by_class
            UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                             sum(f1 * support) / sum(support), sum(support) FROM by_class
            UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT (tp + tn) / (tp + tn + fp + fn) AS a, tp + tn + fp + fn AS n FROM outcomes))""",
        ),
        "threshold_metrics": query(
            "by_class",
            "auc",
            body=f"""SELECT {r('accuracy precision recall f1 roc_auc')} FROM (
            SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy, c.precision, c.recall, c.f1, (SELECT roc_auc FROM auc) AS roc_auc
            FROM outcomes, by_class c WHERE c.class = 'up')""",
        ),
        "feature_summary": query("training", body=_profile()),
        "positive_share": query(
            "training", body=f"SELECT count(*) AS rows, {six('avg(label)')} AS positive_share FROM training"
        ),
        "drift_last_100": query("log", body=_drift("")),
        "drift_per_symbol": query("log", body=_drift("symbol")),
        "top_100_newest": query(
            "log",
            body=f"SELECT ts, symbol, prediction, {r('confidence probability')} FROM (SELECT * FROM log ORDER BY ts DESC, probability DESC LIMIT 100)",
        ),
        "confidence_histogram": query("log", body=bounds),
        "predictions_by_direction": query("log", body="SELECT prediction, count(*) AS predictions FROM log GROUP BY prediction"),
        "predictions_up": query(
            "log", body=f"SELECT ts, symbol, prediction, {r('confidence probability')} FROM log WHERE prediction = 'up'"
        ),
        "prediction_rate": query(
            "log",
            body="SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start, prediction, count(*) AS predictions FROM log GROUP BY ALL",
        ),
        "freshness": query(
            "quotes",
            "hourly",
            body=f"""SELECT symbol, latest_tick, latest_bar, {r('tick_lag_seconds gold_lag_seconds')},
            {six('round_even(tick_lag_seconds + gold_lag_seconds, 1)')} AS total_lag_seconds FROM (
            SELECT symbol, latest_tick, latest_bar, round_even((epoch_us(now) - epoch_us(latest_tick)) / 1e6::DOUBLE, 1) AS tick_lag_seconds,
                   round_even((epoch_us(now) - epoch_us(latest_bar)) / 1e6::DOUBLE, 1) AS gold_lag_seconds
            FROM (SELECT symbol, max(event_ts) AS latest_tick FROM quotes GROUP BY symbol)
            FULL JOIN (SELECT symbol, max(window_start) AS latest_bar FROM hourly GROUP BY symbol) USING (symbol),
            (SELECT max(ts) AS now FROM events))""",
        ),
        "minute_activity": query("active", body="SELECT * FROM active"),
        "offset_growth": query(
            "active",
            body="""SELECT symbol, window_start, max_offset, max_offset - lag(max_offset) OVER (PARTITION BY symbol ORDER BY window_start) AS new_messages
            FROM active""",
        ),
        "stall_runs": query("stalls", body="SELECT * FROM stalls"),
        "stall_alerts": query(
            "stalls",
            body="""SELECT stall_start + to_minutes(n) AS ts, symbol, 'kafka' AS component, n AS consecutive_failures,
            'kafka is silent: nothing new in ' || n || ' checks' AS message
            FROM (SELECT *, unnest(range(3, consecutive_failures + 1)) AS n FROM stalls)""",
        ),
        "quality_report": query("bronze", "raw_metrics", "metrics", "hourly", "log", body=_quality()),
        "duplicate_keys": query(
            "bronze", body="SELECT symbol, last_update_id, count(*) AS n FROM bronze GROUP BY symbol, last_update_id HAVING count(*) > 1"
        ),
    }


view("gate_diffs")(
    f"""
    SELECT strftime(ts, '%Y-%m-%d') AS symbol, event_id, event_id * 3 + 1 + event_id // 97 * 5 AS first_update_id,
           event_id * 3 + 3 + event_id // 97 * 5 AS last_update_id,
           CASE WHEN user_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side,
           {_dec('CASE WHEN user_id % 2 = 0 THEN 60 ELSE 101 END + user_id % 40')} AS price,
           {_dec('CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE value END')} AS qty
    FROM events
    """
)
view("gate_epochs", "gate_diffs")(
    """
    SELECT *, sum(broken) OVER (PARTITION BY symbol ORDER BY first_update_id) AS epoch FROM (
        SELECT *, CASE WHEN first_update_id <> lag(last_update_id) OVER (PARTITION BY symbol ORDER BY first_update_id) + 1 THEN 1 ELSE 0 END AS broken
        FROM gate_diffs)
    """
)
view("gate_bases", "gate_epochs")(
    """
    SELECT d.symbol, d.epoch, min(s.last_update_id) AS snapshot_id
    FROM gate_epochs d JOIN gate_diffs s
      ON s.event_id % 50 = 25 AND s.symbol = d.symbol AND s.last_update_id + 1 BETWEEN d.first_update_id AND d.last_update_id
    GROUP BY d.symbol, d.epoch
    """
)
view("gate_applied", "gate_epochs", "gate_bases")(
    "SELECT d.*, b.snapshot_id FROM gate_epochs d JOIN gate_bases b USING (symbol, epoch) WHERE d.last_update_id > b.snapshot_id"
)
# Diffs that no snapshot had reached when they came.
view("gate_early", "gate_epochs", "gate_applied")(
    "SELECT d.* FROM gate_epochs d ANTI JOIN gate_applied a ON a.event_id = d.event_id"
)
view("gate_levels", "gate_applied", "gate_bases")(
    """
    SELECT * EXCLUDE (epoch) FROM (
        SELECT symbol, epoch, side, price, qty, last_update_id FROM gate_applied
        UNION ALL SELECT symbol, epoch, 'bid', '1.00000000', '1.00000000', snapshot_id FROM gate_bases
        UNION ALL SELECT symbol, epoch, 'ask', '999.00000000', '1.00000000', snapshot_id FROM gate_bases)
    QUALIFY epoch = max(epoch) OVER (PARTITION BY symbol)
    """
)


def stream_oracle() -> dict[str, str]:
    """Twins of the streaming queries: what the same data gives as one batch."""
    found = {
        "stream_bars": query(
            "hourly",
            "metrics",
            body=f"SELECT {BAR_COLS} FROM hourly WHERE window_end <= (SELECT max(event_ts) FROM metrics) - INTERVAL 2 MINUTE",
        ),
        "stream_bars_open": query("hourly", body=f"SELECT {BAR_COLS} FROM hourly"),
        "wide_stream_bars": query("metrics", body=f"SELECT {BAR_COLS} FROM ({depth_bars('metrics', '1 day')})"),
        "stall_stream": """WITH heard AS (SELECT DISTINCT event_type AS symbol, date_trunc('second', ts) AS arrived FROM events),
            gaps AS (SELECT *, coalesce(lead(arrived) OVER (PARTITION BY symbol ORDER BY arrived), max(arrived) OVER ()) AS until FROM heard),
            checks AS (SELECT *, unnest(range(3, CAST(ceil(epoch(until - arrived) / 60) AS BIGINT))) AS n FROM gaps)
            SELECT arrived + to_minutes(n) AS ts, symbol, 'kafka' AS component, n AS consecutive_failures,
                'kafka is silent: nothing new in ' || n || ' checks' AS message FROM checks""",
        "stream_dedup": query("retried", body="SELECT DISTINCT event_type AS symbol, event_id AS last_update_id FROM retried"),
        "stream_bronze_roundtrip": query("bronze", body=f"SELECT {BRONZE_TEXT} FROM bronze"),
        "stream_gate": query(
            "gate_early",
            "gate_bases",
            body="""SELECT symbol, 'diff' AS kind, first_update_id, last_update_id, 'applied' AS status FROM gate_applied
            UNION ALL SELECT symbol, 'snapshot', snapshot_id, snapshot_id, 'applied' FROM gate_bases
            UNION ALL SELECT symbol, 'diff', first_update_id, last_update_id, 'buffered' FROM gate_early
            UNION ALL SELECT e.symbol, 'diff', e.first_update_id, e.last_update_id, 'stale' FROM gate_early e
                JOIN (SELECT symbol, max(snapshot_id) AS newest FROM gate_bases GROUP BY symbol) b
                  ON b.symbol = e.symbol AND e.last_update_id <= b.newest
            UNION ALL SELECT e.symbol, 'diff', e.first_update_id, e.last_update_id, 'resync' FROM gate_early e
                JOIN gate_bases b ON b.symbol = e.symbol AND e.epoch = b.epoch + 1 WHERE e.broken = 1""",
        ),
        "stream_book": query("gate_levels", body=state("gate_levels")),
    }
    found["stream_gate_one_symbol"] = found["stream_gate"].replace("strftime(ts, '%Y-%m-%d') AS symbol", "'ALL' AS symbol")
    return found
