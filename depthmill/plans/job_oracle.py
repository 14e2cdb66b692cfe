"""SQL twins of the job queries: what the stored tables, logs and documents must hold."""

from depthmill.constants import FEATURE_COLS, METADATA_REQUIRED_KEYS
from depthmill.plans import oracle as O
from depthmill.plans.job_catalog import FIRST_DAY, LAST_DAY, MIN_BARS, RUN_ID
from depthmill.plans.oracle import query, view

# A leaf of one tree over separable classes is -1 or 1; its share is the logistic function of twice that.
UP_SHARE = "1 / (1 + exp(-2.0::DOUBLE))"

view("separable")(
    """
    SELECT event_type AS symbol, ts AS window_start, event_id % 3 = 0 AS up,
           CASE WHEN event_id % 3 = 0 THEN 1.0::DOUBLE + event_id % 7 ELSE -1.0::DOUBLE - event_id % 5 END AS shown FROM events
    """
)
view("separable_answers", "separable")(
    f"""
    SELECT window_start AS ts, symbol, CASE WHEN up THEN 'up' ELSE 'down' END AS prediction,
           round({UP_SHARE}, 4) AS confidence, round(CASE WHEN up THEN {UP_SHARE} ELSE 1 - {UP_SHARE} END, 4) AS probability
    FROM separable
    """
)
view("epoch_levels", "epochs", "anchors")(
    f"""
    WITH based AS (SELECT symbol, epoch, min(snapshot_id) AS snapshot_id FROM anchors GROUP BY ALL),
         written AS (SELECT event_id * 3 + 1 + event_id // 97 * 5 AS first_update_id,
                            CASE WHEN user_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS side,
                            {O._dec("CASE WHEN user_id % 2 = 0 THEN 60 ELSE 101 END + user_id % 40")} AS price,
                            {O._dec("CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE value END")} AS qty FROM events)
    SELECT e.symbol, e.epoch, w.side, w.price, w.qty, e.last_update_id
    FROM epochs e JOIN based b ON b.symbol = e.symbol AND b.epoch = e.epoch AND e.last_update_id > b.snapshot_id
    JOIN written w ON w.first_update_id = e.first_update_id
    UNION ALL SELECT symbol, epoch, 'bid', '1.00000000', '5.00000000', snapshot_id FROM based
    """
)


def _once(*reads: str, body: str) -> str:
    """A query over messages without retries."""
    return query(*reads, body=body).replace("FROM retried", "FROM events")


def _report(table: str, lines: list[str]) -> str:
    return f"""SELECT '{table}' AS "table", "check", CAST(failed_rows AS BIGINT) AS failed_rows,
        CASE WHEN failed_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({" UNION ALL ".join(lines)})"""


def _stored_checks() -> str:
    return query("hourly", "quotes", body=" UNION ALL ".join([
        _report("gold", [
            "SELECT 'required_columns' AS \"check\", 1 AS failed_rows",
            "SELECT 'has_data_files', 0",
            f"SELECT 'min_rows({MIN_BARS})', greatest(0, {MIN_BARS} - count(*)) FROM hourly",
        ]),
        _report("quotes", [
            "SELECT 'unique(last_update_id)' AS \"check\", count(*) AS failed_rows FROM (SELECT last_update_id FROM quotes GROUP BY ALL HAVING count(*) > 1)",
            "SELECT 'unique(symbol)', count(*) FROM (SELECT symbol FROM quotes GROUP BY ALL HAVING count(*) > 1)",
            "SELECT 'min_rows(100)', greatest(0, 100 - count(*)) FROM quotes",
        ]),
        _report("metadata", ["SELECT 'required_columns' AS \"check\", 0 AS failed_rows", "SELECT 'not_empty', 0"]),
    ]))


def job_oracle() -> dict[str, str]:
    base = O.batch_oracle()
    metrics = "unnest(['accuracy', 'precision', 'recall', 'f1', 'roc_auc'])"
    columns = '["' + '","'.join(FEATURE_COLS) + '"]'
    assert set(METADATA_REQUIRED_KEYS) <= {"model_version", "optimal_threshold", "feature_cols", "test_metrics"}
    gold = base["feature_rolling_partial"].replace("INTERVAL '60 minutes'", "INTERVAL '1 minute'")
    return {
        "scoring_roundtrip": query("separable_answers", body=f"SELECT ts, symbol, prediction, {O.r('confidence probability')} FROM separable_answers"),
        "scoring_audit": query(
            "separable",
            body=" UNION ALL ".join(
                f"SELECT symbol, window_start, '{c}' AS feature, {O.six('shown' if c == 'spread_change' else '0.5::DOUBLE')} AS value FROM separable"
                for c in FEATURE_COLS
            ),
        ),
        "scoring_stream": query("separable_answers", body=f"SELECT symbol, prediction, {O.r('confidence probability')} FROM separable_answers"),
        "model_metadata": query(
            body=f"""SELECT 'v1' AS model_version, 'price_direction_5min' AS prediction_target, 5 AS label_horizon, '{columns}' AS feature_cols,
            {O.six(UP_SHARE)} AS optimal_threshold, CAST(floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS trained_on_rows,
            {metrics} AS metric, {O.six('1.0::DOUBLE')} AS value FROM events"""
        ),
        "run_log": f"""SELECT '{RUN_ID}' AS run_id, name, value FROM (
            SELECT unnest(['maxIter', 'maxDepth']) AS name, '1' AS value UNION ALL SELECT {metrics}, '1.0000')""",
        "acceptance_gate": f"SELECT 'v1' AS model_version, {O.six('1.0::DOUBLE')} AS roc_auc, true AS features_match, true AS accepted",
        "score_invariants": query(
            "training",
            body="""SELECT CAST(count(*) - floor(count(*) * 0.8::DOUBLE) AS BIGINT) AS answers, 0::BIGINT AS wrong_confidence,
            0::BIGINT AS wrong_direction, 0::BIGINT AS outside, 0::BIGINT AS wrong_area FROM training""",
        ),
        "depth_tables_roundtrip": base["bars_from_messages_5m"],
        "minute_tables_roundtrip": f"SELECT *, count(*) OVER () AS silver_minute_rows, count(*) OVER () AS gold_minute_rows FROM ({gold})",
        "refresh_days_roundtrip": query(
            "hourly",
            body=f"""SELECT symbol, window_start, update_count, CAST(window_start AS DATE) AS date,
            CASE WHEN CAST(window_start AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}' THEN 2 ELSE 1 END AS build FROM hourly""",
        ),
        "pruned_days": query(
            "bronze",
            body=f"""SELECT date, symbol, first_update_id, last_update_id, event_time FROM bronze
            WHERE date BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}' AND symbol IN ('click', 'purchase')""",
        ),
        "fan_out_roundtrip": query("quotes", body="SELECT symbol, count(DISTINCT last_update_id) AS ids, count(*) AS rows FROM quotes GROUP BY symbol"),
        "bounded_batches_roundtrip": "SELECT count(*) AS rows, count(DISTINCT event_id) AS offsets, 4::BIGINT AS batches FROM events",
        "retrain_decisions": query(
            "log",
            body=f"""SELECT log, minimum_auc, decision, decision = 'retrained' AS published FROM (
            SELECT log, minimum_auc, CASE WHEN status <> 'drift_detected' THEN 'skipped' WHEN minimum_auc > 1 THEN 'rejected' ELSE 'retrained' END AS decision
            FROM (SELECT 'whole log' AS log, status FROM ({O._drift("")})
                  UNION ALL SELECT 'upward answers', status FROM ({O._drift("").replace("FROM log", "FROM (SELECT * FROM log WHERE prediction = 'up')")})),
                 (VALUES (0.0::DOUBLE), (1.5::DOUBLE)) AS gates(minimum_auc))""",
        ),
        "offsets_roundtrip": f"""WITH sent AS ({base['envelope_projection']})
            SELECT raw_json, topic, CAST("offset" % 3 AS INTEGER) AS partition, "offset" // 3 AS "offset", kafka_timestamp, 'stream' AS read FROM sent
            UNION ALL SELECT raw_json, topic, 3, "offset", kafka_timestamp, 'stream' FROM sent WHERE "offset" < 10
            UNION ALL SELECT raw_json, topic, CAST("offset" % 3 AS INTEGER), "offset" // 3, kafka_timestamp, 'range' FROM sent
              WHERE "offset" % 3 = 0 AND "offset" // 3 BETWEEN 100 AND 1199 OR "offset" % 3 = 1 AND "offset" // 3 < 30""",
        "restart_roundtrip": _once("bronze", body="SELECT symbol, first_update_id, last_update_id, event_time FROM bronze"),
        "view_roundtrip": query("hourly", body="SELECT symbol, count(*) AS bars, CAST(sum(update_count) AS BIGINT) AS updates FROM hourly GROUP BY symbol"),
        "message_files_roundtrip": base["parse_messages"],
        "book_per_epoch": query(
            "epoch_levels",
            body="""SELECT * FROM (SELECT symbol, epoch, side, price, arg_max(qty, last_update_id) AS qty, max(last_update_id) AS last_update_id
            FROM epoch_levels GROUP BY ALL) WHERE CAST(qty AS DECIMAL(18,8)) <> 0""",
        ),
        "spot_check_from_documents": query(
            "ranked_book",
            "ranked_early",
            body="""SELECT symbol, matched, 10 AS total, round(matched / 10.0::DOUBLE * 100, 1) AS pct, mismatches FROM (
            SELECT symbol, count(*) FILTER (same) AS matched,
                   coalesce(string_agg(line, '; ' ORDER BY line) FILTER (NOT same), '') AS mismatches
            FROM (SELECT a.symbol, a.price = b.price AS same, a.side || ' ' || a.rank || ' ' || a.price || ' ' || b.price AS line
                  FROM ranked_book a JOIN ranked_early b ON a.symbol = b.symbol AND a.side = b.side AND a.rank = b.rank AND a.rank <= 5)
            GROUP BY symbol)""",
        ),
        "display_texts": """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%g UTC') AS at, format('{:.2f}%', value % 100) AS share,
            format('{:.8f}', value) AS quantity FROM events""",
        "ladder_texts": query(
            "book",
            body="""SELECT symbol, side, format('{:.2f}', CAST(price AS DOUBLE)) AS price_text, format('{:.8f}', CAST(qty AS DOUBLE)) AS qty_text FROM book""",
        ),
        "stored_checks": _stored_checks(),
        "refresh_while_read": query(
            "hourly", "metrics", body=f"SELECT 1 AS version, {O.BAR_COLS} FROM hourly UNION ALL SELECT 2, {O.BAR_COLS} FROM ({O.depth_bars('metrics', '1 day')})"
        ),
        "wide_daily_bars": query("metrics", body=f"SELECT {O.BAR_COLS} FROM ({O.depth_bars('metrics', '1 day')})"),
        "bad_messages": _once(
            "message_levels",
            body="""SELECT 'unparseable' AS what, count(*) AS rows FROM events WHERE event_id % 101 = 0 OR event_id % 31 = 0
            UNION ALL SELECT 'no_update_id', count(*) FROM events WHERE event_id % 19 = 0 AND event_id % 101 <> 0 AND event_id % 31 <> 0
            UNION ALL SELECT 'live levels', count(*) FROM (
                SELECT symbol, side, price, arg_max(qty, (last_update_id, pos)) AS qty FROM message_levels
                WHERE (last_update_id - 3) // 3 % 19 <> 0 GROUP BY ALL) WHERE CAST(qty AS DECIMAL(18,8)) <> 0""",
        ),
    }
