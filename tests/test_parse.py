import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from depthmill.constants import DEFAULT_SYMBOL
from depthmill.operators import parse as P
from depthmill.operators import staging as S
from depthmill.sources.readers import book_snapshots


def message(**changes):
    base = {
        "e": "depthUpdate",
        "E": 1704067200123,
        "s": "ETHUSDT",
        "U": 5,
        "u": 9,
        "b": [["10.50000000", "2.00000000"], ["10.40000000", "0.00000000"]],
        "a": [["10.60000000", "3.00000000"], ["10.70000000", "1.50000000"]],
    }
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v is not None})


def parse(spark, *texts):
    return P.parse_depth(spark.createDataFrame([(t,) for t in texts], "value string"))


def one(df):
    (row,) = df.collect()
    return row


def test_normal_message(spark):
    row = one(P.accepted(parse(spark, message())))
    assert P.BRONZE_COLS == [c for c in row.asDict() if c != "event_ts"]
    assert (row.event_time, row.date) == ("2024-01-01 00:00:00", dt.date(2024, 1, 1))
    assert row.event_ts == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert (row.symbol, row.first_update_id, row.last_update_id, row.bid_count, row.ask_count) == ("ETHUSDT", 5, 9, 2, 2)
    assert (row.best_bid_price, row.best_ask_qty) == ("10.50000000", "3.00000000")
    assert row.raw_asks[1] == ["10.70000000", "1.50000000"]


@pytest.mark.parametrize("side", [[], None])
def test_empty_or_missing_side(spark, side):
    row = one(P.accepted(parse(spark, message(b=side))))
    assert (row.bid_count, row.best_bid_price, row.best_bid_qty) == (0, None, None)


def test_default_symbol(spark):
    assert one(P.accepted(parse(spark, message(s=None)))).symbol == DEFAULT_SYMBOL


def test_bytes_and_text_parse_alike(spark):
    df = spark.createDataFrame([(bytearray(message(), "utf8"),)], "value binary")
    assert one(P.accepted(P.parse_depth(df))) == one(P.accepted(parse(spark, message())))


def test_rejects_are_kept_with_a_reason(spark):
    bad = parse(spark, "junk", message(E="bad"), message(E=None), None, message())
    assert P.accepted(bad).count() == 1
    reasons = sorted(r.reject_reason for r in P.quarantine(bad).collect())
    assert reasons == ["empty", "no_event_time", "unparseable", "unparseable"]


def test_case_setting_is_not_touched(spark):
    before = spark.conf.get("spark.sql.caseSensitive")
    assert before == "false"
    assert parse(spark, message()).count() == 1
    assert spark.conf.get("spark.sql.caseSensitive") == before


def test_one_parse_even_under_filters(spark, folder):
    parse(spark, message()).select("raw_text").write.parquet(folder + "/m")
    source = spark.read.parquet(folder + "/m")
    plan = S.quote_metrics(P.accepted(P.parse_depth(source, "raw_text")).transform(S.to_numbers).transform(S.valid_quotes))
    assert plan._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_profile(spark):
    row = one(P.message_profile(P.accepted(parse(spark, message()))))
    assert (row.id_span, row.bid_changes, row.bid_deletions, row.bid_inserts) == (5, 2, 1, 1)
    assert (row.ask_changes, row.ask_deletions, row.ask_inserts) == (2, 0, 2)


def test_messages_round_trip(spark):
    bronze = P.accepted(parse(spark, message(), message(a=None), message(b=[])))
    again = P.accepted(P.parse_depth(P.to_messages(bronze)))
    fields = [c for c in bronze.columns if c != "date"]
    assert sorted(map(str, bronze.select(*fields).collect())) == sorted(map(str, again.select(*fields).collect()))
    assert one(P.to_messages(bronze).select(F.col("key").cast("string").alias("k")).distinct()).k == "ethusdt"


def test_snapshot_documents(spark, folder):
    with open(folder + "/s.json", "w") as out:
        out.write(json.dumps({"symbol": "X", "lastUpdateId": 7, "bids": [["1.0", "2.0"]], "asks": []}))
    row = one(book_snapshots(spark, folder + "/s.json"))
    assert (row.lastUpdateId, row.bids, row.asks) == (7, [["1.0", "2.0"]], [])


def test_best_only_keeps_schema(spark):
    bronze = P.accepted(parse(spark, message()))
    slim = P.best_only(bronze)
    assert slim.schema == bronze.schema or [f.dataType for f in slim.schema] == [f.dataType for f in bronze.schema]
    assert one(slim).raw_bids is None


@pytest.mark.parametrize(
    "bid, ask, kept",
    [("10.0", "11.0", True), ("10.0", "10.0", False), ("11.0", "10.0", False), ("x", "10.0", False), ("1.5d", "10.0", False),
     ("nan", "10.0", False), ("10.0", "nan", False), ("0.0", "10.0", False), ("-1.0", "10.0", False), (" 1e0 ", "10.0", True)],
)
def test_staging_filter(spark, bid, ask, kept):
    bronze = P.accepted(parse(spark, message(b=[[bid, "1"]], a=[[ask, "1"]])))
    assert S.stage_quotes(bronze).count() == int(kept)


def test_latest_duplicate_wins(spark):
    bronze = P.accepted(parse(spark, message(), message(E=1704067260123, b=[["9.0", "1.0"]]), message(s="OTHER")))
    staged = {r.symbol: r for r in S.stage_quotes(bronze).collect()}
    assert set(staged) == {"ETHUSDT", "OTHER"} and staged["ETHUSDT"].best_bid_price == 9.0


def test_duplicates_shrink_before_the_shuffle(spark):
    plan = S.stage_quotes(P.accepted(parse(spark, message())))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_silver_values(spark):
    row = one(S.quote_metrics(S.stage_quotes(P.accepted(parse(spark, message())))))
    assert row.mid_price == pytest.approx(10.55) and row.spread == pytest.approx(0.1)
    assert row.spread_bps == pytest.approx(0.1 / 10.55 * 10000)
    assert row.order_imbalance == 0.0 and (row.bid_depth_total, row.ask_depth_total) == (2.0, 4.5)


def test_depth_is_null_when_only_deletions(spark):
    gone = [["10.5", "0.00000000"]]
    row = one(S.quote_metrics(S.stage_quotes(P.accepted(parse(spark, message(b=gone))))))
    assert row.bid_count == 1 and row.bid_depth_total is None and row.ask_depth_total == 4.5


def test_a_message_without_update_ids_is_rejected(spark):
    texts = ['{"e":"depthUpdate","E":1,"s":"A","U":1,"b":[],"a":[]}', '{"e":"depthUpdate","E":1,"s":"A","u":1,"b":[],"a":[]}', '{"e":"depthUpdate","E":1,"s":"A","U":1,"u":1,"b":[],"a":[]}']
    parsed = P.parse_depth(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [r.reject_reason for r in P.quarantine(parsed).collect()] == ["no_update_id"] * 2
    assert P.accepted(parsed).count() == 1
