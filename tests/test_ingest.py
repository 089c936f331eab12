import datetime as dt
import json

import pytest

from candlestream.operators.candles import ohlcv
from candlestream.operators.ingest import decode_trades, normalize_raw, to_topic_payload


def values(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_decode(spark):
    good = '{"symbol":"A","price":1.5,"quantity":2,"timestamp":1704067200123}'
    row = decode_trades(values(spark, good)).first()
    assert (row.symbol, row.price, row.quantity, row.price_volume) == ("A", 1.5, 2.0, 3.0)
    assert row.event_time == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)


def test_decode_binary_value_and_kept_columns(spark):
    df = values(spark, '{"symbol":"A"}').selectExpr("CAST(value AS BINARY) AS value", "7L AS offset")
    row = decode_trades(df, keep=("offset",)).first()
    assert (row.symbol, row.offset) == ("A", 7)


@pytest.mark.parametrize("bad", ["junk", None, '{"s":1}', "[1]", ""])
def test_malformed_is_a_null_row_and_no_candle(spark, bad):
    decoded = decode_trades(values(spark, bad))
    assert decoded.first().event_time is None
    assert ohlcv(decoded).count() == 0


def test_time_out_of_range_is_dirt(spark):
    rows = [f'{{"symbol":"A","price":1,"quantity":1,"timestamp":{t}}}'
            for t in (9223372036854775807, -9223372036854775808, 253402300799999)]
    times = [r.event_time is None for r in decode_trades(values(spark, *rows)).collect()]
    assert times == [True, True, False]


def test_quoted_price_in_a_trade_is_null(spark):
    df = values(spark, '{"symbol":"A","price":"1.5","quantity":2,"timestamp":1000}')
    assert decode_trades(df).first().price is None


def message(**changes):
    return json.dumps({"s": "A", "p": "1.5", "q": "2", "E": 1000, "x": "ignored", **changes})


@pytest.mark.parametrize("text, number", [
    ("1.5", 1.5), (" 1.5 ", 1.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("-2", -2.0),
    ("inf", float("inf")), (1.5, 1.5),
])
def test_raw_numbers(spark, text, number):
    good, rejects = normalize_raw(values(spark, message(p=text)))
    assert [tuple(r) for r in good.collect()] == [("A", number, 2.0, 1000)]
    assert rejects.count() == 0


@pytest.mark.parametrize("text", ["x", "", "1.5d", "1,5", "0x10", None, [1]])
def test_raw_bad_price_is_rejected_alone(spark, text):
    good, rejects = normalize_raw(values(spark, message(p=text), message()))
    assert good.count() == 1
    assert [r.reason for r in rejects.collect()] == ["no usable price"]


def test_raw_rejects_keep_the_message(spark):
    bad = ["junk", None, "{}", message(s=None, E="late")]
    good, rejects = normalize_raw(values(spark, *bad))
    assert good.count() == 0
    assert sorted((r.value or "", r.reason) for r in rejects.collect()) == sorted([
        ("junk", "unreadable message"), ("", "unreadable message"),
        ("{}", "unreadable message"), (bad[3], "no usable symbol,timestamp"),
    ])


def test_payload_round_trip(spark):
    good, _ = normalize_raw(values(spark, message()))
    payload = to_topic_payload(good)
    assert json.loads(payload.first().value) == {
        "symbol": "A", "price": 1.5, "quantity": 2.0, "timestamp": 1000,
    }
    assert decode_trades(payload).select(*good.columns).collect() == good.collect()
