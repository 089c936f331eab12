import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from candlestream.functions.features import candle_features, risk_level, single_candle_rsi
from candlestream.operators.candles import ohlcv
from tests.data import at, trades


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_candle(spark):
    c = one(ohlcv(trades(spark, [
        ("A", 3, 12.0, 1.0), ("A", 1, 10.0, 2.0), ("A", 9.5, 11.0, 1.0), ("A", 5, 9.0, 0.0),
    ])))
    assert (c.open, c.high, c.low, c.close, c.volume) == (10.0, 12.0, 9.0, 11.0, 4.0)
    assert (c.avg_price, c.vwap) == (10.5, 43.0 / 4)
    assert (c.window_start, c.window_end, c.event_time) == (at(0), at(10), at(9.5))


def test_window_edge(spark):
    df = ohlcv(trades(spark, [("A", 9.999, 1.0, 1.0), ("A", 10.0, 2.0, 1.0)]))
    assert sorted(r.window_start for r in df.collect()) == [at(0), at(10)]


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_ties_go_by_the_tie_column(spark, parts):
    rows = [("A", 1, 5.0, 1.0, 30), ("A", 1, 7.0, 1.0, -4), ("A", 1, 6.0, 1.0, 2**62)]
    c = one(ohlcv(trades(spark, rows, tie=True).repartition(parts), tie="id"))
    assert (c.open, c.close) == (7.0, 6.0)


def test_time_beats_tie(spark):
    rows = [("A", 1, 5.0, 1.0, 2**62), ("A", 1.000001, 7.0, 1.0, -(2**62))]
    c = one(ohlcv(trades(spark, rows, tie=True), tie="id"))
    assert (c.open, c.close) == (5.0, 7.0)


def test_tie_order_keeps_the_hash_aggregate(spark, capsys):
    ohlcv(trades(spark, [("A", 1, 5.0, 1.0, 1)], tie=True), tie="id").explain()
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_zero_volume_has_no_vwap(spark):
    c = one(ohlcv(trades(spark, [("A", 1, 5.0, 0.0), ("A", 2, 6.0, 0.0)])))
    assert (c.volume, c.vwap) == (0.0, None)


def test_missing_price_counts_for_volume_only(spark):
    c = one(ohlcv(trades(spark, [("A", 1, None, 1.0), ("A", 2, 6.0, 1.0), ("A", 3, None, 2.0)])))
    assert (c.open, c.close, c.volume, c.event_time) == (6.0, 6.0, 4.0, at(3))


def features(spark, o, h, l, c):
    row = spark.createDataFrame(
        [(o, h, l, c)], "open double, high double, low double, close double"
    )
    return one(risk_level(single_candle_rsi(candle_features(row))))


def test_flat_candle(spark):
    f = features(spark, 5.0, 5.0, 5.0, 5.0)
    assert (f.price_change, f.volatility, f.candle_strength, f.trend) == (0, 0, 0, "SIDEWAYS")
    assert f.rsi == 50


def test_open_zero_or_missing(spark):
    f = features(spark, 0.0, 1.0, 0.0, 1.0)
    assert (f.price_change_pct, f.volatility, f.trend) == (0, 0, "UP")
    f = features(spark, None, 1.0, 0.0, 1.0)
    assert (f.price_change, f.price_change_pct, f.trend) == (None, 0, "SIDEWAYS")
    assert f.risk_level == "LOW"


def test_single_candle_rsi(spark):
    assert features(spark, 100.0, 120.0, 100.0, 109.999).rsi == pytest.approx(99.99, abs=1e-9)
    assert features(spark, 100.0, 120.0, 80.0, 90.001).rsi == pytest.approx(0.01, abs=1e-9)


@pytest.mark.parametrize("volatility, level", [
    (1.999, "MEDIUM"), (2.0, "HIGH"), (0.999, "LOW"), (1.0, "MEDIUM"), (None, "LOW"),
])
def test_risk_bounds(spark, volatility, level):
    df = spark.createDataFrame([(volatility,)], "volatility double")
    assert risk_level(df).first().risk_level == level


row = st.tuples(
    st.sampled_from("ABC"), st.integers(0, 40), st.integers(1, 999), st.integers(0, 9)
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])))
def test_candle_properties(spark, rows):
    data = trades(spark, [(s, t, p / 10, float(q)) for s, t, p, q in rows])
    df = ohlcv(data)
    found = {(r.symbol, r.window_start): r for r in df.collect()}
    again = ohlcv(data.repartition(5, "price")).collect()
    assert {(r.symbol, r.window_start): r.close for r in again} == {
        k: r.close for k, r in found.items()
    }
    assert sum(r.volume for r in found.values()) == sum(q for *_, q in rows)
    for r in found.values():
        assert r.low <= min(r.open, r.close) and r.high >= max(r.open, r.close)
        assert r.vwap is None or r.low - 1e-9 <= r.vwap <= r.high + 1e-9
