import pytest

from candlestream.functions.rules import RuleList, advise
from candlestream.plans import signals



def label(spark, rules, **row):
    schema = ", ".join(
        f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in row.items()
    )
    values = tuple(v if isinstance(v, str) or v is None else float(v) for v in row.values())
    return advise(spark.createDataFrame([values], schema), rules).first().advice


@pytest.mark.parametrize("rsi, want", [
    (70, "STRONG SELL (Overbought)"), (30, "STRONG BUY (Oversold)"), (50, "HOLD (Neutral)"),
    (None, "HOLD (Neutral)"),
])
def test_basic(spark, rsi, want):
    assert label(spark, signals.BASIC, rsi=rsi) == want


V = dict(rsi=50, trend="SIDEWAYS", risk_level="LOW", volatility=0, close=10, vwap=10)


@pytest.mark.parametrize("row, want", [
    (dict(rsi=30, trend="UP"), "STRONG BUY (Oversold + Uptrend)"),
    (dict(rsi=30, risk_level="HIGH"), "WATCH BUY - HIGH RISK"),
    (dict(rsi=70, trend="DOWN"), "STRONG SELL (Overbought + Downtrend)"),
    (dict(rsi=70), "SELL WARNING (Overbought)"),
    (dict(volatility=2), "HOLD - HIGH VOLATILITY"),
    (dict(close=11, trend="UP"), "BUY SIGNAL (Above VWAP)"),
    (dict(close=9, trend="DOWN"), "SELL SIGNAL (Below VWAP)"),
    ({}, "HOLD (Neutral)"),
    (dict(close=11, trend="UP", vwap=None), "HOLD (Neutral)"),
    (dict(rsi=30, trend="DOWN"), "HOLD (Neutral)"),
])
def test_vwap(spark, row, want):
    assert label(spark, signals.VWAP, **{**V, **row}) == want


M = dict(
    risk_level="LOW", price_change_pct=0, close=10, BB_Upper=12, BB_Lower=8, OBV=1, OBV_prv=1,
    Volume_Spike=0, RSI=50, MACD_Histogram=0, candle_strength=0.8, trend="SIDEWAYS", vwap=10,
    volatility=0,
)
BUY = dict(close=8, RSI=29, Volume_Spike=1, OBV=2, MACD_Histogram=1)
SELL = dict(close=12, RSI=71, Volume_Spike=1, OBV=0, MACD_Histogram=-1)
UP = dict(trend="UP", close=11, OBV=2, MACD_Histogram=1)
DOWN = dict(trend="DOWN", close=9, OBV=0, MACD_Histogram=-1)


@pytest.mark.parametrize("row, want", [
    (dict(risk_level="HIGH", **BUY), 0),
    (dict(price_change_pct=6, close=13, OBV=-1), 1),
    (BUY, 2), ({**BUY, "candle_strength": 0.7}, 6), ({**BUY, "OBV_prv": None}, 6),
    (SELL, 3), ({**SELL, "RSI": 70}, 6),
    (UP, 4), ({**UP, "RSI": 40}, 4), ({**UP, "RSI": 65}, 4), ({**UP, "RSI": 66}, 6),
    ({**UP, "volatility": 2}, 6), ({**UP, "BB_Upper": None}, 6),
    (DOWN, 5), ({**DOWN, "vwap": None}, 6), ({}, 6),
])
def test_multi(spark, row, want):
    assert label(spark, signals.MULTI, **{**M, **row}) == signals.MULTI.labels()[want]


@pytest.mark.parametrize("rsi, want", [
    (None, "NOT ENOUGH DATA"), (30, "BUY SIGNAL"), (70, "SELL SIGNAL"), (31, "HOLD"),
])
def test_rsi14(spark, rsi, want):
    assert label(spark, signals.RSI14, rsi_14=rsi) == want


C = dict(rsi_14=50, sma_crossover="NO CROSS", close=10, bb_lower=8, bb_upper=12)


@pytest.mark.parametrize("row, want", [
    (dict(rsi_14=30, sma_crossover="GOLDEN CROSS"), "SUPER BUY (RSI<30 + Golden Cross)"),
    (dict(rsi_14=70, sma_crossover="DEATH CROSS"), "SUPER SELL (RSI>70 + Death Cross)"),
    (dict(rsi_14=30, sma_crossover="DEATH CROSS"), "BUY SIGNAL - OVERSOLD (RSI < 30)"),
    (dict(rsi_14=70), "SELL SIGNAL - OVERBOUGHT (RSI > 70)"),
    (dict(rsi_14=None, sma_crossover="GOLDEN CROSS"), "BUY SIGNAL - GOLDEN CROSS"),
    (dict(sma_crossover="DEATH CROSS"), "SELL SIGNAL - DEATH CROSS"),
    (dict(close=7), "WATCH BUY - BELOW LOWER BAND"),
    (dict(close=13), "WATCH SELL - ABOVE UPPER BAND"),
    (dict(close=13, bb_upper=None), "HOLD"), ({}, "HOLD"),
])
def test_cross(spark, row, want):
    assert label(spark, signals.CROSS, **{**C, **row}) == want


def test_rule_order(spark):
    rules = RuleList((("close > 1", "first"), ("close > 0", "second")), "none")
    assert [label(spark, rules, close=c) for c in (2, 1, 0)] == ["first", "second", "none"]
