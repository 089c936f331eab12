import math

import pytest

from candlestream.operators import indicators as ind
from candlestream.operators.history import drop_halo, split_history
from tests.data import candles, closes, column, model, walk


def test_rising(spark):
    c = ind.sma_cross(ind.bollinger(ind.rsi(closes(spark, range(1, 22)))))
    assert column(c, "rsi_14") == [None] * 13 + [100.0] * 8
    assert column(c, "sma_9")[8] == 5 and column(c, "sma_9")[20] == 17
    assert column(c, "sma_21") == [None] * 20 + [11.0]
    assert column(c, "sma_crossover") == ["NOT ENOUGH DATA"] * 20 + ["SMA9 ABOVE SMA21"]
    assert column(c, "bb_middle")[18:20] == [None, 10.5]
    assert column(c, "bb_upper")[19] == pytest.approx(10.5 + 2 * math.sqrt(35))
    assert column(c, "bb_lower")[19] == pytest.approx(10.5 - 2 * math.sqrt(35))
    assert column(c, "bb_signal")[18:20] == ["NOT ENOUGH DATA", "INSIDE BAND"]


def test_constant(spark):
    c = ind.obv(ind.sma_cross(ind.bollinger(ind.rsi(closes(spark, [10] * 21)))))
    last = c.orderBy("event_time").collect()[-1]
    assert (last.rsi_14, last.bb_upper, last.bb_lower, last.bb_signal) == (100, 10, 10, "INSIDE BAND")
    assert (last.sma_crossover, last.OBV) == ("NO CROSS", 0)


def test_first_row_of_the_rounded_family(spark):
    c = closes(spark, [10])
    c = ind.macd_sma(ind.rsi(c, warmup=False, digits=3))
    c = ind.obv(ind.bollinger(ind.volume_spike(c), warmup=False, digits=3))
    r = c.first()
    assert (r.RSI, r.MACD_Histogram, r.Volume_Spike, r.OBV, r.OBV_prv) == (100, 0, 0, 0, None)
    assert (r.BB_Upper, r.BB_Lower) == (None, None)


def test_change(spark):
    c = ind.close_change(closes(spark, [1, 3, 2]))
    assert column(c, "change") == [None, 2, -1]
    assert column(c, "gain") == [0, 2, 0] and column(c, "loss") == [0, 0, 1]


@pytest.mark.parametrize("volume, spike", [(15.0, 0), (15.1, 1)])
def test_spike_is_strict_and_excludes_the_row(spark, volume, spike):
    c = ind.volume_spike(closes(spark, [1] * 21, [10.0] * 20 + [volume]))
    assert column(c, "Volume_Spike") == [0] * 20 + [spike]


def test_obv(spark):
    c = ind.obv(closes(spark, [1, 2, 2, 1], [5, 7, 9, 4]))
    assert column(c, "OBV") == [0, 7, 7, 3] and column(c, "OBV_prv") == [None, 0, 7, 7]


def test_obv_carried(spark):
    c = closes(spark, [1, 2, 2, 1], [5, 7, 9, 4]).selectExpr(
        "*", "CASE minute(event_time) WHEN 0 THEN 0D WHEN 1 THEN 100D END AS carried"
    )
    assert column(ind.obv(c, "carried"), "OBV") == [0, 100, 100, 96]


def test_crossing(spark):
    # With 1- and 2-row means the gap is half the change.
    c = ind.sma_cross(closes(spark, [5, 4, 4, 5, 5, 4, 4, 3, 4]), short=1, long=2)
    assert column(c, "sma_crossover") == [
        "NOT ENOUGH DATA", "SMA1 BELOW SMA2", "NO CROSS", "GOLDEN CROSS", "NO CROSS",
        "DEATH CROSS", "NO CROSS", "DEATH CROSS", "GOLDEN CROSS",
    ]


def everything(c):
    c = ind.volume_spike(ind.macd_sma(ind.rsi(c), digits=None))
    return ind.obv(ind.sma_cross(ind.bollinger(c)))


def check(rows, c):
    found = {(r.symbol, r.close, r.event_time): r for r in c.collect()}
    assert len(found) == len(rows)
    symbols = {r[0] for r in rows}
    for symbol in symbols:
        mine = sorted((r for r in rows if r[0] == symbol), key=lambda r: r[1])
        got = sorted((k[2], r) for k, r in found.items() if k[0] == symbol)
        want = model([r[2] for r in mine], [float(r[3]) for r in mine])
        for (_, r), w in zip(got, want, strict=True):
            assert r.OBV == pytest.approx(w["obv"], abs=1e-6)
            assert r.Volume_Spike == w["spike"]
            assert r.MACD_Histogram == pytest.approx(w["histogram"], abs=1e-6)
            for name in ("rsi_14", "bb_upper", "sma_9", "sma_21"):
                if w[name] is None:
                    assert r[name] is None
                else:
                    assert r[name] == pytest.approx(w[name], abs=1e-6)


def test_against_the_model(spark):
    rows = walk(1, {"A": 90, "B": 40, "C": 1})
    check(rows, everything(candles(spark, rows).repartition(3)))


@pytest.mark.parametrize("seed, gap, cell, block", [
    (2, 1, "1 minute", 34),      # one candle per cell, the smallest block
    (3, 1, "16 minutes", 64),
    (4, 200, "16 minutes", 50),  # sparse: a halo spans many cells
    (5, 40, "10 days", 40),      # a cell larger than a block
    (6, 1, "45 minutes", 40),
])
def test_split_history_changes_nothing(spark, seed, gap, cell, block):
    rows = walk(seed, {"HOT": 400, "WARM": 70, "COLD": 20}, gap)
    c = split_history(candles(spark, rows), cell, 33, rows_per_block=block)
    check(rows, drop_halo(everything(c)))
