import pytest

from candlestream.operators import history
from candlestream.operators import indicators as ind
from candlestream.operators.history import BLOCK, HALO, cell_of, drop_halo, split_history
from candlestream.plans import strategies
from candlestream.plans.batch import advice
from tests.data import candles, trades, walk

REACH = strategies.MULTI.reach


def test_no_task_gets_a_hot_symbol(spark):
    rows = walk(1, {"HOT": 2000, **{f"S{i}": 10 for i in range(100)}})
    c = split_history(candles(spark, rows), cell_of("1 minute", 128), REACH, rows_per_block=128)
    sizes = c.groupBy("symbol", BLOCK).count().collect()
    cell = 128 // history.CELLS_PER_BLOCK
    assert max(r["count"] for r in sizes) <= 128 + cell + REACH + cell
    assert len([r for r in sizes if r.symbol == "HOT"]) == -(-2000 // 128)
    assert drop_halo(c).count() == len(rows)
    assert c.filter(HALO).count() <= 16 * (REACH + cell)


def test_short_histories_stay_whole(spark):
    c = candles(spark, walk(2, {"A": 50, "B": 60}))
    assert split_history(c, "1 minute", REACH, rows_per_block=60) is c


def test_missing_symbols_are_split_too(spark):
    c = candles(spark, walk(3, {"A": 300, "B": 20}))
    c = c.selectExpr("NULLIF(symbol, 'A') AS symbol", *c.columns[1:])
    split = split_history(c, "4 minutes", REACH, rows_per_block=64)
    assert drop_halo(split).count() == 320
    assert split.filter("symbol IS NULL").select(BLOCK).distinct().count() == 5


def test_large_block_map_is_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(history, "BROADCAST_ROWS", 3)
    c = candles(spark, walk(4, {"A": 300}))
    split = split_history(c, "4 minutes", REACH, rows_per_block=64)
    assert "ResolvedHint (strategy=broadcast)" not in split._jdf.queryExecution().logical().toString()
    assert drop_halo(split).count() == 300


def test_block_must_exceed_reach(spark):
    with pytest.raises(ValueError):
        split_history(candles(spark, walk(5, {"A": 3})), "1 minute", REACH, rows_per_block=33)
    few = trades(spark, [("A", 0, 1.0, 1.0)])
    with pytest.raises(ValueError):
        advice(few, strategies.MULTI, "60 seconds", rows_per_block=33)


@pytest.mark.parametrize("strategy", [strategies.MULTI, strategies.CROSS, strategies.RSI14])
def test_advice_is_the_same_however_it_is_split(spark, strategy):
    rows = walk(6, {"HOT": 260, "COLD": 45})
    data = trades(spark, [(s, 60 * m, c, float(v)) for s, m, c, v in rows])
    whole = advice(data, strategy, "60 seconds")
    split = advice(data, strategy, "60 seconds", rows_per_block=50)
    assert whole.count() == 305
    assert sorted(whole.collect(), key=str) == sorted(split.collect(), key=str)


def test_reach_is_that_of_the_widest_indicator():
    assert (strategies.MULTI.reach, strategies.CROSS.reach, strategies.RSI14.reach) == (33, 21, 14)
    assert strategies.BASIC.reach == 0 and strategies.MULTI.totals and not strategies.CROSS.totals


@pytest.mark.parametrize("indicator", [
    ind.Bollinger(100), ind.SmaCross(50, 200), ind.Rsi(100), ind.MacdSma(50, 100, 20),
    ind.VolumeSpike(90), ind.Obv(),
])
def test_wide_indicators_are_the_same_however_they_are_split(spark, indicator):
    rows = [(s, m, c, v + m % 9 * 0.00012345) for s, m, c, v in walk(7, {"HOT": 1500, "COLD": 45})]
    c = candles(spark, rows)
    whole = ind.add_indicators(c, indicator)
    split = split_history(c, cell_of("1 minute", 256), indicator.reach, rows_per_block=256)
    split = drop_halo(ind.add_indicators(split, indicator)).select(*whole.columns)
    assert sorted(whole.collect(), key=str) == sorted(split.collect(), key=str)


def test_totals_beyond_their_digits_are_an_error(spark):
    c = candles(spark, [("A", k, float(k), 1e19) for k in range(3)])
    with pytest.raises(Exception, match="(?i)overflow|out.of.range|cannot be represented"):
        ind.add_indicators(c, ind.Obv()).collect()
