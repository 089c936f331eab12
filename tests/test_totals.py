"""Running totals from an index, candles rolled up from parts, and split totals in one exchange."""

import pathlib

import pytest
from pyspark.sql import functions as F

from candlestream import session
from candlestream.operators import history, totals
from candlestream.operators.candles import finished, ohlcv, partial_candles, rolled_up
from candlestream.plans import strategies
from candlestream.plans.batch import advice, stored_advice
from candlestream.plans.panels import newest_labels
from candlestream.sources.store import CandleStore
from tests.data import candles, trades, walk

WIDTH = "60 seconds"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def many_days(spark, seed=1):
    """Some candles on each of ten dates, one symbol with gaps, one that ends early, one new."""
    found = []
    for s, days, step in (("A", range(10), 1), ("B", range(0, 10, 3), 2), ("C", range(4), 1), ("D", range(8, 10), 1)):
        base = walk(seed + ord(s), {s: 18 * len(days)})
        for k, (_, _, close, volume) in enumerate(base):
            found.append((s, 1440 * days[k // 18] + 7 * (k % 18) * step, close, volume + k % 7 * 0.00012345))
    return candles(spark, found)


@pytest.fixture
def stored(spark, tmp_path):
    store = CandleStore(spark, str(tmp_path / "store"))
    c = many_days(spark)
    store.append(c, 0, "one")
    return store, c


def labelled(c, strategy=strategies.MULTI):
    return strategy.label(c).select(*strategy.columns)


@pytest.mark.parametrize("n", [1, 17, 40, 1000])
def test_newest_rows_equal_those_of_the_whole_history(spark, stored, n):
    store, c = stored
    own = store.candles(c.schema, name="one")
    index, _ = session.materialize(totals.total_index(own, WIDTH), "index")
    want = labelled(c).withColumn("k", F.expr("row_number() OVER (PARTITION BY symbol ORDER BY event_time DESC)"))
    got = newest_labels(own, strategies.MULTI, n, index)
    assert rows(got) == rows(want.filter(F.col("k") <= n).drop("k"))


def test_a_panel_reads_the_dates_it_needs(spark, stored):
    store, c = stored
    own = store.candles(c.schema, name="one")
    index, _ = session.materialize(totals.total_index(own, WIDTH), "index")
    only = ("A", "D")
    want = rows(newest_labels(own, strategies.MULTI, 5, index).filter(F.col("symbol").isin(*only)))
    for file in pathlib.Path(f"{store.path}/candles/data").rglob("dt=2024-01-0[1-3]/*.parquet"):
        file.write_bytes(b"not a table")
    later = index.filter(F.col("symbol").isin(*only))
    got = newest_labels(store.candles(c.schema, name="one"), strategies.MULTI, 5, later)
    assert rows(got) == want and len(want) == 10


def test_look_back_with_totals(spark, stored):
    store, c = stored
    own = store.candles(c.schema, name="one")
    index, _ = session.materialize(totals.total_index(own, WIDTH), "index")
    as_of = F.lit("2024-01-10 12:00:00").cast("timestamp")
    since = as_of - F.expr("INTERVAL 80 HOURS")
    want = labelled(c).filter(F.col("event_time") >= since)
    got = stored_advice(own, strategies.MULTI, WIDTH, "80 HOURS", as_of, warm=True, totals=index)
    split = stored_advice(own, strategies.MULTI, WIDTH, "80 HOURS", as_of, warm=True, totals=index, rows_per_block=40)
    assert rows(got) == rows(want) == rows(split) and want.count() > 20
    with pytest.raises(ValueError, match="index"):
        stored_advice(own, strategies.MULTI, WIDTH, "80 HOURS", as_of, warm=True)


def test_an_extended_index_is_the_whole_one(spark, stored):
    store, c = stored
    own = store.candles(c.schema, name="one")
    whole = rows(totals.total_index(own, WIDTH, rows_per_block=40))
    for middle in ("2024-01-01", "2024-01-05", "2024-01-09", "2024-02-01"):
        old, _ = session.materialize(totals.total_index(own.filter(F.col("dt") < middle), WIDTH), "index")
        assert rows(totals.extended_index(old, own, middle, WIDTH)) == whole
    assert rows(totals.total_index(c.limit(0), WIDTH)) == []


def test_shuffled_spans(spark, stored, monkeypatch):
    store, c = stored
    index, _ = session.materialize(totals.total_index(c, WIDTH), "index")
    want = rows(newest_labels(c, strategies.MULTI, 9, index))
    monkeypatch.setattr(totals, "BROADCAST_ROWS", 0)
    assert rows(newest_labels(c, strategies.MULTI, 9, index)) == want


def test_split_totals_exchange_the_candles_once(spark, monkeypatch, capsys):
    plans = {}
    own = session.materialize

    def seen(df, purpose="table"):
        capsys.readouterr()
        df.explain()
        plans[purpose] = capsys.readouterr().out
        return own(df, purpose)

    monkeypatch.setattr(session, "materialize", seen)
    data = trades(spark, [(s, 60 * m, c, float(v)) for s, m, c, v in walk(6, {"HOT": 260, "COLD": 45})])
    split = advice(data, strategies.MULTI, WIDTH, rows_per_block=50)
    capsys.readouterr()
    split.explain()
    final = capsys.readouterr().out
    assert plans["blocks"].count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning" not in final
    whole = rows(advice(data, strategies.MULTI, WIDTH))
    assert rows(split) == whole
    monkeypatch.setattr(history, "BROADCAST_ROWS", 0)
    assert rows(advice(data, strategies.MULTI, WIDTH, rows_per_block=50)) == whole


ODD = [("A", 0, 5.0, 1.0), ("A", 0, 7.0, 2.0), ("A", 59, 6.0, None), ("A", 61, None, 3.0), ("A", 130, 4.0, 0.0),
       ("B", 10, None, 1.0), ("B", 200, 3.0, 0.0), (None, 5, 2.0, 2.0), ("A", 3599, 9.0, 0.1), ("A", 3600, 8.0, 0.2)]


def test_rolled_up_candles_are_those_of_the_trades(spark):
    t = trades(spark, ODD + [("C", 37 * k, float(k % 11), 0.1 * k) for k in range(300)])
    t = t.withColumn("id", F.xxhash64("symbol", "price", "quantity"))
    minutes = partial_candles(t, "1 minute", tie="id")
    assert rows(finished(minutes, counted=True)) == rows(ohlcv(t, "1 minute", tie="id", counted=True))
    for width in ("5 minutes", "1 hour"):
        straight = ohlcv(t, width, tie="id", counted=True)
        again = rolled_up(rolled_up(minutes, "5 minutes"), width)
        number = [F.round(c, 9).alias(c) if k == "double" else c for c, k in straight.dtypes]
        assert rows(finished(again, counted=True).select(*number)) == rows(straight.select(*number))
    empty = partial_candles(t.limit(0), "1 minute", tie="id")
    assert finished(rolled_up(empty, "1 hour")).count() == 0


def test_parts_that_cross_a_window_are_an_error(spark):
    parts = partial_candles(trades(spark, [("A", 60 * k, 1.0, 1.0) for k in range(30)]), "7 minutes")
    with pytest.raises(Exception, match="cannot be made"):
        rolled_up(parts, "10 minutes").collect()
