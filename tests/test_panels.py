import datetime as dt

from pyspark.sql import functions as F

from candlestream.operators.latest import latest_n, recent, top_rows
from candlestream.plans import panels, strategies
from tests.data import at, candles, walk


def minutes(df, time="time"):
    return [int((r[time] - at(0)).total_seconds() // 60) for r in df.collect()]


def test_newest_rows_ascending(spark):
    c = candles(spark, [("A", i, 1.0) for i in range(600)])
    got = latest_n(c.repartition(7), 500).collect()
    assert [r.event_time for r in got] == [at(60 * i + 59) for i in range(100, 600)]


def test_newest_per_symbol_and_filter(spark):
    c = candles(spark, walk(1, {"A": 50, "B": 5, "C": 20}))
    got = latest_n(c, 10, ascending=False).collect()
    assert [r.symbol for r in got] == ["A"] * 10 + ["B"] * 5 + ["C"] * 10
    assert got[0].event_time > got[9].event_time
    assert {r.symbol for r in latest_n(c, 3, symbols=["B", "C"]).collect()} == {"B", "C"}


def test_merge_in_groups_is_exact(spark, monkeypatch):
    from candlestream.operators import latest

    monkeypatch.setattr(latest, "MERGE_GROUPS", 3)
    c = candles(spark, [("A", i, 1.0) for i in range(400)]).repartition(11)
    assert sorted(minutes(top_rows(c, 7), "event_time")) == list(range(393, 400))


def test_pruned_before_the_shuffle(spark, capsys):
    top_rows(candles(spark, [("A", 1, 1.0)]), 5).explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 4


def test_mixed_store_loses_no_row(spark):
    c = candles(spark, [("A", i, 1.0) for i in range(6)]).withColumns({
        "rsi": F.lit(50.0), "advice": F.lit("HOLD"),
    })
    odd = F.minute("event_time") % 2 == 1
    mixed = c.withColumn("window_start", F.when(~odd, F.col("window_start")))
    got = panels.mixed_chart(mixed)
    assert minutes(got) == [0, 1, 2, 3, 4, 5]
    assert got.collect()[1].time == at(60 + 59)
    assert minutes(panels.window_chart(mixed)) == [0, 2, 4]
    assert panels.candle_chart(mixed).columns == [
        "symbol", "time", "open", "high", "low", "close", "rsi", "advice",
    ]


def test_newest_labels_equal_the_whole_history(spark):
    c = candles(spark, walk(2, {"A": 120, "B": 38, "C": 5}))
    columns = strategies.CROSS.columns
    whole = latest_n(strategies.CROSS.label(c).select(*columns), 30).collect()
    part = panels.newest_labels(c, strategies.CROSS, 30).orderBy("symbol", "event_time").collect()
    assert whole == part and len(whole) == 65


def test_panel_titles(spark):
    rows = strategies.CROSS.label(candles(spark, walk(3, {"A": 30, "B": 30})))
    assert panels.band_panel(rows).columns[2:] == list(panels.BAND_TITLES.values())
    assert panels.sma_rsi_panel(rows, 4).count() == 8
    table = panels.signal_table(rows, symbols=["A"])
    assert table.columns == list(panels.SIGNAL_TITLES.values()) and table.count() == 15
    times = [r[0] for r in table.collect()]
    assert times == sorted(times, reverse=True)


def test_newest_of_the_table(spark):
    c = candles(spark, walk(4, {"A": 20, "B": 9}))
    assert minutes(panels.newest(c, 5), "event_time") == [20, 19, 18, 17, 16]


def test_recent(spark):
    c = candles(spark, [("A", i, 1.0) for i in range(200)] + [("B", 199, 1.0)])
    c = c.withColumn("close", F.when(F.minute("event_time") != 5, F.col("close")))
    as_of = F.lit(at(60 * 199 + 59))
    assert recent(c, "2 HOURS", as_of).count() == 121 + 1 - 2
    assert recent(c, "30 MINUTES", as_of, ["B"]).count() == 1
    assert recent(c, "2 HOURS").count() == 0
    now = candles(spark, [("A", 0, 1.0)]).withColumn("event_time", F.current_timestamp())
    assert recent(now, "30 MINUTES").count() == 1


def test_time_filter_reaches_the_files(spark, tmp_path, capsys):
    candles(spark, [("A", 0, 1.0)]).write.parquet(str(tmp_path / "c"))
    recent(spark.read.parquet(str(tmp_path / "c")), "2 HOURS", F.lit(dt.datetime(2024, 1, 2)),
           ["A"]).select("symbol", "close").explain()
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(event_time" in plan and "EqualTo(symbol,A)" in plan
    assert "ReadSchema: struct<symbol:string,close:double,event_time:timestamp>" in plan
