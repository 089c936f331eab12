import datetime as dt
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from candlestream.operators.candles import ohlcv
from candlestream.operators.ingest import decode_trades
from candlestream.plans import strategies
from candlestream.plans.batch import advice
from candlestream.sources.files import replay_stream
from candlestream.sources.store import CandleStore
from candlestream.operators.latest import top_rows
from candlestream.sources.outside import CommittedSink
from candlestream.streaming import audit, jobs
from candlestream.streaming.audit import COUNTED, LATE, OPEN, UNUSABLE, trade_audit
from candlestream.streaming.jobs import streamed
from tests.data import at, trades, walk

WIDTH, DELAY = "60 seconds", "60 seconds"
SCHEMA = "symbol string, event_time timestamp, price double, quantity double"


def stream_candles(*args, **options):
    return jobs.stream_candles(*args, **{"once": True, **options})


def stream_labels(*args, **options):
    return jobs.stream_labels(*args, **{"once": True, **options})


class Feed:
    """A folder of trade files, one micro-batch each, in the order they were added."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)
        self.store = CandleStore(spark, f"{self.path}/store")

    def add(self, df):
        df.coalesce(1).write.mode("append").parquet(f"{self.path}/feed")

    def stream(self):
        return replay_stream(self.spark, f"{self.path}/feed", SCHEMA, files_per_batch=1)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def ticks(spark, rows):
    """A trade per walk row, at its minute."""
    return trades(spark, [(s, 60 * m + 5, c, float(v)) for s, m, c, v in rows])


def name(purpose):
    return f"{purpose}_{uuid.uuid4().hex[:8]}"


def finish(query):
    query.awaitTermination()
    return query


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def closed(df, newest):
    limit = newest - dt.timedelta(seconds=60)
    if "window_end" in df.columns:
        return df.filter(F.col("window_end") <= F.lit(limit))
    return df.filter(F.date_trunc("minute", "event_time") + F.expr("INTERVAL 1 MINUTE") <= F.lit(limit))


def cut(spark, rows, parts):
    """The rows in `parts` files by time."""
    rows = sorted(rows, key=lambda r: r[1])
    size = -(-len(rows) // parts)
    return [ticks(spark, rows[i:i + size]) for i in range(0, len(rows), size)]


def newest_of(data):
    return at(60 * max(r[1] for r in data) + 5)


def test_row_by_row_stream_equals_batch(spark, feed):
    data = walk(1, {"A": 60, "B": 30})
    for part in cut(spark, data, 3):
        feed.add(part)
    job = name("vwap")
    finish(stream_candles(feed.stream(), strategies.VWAP, feed.store, job, WIDTH, DELAY))
    want = closed(advice(ticks(spark, data), strategies.VWAP, WIDTH), newest_of(data))
    got = streamed(feed.store, job).select(*want.columns)
    assert rows(got) == rows(want) and want.count() > 50


def stream_in_state(*args, **options):
    return jobs.stream_labels_in_state(*args, **{"once": True, **options})


@pytest.mark.parametrize("job_of", [stream_labels, stream_in_state])
@pytest.mark.parametrize("strategy, parts, block", [
    (strategies.MULTI, 2, 1 << 18), (strategies.CROSS, 5, 1 << 18), (strategies.MULTI, 3, 40),
    (strategies.RSI14, 1, 40),
])
def test_split_points_do_not_matter(spark, feed, job_of, strategy, parts, block):
    data = walk(2, {"A": 150, "B": 60, "C": 3}, gap=2)
    for part in cut(spark, data, parts):
        feed.add(part)
    job = name("labels")
    finish(job_of(
        feed.stream(), strategy, feed.store, job, WIDTH, DELAY, rows_per_block=block
    ))
    want = closed(advice(ticks(spark, data), strategy, WIDTH), newest_of(data))
    got = feed.store.labels(strategy.schema(spark), job).select(*strategy.columns)
    assert rows(got) == rows(want) and want.count() > 150
    stored = feed.store.candles().filter(F.col("writer") == job)
    assert stored.count() == want.count()


@pytest.mark.parametrize("job_of", [stream_labels, stream_in_state])
def test_restart_goes_on_where_it_stopped(spark, feed, job_of):
    data = walk(3, {"A": 80, "B": 50})
    job = name("restart")
    for part in cut(spark, data, 3):
        feed.add(part)
        finish(job_of(feed.stream(), strategies.MULTI, feed.store, job, WIDTH, DELAY))
    want = closed(advice(ticks(spark, data), strategies.MULTI, WIDTH), newest_of(data))
    got = feed.store.labels(strategies.MULTI.schema(spark), job)
    assert rows(got.select(*strategies.MULTI.columns)) == rows(want)


def test_state_of_other_symbols_is_not_touched(spark, feed):
    """Incomplete candles, fractional volumes, and batches of one symbol of three."""
    data = [(s, m, c, v + m % 7 * 0.00012345) for s, m, c, v in walk(12, {"A": 60, "B": 60, "C": 60})]
    early = [r for r in data if r[1] <= 30]
    only_a = [r for r in data if r[1] > 30 and r[0] == "A"]
    blank = trades(spark, [("A", 60 * 31 + 5, None, 2.0)])
    job = name("labels")
    only_a = [r for r in only_a if r[1] > 31]
    for part in (ticks(spark, early), blank.unionByName(ticks(spark, only_a[:10]).select(*blank.columns)),
                 ticks(spark, only_a[10:])):
        feed.add(part)
    query = finish(stream_in_state(feed.stream(), strategies.CROSS, feed.store, job, WIDTH, DELAY))
    given = spark.read.parquet(f"{feed.path}/feed")
    want = closed(advice(given, strategies.CROSS, WIDTH), newest_of(only_a))
    got = feed.store.labels(strategies.CROSS.schema(spark), job).select(*strategies.CROSS.columns)
    assert rows(got) == rows(want)
    # Per symbol the remembered candles and one total are written: of A alone in the last batch.
    updated = [
        o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"]
        if "transformWithState" in o["operatorName"]
    ]
    assert 0 < updated[-1] <= strategies.CROSS.reach + 1 < max(updated)


def test_a_batch_replayed_after_its_commit_adds_nothing(spark, feed, monkeypatch):
    """The driver is lost after the candles of a batch are stored, and once after its labels are."""
    data = walk(13, {"A": 60, "B": 30})
    job = name("replayed")
    for k, part in enumerate(cut(spark, data, 3)):
        feed.add(part)
        if k:
            with monkeypatch.context() as broken:
                own = CandleStore.write_labels

                def lost(*args, _own=own, _k=k):
                    if _k == 2:
                        _own(*args)
                    raise RuntimeError("the driver is lost")

                broken.setattr(CandleStore, "write_labels", lost)
                with pytest.raises(Exception, match="lost"):
                    finish(stream_in_state(feed.stream(), strategies.MULTI, feed.store, job, WIDTH, DELAY))
            feed.store = CandleStore(spark, feed.store.path)
        finish(stream_in_state(feed.stream(), strategies.MULTI, feed.store, job, WIDTH, DELAY))
    want = closed(advice(ticks(spark, data), strategies.MULTI, WIDTH), newest_of(data))
    got = feed.store.labels(strategies.MULTI.schema(spark), job).select(*strategies.MULTI.columns)
    assert rows(got) == rows(want)
    assert feed.store.candles(name=job).count() == want.count()


def fates(store, job, given):
    found = trade_audit(given, streamed(store, job), WIDTH).collect()
    total = {}
    for r in found:
        total[r.symbol, r.fate] = total.get((r.symbol, r.fate), 0) + r.n
    return total


def test_every_trade_has_one_fate(spark, feed):
    data = walk(4, {"A": 60, "B": 30})
    parts = cut(spark, data, 4)
    job = name("candles")
    late = trades(spark, [("A", 10, 1.0, 1.0), ("B", 70, 1.0, 1.0), ("B", 70, 2.0, 1.0)])
    lost = late.limit(1).withColumn("event_time", F.lit(None).cast("timestamp"))
    for part in (*parts[:3], late.union(lost), parts[3]):
        feed.add(part)
    finish(stream_candles(feed.stream(), strategies.BASIC, feed.store, job, WIDTH, DELAY))
    given = spark.read.parquet(f"{feed.path}/feed")
    got = fates(feed.store, job, given)
    assert sum(got.values()) == given.count()
    assert got["A", UNUSABLE] == 1 and got["A", LATE] == 1 and got["B", LATE] == 2
    counted = streamed(feed.store, job).groupBy("symbol").agg(F.sum("n_trades")).collect()
    assert all(got[symbol, COUNTED] == n for symbol, n in counted)
    assert sum(n for (_, fate), n in got.items() if fate == OPEN) <= 4


def test_a_trade_counted_in_a_later_batch_is_not_late(spark, feed):
    """Three files, one per batch: minute 1 comes again in the second, before it is closed."""
    job = name("candles")
    for second, price in ((65, 1.0), (66, 999.0), (400, 2.0), (900, 3.0)):
        feed.add(trades(spark, [("A", second, price, 1.0)]))
    finish(stream_candles(feed.stream(), strategies.BASIC, feed.store, job, WIDTH, DELAY))
    assert streamed(feed.store, job).agg(F.max("high")).first()[0] == 999.0
    got = fates(feed.store, job, spark.read.parquet(f"{feed.path}/feed"))
    assert got["A", COUNTED] == 3 and ("A", LATE) not in got


def test_audit_by_a_stream_of_its_own(spark, feed):
    """Each trade is counted once over runs and replays, and the state says which windows are open."""
    data = walk(14, {"A": 60, "B": 30})
    parts = cut(spark, data, 4)
    late = trades(spark, [("A", 10, 1.0, 1.0), ("B", 70, 1.0, 1.0), (None, 70, 2.0, 1.0)])
    lost = late.limit(1).withColumn("event_time", F.lit(None).cast("timestamp"))
    job, own = name("candles"), name("audit")
    read = []
    for more in ((parts[0], parts[1]), (late.union(lost), parts[2]), (parts[3],)):
        for part in more:
            feed.add(part)
        finish(stream_candles(feed.stream(), strategies.BASIC, feed.store, job, WIDTH, DELAY))
        query = finish(audit.stream_audit(feed.stream(), feed.store, own, WIDTH, once=True))
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
        given = spark.read.parquet(f"{feed.path}/feed")
        counts = audit.audited(feed.store, own)
        assert rows(counts.groupBy("symbol", "window_start", "end").agg(F.sum("n"))) == rows(
            audit.given_counts(given, WIDTH))
        final = streamed(feed.store, job)
        whole = rows(trade_audit(given, final, WIDTH))
        assert rows(audit.fates(counts, final)) == whole
        held = audit.open_windows(feed.store, job)
        assert rows(audit.fates(counts, final, held)) == whole
        assert held.count() == sum(r[2] == OPEN for r in whole) > 0
    assert sum(read) == given.count() and read[2] == parts[3].count()


def test_newest_rows_are_kept_published(spark, feed, monkeypatch):
    data = walk(15, {"A": 90, "B": 20})
    job = name("live")
    for part in cut(spark, data, 4):
        feed.add(part)
    finish(stream_in_state(feed.stream(), strategies.RSI14, feed.store, job, WIDTH, DELAY, newest=7))
    want = closed(advice(ticks(spark, data), strategies.RSI14, WIDTH), newest_of(data))
    view = feed.store.published(jobs.newest_table(job))
    assert rows(view) == rows(top_rows(want, 7)) and view.count() == 14
    # A batch merged before changes nothing.
    version = feed.store.version(jobs.newest_table(job))
    jobs.publish_newest(feed.store, view, 7, version, job)
    assert rows(feed.store.published(jobs.newest_table(job))) == rows(view)


def test_a_sink_that_commits_sees_a_replayed_batch_once(spark, feed, monkeypatch):
    data = walk(16, {"A": 60})
    sink = CommittedSink("parquet", {"path": f"{feed.path}/rows"}, {"path": f"{feed.path}/commits"})
    job = name("outside")
    feed.add(ticks(spark, data))

    def run():
        finish(stream_labels(feed.stream(), strategies.RSI14, feed.store, job, WIDTH, DELAY, sink=sink))

    with monkeypatch.context() as broken:
        def lost(*args):
            raise RuntimeError("the driver is lost")

        broken.setattr(CandleStore, "write_state", lost)
        with pytest.raises(Exception, match="lost"):
            run()
    run()
    want = closed(advice(ticks(spark, data), strategies.RSI14, WIDTH), newest_of(data))
    got = sink.read(spark, want.schema)
    assert rows(got.select(*want.columns)) == rows(want)
    assert spark.read.parquet(f"{feed.path}/rows").count() == 2 * want.count()


def test_late_trades_change_nothing_after_a_restart(spark, feed):
    data = walk(4, {"A": 60, "B": 30})
    feed.add(ticks(spark, data))
    job = name("candles")

    def run():
        finish(stream_candles(feed.stream(), strategies.BASIC, feed.store, job, WIDTH, DELAY))

    run()
    before = rows(streamed(feed.store, job))
    feed.add(trades(spark, [("A", 10, 1.0, 1.0), ("B", 70, 1.0, 1.0)]))
    run()
    assert rows(streamed(feed.store, job)) == before


def test_empty_batches_and_untouched_symbols(spark, feed):
    """A batch without a final candle writes no state; one symbol's batch keeps the others'."""
    data = walk(7, {"A": 60, "B": 60})
    early = [r for r in data if r[1] <= 40]
    only_a = [r for r in data if r[1] > 40 and r[0] == "A"]
    job = name("labels")
    for part in (early, [early[0]], only_a[: len(only_a) // 2], only_a[len(only_a) // 2 :]):
        feed.add(ticks(spark, part))
    finish(stream_labels(feed.stream(), strategies.MULTI, feed.store, job, WIDTH, DELAY))
    want = closed(advice(ticks(spark, early + only_a), strategies.MULTI, WIDTH), newest_of(early + only_a))
    got = feed.store.labels(strategies.MULTI.schema(spark), job)
    extra = ticks(spark, [early[0]])
    assert extra.count() == 1
    assert got.count() == want.count()
    assert {r.symbol for r in got.collect()} == {"A", "B"}


def test_wide_strategies_stream_as_in_batch(spark, feed):
    from dataclasses import replace

    from candlestream.operators import indicators as ind

    wide = replace(strategies.CROSS, indicators=(ind.Bollinger(50), ind.SmaCross(), ind.Rsi()))
    data = walk(8, {"A": 150, "B": 60})
    for part in cut(spark, data, 4):
        feed.add(part)
    job = name("wide")
    finish(stream_labels(feed.stream(), wide, feed.store, job, WIDTH, DELAY))
    want = closed(advice(ticks(spark, data), wide, WIDTH), newest_of(data))
    got = feed.store.labels(wide.schema(spark), job).select(*wide.columns)
    assert wide.reach == 49 and rows(got) == rows(want)


def test_fractional_volumes_add_up_in_any_batches(spark, feed):
    data = [(s, m, c, v + m % 7 * 0.00012345) for s, m, c, v in walk(9, {"A": 120})]
    for part in cut(spark, data, 5):
        feed.add(part)
    job = name("fractions")
    finish(stream_labels(feed.stream(), strategies.MULTI, feed.store, job, WIDTH, DELAY))
    want = closed(advice(ticks(spark, data), strategies.MULTI, WIDTH), newest_of(data))
    got = feed.store.labels(strategies.MULTI.schema(spark), job).select(*strategies.MULTI.columns)
    assert rows(got) == rows(want)


def test_a_running_stream_takes_batch_after_batch(spark, feed):
    """Processing-time trigger, the strategy's own; labels also go to a sink."""
    data = walk(10, {"A": 60})
    parts = cut(spark, data, 3)
    job, sink = name("running"), f"{feed.path}/sink"
    feed.add(parts[0])
    query = stream_labels(
        feed.stream(), strategies.RSI14, feed.store, job, WIDTH, DELAY, trigger="100 milliseconds",
        sink=("parquet", {"path": sink}), once=False,
    )
    try:
        for part in parts[1:]:
            query.processAllAvailable()
            feed.add(part)
        query.processAllAvailable()
    finally:
        query.stop()
    want = closed(advice(ticks(spark, data), strategies.RSI14, WIDTH), newest_of(data))
    assert rows(spark.read.parquet(sink).select(*want.columns)) == rows(want)
    assert strategies.MULTI.trigger == "60 seconds"


def test_json_stream(spark, tmp_path):
    lines = [
        f'{{"symbol":"A","price":{100 + i},"quantity":1,"timestamp":{i * 1000}}}' for i in range(90)
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join([*lines, "junk"]))
    raw = replay_stream(spark, str(tmp_path / "in"), "value string", "text")
    store, job = CandleStore(spark, str(tmp_path / "store")), name("json")
    finish(stream_candles(decode_trades(raw), strategies.BASIC, store, job))
    batch = ohlcv(decode_trades(spark.read.text(str(tmp_path / "in"))))
    assert streamed(store, job).count() == batch.filter("unix_millis(window_end) <= 79000").count() == 7


def test_one_checkpoint_per_stream(spark, feed):
    feed.add(ticks(spark, walk(5, {"A": 5})))
    job = name("twice")
    args = (feed.stream(), strategies.BASIC, feed.store, job, WIDTH, DELAY)
    running = stream_candles(*args, trigger="1 hour", once=False)
    try:
        with pytest.raises(PySparkException):
            stream_candles(*args)
    finally:
        running.stop()


def test_strategies_go_to_the_right_job(feed):
    with pytest.raises(ValueError):
        stream_candles(None, strategies.MULTI, feed.store, "x")


def test_totals_need_the_whole_history(spark):
    from candlestream.plans.panels import newest_labels

    with pytest.raises(ValueError):
        newest_labels(None, strategies.MULTI, 5)
