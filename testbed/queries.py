"""Registered queries: every operator over the driver's whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlestream.functions.features import candle_features, risk_level, single_candle_rsi
from candlestream.operators import indicators as ind
from candlestream.operators.candles import finished, ohlcv, partial_candles, rolled_up
from candlestream.operators.history import ROWS_PER_BLOCK, drop_halo
from candlestream.operators.ingest import decode_trades, normalize_raw, to_topic_payload
from candlestream.operators.latest import latest_n, recent
from candlestream.operators.totals import extended_index, total_index
from candlestream.plans import panels, reports, strategies
from candlestream.plans.batch import advice, bounded_history, stored_advice, stored_candles
from candlestream.schemas import SALES_SCHEMA, STUDENT_SCHEMA
from candlestream.session import materialize, new_folder, stream_session
from candlestream.sources.files import infer_csv, read_csv, read_lines, tab_lines, write_tab_lines
from candlestream.sources.store import CandleStore
from candlestream.sources.outside import CommittedSink
from candlestream.streaming.audit import (
    COUNTED, LATE, audited, fates, open_windows, stream_audit, trade_audit,
)
from candlestream.streaming.jobs import (
    newest_table, stream_candles, stream_labels, stream_labels_in_state, streamed,
)
from testbed import adapters as tb

Query = Callable[[SparkSession, str], DataFrame]

WIDTH, DELAY = "1 hour", "1 hour"
TIE = "event_id"
KEY = ["symbol", "event_time"]

# Small enough that the split-history path runs on every test table; the second, for indicators
# that look back further.
SMALL_BLOCK, WIDE_BLOCK = 64, 256


def edge(df: DataFrame) -> DataFrame:
    """Doubles rounded for comparison across engines: first to nine digits, which removes float
    noise, then to six. In one step a mean such as 0.0000005 would go either way."""
    return df.withColumns({
        name: F.round(F.round(F.col(f"`{name}`"), 9), 6) for name, kind in df.dtypes if kind == "double"
    })


# Ingest

def trades_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.zoneless(edge(decode_trades(tb.topic_values(spark, sf_dir))))


def trades_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_raw(tb.raw_messages(spark, sf_dir))[0]


def trades_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_raw(tb.raw_messages(spark, sf_dir))[1]


def topic_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_topic_payload(decode_trades(tb.topic_values(spark, sf_dir)))


# Candles and their features

def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlcv(tb.trades(spark, sf_dir), WIDTH, tie=TIE)


def candles(width: str) -> Query:
    return lambda spark, sf_dir: edge(ohlcv(tb.trades(spark, sf_dir), width, tie=TIE))


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candle_features(hourly(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(_features(spark, sf_dir).select(
        *KEY, "price_change", "price_change_pct", "volatility", "trend", "body_size",
        "range_size", "candle_strength",
    ))


def candle_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(risk_level(_features(spark, sf_dir)).select(*KEY, "volatility", "risk_level"))


def rsi_single_candle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(
        single_candle_rsi(hourly(spark, sf_dir)).select(*KEY, "close", "rsi")
    )


def candles_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-minute parts, stored; hours of these, stored again; six hours of the hours."""
    store = _store(spark)
    parts = partial_candles(tb.trades(spark, sf_dir), "10 minutes", tie=TIE)
    store.append(parts, 0, "minutes")
    store.append(rolled_up(store.candles(parts.schema, name="minutes"), WIDTH), 0, "hours")
    return edge(finished(rolled_up(store.candles(parts.schema, name="hours"), "6 hours")))


# Rolling indicators

def rolling(
    indicator: ind.Indicator, *columns: str, rows_per_block: int = ROWS_PER_BLOCK,
    fractional: bool = False,
) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = tb.trades(spark, sf_dir)
        if fractional:
            c, rows = materialize(_fractional(t), "candles")
            c = bounded_history(c, rows, WIDTH, indicator.reach, rows_per_block)
        else:
            c = stored_candles(t, WIDTH, indicator.reach, TIE, rows_per_block)
        return edge(drop_halo(ind.add_indicators(c, indicator)).select(*KEY, *columns))
    return query


def _fractional(trades: DataFrame) -> DataFrame:
    """Candles whose volumes have eight decimals, as exchanges quote them."""
    candles = ohlcv(trades, WIDTH, tie=TIE)
    return candles.withColumn("volume", F.round(F.col("volume") * (F.col("close") - 10000.0) / 7000, 8))


# Advice

def labelled(strategy: strategies.Strategy, **options: int) -> Query:
    return lambda spark, sf_dir: edge(
        advice(tb.trades(spark, sf_dir), strategy, WIDTH, TIE, **options)
    )


def advice_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored candles of two writers; labels of one writer's last 96 hours, published."""
    store = _store(spark)
    store.append(hourly(spark, sf_dir), 0, "hours")
    store.append(ohlcv(tb.trades(spark, sf_dir), "6 hours", tie=TIE), 0, "sixes")
    as_of = tb.table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    stored = store.candles(hourly(spark, sf_dir).schema, name="hours")
    labels = stored_advice(
        stored, strategies.RSI14, WIDTH, "96 HOURS", as_of, symbols=["click", "view", "purchase"]
    )
    store.publish(labels, 1)
    return edge(store.published())


def _indexed_store(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored candles and the index of their totals: made of the older half of the dates and then
    extended by the newer half."""
    store = _store(spark)
    c, _ = materialize(hourly(spark, sf_dir), "candles")
    store.append(c, 0, "hours")
    first, last = c.agg(F.to_date(F.min("event_time")), F.to_date(F.max("event_time"))).first()
    middle = str(first + (last - first) / 2)
    stored = store.candles(c.schema, name="hours")
    index, _ = materialize(total_index(stored.filter(F.col("dt") < middle), WIDTH, SMALL_BLOCK), "index")
    index, _ = materialize(extended_index(index, stored, middle, WIDTH), "index")
    return stored, index


def advice_stored_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 96 hours of three symbols as in the whole history, read from their dates on."""
    stored, index = _indexed_store(spark, sf_dir)
    as_of = tb.table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    return edge(stored_advice(
        stored, strategies.MULTI, WIDTH, "96 HOURS", as_of, symbols=["click", "view", "purchase"],
        warm=True, totals=index,
    ))


def panel_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest rows per symbol of the strategy with running totals, from the dates they need."""
    stored, index = _indexed_store(spark, sf_dir)
    return edge(panels.newest_labels(stored, strategies.MULTI, panels.INDICATOR_ROWS, index))


# Panels

def _mixed_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two writers: hourly candles with windows, six-hour candles without."""
    t = tb.trades(spark, sf_dir)
    return advice(t, strategies.VWAP, WIDTH, TIE).unionByName(
        advice(t, strategies.BASIC, "6 hours", TIE), allowMissingColumns=True
    )


def chart(panel: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: edge(panel(_mixed_store(spark, sf_dir)))


def chart_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One writer only: two writers' candles can end with the same trade."""
    return edge(panels.candle_chart(advice(tb.trades(spark, sf_dir), strategies.VWAP, WIDTH, TIE)))


def indicator_panel(panel: Callable[..., DataFrame], n: int) -> Query:
    """From candles: only the newest rows are labelled, and the panel prunes no more."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        newest = panels.newest_labels(hourly(spark, sf_dir), strategies.CROSS, n)
        return edge(panel(newest, n=None))
    return query


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From stored labels: the panel prunes."""
    labels, _ = materialize(advice(tb.trades(spark, sf_dir), strategies.CROSS, WIDTH, TIE), "labels")
    return edge(panels.band_panel(labels))


def latest_per_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(latest_n(hourly(spark, sf_dir), 100))


def table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly(spark, sf_dir).agg(F.count("*").alias("n"))


def latest_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge(panels.newest(hourly(spark, sf_dir)))


def recent_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = tb.table(spark, sf_dir, "events").agg(F.max("ts")).scalar()
    return edge(recent(hourly(spark, sf_dir), "48 HOURS", as_of))


# Reports

def revenue_by_country(spark: SparkSession, sf_dir: str, n: int = 10) -> DataFrame:
    per_supplier = reports.revenue_totals(tb.order_lines(spark, sf_dir), "l_suppkey")
    totals = tb.country_totals(spark, sf_dir, per_supplier)
    return reports.rank_revenue(totals, exclude="UNITED KINGDOM", n=n).withColumn(
        "Total_Revenue", F.round("Total_Revenue", 2)
    )


def top_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revenue_by_country(spark, sf_dir, 1).select("Country")


def school(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: edge(report(tb.students(spark, sf_dir)))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.word_count(tb.table(spark, sf_dir, "documents"), "text")


def pair_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirt by what the event says: small values lack a count, large ones have a bad one."""
    lines = tb.table(spark, sf_dir, "events").select(F.concat(
        "event_type",
        F.when(F.col("value") < 1, "").when(F.col("value") > 100, "\tx")
        .otherwise(F.concat(F.lit("\t"), F.get_json_object("props", "$.k"))),
    ).alias("value"))
    return reports.sum_pairs(lines)


def word_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tab_lines(word_count(spark, sf_dir), "word", "n")


def csv_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines written as CSV and read back by name with fixed types."""
    path = new_folder(spark, "csv")
    tb.order_lines(spark, sf_dir).withColumnRenamed("l_suppkey", "Country").write.csv(
        path, header=True
    )
    return reports.revenue_by_key(read_csv(spark, path, SALES_SCHEMA), n=10).withColumn(
        "Total_Revenue", F.round("Total_Revenue", 2)
    )


def csv_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with another separator."""
    path = new_folder(spark, "csv")
    tb.students(spark, sf_dir).write.csv(path, header=True, sep=";")
    return edge(reports.mean_grade(read_csv(spark, path, STUDENT_SCHEMA, ";"), "address"))


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types found by reading, from files whose columns stand in two orders and one of which
    lacks a column; a grade with a fraction in one row makes the whole column a double."""
    path = new_folder(spark, "csv")
    s = tb.students(spark, sf_dir).withColumn("G3", F.col("G3") + F.when(F.col("student") == 1, 0.5).otherwise(0))
    first = F.col("student") % 2 == 0
    s.filter(first).write.csv(path, header=True, mode="append")
    backwards = s.filter(~first).select(*reversed([c for c in s.columns if c != "goout"]))
    backwards.write.csv(path, header=True, mode="append")
    found = infer_csv(spark, path)
    return edge(found.groupBy("address").agg(
        F.avg("G3").alias("Avg_G3"), F.sum("absences").alias("absences"), F.count("goout").alias("goout"),
        F.max("Mjob").alias("Mjob"), F.lit(dict(found.dtypes)["G3"]).alias("grade_type"),
        F.lit(dict(found.dtypes)["absences"]).alias("absences_type"),
    ))


def text_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts per language as tab-separated text, read back and summed per word."""
    path = new_folder(spark, "pairs")
    words = tb.table(spark, sf_dir, "documents").select(
        "lang", F.explode(F.split("text", reports.WORD_BREAK)).alias("word")
    ).filter("word != ''")
    write_tab_lines(words.groupBy("lang", "word").agg(F.count("*").alias("n")), path, "word", "n")
    return reports.sum_pairs(read_lines(spark, path))


# Store

def _store(spark: SparkSession) -> CandleStore:
    return CandleStore(spark, new_folder(spark, "store"))


def store_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    c = hourly(spark, sf_dir)
    store.append(c, 0, "hours")
    store.append(ohlcv(tb.trades(spark, sf_dir), "6 hours", tie=TIE), 0, "sixes")
    return edge(store.tail("hours", 33, c.schema).select(*c.columns))


def store_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six batches of one writer, each sent twice, all dates but the last compacted."""
    store = _store(spark)
    c, _ = materialize(hourly(spark, sf_dir), "candles")
    for batch in (0, 1, 1, 2, 3, 3, 4, 5):
        store.append(c.filter(F.pmod(F.xxhash64(*KEY), F.lit(6)) == batch), batch, "hours")
    newest = str(c.agg(F.to_date(F.max("event_time"))).first()[0])
    store.compact("candles", c.schema, "hours", newest)
    return edge(store.candles(c.schema, name="hours").select(*c.columns))


def store_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark)
    t = tb.trades(spark, sf_dir)
    store.publish(advice(t, strategies.BASIC, WIDTH, TIE), 1)
    store.publish(advice(t, strategies.RSI14, WIDTH, TIE), 2)
    return edge(store.published())


# Streams

PARTS = 5


def _events(sf_dir: str) -> str:
    return f"{sf_dir}/events.parquet"


def _quarter(events: DataFrame, parts: int) -> Column:
    """Which of `parts` equal spans of time an event falls into."""
    span = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    first, last = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("a", "b"))
    share = (F.unix_micros(F.col("ts").cast("timestamp")) - span.select(first).scalar()) * parts
    return F.floor(share / (span.select(last - first).scalar() + 1))


def _cut(spark: SparkSession, sf_dir: str, parts: int = PARTS) -> str:
    """The events in files by time, which a stream takes one by one."""
    events = tb.table(spark, sf_dir, "events")
    timed, _ = materialize(events.withColumn("part", _quarter(events, parts)), "events")
    path = new_folder(spark, "feed")
    for k in range(parts):
        timed.filter(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(path)
    return path


def _feed(spark: SparkSession, path: str) -> DataFrame:
    return tb.trade_stream(stream_session(spark), path, files_per_batch=1)


def streamed_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, strategy = _store(spark), strategies.VWAP
    trades = tb.trade_stream(stream_session(spark), _events(sf_dir))
    query = stream_candles(
        trades, strategy, store, _name("candles"), WIDTH, DELAY, TIE, once=True
    )
    query.awaitTermination()
    return tb.zoneless(edge(streamed(store, query.name).select(*strategy.columns)))


def _name(purpose: str) -> str:
    """Stream names are unique per session, and one session may run a query twice."""
    return f"{purpose}_{uuid.uuid4().hex[:8]}"


def streamed_labels(
    strategy: strategies.Strategy, parts: int = PARTS, job: Callable = stream_labels, **options: int
) -> Query:
    """Events in several batches, so that each goes on from what the one before left."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = _store(spark)
        name = _name("labels")
        job(
            _feed(spark, _cut(spark, sf_dir, parts)), strategy, store, name, WIDTH, DELAY, TIE,
            once=True, **options,
        ).awaitTermination()
        rows = store.labels(strategy.schema(spark), name)
        return tb.zoneless(edge(rows.select(*strategy.columns)))
    return query


def panel_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest rows that a label stream keeps published, after five batches."""
    store, name = _store(spark), _name("live")
    stream_labels_in_state(
        _feed(spark, _cut(spark, sf_dir)), strategies.CROSS, store, name, WIDTH, DELAY, TIE,
        newest=panels.INDICATOR_ROWS, once=True,
    ).awaitTermination()
    return tb.zoneless(edge(panels.band_panel(store.published(newest_table(name)), n=None)))


def sink_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels in four batches to an outside store; one is sent twice, and one is lost before its
    commit and sent again."""
    folder = new_folder(spark, "outside")
    sink = CommittedSink("parquet", {"path": f"{folder}/rows"}, {"path": f"{folder}/commits"})
    lost = CommittedSink("parquet", sink.rows, {"path": f"{folder}/lost"})
    labels, _ = materialize(advice(tb.trades(spark, sf_dir), strategies.RSI14, WIDTH, TIE), "labels")
    batch = F.pmod(F.xxhash64(*KEY), F.lit(4))
    for k, to in ((0, sink), (1, sink), (1, sink), (2, lost), (2, sink), (3, sink)):
        to.write(labels.filter(batch == k), k, "labels")
    return edge(sink.read(spark, labels.schema).select(*labels.columns))


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay all events, then send the purchases again after a restart: the stored candles
    must not change, and the audit must find the purchases whose candle was closed."""
    store = _store(spark)
    late = f"{store.path}/late"
    events = tb.table(spark, sf_dir, "events")
    events.limit(0).write.parquet(late)
    own = stream_session(spark)
    trades = tb.trade_stream(own, _events(sf_dir)).union(tb.trade_stream(own, late))
    name = _name("late")

    def run() -> None:
        stream_candles(
            trades, strategies.BASIC, store, name, WIDTH, DELAY, TIE, once=True
        ).awaitTermination()

    run()
    again = events.filter("event_type = 'purchase'")
    again.write.mode("append").parquet(late)
    run()
    given = tb.as_trades(events.union(again), "CAST(ts AS TIMESTAMP)")
    final = streamed(store, name)
    late_ones = trade_audit(given, final, WIDTH).filter(F.col("fate") == LATE)
    candles = final.select("symbol", F.lit(1).alias("c"), F.lit(0).cast("bigint").alias("l"))
    return candles.union(late_ones.select("symbol", F.lit(0), "n")).groupBy("symbol").agg(
        F.sum("c").alias("candles"), F.sum("l").alias("late")
    )


def _late_feed(spark: SparkSession, sf_dir: str) -> str:
    """Four spans of events, the first one's purchases once more before the last, and trades without
    a time."""
    events = tb.table(spark, sf_dir, "events")
    timed, _ = materialize(events.withColumn("part", _quarter(events, 4)), "events")
    again = timed.filter("part = 0 AND event_type = 'purchase'")
    lost = timed.filter("part = 1 AND event_type = 'error'").withColumn(
        "ts", F.lit(None).cast("timestamp_ntz")
    )
    feed = new_folder(spark, "feed")
    for part in (*(timed.filter(F.col("part") == k) for k in range(3)), again.union(lost),
                 timed.filter("part = 3")):
        part.drop("part").coalesce(1).write.mode("append").parquet(feed)
    return feed


def stream_late_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The late feed in one run: each trade has one fate."""
    store, name, feed = _store(spark), _name("continuous"), _late_feed(spark, sf_dir)
    stream_candles(
        _feed(spark, feed), strategies.BASIC, store, name, WIDTH, DELAY, TIE, once=True
    ).awaitTermination()
    given = tb.as_trades(spark.read.parquet(feed), "CAST(ts AS TIMESTAMP)")
    return _fates_per_symbol(trade_audit(given, streamed(store, name), WIDTH))


def stream_audit_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, trades counted by a second stream that reads each once, and open windows read from
    the first one's state."""
    store, name, feed = _store(spark), _name("candles"), _late_feed(spark, sf_dir)
    stream_candles(
        _feed(spark, feed), strategies.BASIC, store, name, WIDTH, DELAY, TIE, once=True
    ).awaitTermination()
    counts = _name("audit")
    for _ in range(2):
        stream_audit(_feed(spark, feed), store, counts, WIDTH, once=True).awaitTermination()
    return _fates_per_symbol(fates(audited(store, counts), streamed(store, name), open_windows(store, name)))


def _fates_per_symbol(fates: DataFrame) -> DataFrame:
    return fates.groupBy("symbol").agg(
        F.sum("n").alias("trades"),
        F.coalesce(F.sum(F.when(F.col("fate") == COUNTED, F.col("n"))), F.lit(0)).alias("counted"),
        F.coalesce(F.sum(F.when(F.col("fate") == LATE, F.col("n"))), F.lit(0)).alias("late"),
        F.coalesce(F.sum(F.when(F.isnull("window_start"), F.col("n"))), F.lit(0)).alias("unusable"),
    )


QUERIES: dict[str, Query] = {
    "trades_decode": trades_decode,
    "trades_normalize": trades_normalize,
    "trades_rejects": trades_rejects,
    "topic_payload": topic_payload,
    "candles_1h": candles("1 hour"),
    "candles_6h": candles("6 hours"),
    "candles_rollup": candles_rollup,
    "candles_tie_break": candles("1 hour"),
    "candle_features": features,
    "candle_risk": candle_risk,
    "rsi_single_candle": rsi_single_candle,
    "close_change": rolling(ind.CloseChange(), "prev_close", "change", "gain", "loss"),
    "rsi_rounded": rolling(ind.Rsi(warmup=False, digits=3), "RSI"),
    "rsi14_warm": rolling(ind.Rsi(), "rsi_14"),
    "macd_sma": rolling(
        ind.MacdSma(lines=True), "macd_line", "signal_line", "MACD_Histogram"
    ),
    "macd_wide_split": rolling(
        ind.MacdSma(50, 100, 20, lines=True), "macd_line", "signal_line",
        rows_per_block=WIDE_BLOCK,
    ),
    "volume_spike": rolling(
        ind.VolumeSpike(mean=True), "past_volume", "Volume_Spike"
    ),
    "bollinger_rounded": rolling(
        ind.Bollinger(warmup=False, digits=3), "BB_Upper", "BB_Lower"
    ),
    "bollinger_warm": rolling(ind.Bollinger(), "bb_middle", "bb_upper", "bb_lower"),
    "bollinger_wide_split": rolling(
        ind.Bollinger(100), "bb_middle", "bb_upper", "bb_lower", rows_per_block=WIDE_BLOCK
    ),
    "band_signal": rolling(ind.Bollinger(), "close", "bb_signal"),
    "obv": rolling(ind.Obv(), "volume", "OBV"),
    "obv_prev": rolling(ind.Obv(), "OBV_prv"),
    "obv_fractional": rolling(ind.Obv(), "volume", "OBV", fractional=True),
    "obv_fractional_split": rolling(
        ind.Obv(), "volume", "OBV", fractional=True, rows_per_block=SMALL_BLOCK
    ),
    "sma_cross": rolling(
        ind.SmaCross(digits=9), "sma_9", "sma_21", "sma_crossover"
    ),
    "sma_cross_wide_split": rolling(
        ind.SmaCross(50, 200, digits=9), "sma_50", "sma_200", "sma_crossover",
        rows_per_block=WIDE_BLOCK,
    ),
    "advice_basic": labelled(strategies.BASIC),
    "advice_vwap": labelled(strategies.VWAP),
    "advice_multi": labelled(strategies.MULTI),
    "advice_rsi14": labelled(strategies.RSI14),
    "advice_cross": labelled(strategies.CROSS),
    "advice_multi_split": labelled(strategies.MULTI, rows_per_block=SMALL_BLOCK),
    "advice_cross_split": labelled(strategies.CROSS, rows_per_block=SMALL_BLOCK),
    "advice_stored_rsi14": advice_stored,
    "advice_stored_multi": advice_stored_multi,
    "panel_multi": panel_multi,
    "chart_event_time": chart_event_time,
    "chart_window_start": chart(panels.window_chart),
    "chart_fallback_time": chart(panels.mixed_chart),
    "panel_bands": indicator_panel(panels.band_panel, panels.INDICATOR_ROWS),
    "panel_bands_stored": stored_panel,
    "panel_sma_rsi": indicator_panel(panels.sma_rsi_panel, panels.INDICATOR_ROWS),
    "table_signals": indicator_panel(panels.signal_table, panels.TABLE_ROWS),
    "latest_per_symbol": latest_per_symbol,
    "table_count": table_count,
    "latest_five": latest_five,
    "recent_lookback": recent_lookback,
    "revenue_by_country": revenue_by_country,
    "top_country": top_country,
    "grade_filter": school(reports.low_grade_applicants),
    "study_count": school(reports.study_time_count),
    "grade_by_job": school(lambda s: reports.mean_grade(s, "Mjob")),
    "grade_by_status": school(lambda s: reports.mean_grade(s, "romantic", ranked=False)),
    "total_alcohol": school(
        lambda s: reports.total_alcohol(s).select("student", "Total_Alcohol")
    ),
    "grade_class": school(lambda s: reports.grade_class(s).select("student", "G3", "Rank")),
    "sql_absentees": school(reports.absentees),
    "sql_by_address": school(reports.by_address),
    "word_count": word_count,
    "word_lines": word_lines,
    "pair_sum": pair_sum,
    "text_pairs": text_pairs,
    "csv_revenue": csv_revenue,
    "csv_students": csv_students,
    "csv_inferred": csv_inferred,
    "store_tail": store_tail,
    "store_compacted": store_compacted,
    "store_published": store_published,
    "stream_candles": streamed_candles,
    "stream_indicators": streamed_labels(strategies.CROSS),
    "stream_multi": streamed_labels(strategies.MULTI),
    "stream_multi_split": streamed_labels(strategies.MULTI, rows_per_block=SMALL_BLOCK),
    "stream_indicators_state": streamed_labels(strategies.CROSS, job=stream_labels_in_state),
    "stream_multi_state": streamed_labels(
        strategies.MULTI, job=stream_labels_in_state, rows_per_block=SMALL_BLOCK
    ),
    "stream_late_drop": stream_late_drop,
    "stream_late_continuous": stream_late_continuous,
    "stream_audit_incremental": stream_audit_incremental,
    "panel_live": panel_live,
    "sink_replayed": sink_replayed,
}
