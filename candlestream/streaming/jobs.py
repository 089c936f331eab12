"""Streaming jobs: trades to stored candles, labels and an audit of what was left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from candlestream.operators.candles import ohlcv
from candlestream.operators.history import ROWS_PER_BLOCK, drop_halo
from candlestream.operators.indicators import EXACT_TOTAL
from candlestream.operators.latest import top_rows
from candlestream.plans.batch import bounded_history
from candlestream.plans.strategies import Strategy
from candlestream.session import new_folder, written
from candlestream.sources.outside import CommittedSink
from candlestream.sources.store import CandleStore
from candlestream.streaming.state import CARRIED, KNOWN, with_past

# Format and options of an outside store.
Sink = tuple[str, dict[str, str]]

# What a stream remembers of a candle: the candle, and the running volume total up to it.
_TOTAL, _CARRIED, _KNOWN = "obv_total", CARRIED, KNOWN


def start(
    writer: DataStreamWriter, store: CandleStore, name: str, trigger: str, once: bool
) -> StreamingQuery:
    """Start under `name`; Spark refuses a second active stream of that name, and with it a
    second user of its checkpoint. `once` handles what is there now and stops."""
    timing = {"availableNow": True} if once else {"processingTime": trigger}
    return (
        writer.queryName(name).option("checkpointLocation", store.checkpoint(name))
        .trigger(**timing).start()
    )


def stream_candles(
    trades: DataFrame,
    strategy: Strategy,
    store: CandleStore,
    name: str,
    width: str | None = None,
    watermark: str | None = None,
    tie: str | None = None,
    trigger: str | None = None,
    sink: Sink | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Final candles, labelled row by row, straight into a Parquet folder or another `sink`
    (format and options, such as a document store's). Not for rolling strategies. Append mode: a
    candle is written once, after the watermark has passed it. The folder also holds `n_trades`,
    which the audit needs."""
    if strategy.rolling:
        raise ValueError(f"{strategy.name} looks back over candles: use stream_labels")
    candles = ohlcv(
        trades, width or strategy.width, tie=tie, watermark=watermark or strategy.watermark,
        counted=sink is None,
    )
    window = [] if "window_start" in strategy.columns else ["window_start", "window_end"]
    extra = [] if sink else [*window, "n_trades"]
    rows = strategy.label(candles).select(*strategy.columns, *extra)
    kind, options = sink or ("parquet", {"path": f"{store.path}/streamed/{name}"})
    writer = rows.writeStream.format(kind).options(**options).outputMode("append")
    return start(writer, store, name, trigger or strategy.trigger, once)


def streamed(store: CandleStore, name: str) -> DataFrame:
    return store.spark.read.parquet(f"{store.path}/streamed/{name}")


def remembered(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(_TOTAL, EXACT_TOTAL)


def label_batch(
    new: DataFrame,
    rows: int,
    past: DataFrame | None,
    strategy: Strategy,
    width: str,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Label `new` candles given the newest stored ones of each symbol.

    The last stored candle of a symbol carries its running total; those before it carry 0, so
    the total over stored and new rows continues the one over the whole history.
    """
    empty_total = F.lit(None).cast(EXACT_TOTAL)
    history = new.withColumns({_CARRIED: empty_total, _KNOWN: F.lit(False)})
    if past is not None:
        newest = F.max("event_time").over(Window.partitionBy("symbol"))
        known = past.withColumns({
            _CARRIED: F.when(F.col("event_time") == newest, F.col(_TOTAL))
            .otherwise(F.lit(0).cast(EXACT_TOTAL)),
            _KNOWN: F.lit(True),
        }).drop(_TOTAL)
        history = known.unionByName(history)
    return label_history(history, rows, strategy, width, rows_per_block)


def label_history(
    history: DataFrame, rows: int, strategy: Strategy, width: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Label the candles not `known`, after the known ones of each symbol, which carry its total."""
    empty_total = F.lit(None).cast(EXACT_TOTAL)
    history = bounded_history(history, rows, width, strategy.reach, rows_per_block)
    labelled = drop_halo(strategy.label(history, _CARRIED)).filter(~F.col(_KNOWN))
    if _TOTAL not in labelled.columns:
        labelled = labelled.withColumn(_TOTAL, empty_total)
    return labelled.drop(_CARRIED, _KNOWN)


def newest_table(name: str) -> str:
    """Under which name a label stream publishes its newest rows."""
    return f"newest-{name}"


def publish_newest(store: CandleStore, labels: DataFrame, n: int, batch_id: int, name: str) -> None:
    """Merge a batch's labels into the published newest n rows per symbol, reading these and the
    batch only. Readers see the rows of one batch or of the next; a batch merged before is not
    merged again."""
    table = newest_table(name)
    version = store.version(table)
    if version is not None and version >= batch_id:
        return
    rows = labels if version is None else store.published(table).unionByName(labels)
    store.publish(top_rows(rows, n), batch_id, table)


def stream_labels_in_state(
    trades: DataFrame,
    strategy: Strategy,
    store: CandleStore,
    name: str,
    width: str | None = None,
    watermark: str | None = None,
    tie: str | None = None,
    trigger: str | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
    newest: int | None = None,
    once: bool = False,
) -> StreamingQuery:
    """As `stream_labels`, with what the stream remembers in the engine's state.

    A batch reads and writes the state of the symbols it has candles of, wherever they are, and
    nothing of the others; the store only gets its new candles and labels. The number of symbols
    is bounded by the state store, not by what a batch can rewrite. `newest` rows per symbol are
    published after each batch, for panels (see `newest_table`).
    """
    width = width or strategy.width
    candles = ohlcv(trades, width, tie=tie, watermark=watermark or strategy.watermark)

    def run(batch: DataFrame, batch_id: int) -> None:
        # Once: what the state gives is read several times below.
        history, rows = written(batch, new_folder(store.spark, "history"), reader=store.spark)
        if rows:
            store.append(history.filter(~F.col(_KNOWN)).drop(_CARRIED, _KNOWN), batch_id, name)
            labels = label_history(history, rows, strategy, width, rows_per_block)
            stored = store.write_labels(labels, batch_id, name)
            if newest:
                publish_newest(store, stored.select(*strategy.columns), newest, batch_id, name)

    remembering = with_past(candles, strategy.reach, strategy.complete_only)
    writer = remembering.writeStream.outputMode("append").foreachBatch(run)
    return start(writer, store, name, trigger or strategy.trigger, once)


def stream_labels(
    trades: DataFrame,
    strategy: Strategy,
    store: CandleStore,
    name: str,
    width: str | None = None,
    watermark: str | None = None,
    tie: str | None = None,
    trigger: str | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
    sink: Sink | CommittedSink | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Final candles into the store, and each new candle labelled over its symbol's history.

    A batch reads its own candles and, of each symbol that has one, as many stored candles as the
    strategy looks back, however long the history is. All its outputs are folders named by the
    batch, so a replay changes nothing. An empty batch writes nothing. A `sink` gets the labels
    too, batch by batch: to a plain one (format and options) a replay appends them again; of a
    `CommittedSink` readers see them once.
    """
    width = width or strategy.width
    candles = ohlcv(trades, width, tie=tie, watermark=watermark or strategy.watermark)
    schema = remembered(candles.schema)

    def run(batch: DataFrame, batch_id: int) -> None:
        new, rows = store.append(batch, batch_id, name)
        if not rows:
            return
        past, slot = store.state(schema, batch_id, name)
        near = past
        if past is not None:
            symbols = new.select("symbol").distinct()
            near = past.join(symbols, past["symbol"].eqNullSafe(symbols["symbol"]), "left_semi")
        labels = store.write_labels(
            label_batch(new, rows, near, strategy, width, rows_per_block), batch_id, name
        )
        if isinstance(sink, CommittedSink):
            sink.write(labels.select(*strategy.columns), batch_id, name)
        elif sink:
            kind, options = sink
            labels.select(*strategy.columns).write.format(kind).options(**options).mode("append").save()
        done = labels.select(*schema.names)
        state = done if past is None else past.unionByName(done)
        store.write_state(top_rows(state, strategy.reach), batch_id, name, slot)

    writer = candles.writeStream.outputMode("append").foreachBatch(run)
    return start(writer, store, name, trigger or strategy.trigger, once)
