"""Audit of trades that no candle counts: unusable ones and late ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from candlestream.sources.store import CandleStore

COUNTED, LATE, UNUSABLE, OPEN = "counted", "late", "no event time", "open"


KEYS = ["symbol", "window_start"]


def given_counts(trades: DataFrame, width: str) -> DataFrame:
    """(symbol, window_start, end, n): how many trades each window was given; those without a time
    have NULL for both ends. Counts of parts of the trades add up."""
    untimed = F.isnull("event_time")
    # A window drops rows without a time; these get one that is not looked at.
    timed = trades.select(
        "symbol", untimed.alias("untimed"), F.coalesce("event_time", F.timestamp_seconds(F.lit(0))).alias("time")
    )
    counted = timed.groupBy("symbol", "untimed", F.window("time", width).alias("candle")).agg(
        F.count(F.lit(1)).alias("n")
    )
    start, end = (F.when(~F.col("untimed"), F.col(f"candle.{edge}")) for edge in ("start", "end"))
    return counted.select("symbol", start.alias("window_start"), end.alias("end"), "n")


def fates(counts: DataFrame, candles: DataFrame, still_open: DataFrame | None = None) -> DataFrame:
    """(symbol, window_start, fate, n) from `given_counts` and a stream's final candles.

    A window's candle says how many trades it is made of (`n_trades`); the others came too late. A
    window without a candle is open if `still_open` (symbol, window_start), read from the stream's
    state, lists it. Without that table it is open unless it ended before the end of a candle that
    is final. Trades of windows that are neither final nor open were late.
    """
    given = counts.filter("window_start IS NOT NULL").groupBy(*KEYS, "end").agg(F.sum("n").alias("n"))
    final = candles.groupBy(*KEYS).agg(F.sum("n_trades").alias("counted"))
    same = [given[k].eqNullSafe(final[k]) for k in KEYS]
    judged = given.join(final, same, "left").select(
        given["symbol"], given["window_start"], "end", "n",
        F.coalesce("counted", F.lit(0)).alias("counted"), F.isnull("counted").alias("missing"),
    )
    if still_open is None:
        last = candles.agg(F.max("window_end").alias("last"))
        judged = judged.withColumn("waits", ~F.coalesce(F.col("end") <= last.scalar(), F.lit(False)))
    else:
        listed = still_open.select(F.col("symbol").alias("of"), F.col("window_start").alias("at")).distinct()
        listed = listed.withColumn("waits", F.lit(True))
        judged = judged.join(
            listed, F.col("symbol").eqNullSafe(F.col("of")) & (F.col("window_start") == F.col("at")), "left"
        ).withColumn("waits", F.coalesce("waits", F.lit(False)))
    rest = F.when(F.col("missing") & F.col("waits"), OPEN).otherwise(LATE)
    fate = F.explode(F.array(
        F.struct(F.lit(COUNTED).alias("fate"), F.col("counted").alias("n")),
        F.struct(rest.alias("fate"), (F.col("n") - F.col("counted")).alias("n")),
    )).alias("f")
    unusable = counts.filter("window_start IS NULL").groupBy("symbol").agg(F.sum("n").alias("n"))
    return judged.select(*KEYS, fate).select(*KEYS, "f.fate", "f.n").filter("n > 0").unionByName(
        unusable.select("symbol", F.lit(None).cast("timestamp").alias("window_start"),
                        F.lit(UNUSABLE).alias("fate"), "n")
    )


def trade_audit(trades: DataFrame, candles: DataFrame, width: str) -> DataFrame:
    """(symbol, window_start, fate, n): what became of all `trades` a stream was given.

    `candles` are the stream's final ones with `n_trades`. Each trade is in one row, the audit can
    be run at any time, and its answer does not depend on how the stream was cut into batches.
    """
    return fates(given_counts(trades, width), candles)


def open_windows(store: CandleStore, name: str) -> DataFrame:
    """(symbol, window_start) of the windows that the candle stream `name` still holds open, from its
    state; the stream may be running or stopped."""
    held = store.spark.read.format("statestore").load(store.checkpoint(name))
    fields = held.schema["key"].dataType
    window = next(f.name for f in fields if f.dataType.simpleString().startswith("struct<start"))
    return held.select(F.col("key.symbol").alias("symbol"), F.col(f"key.`{window}`.start").alias("window_start"))


AUDITED = StructType().add("symbol", "string").add("window_start", "timestamp").add("end", "timestamp").add("n", "long")


def stream_audit(
    trades: DataFrame, store: CandleStore, name: str, width: str, trigger: str = "10 seconds", once: bool = False
) -> StreamingQuery:
    """Counts the trades a candle stream is given, batch by batch, into the store's log: each trade
    is read once, however often the audit is asked for, and a replayed batch counts once. `name`
    is the audit's own, `trades` a second stream over the same source."""
    def run(batch: DataFrame, batch_id: int) -> None:
        counts = given_counts(batch, width).withColumn("dt", F.to_date("window_start"))
        store.log("audit").write(counts, batch_id, name)

    timing = {"availableNow": True} if once else {"processingTime": trigger}
    return (
        trades.writeStream.foreachBatch(run).queryName(name)
        .option("checkpointLocation", store.checkpoint(name)).trigger(**timing).start()
    )


def audited(store: CandleStore, name: str) -> DataFrame:
    """What `stream_audit` has counted so far, for `fates`."""
    return store.log("audit").read(AUDITED, [name]).select(*AUDITED.names)
