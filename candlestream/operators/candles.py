"""Trades to OHLCV candles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wider than any 64-bit tie value on either side of zero.
_TIE_SPAN = "100000000000000000000"


def _trade_order(tie: str | None) -> Column:
    """What "first" and "last" trade mean.

    With a tie column the pair (time, tie) is packed into one decimal. A struct would say the
    same, but it cannot live in a hash aggregate's buffer: Spark would sort all trades first.
    """
    if tie is None:
        return F.col("event_time")
    micros = "CAST(unix_micros(CAST(event_time AS TIMESTAMP)) AS DECIMAL(18,0))"
    return F.expr(
        f"{micros} * CAST({_TIE_SPAN} AS DECIMAL(21,0)) + CAST(`{tie}` AS DECIMAL(19,0))"
    )


def ohlcv(
    trades: DataFrame,
    width: str = "10 seconds",
    by: Sequence[str] = ("symbol",),
    tie: str | None = None,
    watermark: str | None = None,
    counted: bool = False,
) -> DataFrame:
    """Tumbling-window candles per `by`, in batch and (with `watermark`) on a stream.

    Every aggregate has a fixed-size partial form, so a busy symbol or window is reduced on the
    map side to one row per task before the single shuffle. Trades without a price still count
    for volume and time but never become open, high, low or close. `counted` adds `n_trades`, how
    many trades a candle is made of.
    """
    if watermark is not None:
        trades = trades.withWatermark("event_time", watermark)
    price, quantity = F.col("price"), F.col("quantity")
    traded = F.sum("quantity")
    priced_at = F.when(price.isNotNull(), _trade_order(tie))
    candles = trades.groupBy(F.window("event_time", width), *by).agg(
        F.min_by(price, priced_at).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, priced_at).alias("close"),
        traded.alias("volume"),
        F.avg(price).alias("avg_price"),
        F.when(traded != 0, F.sum(price * quantity) / traded).alias("vwap"),
        F.max("event_time").alias("event_time"),
        F.count(F.lit(1)).alias("n_trades"),
    )
    return candles.select(
        *by, "open", "high", "low", "close", "volume", "avg_price", "vwap", "event_time",
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *(["n_trades"] if counted else []),
    )


# Candles in parts: what a window's trades come to, in a form that wider windows can be made of.

def partial_candles(
    trades: DataFrame, width: str = "10 seconds", by: Sequence[str] = ("symbol",),
    tie: str | None = None, watermark: str | None = None,
) -> DataFrame:
    """One row per window and `by`, from which `rolled_up` makes wider windows and `finished` the
    candle. First and last price come with their place (time and tie), means as sum and count. So
    trades are read once for all widths, on a stream as in batch."""
    if watermark is not None:
        trades = trades.withWatermark("event_time", watermark)
    price, quantity = F.col("price"), F.col("quantity")
    place = F.when(price.isNotNull(), _trade_order(tie))
    parts = trades.groupBy(F.window("event_time", width), *by).agg(
        F.min_by(price, place).alias("open"), F.min(place).alias("open_at"),
        F.max(price).alias("high"), F.min(price).alias("low"),
        F.max_by(price, place).alias("close"), F.max(place).alias("close_at"),
        F.sum(quantity).alias("volume"), F.sum(price).alias("price_sum"), F.count(price).alias("n_priced"),
        F.sum(price * quantity).alias("notional"), F.max("event_time").alias("event_time"),
        F.count(F.lit(1)).alias("n_trades"),
    )
    return _windowed(parts, by)


def _windowed(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    return parts.select(
        *by, "open", "open_at", "high", "low", "close", "close_at", "volume", "price_sum", "n_priced",
        "notional", "event_time", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), "n_trades",
    )


def rolled_up(parts: DataFrame, width: str, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Windows of `width` from narrower ones, in the same form; equal to those made of the trades.
    A part that reaches beyond its window, as 7 of 10 minutes do, is an error."""
    wide = F.window("window_start", width)
    inside = F.when(
        F.col("window_end") > wide.end, F.raise_error(F.lit(f"windows of {width} cannot be made of these parts"))
    ).otherwise(F.col("n_trades"))
    return _windowed(parts.groupBy(wide, *by).agg(
        F.min_by("open", "open_at").alias("open"), F.min("open_at").alias("open_at"),
        F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "close_at").alias("close"), F.max("close_at").alias("close_at"),
        F.sum("volume").alias("volume"), F.sum("price_sum").alias("price_sum"),
        F.sum("n_priced").alias("n_priced"), F.sum("notional").alias("notional"),
        F.max("event_time").alias("event_time"), F.sum(inside).alias("n_trades"),
    ), by)


def finished(parts: DataFrame, by: Sequence[str] = ("symbol",), counted: bool = False) -> DataFrame:
    """Candles as `ohlcv` makes them."""
    return parts.select(
        *by, "open", "high", "low", "close", "volume",
        F.when(F.col("n_priced") > 0, F.col("price_sum") / F.col("n_priced")).alias("avg_price"),
        F.when(F.col("volume") != 0, F.col("notional") / F.col("volume")).alias("vwap"),
        "event_time", "window_start", "window_end", *(["n_trades"] if counted else []),
    )
