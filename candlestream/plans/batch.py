"""Trades or stored candles to advice, in batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestream.operators.candles import ohlcv
from candlestream.operators.history import (
    ROWS_PER_BLOCK, cell_of, check_reach, drop_halo, split_history,
)
from candlestream.operators.latest import complete, on_or_after, only_symbols, top_rows
from candlestream.operators.totals import CARRIED, KNOWN, resumed
from candlestream.plans.strategies import Strategy
from candlestream.session import materialize


def bounded_history(
    candles: DataFrame, rows: int, width: str, reach: int, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Stored candles, split where a symbol could exceed one task's share.

    A table with at most `rows_per_block` rows in all needs no look at its symbols.
    """
    check_reach(reach, rows_per_block)
    if rows <= rows_per_block:
        return candles
    return split_history(candles, cell_of(width, rows_per_block), reach, rows_per_block)


def stored_candles(
    trades: DataFrame,
    width: str,
    reach: int,
    tie: str | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Candles written once to the shared folder and ready for rolling windows.

    Rolling indicators read candles several times; without the table every read would go back
    to the trades.
    """
    candles, rows = materialize(ohlcv(trades, width, tie=tie), "candles")
    return bounded_history(candles, rows, width, reach, rows_per_block)


def advice(
    trades: DataFrame,
    strategy: Strategy,
    width: str | None = None,
    tie: str | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """The strategy's result table over the whole history of every symbol."""
    width = width or strategy.width
    if strategy.rolling:
        candles = stored_candles(trades, width, strategy.reach, tie, rows_per_block)
    else:
        candles = ohlcv(trades, width, tie=tie)
    return drop_halo(strategy.label(candles)).select(*strategy.columns)


def stored_advice(
    candles: DataFrame,
    strategy: Strategy,
    width: str | None = None,
    interval: str | None = None,
    as_of: Column | None = None,
    symbols: Sequence[str] | None = None,
    warm: bool = False,
    rows_per_block: int = ROWS_PER_BLOCK,
    totals: DataFrame | None = None,
) -> DataFrame:
    """The strategy's result table from stored candles of one writer.

    Only complete candles of the last `interval` before `as_of` (now by default) are read, by
    their `dt` folders where there are some. Indicators start anew at the look-back's first
    candle; `warm` reads as many candles per symbol before it as they look back, so that the
    first rows have the values they have in the whole history. Running totals go on from
    `totals`, the index of the complete candles (see `operators.totals`).
    """
    rows = only_symbols(complete(candles), symbols)
    if interval is not None:
        now = F.current_timestamp() if as_of is None else as_of
        since = now - F.expr(f"INTERVAL {interval}")
        inside = on_or_after(rows, since)
        if warm:
            if strategy.totals:
                return _resumed_advice(rows, strategy, width or strategy.width, since, totals, rows_per_block)
            before = top_rows(rows.filter(F.col("event_time") < since), strategy.reach)
            inside = inside.withColumn("inside", F.lit(True)).unionByName(
                before.withColumn("inside", F.lit(False))
            )
        rows = inside
    stored, n = materialize(rows, "candles")
    width = width or strategy.width
    labelled = drop_halo(strategy.label(
        bounded_history(stored, n, width, strategy.reach, rows_per_block)
    ))
    if "inside" in stored.columns:
        labelled = labelled.filter("inside")
    return labelled.select(*strategy.columns)


def _resumed_advice(
    rows: DataFrame, strategy: Strategy, width: str, since: Column, totals: DataFrame | None, rows_per_block: int
) -> DataFrame:
    if totals is None:
        raise ValueError(f"{strategy.name} needs the whole history or an index of its totals")
    starts = totals.select("symbol").distinct().withColumn("since", F.to_date(since))
    stored, n = materialize(resumed(rows, totals, starts, strategy.reach), "candles")
    labelled = drop_halo(strategy.label(
        bounded_history(stored, n, width, strategy.reach, rows_per_block), CARRIED
    ))
    return labelled.filter(~F.col(KNOWN) & (F.col("event_time") >= since)).select(*strategy.columns)
