"""Newest rows per symbol, and look-back filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Partial winners of one symbol are merged in this many groups before the last merge.
MERGE_GROUPS = 64


def only_symbols(df: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    return df if symbols is None else df.filter(F.col("symbol").isin(*symbols))


def top_rows(
    df: DataFrame, n: int, by: Sequence[str] = ("symbol",), time: str = "event_time",
    place: str | None = None,
) -> DataFrame:
    """The n newest rows of each group, with their place (from 1) in a column `place` if named.

    Spark prunes `row_number <= n` before the shuffle, but a group present in every input task
    would still send n rows per task to one task. Merging in groups of input tasks first keeps
    the last merge at n * MERGE_GROUPS rows. Rows without a time come last.
    """
    newest = F.col(time).desc_nulls_last()
    merge = df.withColumn("merge_group", F.spark_partition_id() % MERGE_GROUPS)
    at = place or "place"
    for keys in ((*by, "merge_group"), tuple(by)):
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(newest))
        merge = merge.withColumn(at, number).filter(F.col(at) <= n)
    return merge.drop("merge_group") if place else merge.drop("merge_group", at)


def latest_n(
    df: DataFrame,
    n: int = 500,
    time: str = "event_time",
    by: Sequence[str] = ("symbol",),
    symbols: Sequence[str] | None = None,
    ascending: bool = True,
) -> DataFrame:
    """The n newest rows per symbol, ordered by symbol and time."""
    rows = top_rows(only_symbols(df, symbols), n, by, time)
    return rows.orderBy(*by, F.col(time).asc() if ascending else F.col(time).desc())


def complete(df: DataFrame) -> DataFrame:
    """Rows that have the fields indicators need."""
    return df.dropna(subset=["symbol", "close", "event_time"])


def recent(
    df: DataFrame,
    interval: str,
    as_of: Column | None = None,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """Complete rows of the last `interval` before `as_of` (now by default)."""
    now = F.current_timestamp() if as_of is None else as_of
    return on_or_after(only_symbols(complete(df), symbols), now - F.expr(f"INTERVAL {interval}"))


def on_or_after(df: DataFrame, since: Column) -> DataFrame:
    """Rows from `since` on; of a stored table only the `dt` folders that can hold them."""
    rows = df.filter(F.col("event_time") >= since)
    return rows.filter(F.col("dt") >= F.to_date(since)) if "dt" in df.columns else rows
