"""Running totals from a date on, without the history before it.

An index has one row per symbol and date: how many candles, the time of the last, and the exact
volume total up to it. Whoever needs the candles from some date on reads these, as many dates
before them as the indicators look back, and takes the total over all the rest from the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlestream.operators.history import BROADCAST_ROWS, ROWS_PER_BLOCK, drop_halo
from candlestream.operators.indicators import EXACT_TOTAL, Obv, add_indicators
from candlestream.session import materialize

CARRIED, KNOWN = "carried", "known"
INDEX = ["symbol", "dt", "n", "last_time", "total"]


def _date(df: DataFrame) -> Column:
    return F.col("dt") if "dt" in df.columns else F.to_date("event_time")


def _by_date(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("symbol", F.to_date("event_time").alias("dt")).agg(
        F.count(F.lit(1)).alias("n"), F.max("event_time").alias("last_time"),
        F.max_by("obv_total", "event_time").alias("total"),
    ).select(*INDEX)


def total_index(candles: DataFrame, width: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """The index of stored candles of one writer, over their whole history."""
    from candlestream.plans.batch import bounded_history

    rows, n = materialize(candles.select("symbol", "event_time", "close", "volume"), "index")
    split = bounded_history(rows, n, width, Obv().reach, rows_per_block)
    return _by_date(drop_halo(add_indicators(split, Obv())))


def extended_index(
    index: DataFrame, candles: DataFrame, since: str, width: str, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """The index after dates from `since` on were added or changed: they alone are read, and the
    last candles before them."""
    from candlestream.plans.batch import bounded_history

    first = F.lit(since).cast("date")
    symbols = candles.filter(_date(candles) >= first).select("symbol").distinct()
    starts = symbols.withColumn("since", first)
    rows, n = materialize(resumed(
        candles.select("symbol", "event_time", "close", "volume", *(["dt"] if "dt" in candles.columns else [])),
        index, starts, Obv().reach,
    ), "index")
    split = bounded_history(rows, n, width, Obv().reach, rows_per_block)
    new = _by_date(drop_halo(add_indicators(split, Obv(CARRIED))).filter(~F.col(KNOWN)))
    return index.select(*INDEX).filter(F.col("dt") < first).unionByName(new)


def newest_dates(index: DataFrame, n: int) -> DataFrame:
    """(symbol, since): the date from which on each symbol has its newest n candles, or its first."""
    later = Window.partitionBy("symbol").orderBy(F.desc("dt")).rowsBetween(Window.unboundedPreceding, -1)
    kept = index.withColumn("later", F.coalesce(F.sum("n").over(later), F.lit(0))).filter(F.col("later") < n)
    return kept.groupBy("symbol").agg(F.min("dt").alias("since"))


def resumed(candles: DataFrame, index: DataFrame, starts: DataFrame, reach: int) -> DataFrame:
    """Candles of each symbol in `starts` (symbol, since) from its date on, and at least `reach`
    candles before them where there are so many. Column `known` marks the latter; the last of them
    carries the total up to it in `carried`, the others 0, the candles from the date on NULL.

    `index` is the index of the same candles. With a column `dt`, as stored candles have it, only
    the files of the dates needed are read.
    """
    own = F.col("i.symbol").eqNullSafe(F.col("s.symbol")) & (F.col("i.dt") < F.col("s.since"))
    before = index.alias("i").join(starts.alias("s"), own).select("i.*")
    later = Window.partitionBy("symbol").orderBy(F.desc("dt")).rowsBetween(Window.unboundedPreceding, -1)
    kept = before.withColumn("later", F.coalesce(F.sum("n").over(later), F.lit(0))).filter(F.col("later") < reach)
    spans = kept.groupBy("symbol").agg(
        F.min("dt").alias("start"), F.max("last_time").alias("last_time"),
        F.max_by("total", "last_time").alias("before"),
    )
    same = F.col("s.symbol").eqNullSafe(F.col("k.symbol"))
    spans = starts.alias("s").join(spans.alias("k"), same, "left").select(
        F.col("s.symbol").alias("of"), "since", F.coalesce("start", "since").alias("start"), "last_time", "before"
    )
    spans, size = materialize(spans, "spans")
    earliest = spans.agg(F.min("start")).first()[0]
    if size <= BROADCAST_ROWS:
        spans = F.broadcast(spans)
    dated = candles.withColumn("dt", _date(candles)).filter(F.col("dt") >= F.lit(earliest))
    rows = dated.join(spans, F.col("symbol").eqNullSafe(F.col("of"))).filter(F.col("dt") >= F.col("start"))
    carried = F.when(F.col("event_time") == F.col("last_time"), F.col("before")).otherwise(F.lit(0)).cast(EXACT_TOTAL)
    known = F.col("dt") < F.col("since")
    return rows.withColumns({KNOWN: known, CARRIED: F.when(known, carried)}).drop(
        "of", "since", "start", "last_time", "before", *([] if "dt" in candles.columns else ["dt"])
    )
