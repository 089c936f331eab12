"""Rolling windows over a symbol's history without one task per symbol.

Row-frame windows need a symbol's candles in order, and plain `PARTITION BY symbol` puts all
of them into one task. `split_history` cuts the history of long symbols into blocks and gives
each block a *halo*: copies of the candles just before it. A frame of finite reach then sees
exactly the rows it would see in the whole history. Indicators partition by
`partition_keys(...)`, which includes the block when there is one, and `drop_halo` removes the
copies afterwards. Running totals, whose reach is unbounded, are summed over blocks first, see
`with_earlier_totals`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEY, BLOCK, HALO = "history_key", "history_block", "history_halo"

# Candles of one symbol one task may hold before its history is split. Each row costs some
# hundred aggregate updates over its frames, so blocks are small enough to spread well.
ROWS_PER_BLOCK = 1 << 16

# Time cells a block is made of at one candle per slot; a halo copies one cell or two.
CELLS_PER_BLOCK = 32

# Map rows (about 60 bytes each) up to which the block map is broadcast, else shuffled. Enough
# for the split symbols of a table of a billion candles.
BROADCAST_ROWS = 500_000


def partition_keys(c: DataFrame, by: Sequence[str]) -> list[str]:
    """What a symbol's rolling windows are partitioned by."""
    return [KEY, BLOCK] if BLOCK in c.columns else list(by)


def _key(by: Sequence[str]) -> Column:
    """The symbol as a struct: never NULL itself, and equal to itself where the symbol is. So
    joins by it are plain equalities, which windows by it share their partitioning with."""
    return F.struct(*by).alias(KEY)


def _block_map(
    c: DataFrame, cell: str, rows_per_block: int, reach: int, by: Sequence[str], time: str
) -> DataFrame:
    """(symbol, time cell) -> blocks, for symbols with more than `rows_per_block` candles.

    A cell belongs to the block its first row falls into, counting `rows_per_block` rows per
    block, and is halo for every later block that starts fewer than `reach` rows after the
    cell's end. Any two neighbouring blocks span more than `rows_per_block` rows together, so
    with `reach` below that no cell is needed beyond the second block after its own.
    """
    per_symbol = Window.partitionBy(KEY)
    until_here = F.sum("n").over(per_symbol.orderBy("cell"))
    cells = (
        c.groupBy(_key(by), F.window(time, cell).start.alias("cell"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            KEY, "cell",
            until_here.alias("end"),
            (until_here - F.col("n")).alias("start"),
            F.sum("n").over(per_symbol).alias("total"),
        )
        .filter(F.col("total") > rows_per_block)
        .withColumn(BLOCK, F.floor(F.col("start") / rows_per_block))
    )
    following = per_symbol.orderBy(BLOCK)

    def ahead(n: int) -> Column:
        return F.struct(
            F.lead(BLOCK, n).over(following).alias(BLOCK),
            F.lead("first", n).over(following).alias("first"),
        )

    blocks = cells.groupBy(KEY, BLOCK).agg(F.min("start").alias("first")).select(
        KEY, BLOCK, ahead(1).alias("next1"), ahead(2).alias("next2")
    )
    own = F.struct(F.col(BLOCK), F.lit(False).alias(HALO))
    as_halo = [
        F.when(
            F.col(f"{later}.first") < F.col("end") + reach,
            F.struct(F.col(f"{later}.{BLOCK}").alias(BLOCK), F.lit(True).alias(HALO)),
        )
        for later in ("next1", "next2")
    ]
    places = F.explode(F.array_compact(F.array(own, *as_halo)))
    return cells.join(blocks, [KEY, BLOCK]).select(KEY, "cell", places.alias("place")).select(
        KEY, "cell", "place.*"
    )


def split_history(
    c: DataFrame,
    cell: str,
    reach: int,
    rows_per_block: int = ROWS_PER_BLOCK,
    by: Sequence[str] = ("symbol",),
    time: str = "event_time",
) -> DataFrame:
    """Add the block and halo columns; symbols of at most `rows_per_block` candles stay whole.

    `c` should be a stored table (it is read twice: two columns to count, then all). `cell` is
    the time grain blocks are cut at, see `cell_of`; `reach` is how many earlier candles the
    indicators to come look at. The number of map rows is known before the
    join, so the map is broadcast only when it is small.
    """
    from candlestream.session import materialize

    check_reach(reach, rows_per_block)
    block_map, size = materialize(
        _block_map(c, cell, rows_per_block, reach, by, time), "block-map"
    )
    if size == 0:
        return c
    if size <= BROADCAST_ROWS:
        block_map = F.broadcast(block_map)
    keyed = c.select("*", _key(by), F.window(time, cell).start.alias("cell"))
    return keyed.join(block_map, [KEY, "cell"], "left").drop("cell").withColumns({
        BLOCK: F.coalesce(F.col(BLOCK), F.lit(0)),
        HALO: F.coalesce(F.col(HALO), F.lit(False)),
    })


def cell_of(width: str, rows_per_block: int) -> str:
    """The time grain blocks are cut at, for candles of `width` (such as "10 seconds")."""
    times = max(rows_per_block // CELLS_PER_BLOCK, 1)
    return " ".join(str(int(w) * times) if w.isdigit() else w for w in width.split())


def check_reach(reach: int, rows_per_block: int) -> None:
    if rows_per_block <= reach:
        raise ValueError(
            f"indicators look {reach} candles back; a block of {rows_per_block} must hold more"
        )


def drop_halo(c: DataFrame) -> DataFrame:
    return c.filter(~F.col(HALO)).drop(KEY, BLOCK, HALO) if BLOCK in c.columns else c


def with_earlier_totals(c: DataFrame, values: Sequence[str]) -> DataFrame:
    """Adds `<value>_before` to a split history: the sum of `value` over all earlier blocks of the
    candle's symbol.

    The candles, labelled so far, are written once. Each block is then one row: its sums are added
    up per map task, and a task that adds up a symbol's blocks sees one row per block, never the
    symbol's candles. These rows are counted before they are joined: broadcast up to the size of a
    block map, shuffled beyond it. So the candles are exchanged once, for their windows.
    """
    from candlestream.session import materialize

    blocks, _ = materialize(c, "blocks")
    earlier = Window.partitionBy(KEY).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy(KEY, BLOCK).agg(*[F.sum(v).alias(f"{v}_sum") for v in values]).select(
        KEY, BLOCK, *[F.coalesce(F.sum(f"{v}_sum").over(earlier), F.lit(0)).alias(f"{v}_before") for v in values]
    )
    sums, size = materialize(sums, "block-totals")
    return blocks.join(F.broadcast(sums) if size <= BROADCAST_ROWS else sums, [KEY, BLOCK], "left")
