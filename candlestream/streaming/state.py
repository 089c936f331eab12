"""What a label stream remembers of each symbol, held in the stream's own state.

The state of a symbol is its newest candles, as many as the strategy looks back, and the exact
running volume total up to the last of them. A batch touches the state of the symbols it has
candles of and of no others; the checkpoint keeps it, so a replayed batch starts from the state
the first run of it started from.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from candlestream.operators.indicators import EXACT, EXACT_TOTAL

CARRIED, KNOWN = "carried", "known"
_VOLUME, _KEPT = "exact_volume", "kept"


class Remembering(StatefulProcessor):
    """Gives, of a symbol with new candles, the remembered ones and then the new ones.

    The last remembered candle carries the total up to it, the others 0; new candles carry NULL.
    Of the new candles of a batch only those marked `kept` are remembered.
    """

    def __init__(self, columns: StructType, reach: int) -> None:
        self.columns, self.reach = columns, reach

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.columns)
        self.total = handle.getValueState("total", StructType().add("total", EXACT_TOTAL))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        names = self.columns.names
        out = Row(*names, CARRIED, KNOWN)
        time, close = names.index("event_time"), names.index("close")
        past = [tuple(r) for r in self.rows.get()]
        total = self.total.get()[0] if past else Decimal(0)
        for k, row in enumerate(past):
            yield out(*row, total if k == len(past) - 1 else Decimal(0), True)
        before = past[-1][close] if past else None
        kept = past
        for row in sorted((tuple(r) for r in rows), key=lambda r: r[time]):
            *candle, volume, keep = row
            yield out(*candle, None, False)
            if keep:
                if before is not None and candle[close] is not None and volume is not None:
                    step = candle[close] - before
                    total += volume if step > 0 else -volume if step < 0 else 0
                before = candle[close]
                kept = [*kept[1 - self.reach:], tuple(candle)] if self.reach > 1 else [tuple(candle)]
        if kept:
            self.rows.put(kept)
            self.total.update((total,))

    def close(self) -> None:
        pass


def with_past(candles: DataFrame, reach: int, complete_only: bool) -> DataFrame:
    """The candles of a stream, each batch's after the remembered ones of the same symbols, with
    columns `carried` and `known`. A symbol's new candles of one batch pass through one task."""
    columns = candles.schema
    missing = F.isnull("symbol") | F.isnull("close") | F.isnull("event_time")
    whole = ~missing if complete_only else F.lit(True)
    given = candles.withColumns({_VOLUME: F.col("volume").cast(EXACT), _KEPT: whole})
    out = StructType([*columns.fields]).add(CARRIED, EXACT_TOTAL).add(KNOWN, "boolean")
    return given.groupBy("symbol").transformWithState(
        statefulProcessor=Remembering(columns, max(reach, 1)), outputStructType=out,
        outputMode="Append", timeMode="None",
    )
