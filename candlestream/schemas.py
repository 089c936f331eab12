"""Explicit schemas of every input; nothing is inferred at read time."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

# One trade as it travels through the topic; `timestamp` is epoch milliseconds.
TRADE_SCHEMA = _struct(symbol=_S, price=_D, quantity=_D, timestamp=_L)

# One exchange message. The exchange quotes its numbers, so price and quantity are text here.
RAW_MESSAGE_SCHEMA = _struct(s=_S, p=_S, q=_S, E=_L)

SALES_SCHEMA = _struct(Quantity=_D, UnitPrice=_D, Country=_S)

STUDENT_SCHEMA = _struct(
    higher=_S, Mjob=_S, romantic=_S, address=_S,
    G3=_I, studytime=_I, Dalc=_I, Walc=_I, absences=_I, goout=_I,
)


def candle_schema(time_type: T.DataType | None = None) -> T.StructType:
    """A stored candle. Rows of older writers lack the window columns; they read as NULL."""
    t = time_type or T.TimestampType()
    return _struct(
        symbol=_S, open=_D, high=_D, low=_D, close=_D, volume=_D, avg_price=_D, vwap=_D,
        event_time=t, window_start=t, window_end=t,
    )


CANDLE_COLUMNS = candle_schema().names
