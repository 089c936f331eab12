"""From topic payloads and raw exchange messages to typed trades, and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestream.schemas import RAW_MESSAGE_SCHEMA, TRADE_SCHEMA

# Years 1 to 9999 in epoch milliseconds. Anything outside is dirt, not a time.
_FIRST_MS, _LAST_MS = -62135596800000, 253402300799999

# Text that denotes a number: decimal, exponent, infinity or NaN. Java also reads "1.5d" as a
# number, which no JSON producer means.
_NUMBER = r"(?i)^\s*[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def event_time(ms: Column) -> Column:
    """Epoch milliseconds as a timestamp; out-of-range values are NULL instead of an error."""
    return F.when(ms.between(_FIRST_MS, _LAST_MS), F.timestamp_millis(ms))


def decode_trades(df: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Typed trades of JSON payloads. A payload that does not parse becomes a row of NULLs.

    `keep` passes source columns through, such as a topic's `offset` to break time ties with.
    """
    payload = F.from_json(F.col(value_col).cast("string"), TRADE_SCHEMA)
    return with_notional(
        df.select(payload.alias("trade"), *keep)
        .select("trade.*", *keep)
        .withColumn("event_time", event_time(F.col("timestamp")))
    )


def with_notional(trades: DataFrame) -> DataFrame:
    return trades.withColumn("price_volume", F.col("price") * F.col("quantity"))


def _number(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def _typed_messages(df: DataFrame, value_col: str) -> DataFrame:
    message = F.from_json(F.col("value"), RAW_MESSAGE_SCHEMA)
    return (
        df.select(F.col(value_col).cast("string").alias("value"))
        .withColumn("message", message)
        .select(
            "value",
            F.col("message.s").alias("symbol"),
            _number(F.col("message.p")).alias("price"),
            _number(F.col("message.q")).alias("quantity"),
            F.col("message.E").alias("timestamp"),
            F.coalesce(*[F.col(f"message.{f}").cast("string") for f in "spqE"])
            .isNull().alias("unreadable"),
        )
    )


def _missing() -> Column:
    """Names of the fields a message lacks, as one text; empty when it is complete."""
    fields = TRADE_SCHEMA.names
    return F.concat_ws(",", *[F.when(F.col(f).isNull(), F.lit(f)) for f in fields])


def normalize_raw(df: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split raw exchange messages into (complete trades, rejects with a reason)."""
    typed = _typed_messages(df, value_col).withColumn("missing", _missing())
    good = typed.filter("missing = ''").select(*TRADE_SCHEMA.names)
    rejects = typed.filter("missing != ''").select(
        "value",
        F.when(F.col("unreadable"), "unreadable message")
        .otherwise(F.concat(F.lit("no usable "), "missing")).alias("reason"),
    )
    return good, rejects


def to_topic_payload(trades: DataFrame) -> DataFrame:
    """One JSON `value` per trade. No key, so one busy symbol spreads over all topic partitions."""
    return trades.select(F.to_json(F.struct(*TRADE_SCHEMA.names)).alias("value"))
