"""The driver's tables in the shape of the engine's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlestream.operators.ingest import with_notional
from candlestream.sources.files import replay_stream

# With raw values (0.01 to 490) nearly every candle is HIGH risk; this brings all classes up.
PRICE_OFFSET = 10000.0

EVENT_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_trades(events: DataFrame, event_time: str = "ts", offset: float = PRICE_OFFSET) -> DataFrame:
    """symbol = event type, price = value + offset, quantity = the number in `props`."""
    return with_notional(events.select(
        F.col("event_type").alias("symbol"),
        (F.col("value") + offset).alias("price"),
        F.get_json_object("props", "$.k").try_cast("double").alias("quantity"),
        F.expr(event_time).alias("event_time"),
        "event_id",
    ))


def trades(spark: SparkSession, sf_dir: str, offset: float = PRICE_OFFSET) -> DataFrame:
    return as_trades(table(spark, sf_dir, "events"), offset=offset)


def trade_stream(
    spark: SparkSession, path: str, offset: float = PRICE_OFFSET, files_per_batch: int | None = None
) -> DataFrame:
    """Streams need TIMESTAMP for their watermark; the files hold zone-less times."""
    events = replay_stream(spark, path, EVENT_SCHEMA, files_per_batch=files_per_batch)
    return as_trades(events, "CAST(ts AS TIMESTAMP)", offset)


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as the session's wall-clock times, the way the files hold them."""
    return df.withColumns({
        name: F.col(name).cast("timestamp_ntz") for name, kind in df.dtypes if kind == "timestamp"
    })


def millis(time: str = "ts") -> str:
    return f"unix_millis(CAST({time} AS TIMESTAMP))"


def topic_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the JSON trades a topic holds."""
    return trades(spark, sf_dir, 0.0).select(
        F.to_json(F.struct(
            "symbol", "price", "quantity", F.expr(millis("event_time")).alias("timestamp"),
        )).alias("value")
    )


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as exchange messages, quoted numbers and all. Dirt by what the event says: the
    price of errors is not a number, signups of less than 1 come as plain text, and purchases
    of less than 1 lack their quantity."""
    events = table(spark, sf_dir, "events")
    quantity = F.get_json_object("props", "$.k")
    message = F.to_json(F.struct(
        F.col("event_type").alias("s"),
        F.when(F.col("event_type") == "error", "n/a")
        .otherwise(F.col("value").cast("string")).alias("p"),
        F.when((F.col("event_type") == "purchase") & (F.col("value") < 1), None)
        .otherwise(quantity).alias("q"),
        F.expr(millis()).alias("E"),
    ))
    plain = (F.col("event_type") == "signup") & (F.col("value") < 1)
    return events.select(F.when(plain, "ping").otherwise(message).alias("value"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_quantity").alias("Quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("UnitPrice"),
    )


def country_totals(spark: SparkSession, sf_dir: str, per_supplier: DataFrame) -> DataFrame:
    """Supplier totals summed to countries. Lines are summed per supplier before they are
    joined, so no supplier, however busy, is a hot join key."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey").agg(F.sum("Total_Revenue").alias("Total_Revenue"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("Country"), "Total_Revenue")
    )


def students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as students: a grade of 0 to 20 from the price, habits from dates and priority."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("student"),
        F.when(F.col("o_orderstatus") == "P", "no").otherwise("yes").alias("higher"),
        F.col("o_orderpriority").alias("Mjob"),
        F.when(F.col("o_orderstatus") == "O", "yes").otherwise("no").alias("romantic"),
        F.when(F.col("o_orderpriority") < "3", "U").otherwise("R").alias("address"),
        F.floor(F.col("o_totalprice") / 25000).cast("int").alias("G3"),
        (F.month("o_orderdate") % 4 + 1).alias("studytime"),
        F.dayofweek("o_orderdate").alias("Dalc"),
        F.quarter("o_orderdate").alias("Walc"),
        F.dayofmonth("o_orderdate").alias("absences"),
        (F.month("o_orderdate") % 5 + 1).alias("goout"),
    )
