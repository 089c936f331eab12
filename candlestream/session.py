"""Session defaults and the shared working folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# State of many (symbol, window) groups stays off the executor heap.
STREAM_DEFAULTS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# What a new session should start with. `shuffle.partitions` is left to the cluster and AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **STREAM_DEFAULTS,
}


def build_session(app: str = "candlestream", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stream_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of the same cluster to read a stream in.

    A stateful stream keeps the number of shuffle partitions of its first start for good, and
    adaptive execution does not merge them. So the number is chosen for the stream (one per core
    by default), and the caller's own settings are left alone.
    """
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    own = spark.newSession()
    settings = {
        **STREAM_DEFAULTS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": spark.conf.get("spark.sql.session.timeZone"),
    }
    for key, value in settings.items():
        own.conf.set(key, value)
    return own


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Executors on other machines must see it, so a temporary folder is chosen only where the
    whole of Spark runs in this process.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="candlestream-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path of its own below the shared folder; nothing is ever written twice to it."""
    return f"{shared_folder(spark)}/candlestream/{purpose}-{uuid.uuid4().hex}"


def written(
    df: DataFrame,
    path: str,
    partition_by: tuple[str, ...] = (),
    reader: SparkSession | None = None,
) -> tuple[DataFrame, int]:
    """Write `df` as Parquet and read it back; also returns its row count.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the input), keeps
    column pruning and real sizes for the next plan, and counts rows without another job.
    """
    rows = Observation()
    counted = df.observe(rows, F.count(F.lit(1)).alias("n"))
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path), rows.get["n"]


def materialize(df: DataFrame, purpose: str = "table") -> tuple[DataFrame, int]:
    return written(df, new_folder(df.sparkSession, purpose))
