"""Optional document-store connector: options only, the connector itself comes with the cluster."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

URI_CONF, URI_ENV = "spark.mongodb.connection.uri", "CANDLESTREAM_STORE_URI"


def document_options(
    spark: SparkSession | None, database: str, collection: str, uri: str | None = None
) -> dict[str, str]:
    """Connector options. Credentials come from the caller, the Spark conf or the environment."""
    if uri is None and spark is not None:
        uri = spark.conf.get(URI_CONF, None)
    uri = uri or os.environ.get(URI_ENV)
    if not uri:
        raise ValueError(f"no store URI: pass one, or set {URI_CONF} or {URI_ENV}")
    return {URI_CONF: uri, "database": database, "collection": collection}


def document_reader(spark: SparkSession, options: dict[str, str]) -> DataFrameReader:
    """Give it a schema before `load()`, or the connector samples the collection."""
    return spark.read.format("mongodb").options(**options)


def write_documents(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    df.write.format("mongodb").mode(mode).options(**options).save()
