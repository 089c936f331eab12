"""Trade topics. Options are built by plain functions, so they can be tested without a broker."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlestream.operators.ingest import decode_trades, to_topic_payload

# Topic name and delivery settings (fixed values).
TOPIC = "crypto-prices"
PRODUCER = {"kafka.acks": "1", "kafka.retries": "5"}


@dataclass(frozen=True)
class Tls:
    """PEM texts (not paths) of the cluster authority, the client certificate and its key."""

    ca: str
    certificate: str
    key: str

    @staticmethod
    def from_files(ca: str, certificate: str, key: str) -> Tls:
        texts = []
        for path in (ca, certificate, key):
            with open(path, encoding="utf-8") as pem:
                texts.append(pem.read())
        return Tls(*texts)

    def options(self) -> dict[str, str]:
        return {
            "kafka.security.protocol": "SSL",
            "kafka.ssl.truststore.type": "PEM",
            "kafka.ssl.truststore.certificates": self.ca,
            "kafka.ssl.keystore.type": "PEM",
            "kafka.ssl.keystore.certificate.chain": self.certificate,
            "kafka.ssl.keystore.key": self.key,
        }


def kafka_options(
    servers: str, topic: str = TOPIC, starting: str = "latest", tls: Tls | None = None,
    per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options of a stream. Offsets the broker no longer has are skipped, not an error;
    `per_trigger` bounds how many are read at once, so that a backlog comes in parts."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        **({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {}),
        **(tls.options() if tls else {}),
    }


def replay_options(servers: str, topic: str = TOPIC, tls: Tls | None = None) -> dict[str, str]:
    """Batch read of everything the topic holds now; lost offsets are an error."""
    return {
        **kafka_options(servers, topic, "earliest", tls), "endingOffsets": "latest",
        "failOnDataLoss": "true",
    }


def sink_options(servers: str, topic: str = TOPIC, tls: Tls | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        **PRODUCER,
        **(tls.options() if tls else {}),
    }


# Offsets of a partition stay below this, so that partition and offset fit into one number.
_OFFSETS = 10**15


def _placed(raw: DataFrame) -> DataFrame:
    """Decoded trades with `place`, which orders trades of equal time: an offset is unique within
    its partition only, so the number holds both."""
    place = (F.col("partition").cast("bigint") * _OFFSETS + F.col("offset")).alias("place")
    return decode_trades(raw.select("*", place), keep=("place",))


def trade_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return _placed(spark.readStream.format("kafka").options(**options).load())


def replay_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return _placed(spark.read.format("kafka").options(**options).load())


def write_trades(trades: DataFrame, options: dict[str, str]) -> None:
    to_topic_payload(trades).write.format("kafka").options(**options).save()
