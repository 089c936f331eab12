"""An outside store without transactions, so written that its readers see each batch once."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_COMMIT = "writer string, batch_id bigint, attempt string, at timestamp"
_TAGS = ["writer", "batch_id", "attempt"]


@dataclass(frozen=True)
class CommittedSink:
    """Rows go to one table or collection, commits to another, of any format that appends.

    Every attempt to write a batch tags its rows; after all of them are written, one row says that
    the attempt counts. Readers take the rows of the first attempt of each batch that has one. So
    an attempt that fails midway, or whose batch is replayed after it, leaves nothing that counts
    twice. Rows that do not count can be removed at any time.
    """

    format: str
    rows: dict[str, str]
    commits: dict[str, str]

    def write(self, batch: DataFrame, batch_id: int, name: str) -> None:
        attempt = uuid.uuid4().hex
        tags = {"writer": F.lit(name), "batch_id": F.lit(batch_id).cast("bigint"), "attempt": F.lit(attempt)}
        self._append(batch.withColumns(tags), self.rows)
        commit = batch.sparkSession.range(1).select(
            *[value.alias(tag) for tag, value in tags.items()], F.current_timestamp().alias("at")
        )
        self._append(commit, self.commits)

    def _append(self, df: DataFrame, options: dict[str, str]) -> None:
        df.write.format(self.format).options(**options).mode("append").save()

    def read(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """The rows that count, with the columns of `schema`, `writer` and `batch_id`."""
        tagged = StructType([*schema.fields]).add("writer", "string").add("batch_id", "long").add("attempt", "string")
        rows = spark.read.format(self.format).options(**self.rows).schema(tagged).load()
        commits = spark.read.format(self.format).options(**self.commits).schema(_COMMIT).load()
        first = commits.groupBy("writer", "batch_id").agg(
            F.min_by("attempt", F.struct("at", "attempt")).alias("attempt")
        )
        return rows.join(first, _TAGS, "left_semi").select(*schema.names, "writer", "batch_id")
