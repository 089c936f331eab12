"""Candle and indicator tables as Parquet folders.

    <path>/candles/...                         appended by streams, see `log`
    <path>/labels/...                          indicators and advice, likewise
    <path>/tail/<name>/<0 or 1>                newest candles per symbol
    <path>/published/<table>/...               replaced as a whole

Which files of a table count is said by a log, not by its folders. So a batch counts once, however
often it is replayed, a read for some dates opens the files of these dates only, and closed dates
can be compacted while others read and write.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from candlestream.operators.latest import top_rows
from candlestream.schemas import candle_schema
from candlestream.session import written
from candlestream.sources.log import CommitLog, stored

# Files one date is spread over: of a whole table, and of one batch of a stream.
_FILES_PER_DATE, _FILES_PER_BATCH = 8, 1


def _by_date(df: DataFrame, files: int) -> DataFrame:
    """Rows placed and ordered for folders by date: few files per date instead of one per task
    and date, and symbols in runs that a reader's filter can skip. A plain repartition, which also
    holds inside a stream's batch, where adaptive execution is off and hints to it are dropped."""
    spread = F.pmod(F.xxhash64("symbol", "event_time"), F.lit(files))
    dated = df.withColumns({"dt": F.to_date("event_time"), "spread": spread})
    placed = dated.repartition("dt", "spread").drop("spread")
    return placed.sortWithinPartitions("dt", "symbol", "event_time")


@dataclass(frozen=True)
class CandleStore:
    spark: SparkSession
    path: str
    _logs: dict = field(default_factory=dict, compare=False, repr=False)

    def log(self, table: str) -> CommitLog:
        return self._logs.setdefault(table, CommitLog(self.spark, f"{self.path}/{table}"))

    def checkpoint(self, name: str) -> str:
        """Each stream has its own; it lives and dies with the tables its batches wrote."""
        return f"{self.path}/checkpoints/{name}"

    # Appended candles

    def append(
        self, candles: DataFrame, batch_id: int, name: str = "batch"
    ) -> tuple[DataFrame, int]:
        """Store one batch; returns it as read back from the files, and its row count.

        A micro-batch runs once, here; what follows reads the files in the store's own session,
        where adaptive execution is on. A batch stored before is read back, not written again.
        """
        files = _FILES_PER_BATCH if candles.sparkSession is not self.spark else _FILES_PER_DATE
        rows, n = self.log("candles").write(_by_date(candles, files), batch_id, name)
        return rows.drop("dt"), n

    def candles(
        self, columns: StructType | None = None, since: str | None = None, name: str | None = None,
        until: str | None = None,
    ) -> DataFrame:
        """Stored candles of one writer, or of all; columns a writer lacks are NULL.

        `since` and `until` are dates; only the files of dates between them are opened.
        """
        return self._table("candles", columns or candle_schema(), since, name, until)

    def _table(
        self, table: str, columns: StructType, since: str | None, name: str | None, until: str | None = None
    ) -> DataFrame:
        log = self.log(table)
        return log.read(columns, log.writers() if name is None else [name], since, until)

    def compact(self, table: str, columns: StructType, name: str, before: str) -> int:
        """Merge the files of each date before `before`, which no batch adds to any more, into few;
        returns how many files went."""
        return self.log(table).compact(
            columns, name, before, lambda rows: _by_date(rows, _FILES_PER_DATE), _FILES_PER_DATE
        )

    def tail(
        self, name: str, n: int, columns: StructType | None = None, since: str | None = None
    ) -> DataFrame:
        """The newest n stored candles per symbol of one writer: two writers may hold the same
        candles, or candles of other widths."""
        return top_rows(self.candles(columns, since, name), n)

    # Labelled candles of one writer

    def write_labels(self, rows: DataFrame, batch_id: int, name: str) -> DataFrame:
        return self.log("labels").write(_by_date(rows, _FILES_PER_BATCH), batch_id, name)[0].drop("dt")

    def labels(
        self, columns: StructType, name: str, since: str | None = None, until: str | None = None
    ) -> DataFrame:
        return self._table("labels", columns, since, name, until)

    # What a stream needs of its past: two slots in turn, never read and written at once

    def _slot(self, name: str, slot: int) -> str:
        return f"{self.path}/tail/{name}/{slot}"

    def write_state(self, rows: DataFrame, batch_id: int, name: str, slot: int) -> None:
        written(rows.withColumn("state_of", F.lit(batch_id)), self._slot(name, slot))

    def state(self, schema: StructType, batch_id: int, name: str) -> tuple[DataFrame | None, int]:
        """The newest state left before batch `batch_id`, or None, and the slot for the next one.

        Empty batches leave no state, so the newest may be some batches old. A replayed batch
        finds its own state in one slot, and the one it started from in the other.
        """
        if batch_id == 0:
            return None, 0
        full = StructType([*schema.fields, StructField("state_of", IntegerType())])
        found = []
        for slot in (0, 1):
            rows = stored(self.spark, full, self._slot(name, slot))
            if rows is None:
                continue
            of = rows.agg(F.max("state_of")).first()[0]
            if of is not None and of < batch_id:
                found.append((of, slot, rows))
        if not found:
            return None, 0
        _, slot, rows = max(found, key=lambda x: x[0])
        return rows.drop("state_of"), 1 - slot

    # Whole tables replaced at once

    def publish(self, df: DataFrame, batch_id: int, table: str = "indicators") -> DataFrame:
        """Replace `table`. Readers see the old version until the new one is complete, and go on
        reading it: every publication has a folder of its own."""
        root = f"{self.path}/published/{table}"
        folder = f"data/{batch_id:012d}-{uuid.uuid4().hex}"
        rows, _ = written(df, f"{root}/{folder}")
        self.spark.range(1).select(
            F.lit(batch_id).cast("bigint").alias("version"), F.current_timestamp().alias("at"),
            F.lit(folder).alias("folder"),
        ).coalesce(1).write.mode("append").parquet(f"{root}/versions")
        return rows

    def _versions(self, table: str) -> DataFrame | None:
        return stored(
            self.spark, "version bigint, at timestamp, folder string", f"{self.path}/published/{table}/versions"
        )

    def version(self, table: str = "indicators") -> int | None:
        """The newest published version, or None."""
        versions = self._versions(table)
        return None if versions is None else versions.agg(F.max("version")).first()[0]

    def published(self, table: str = "indicators") -> DataFrame:
        """The newest complete version; of one published again, the last."""
        versions = self._versions(table)
        if versions is None:
            raise ValueError(f"{table} was never published")
        newest = versions.agg(F.max_by("folder", F.struct("version", "at"))).first()[0]
        return self.spark.read.parquet(f"{self.path}/published/{table}/{newest}")
