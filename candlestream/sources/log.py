"""Which files of a table count: an append-only log per writer.

A commit is one small file that lists the files of one batch, with their dates and rows. A table's
readers open what the log lists and nothing else, so a batch that was written and never committed
leaves nothing to be read, and a batch that is replayed after its commit writes nothing. Should two
runs of a batch commit it, the first commit counts.

    <root>/data/writer=<name>/commit=<batch>-<id>/dt=<date>/...   never written twice
    <root>/log/heads/...                                          one row per writer and epoch
    <root>/log/writer=<name>/<epoch>/...                          what counted before the epoch, in
                                                                  one file, then one file per commit

A reader reads the newest epoch. A new epoch starts when entries are an eighth
of all commits (`EPOCH` at least), so the number of epochs grows with the logarithm of the commits
and a snapshot's cost is spread over many of them. Compaction is a commit, too: it lists the new
files of a date and, as gone, those they replace; open readers go on with the old files.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from candlestream.session import written

EPOCH = 256

# A commit has one row without a file, which says that its batch counts and how many rows it has,
# and one per file.
_ENTRY = (
    "commit string, batch_id bigint, at timestamp, dt date, file string, rows bigint, gone boolean"
)
FOLDER_KEYS = (
    StructField("writer", StringType()), StructField("commit", StringType()), StructField("dt", DateType()),
)


def stored(spark: SparkSession, schema: str | StructType, path: str) -> DataFrame | None:
    """The Parquet table at `path`, or None where there is no such folder."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass(frozen=True)
class CommitLog:
    """The log and the data of one table of a store. One process writes under a name at a time."""

    spark: SparkSession
    root: str
    _seen: dict = field(default_factory=dict, compare=False, repr=False)

    # Reading

    def _heads(self) -> dict[str, int]:
        """The newest epoch of each writer."""
        heads = stored(self.spark, "name string, epoch bigint", f"{self.root}/log/heads")
        if heads is None:
            return {}
        return {r["name"]: r["epoch"] for r in heads.groupBy("name").agg(F.max("epoch").alias("epoch")).collect()}

    def _epoch_folder(self, name: str, epoch: int) -> str:
        return f"{self.root}/log/writer={name}/{epoch}"

    def _rows(self, name: str, epoch: int | None) -> DataFrame:
        if epoch is None:
            return self.spark.createDataFrame([], _ENTRY)
        return self.spark.read.schema(_ENTRY).parquet(self._epoch_folder(name, epoch))

    @staticmethod
    def _counting(rows: DataFrame) -> DataFrame:
        """Of several commits of one batch the first, and of its files those not gone."""
        marks = rows.filter("file IS NULL")
        first = marks.groupBy("batch_id").agg(F.min_by("commit", F.struct("at", "commit")).alias("commit"))
        valid = rows.join(first, ["batch_id", "commit"], "left_semi")
        gone = valid.filter("gone").select("file")
        return valid.filter("NOT gone").join(gone, "file", "left_anti")

    def entries(self, name: str) -> DataFrame:
        """commit, batch_id, at, dt, file, rows of what counts; rows without a file are commits."""
        return self._counting(self._rows(name, self._heads().get(name)))

    def files(self, name: str, since: str | None = None, until: str | None = None) -> list[str]:
        """The files a reader of the dates from `since` to `until` opens."""
        found = self.entries(name).filter("file IS NOT NULL")
        if since is not None:
            found = found.filter(F.col("dt") >= F.lit(since).cast("date"))
        if until is not None:
            found = found.filter(F.col("dt") <= F.lit(until).cast("date"))
        return [r["file"] for r in found.select("file").collect()]

    def read(
        self, columns: StructType, names: list[str], since: str | None = None, until: str | None = None
    ) -> DataFrame:
        """Rows with `columns`, `writer`, `commit` and `dt`; columns a writer lacks are NULL."""
        listed = [f for name in names for f in self.files(name, since, until)]
        return self._open(columns, listed)

    def _open(self, columns: StructType, files: list[str]) -> DataFrame:
        schema = StructType([*columns.fields, *FOLDER_KEYS])
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*files)

    def writers(self) -> list[str]:
        return sorted(self._heads())

    # Writing

    def _known(self, name: str) -> dict:
        """The writer's epoch and commits, read once per process. Its folders are made first, so that
        there is something to read."""
        if name not in self._seen:
            self._new_head(name, 0)
            epoch = self._heads()[name]
            if epoch == 0:
                nothing = self.spark.createDataFrame([], _ENTRY)
                nothing.coalesce(1).write.mode("append").parquet(self._epoch_folder(name, 0))
            marks = self._rows(name, epoch).filter("file IS NULL").select("batch_id", "commit").collect()
            found = {r["batch_id"]: r["commit"] for r in marks}
            self._seen[name] = {"epoch": epoch, "batches": found, "before": len(found), "since": 0}
        return self._seen[name]

    def _new_head(self, name: str, epoch: int) -> None:
        head = self.spark.createDataFrame([(name, epoch)], "name string, epoch bigint")
        head.coalesce(1).write.mode("append").parquet(f"{self.root}/log/heads")

    def write(self, rows: DataFrame, batch_id: int, name: str) -> tuple[DataFrame, int]:
        """Write and commit one batch of rows with a column `dt`, placed as they are; returns it as
        read back, and its row count. A batch that has a commit is not written again. A batch
        without rows leaves no commit."""
        if batch_id in self._known(name)["batches"]:
            if rows.sparkSession is not self.spark:
                # The stream's own state is only brought forward by running its batch.
                rows.write.format("noop").mode("overwrite").save()
            found = self.entries(name).filter(F.col("batch_id") == batch_id).select("file", "rows").collect()
            return self._batch(rows, [r["file"] for r in found if r["file"]]), sum(r["rows"] for r in found)
        commit = f"{batch_id}-{uuid.uuid4().hex}"
        n = self._write_files(rows, name, commit)
        if not n:
            return self._batch(rows, []), 0
        return self._batch(rows, self._commit(name, batch_id, commit, n)), n

    def _batch(self, rows: DataFrame, files: list[str]) -> DataFrame:
        columns = StructType([f for f in rows.schema.fields if f.name != "dt"])
        return self._open(columns, files).select(*[f"`{c}`" for c in rows.columns])

    def _folder(self, name: str, commit: str) -> str:
        return f"{self.root}/data/writer={name}/commit={commit}"

    def _write_files(self, rows: DataFrame, name: str, commit: str) -> int:
        return written(rows, self._folder(name, commit), ("dt",), self.spark)[1]

    def _commit(self, name: str, batch_id: int, commit: str, rows: int, gone: Sequence[str] = ()) -> list[str]:
        """One file that lists those of `commit`; returns them."""
        found = self.spark.read.schema("dt date").parquet(self._folder(name, commit)).inputFiles()
        # File names come percent-encoded, and are opened as they are.
        files = [unquote(f) for f in found]
        listed = [(_date(f), f, 0, False) for f in files] + [(None, f, 0, True) for f in gone]
        entry = self.spark.createDataFrame(
            [(None, None, rows, False), *listed], "dt date, file string, rows bigint, gone boolean"
        ).select(
            F.lit(commit).alias("commit"), F.lit(batch_id).cast("bigint").alias("batch_id"),
            F.current_timestamp().alias("at"), "dt", "file", "rows", "gone",
        )
        known = self._known(name)
        entry.coalesce(1).write.mode("append").parquet(self._epoch_folder(name, known["epoch"]))
        known["batches"][batch_id] = commit
        known["since"] += 1
        if known["since"] >= max(EPOCH, known["before"] // 8):
            self._new_epoch(name)
        return files

    def _new_epoch(self, name: str) -> None:
        """What counts now becomes a snapshot; readers see the epoch when that is complete."""
        known = self._known(name)
        epoch = known["epoch"] + 1
        columns = [f.split()[0] for f in _ENTRY.split(", ")]
        # What a lost driver left of this epoch, which no head names yet, is overwritten.
        self.entries(name).select(*columns).coalesce(1).write.mode("overwrite").parquet(
            self._epoch_folder(name, epoch)
        )
        self._new_head(name, epoch)
        known.update(epoch=epoch, before=len(known["batches"]), since=0)

    # Compaction

    def compact(self, columns: StructType, name: str, before: str, place, files: int) -> int:
        """Rewrite the dates before `before` that have more than `files` files; `place` puts rows in
        order for writing. Returns how many files went. Batch numbers of compactions are negative."""
        entries = self.entries(name).filter(F.col("file").isNotNull() & (F.col("dt") < F.lit(before).cast("date")))
        many = entries.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > files)
        gone = [r["file"] for r in entries.join(many, "dt", "left_semi").select("file").collect()]
        if not gone:
            return 0
        batch_id = min([0, *self._known(name)["batches"]]) - 1
        commit = f"{batch_id}-{uuid.uuid4().hex}"
        n = self._write_files(place(self._open(columns, gone).drop("writer", "commit")), name, commit)
        self._commit(name, batch_id, commit, n, gone)
        return len(gone)


def _date(file: str) -> date | None:
    """The date of a file by its folder."""
    found = re.search(r"/dt=(\d{4}-\d{2}-\d{2})/[^/]*$", file)
    return date.fromisoformat(found[1]) if found else None
