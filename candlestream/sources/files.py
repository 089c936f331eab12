"""File sources: CSV, text lines, replay streams, and tab-separated output."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> DataFrame:
    """CSV with a header. Columns are matched by name, so extra or reordered ones do no harm.

    The header of one file names the columns; a file of the folder with another header is an
    error. The schema's types are then cast, unreadable values becoming NULL. No pass over the
    data to infer types.
    """
    header = spark.read.csv(path, header=True, sep=sep).schema
    named = spark.read.schema(header).csv(path, header=True, sep=sep, enforceSchema=False)
    return named.select(
        *[F.trim(field.name).try_cast(field.dataType).alias(field.name) for field in schema]
    )


# Types a column of text may be read as, narrowest first, and what their values look like.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
INFERRED = {
    "boolean": r"^(?i:true|false)$", "int": r"^[+-]?[0-9]+$", "bigint": r"^[+-]?[0-9]+$", "double": _NUMBER,
    "date": _DAY + "$", "timestamp": _DAY + r"([ T][0-9]{1,2}:[0-9]{2}.*)?$",
}


def _by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a folder by their first line."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")
    ).filter("block = 0").withColumn("place", F.monotonically_increasing_id())
    first = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
    found: dict[str, list[str]] = {}
    for r in first.orderBy("file").collect():
        found.setdefault(r["header"], []).append(unquote(r["file"]))
    return found


def infer_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with headers and types found by reading: files whose columns differ in order or number
    are matched by name, and a column gets the narrowest type that holds every value of it.

    Each value says which types it fits; these are combined over all rows in one aggregate, so a
    value that appears once decides as any other. Blank values are NULL and fit all types; a
    column without values is text. Files without a line are left out; a folder without any is an
    error.
    """
    parts = [
        spark.read.csv(files, header=True, sep=sep, inferSchema=False)
        for files in _by_header(spark, path).values()
    ]
    if not parts:
        raise ValueError(f"{path} has no header")
    texts = parts[0]
    for part in parts[1:]:
        texts = texts.unionByName(part, allowMissingColumns=True)
    columns = texts.columns
    texts = texts.select(*[F.nullif(F.trim(f"`{c}`"), F.lit("")).alias(c) for c in columns])

    def fits(column: Column, kind: str) -> Column:
        return F.when(column.isNotNull(), column.rlike(INFERRED[kind]) & column.try_cast(kind).isNotNull())

    each = [
        F.bool_and(fits(F.col(f"`{c}`"), kind)).alias(f"{k} {kind}") for k, c in enumerate(columns) for kind in INFERRED
    ]
    fitting = texts.agg(*each).first().asDict()
    kinds = [next((kind for kind in INFERRED if fitting[f"{k} {kind}"]), "string") for k in range(len(columns))]
    return texts.select(*[F.col(f"`{c}`").try_cast(kind).alias(c) for c, kind in zip(columns, kinds, strict=True)])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row `value` per text line."""
    return spark.read.text(path)


def _as_pattern(path: str) -> str:
    """The path as a pattern that matches only itself.

    A stream takes a plain path for a folder; a pattern may also name a single file.
    """
    path = path.rstrip("/")
    return path if set(path) & set("*?[{") else f"{path[:-1]}[{path[-1]}]"


def replay_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    file_format: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream over stored files, a folder or one file; stands in for a topic."""
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(_as_pattern(path))


def tab_lines(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in columns]).alias("value"))


def write_tab_lines(df: DataFrame, path: str, *columns: str) -> None:
    tab_lines(df, *columns).write.mode("overwrite").text(path)
