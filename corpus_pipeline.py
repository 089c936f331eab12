"""From raw documents to packed training sequences.

Each stage takes the documents its predecessor kept and returns them with the columns of
`documents`; the last returns one row per piece of a sequence. What is written between stages goes
to the folder that all executors share.

Rows are told apart by id and text. A row with a NULL or empty text fails the quality rules. Of
rows that repeat id and text one stays. Extra columns are passed through to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlestream.llm import decontamination, jaccard_join, packing, pii, quality
from candlestream.session import materialize

# Rejected keys that are sent to all executors; more are joined by shuffle.
BROADCAST_KEYS = 200_000

_KEY = "__text_key"


def _without(docs: DataFrame, keys: DataFrame, rows: int) -> DataFrame:
    """`docs`, which has the columns of `keys`, without the rows that `keys` lists."""
    if rows <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    same = [docs[c].eqNullSafe(keys[c]) for c in keys.columns]
    return docs.join(keys, same, "left_anti")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_KEY, F.unhex(F.md5(F.coalesce("text", F.lit("")))))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    judged = quality.cascade(docs, into="__failed_rule")
    return judged.filter(F.isnull("__failed_rule")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates."""
    judged, _ = materialize(jaccard_join.near_duplicates(docs), "duplicates")
    stays = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("class_key"))
    key = F.col("text_key").alias(_KEY)
    goes, n = materialize(judged.filter(~stays).select("doc_id", key).distinct(), "goes")
    kept = _without(_keyed(docs), goes, n)
    repeated, rows = materialize(
        judged.filter(stays).groupBy("doc_id", key).count().filter("count > 1").drop("count"), "repeated"
    )
    if rows:
        once = _keyed(docs).join(repeated, [docs["doc_id"].eqNullSafe(repeated["doc_id"]), F.col(_KEY) == repeated[_KEY]], "left_semi")
        kept = _without(kept, repeated, rows).union(once.dropDuplicates(["doc_id", _KEY]))
    return kept.select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = _keyed(docs)
    found = decontamination.leaks(keyed.select(_KEY, "text"), items, doc_id=_KEY)
    goes, n = materialize(found.select(F.col("doc_id").alias(_KEY)).distinct(), "leaks")
    return _without(keyed, goes, n).select(*docs.columns)


def pii_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced."""
    replaced = pii.replace_pii(docs)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        replaced = replaced.withColumn(
            "n_chars", F.when(F.col("n_replaced") > 0, length).otherwise(F.col("n_chars"))
        )
    return replaced.select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    pieces = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces).withColumnRenamed("doc", "doc_id")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_surrogates", pii_surrogates),
    ("best_fit_packing", best_fit_packing),
]

# Near duplicates and token ids are not to be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir), name)
    return docs
