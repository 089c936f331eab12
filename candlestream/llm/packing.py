"""Tokenised documents packed into sequences by vector best-fit.

A document is its token ids and an end id. Only a longer one than a sequence is cut: into pieces of
the full length, of which the first may be shorter. A sequence has three capacities: tokens,
documents, and attention cost, which is the sum of squared lengths. Pieces are placed longest first
into the sequence that holds them under every capacity and whose weighted remainder is smallest
(`residual`) or whose remainder points most the piece's way (`dot`); if none holds a piece, a new
sequence opens. Pieces are dealt into groups of about `GROUP_PIECES`, packed on their own; each
group leaves few sequences partly filled, whatever the size of the table.

Defined cases: NULL and empty texts are the end id alone; repeated rows are packed each; an empty
table gives an empty result; ids outside the capacities cannot occur, since no piece is longer
than a sequence; columns other than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import functools
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candlestream.llm.groups import by_group
from candlestream.session import materialize

GROUP_PIECES = 20_000
END_ID = 2

# Below this code point all libraries agree on letters, digits and white space.
LATIN_END = 0x250
SPECIAL = "<|endoftext|>"


@dataclass(frozen=True)
class Capacities:
    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.float64)


@functools.cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def _ranked(path: str):
    """The same vocabulary in a faster library, or None if its ranks are not beside it."""
    ranks = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks):
        return None
    import base64

    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )


def encode(texts: list[str], path: str) -> list[list[int]]:
    """Token ids as the tokenizer file at `path` has them, no special tokens added. Latin texts
    take the faster library, which gives the same ids; all others the file's own."""
    ranked = _ranked(path)
    own = [ranked is None or SPECIAL in t or not _latin(t) for t in texts]
    slow = [t for t, o in zip(texts, own, strict=True) if o]
    encoded = iter(_tokenizer(path).encode_batch_fast(slow, add_special_tokens=False) if slow else [])
    return [
        next(encoded).ids if o else ranked.encode_ordinary(t)
        for t, o in zip(texts, own, strict=True)
    ]


def _latin(text: str) -> bool:
    return text.isascii() or max(text) < chr(LATIN_END)


_PIECES = "doc bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut(path: str, tokens: int, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: list[tuple] = []
                encoded = encode(part.column("text").to_pylist(), path)
                for doc, ids in zip(part.column("doc").to_pylist(), encoded, strict=True):
                    data = np.array([*ids, end_id], "<u4").tobytes()
                    n = len(data) // 4
                    begin, end = 0, n % tokens or tokens
                    for piece in range(-(-n // tokens)):
                        own = data[4 * begin:4 * end]
                        row = (doc, piece, begin, end - begin, zlib.crc32(own))
                        rows.append((*row, own) if with_ids else row)
                        begin, end = end, end + tokens
                names = ["doc", "piece", "start", "length", "ids_crc32", "ids"]
                kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.binary()]
                yield pa.RecordBatch.from_arrays([
                    pa.array(values, kind) for values, kind in
                    zip(zip(*rows, strict=True), kinds, strict=False)
                ], names=names[:len(rows[0])])

    return cut


def pieces(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokens: int = 1024,
    end_id: int = END_ID, with_ids: bool = False,
) -> DataFrame:
    """doc, piece, start, length and CRC-32 of the ids; `with_ids` adds the ids themselves."""
    source = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    schema = _PIECES + (", ids binary" if with_ids else "")
    return source.mapInArrow(_cut(path, tokens, end_id, with_ids), schema)


def best_fit(
    lengths: np.ndarray, capacities: Capacities, weights: tuple[float, float, float], rule: str,
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and place in it for each length."""
    order = np.argsort(-lengths, kind="stable")
    scale = np.array(weights) / capacities.vector() ** (1 if rule == "dot" else 2)
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    left = np.empty((3, len(lengths)))
    names = np.empty(len(lengths), np.int64)
    opened = live = 0
    shortest = int(lengths.min()) if len(lengths) else 0
    for k, at in enumerate(order.tolist()):
        n = int(lengths[at])
        need = np.array([n, 1, n * n], np.float64)
        if (need > capacities.vector()).any():
            raise ValueError(f"no sequence holds a piece of {n} tokens")
        open_now = left[:, :live]
        fits = np.flatnonzero((open_now >= need[:, None]).all(0))
        if len(fits):
            rest = open_now[:, fits]
            if rule == "dot":
                best = fits[np.argmax((scale[:, None] * need[:, None] / capacities.vector()[:, None] * rest).sum(0))]
            else:
                best = fits[np.argmin((scale[:, None] * (rest - need[:, None]) ** 2).sum(0))]
        else:
            best = live
            left[:, live] = capacities.vector()
            names[live] = opened
            opened += 1
            live += 1
        bins[at] = names[best]
        offsets[at] = capacities.tokens - int(left[0, best])
        left[:, best] -= need
        if k % 256 == 255:
            # Sequences that hold not even the shortest piece are closed.
            stay = np.flatnonzero((left[0, :live] >= shortest) & (left[1, :live] >= 1))
            left[:, :len(stay)] = left[:, stay]
            names[:len(stay)] = names[stay]
            live = len(stay)
    return bins, offsets


def pack(
    table: DataFrame, capacities: Capacities = Capacities(),
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "residual",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """`table` (with column `length`) plus sequence_id and offset."""
    kept = [c for c in table.columns if c not in ("sequence_id", "offset")]
    written, n = materialize(table.select(*[F.col(f"`{c}`") for c in kept]), "pieces")
    groups = max(1, -(-n // group_pieces))
    dealt = written.withColumn(
        "group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    )
    schema = StructType(written.schema.fields).add("sequence_id", "long").add("offset", "long")

    def placed(part: pa.Table) -> pa.RecordBatch:
        group = part.column("group")[0].as_py()
        bins, offsets = best_fit(part.column("length").to_numpy(), capacities, weights, rule)
        out = part.drop(["group"]).append_column("sequence_id", pa.array(bins + (group << 32)))
        out = out.append_column("offset", pa.array(offsets))
        return out.combine_chunks().to_batches()[0]

    return by_group(dealt, ["group"], placed, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence, from pieces packed with their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.count("*").alias("documents"), parts.alias("parts")
    ).select(
        "sequence_id", "length", "documents",
        F.aggregate("parts", F.lit(b""), lambda ids, p: F.concat(ids, p["ids"])).alias("ids"),
    )
