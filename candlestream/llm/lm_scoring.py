"""Log probability of texts under a smoothed n-gram model, read off a weighted backoff automaton.

Smoothed n-grams are the states and arcs of an automaton with failure arcs (see backoff.py); one walk
over a text from left to right carries the state and adds up the arcs' log probabilities. The
probabilities of all words and one unknown word sum to one in every state.

The automaton never is in one place. Documents are dealt into chunks; a chunk's distinct n-grams
go, with its training counts, to the tasks that own their hash ranges, these add up, and each
chunk gets the totals of its own n-grams back, which make the part of the automaton that its texts
can reach. An n-gram, however frequent, travels once per chunk. Rows that repeat id and text are
counted before the shuffle and travel once, so that they cannot fill a chunk.

Defined cases: NULL and empty texts hold the end token only; a NULL id counts as training text;
repeated rows count and are scored each; an empty table gives an empty result; columns other than
id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestream.llm import text as tx
from candlestream.llm.backoff import automaton
from candlestream.session import materialize

ORDER = 2
STRENGTH = 30.0

CHUNK_BYTES = 3 << 20
# N-grams of all chunks that one task adds up, about.
RANGE_GRAMS = 500_000
# Chunks or ranges of one task, at most on average, where the session's partitions would hold more.
PER_TASK = 16

# Hashes of repeated rows that are sent to all executors; more are joined.
BROADCAST_REPEATED = 100_000

START, END = tx.random_numbers(2, 31)

FOLDS, HELD_OUT = 7, 2


def held_out(doc_id: Column) -> Column:
    """Whether the id's CRC-32 puts the document in the fold that the model does not learn from."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


def _tokens(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's words and end token, row after row, and tokens per row."""
    hashes, counts = [], []
    for texts in tx.slices(column, lower=True):
        starts, stops, n = tx.word_edges(texts)
        own = tx.word_hashes(texts.data, starts, stops)
        hashes.append(np.insert(own, np.cumsum(n), END))
        counts.append(n + 1)
    return np.concatenate(hashes), np.concatenate(counts)


def _grams(tokens: np.ndarray, counts: np.ndarray, order: int) -> list[np.ndarray]:
    """For each length up to `order`, a hash of the tokens that end at each place. Before the
    first token of a row stand start marks."""
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    place = np.arange(len(tokens)) - np.repeat(first, counts)
    grams = [tokens]
    back = tokens
    for size in range(2, order + 1):
        before = np.empty_like(tokens)
        before[size - 1:] = tokens[:len(tokens) - size + 1]
        before[:size - 1] = START
        before[place < size - 1] = START
        back = tx.mix(back * tx.U64(0x9E3779B97F4A7C15) + before)
        grams.append(back)
    return grams


def _planes(values: np.ndarray) -> bytes:
    """Byte planes of an array: high bytes are mostly zero, which the shuffle's codec shrinks."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplaned(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _ranges(sorted_hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of `ranges` equal ranges of hashes begins."""
    bounds = [(k << 64) // ranges for k in range(1, ranges)]
    return np.concatenate([
        [0], np.searchsorted(sorted_hashes, np.array(bounds, np.uint64)), [len(sorted_hashes)]
    ])


_COUNTED = "size int, range int, chunk int, hashes binary, counts binary, n bigint"
_TOTALS = "chunk int, size int, range int, totals binary, known bigint, tokens bigint"
_SCORED = "doc bigint, held_out boolean, copies bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _counted(order: int, ranges: int):
    def count(key: tuple, table: pa.Table) -> pa.Table:
        tokens, counts = _tokens(table.column("text"))
        learned = np.where(table.column("held_out").to_numpy(), 0, table.column("copies").to_numpy())
        learned = np.repeat(learned, counts)
        rows: dict[str, list] = {k: [] for k in ("size", "range", "chunk", "hashes", "counts", "n")}
        for size, grams in enumerate(_grams(tokens, counts, order), 1):
            distinct, at = np.unique(grams, return_inverse=True)
            seen = np.bincount(at, learned, len(distinct)).astype(np.uint64)
            edges = _ranges(distinct, ranges)
            for r in np.flatnonzero(np.diff(edges)).tolist():
                part = slice(edges[r], edges[r + 1])
                steps = np.diff(distinct[part], prepend=tx.U64(0))
                for name, value in (
                    ("size", size), ("range", r), ("chunk", key[0].as_py()),
                    ("hashes", _planes(steps)), ("counts", _planes(seen[part])), ("n", len(steps)),
                ):
                    rows[name].append(value)
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(rows.items(), kinds, strict=True)})

    return count


def _added(key: tuple, table: pa.Table) -> pa.Table:
    hashes = [np.cumsum(_unplaned(x, np.uint64), dtype=np.uint64) for x in table.column("hashes").to_pylist()]
    counts = [_unplaned(x, np.uint64) for x in table.column("counts").to_pylist()]
    distinct, at = np.unique(np.concatenate(hashes), return_inverse=True)
    sums = np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.uint64)
    totals, done = [], 0
    for own in hashes:
        totals.append(_planes(sums[at[done:done + len(own)]]))
        done += len(own)
    once = np.zeros(len(hashes), np.int64)
    known, tokens = once.copy(), once.copy()
    known[0], tokens[0] = np.count_nonzero(sums), int(sums.sum())
    n = len(totals)
    return pa.table({
        "chunk": table.column("chunk"), "size": pa.array([key[0].as_py()] * n, pa.int32()),
        "range": pa.array([key[1].as_py()] * n, pa.int32()), "totals": pa.array(totals, pa.binary()),
        "known": pa.array(known), "tokens": pa.array(tokens),
    })


def _scored(order: int, strength: float, all_tokens: int, all_known: int):
    def score(key: tuple, table: pa.Table, found: pa.Table) -> pa.Table:
        tokens, counts = _tokens(table.column("text"))
        parts: dict[int, list[tuple[int, bytes]]] = {}
        for size, r, data in zip(*(found.column(c).to_pylist() for c in ("size", "range", "totals")), strict=True):
            parts.setdefault(size, []).append((r, data))
        edges = np.concatenate([[0], np.cumsum(counts)])
        place = np.arange(len(tokens)) - np.repeat(edges[:-1], counts)
        places, seen = [], []
        for size, grams in enumerate(_grams(tokens, counts, order), 1):
            distinct, at = np.unique(grams, return_inverse=True)
            places.append(at)
            seen.append(np.concatenate([_unplaned(data, np.uint64) for _, data in sorted(parts[size])]))
            if size == 1:
                # Every training text has one end, and one start.
                texts = int(seen[0][np.searchsorted(distinct, END)])
        model = automaton(places, seen, place, texts, strength, all_tokens, all_known)
        words = places[0].tolist()
        walked = [model.walk(words[a:b], model.start)[0] for a, b in pairwise(edges.tolist())]
        own = seen[0][places[0]]
        base = np.log10((own + 1) / (all_tokens + all_known + 1))
        return pa.table({
            "doc": table.column("doc"), "held_out": table.column("held_out"), "copies": table.column("copies"),
            "n_tokens": pa.array(counts.astype(np.int64)),
            "n_known": pa.array(np.add.reduceat((own > 0).astype(np.int64), edges[:-1])),
            "base_score": pa.array(np.add.reduceat(base, edges[:-1])), "score": pa.array(walked, pa.float64()),
        })

    return score


def _spread(df: DataFrame, groups: int, *keys: str) -> DataFrame:
    """Partitions by the number of groups, where the session's are too few for them."""
    own = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(-(-groups // PER_TASK), *keys) if groups > own * PER_TASK else df


def scores(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", learn: Column | None = None,
    order: int = ORDER, strength: float = STRENGTH,
) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (add-one unigrams) and score (the automaton's log10 probability). `learn` tells which rows
    are training text; by default all whose id does not fall into the held-out fold."""
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    key = F.col(f"`{doc_id}`")
    out = held_out(key) if learn is None else ~learn
    source = docs.select(
        key.cast("bigint").alias("doc"), plain.alias("text"), out.alias("held_out"),
        F.xxhash64(key, plain).alias("hash"),
    )
    repeated, many = materialize(
        source.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "repeated"
    )
    volume = source.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    chunks = volume // CHUNK_BYTES + 1
    ranges = max(1, volume // 6 // RANGE_GRAMS + 1)
    rows = source.withColumn("copies", F.lit(1).cast("bigint"))
    if many:
        repeated = F.broadcast(repeated) if many <= BROADCAST_REPEATED else repeated
        once = source.join(repeated, "hash", "left_semi").groupBy("doc", "text", "held_out", "hash").agg(
            F.count("*").alias("copies"))
        rows = rows.join(repeated, "hash", "left_anti").unionByName(once)
    rows = _spread(rows.select(
        "doc", "text", "held_out", "copies", F.pmod("hash", F.lit(chunks)).cast("int").alias("chunk")
    ), chunks, "chunk")
    counted = rows.groupBy("chunk").applyInArrow(_counted(order, ranges), _COUNTED)
    counted = _spread(counted, ranges * order, "size", "range")
    totals, _ = materialize(counted.groupBy("size", "range").applyInArrow(_added, _TOTALS), "totals")
    known, tokens = totals.filter("size = 1").agg(F.sum("known"), F.sum("tokens")).first()
    found = _spread(totals.select("chunk", "size", "range", "totals"), chunks, "chunk")
    scored = rows.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        _scored(order, strength, tokens or 0, known or 0), _SCORED
    )
    if many:
        scored = scored.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return scored.select(
        F.col("doc").alias("doc_id"), "held_out", "n_tokens", "n_known",
        F.lit(tokens or 0).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
