"""Hard negatives of anchors, found by bounds along a spanning tree of the anchors.

A row's score is its inner product with an anchor. The least spanning tree of a chunk of anchors
is walked from its root: |score at child - score at parent| is at most the length of their edge
times the row's norm, so an interval known at the parent, widened by that, holds the score at the
child. Only rows whose interval reaches what is sought are scored anew; for all others the
interval goes on to the next child. What is sought is first the `positives` best rows of the
anchor's label, and then, per positive, the best `negatives` rows of other labels in its window of
scores: a row is out when its interval misses the window, or when enough rows that are surely
in it are surely better. So no row that belongs to a result is passed over.

Rows are dealt at random into groups of `ROWS`, anchors into chunks of `ANCHORS`; each anchor
chunk meets each group once, in a task of its own, and leaves at most a few rows per anchor, which
are merged by anchor. The work is that of a query set against all rows, in blocks: it grows with
anchors times rows, but a task never holds more than one chunk and one group.

Components are integers, and so are scores. Bounds are in floating point, rounded outwards.

Defined cases: a row with a NULL id, label or vector, or a NULL or non-finite component, takes no
part; shorter vectors count as padded with zeros, empty ones are all zero; rows that repeat
an id are rows of their own, but none is a positive or negative of an anchor with its own id; an
anchor of which no other row has the label has no result, and a positive score below zero has no
window; an empty table gives an empty result; other columns are not read, so their names cannot
clash. A score that a bigint cannot hold is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlestream.session import materialize

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# Percent of the positive's score between which a negative's lies.
WINDOW = (30, 90)

# Rows and anchors that meet in a task.
ROWS, ANCHORS = 4096, 1024

_EXACT = 1 << 53


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that take part, their components as packed integers."""
    for batch in batches:
        column = batch.column("v")
        offsets = column.offsets.to_numpy()
        values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        rows = np.flatnonzero(np.asarray(column.is_valid()) & (bad[offsets[1:]] == bad[offsets[:-1]]))
        scaled = np.floor(SCALE * np.where(np.isfinite(values), values, 0.0))
        if scaled.size and np.abs(scaled).max() >= 2.0 ** 63:
            raise OverflowError("a scaled component is beyond a bigint")
        data = scaled.astype("<i8")
        packed = [data[offsets[k]:offsets[k + 1]].tobytes() for k in rows.tolist()]
        at = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(at), batch.column("label").take(at), pa.array(packed, pa.binary())],
            names=["id", "label", "x"],
        )


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows, padded with zeros."""
    values = column.to_pylist()
    if all(len(v) == 8 * dims for v in values):
        return np.frombuffer(b"".join(values), "<i8").reshape(len(values), dims)
    out = np.zeros((len(values), dims), np.int64)
    for k, v in enumerate(values):
        out[k, :len(v) // 8] = np.frombuffer(v, "<i8")
    return out


class Block:
    """Rows of one group, to be scored against anchors."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, largest_anchor: int) -> None:
        self.ids, self.labels = ids, labels
        largest = int(np.abs(x).max()) if x.size else 0
        product = max(largest, 1) * max(largest_anchor, 1) * max(x.shape[1], 1)
        # Sums of products below 2^53 are exact as doubles; beyond 2^63 only Python's integers are.
        self.kind = np.float64 if product < _EXACT else np.int64 if product < 1 << 62 else object
        self.x = x.astype(self.kind)
        self.norms = np.sqrt((x.astype(np.float64) ** 2).sum(1)) * (1 + 1e-12)

    def scores(self, rows: np.ndarray | slice, anchor: np.ndarray) -> np.ndarray:
        found = self.x[rows] @ anchor.astype(self.kind)
        if self.kind is object and any(not -(1 << 63) <= s < 1 << 63 for s in found):
            raise OverflowError("a score is beyond a bigint")
        return found.astype(np.int64)


def spanning_tree(vectors: np.ndarray) -> list[tuple[int, int, float]]:
    """(child, parent, edge length) of a least spanning tree, each parent before its children, depth
    first; the root, row 0, is its own parent. Lengths are rounded upwards."""
    n = len(vectors)
    points = vectors.astype(np.float64)
    gap = np.full(n, np.inf)
    near = np.zeros(n, np.int64)
    gap[0] = 0.0
    out = np.zeros(n, bool)
    children: dict[int, list[tuple[int, float]]] = {}
    for _ in range(n):
        at = int(np.argmin(np.where(out, np.inf, gap)))
        out[at] = True
        if at:
            children.setdefault(int(near[at]), []).append((at, float(gap[at])))
        squares = ((points - points[at]) ** 2).sum(1)
        length = np.sqrt(squares) * (1 + 1e-12)
        closer = ~out & (length < gap)
        gap[closer], near[closer] = length[closer], at
    order, stack = [], [(0, 0, 0.0)]
    while stack:
        at, parent, length = stack.pop()
        order.append((at, parent, length))
        stack += [(child, at, edge) for child, edge in children.get(at, [])]
    return order


Sought = Callable[[int, np.ndarray, np.ndarray], np.ndarray]


def walk(block: Block, anchors: np.ndarray, sought: Sought) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Anchor, rows and their scores: the rows that `sought`, given the anchor and lower and upper
    bounds of all rows, names as possibly in its result."""
    tree = spanning_tree(anchors)
    waiting = np.zeros(len(anchors), np.int64)
    for at, parent, _ in tree:
        waiting[parent] += at != parent
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for at, parent, length in tree:
        if at == parent:
            low, high = _around(block.scores(slice(None), anchors[at]))
        else:
            low, high = bounds[parent]
            waiting[parent] -= 1
            if not waiting[parent]:
                del bounds[parent]
            slack = length * block.norms
            # Doubles of integers beyond 2^53 and of these sums are off by less than the added share.
            low = low - slack - (np.abs(low) + slack) * 1e-12
            high = high + slack + (np.abs(high) + slack) * 1e-12
        rows = sought(at, low, high)
        scores = block.scores(rows, anchors[at])
        if len(rows):
            low[rows], high[rows] = _around(scores)
        if waiting[at]:
            bounds[at] = (low, high)
        yield at, rows, scores


def _around(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Doubles below and above integer scores, equal to them where doubles are exact."""
    value = scores.astype(np.float64)
    off = np.where(np.abs(value) < _EXACT, 0.0, np.abs(value) * 1e-12)
    return value - off, value + off


def _largest(values: np.ndarray, k: int) -> float:
    """The k-th largest value, or minus infinity where there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the first `k` by falling score, then by id."""
    return np.lexsort((ids, -scores))[:k]


def _positives(block: Block, ids: np.ndarray, labels: np.ndarray, k: int) -> Sought:
    def sought(at: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        own = np.flatnonzero((block.labels == labels[at]) & (block.ids != ids[at]))
        return own[high[own] >= _largest(low[own], k)]

    return sought


def _negatives(block: Block, ids: np.ndarray, labels: np.ndarray, positives: list[list[int]], window: tuple[int, int], k: int) -> Sought:
    def sought(at: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        other = np.flatnonzero((block.labels != labels[at]) & (block.ids != ids[at]))
        low, high = low[other], high[other]
        wanted = np.zeros(len(other), bool)
        for score in positives[at]:
            least, most = window[0] * score / 100, window[1] * score / 100
            if least > most:
                continue
            slack = abs(most) * 1e-12
            reach = (high >= least - slack) & (low <= most + slack)
            sure = low[(low >= least + slack) & (high <= most - slack)]
            wanted |= reach & (high >= _largest(sure, k))
        return other[wanted]

    return sought


def _met(dims: int, positives: int, negatives: int | None, window: tuple[int, int]):
    """What a group of rows holds for a chunk of anchors: positives, or negatives of their windows."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({f.name: pa.array([], f.type) for f in _FOUND}, schema=_FOUND)
        if not left.num_rows or not right.num_rows:
            return empty
        anchors = _matrix(right.column("x"), dims)
        own = right.column("anchor").to_numpy()
        ids, labels = right.column("id").to_numpy(), right.column("label").to_numpy()
        block = Block(
            left.column("id").to_numpy(), left.column("label").to_numpy(), _matrix(left.column("x"), dims),
            int(np.abs(anchors).max()) if anchors.size else 0,
        )
        out: list[tuple[np.ndarray, ...]] = []

        def add(at: int, rank: int, rows: np.ndarray, scores: np.ndarray, k: int) -> None:
            best = _first(block.ids[rows], scores, k)
            n = len(best)
            out.append((np.full(n, own[at]), np.full(n, rank), block.ids[rows[best]], scores[best]))

        if negatives is None:
            for at, rows, scores in walk(block, anchors, _positives(block, ids, labels, positives)):
                add(at, 0, rows, scores, positives)
        else:
            known = [[p["score"] for p in ps] for ps in right.column("positives").to_pylist()]
            sought = _negatives(block, ids, labels, known, window, negatives)
            for at, rows, scores in walk(block, anchors, sought):
                small = not len(scores) or int(np.abs(scores).max()) < 1 << 56
                scaled = 100 * (scores if small else scores.astype(object))
                for rank, score in enumerate(known[at]):
                    inside = np.flatnonzero((scaled >= window[0] * score) & (scaled <= window[1] * score))
                    add(at, rank, rows[inside], scores[inside], negatives)
        if not out:
            return empty
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)]
        return pa.table([pa.array(c) for c in columns], schema=_FOUND)

    return run


_FOUND = pa.schema([("anchor", pa.int64()), ("rank", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
_FOUND_SQL = "anchor bigint, rank bigint, id bigint, score bigint"


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW, row_group: int = ROWS, anchor_chunk: int = ANCHORS,
) -> DataFrame:
    """One row per anchor, positive and negative: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score. `rows` has columns `id`, `label` and `x`, integers packed as
    little-endian 64-bit numbers, without NULLs; `is_anchor` says which of them are anchors."""
    placed, n = materialize(rows.select("id", "label", "x"), "rows")
    chosen, m = materialize(
        placed.filter(is_anchor).withColumn("anchor", F.monotonically_increasing_id()), "anchors"
    )
    dims = (placed.agg(F.max(F.octet_length("x"))).first()[0] or 0) // 8
    groups, chunks = max(1, -(-n // row_group)), max(1, -(-m // anchor_chunk))
    place = F.xxhash64(F.monotonically_increasing_id())
    placed = placed.withColumn("group", F.pmod(place, F.lit(groups)).cast("int")).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )

    def meet(side: DataFrame, of: int | None) -> DataFrame:
        side = side.withColumn("chunk", F.pmod(F.xxhash64("anchor"), F.lit(chunks)).cast("int")).withColumn(
            "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        )
        return placed.groupBy("group", "chunk").cogroup(side.groupBy("group", "chunk")).applyInArrow(
            _met(dims, positives, of, window), _FOUND_SQL
        )

    def first(found: DataFrame, k: int) -> DataFrame:
        by = Window.partitionBy("anchor", "rank").orderBy(F.desc("score"), "id")
        return found.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= k)

    best = first(meet(chosen, None), positives).groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("positives")
    )
    known, _ = materialize(chosen.join(best, "anchor"), "positives")
    found, _ = materialize(first(meet(known, negatives), negatives), "negatives")
    named = known.select(
        "anchor", F.col("id").alias("anchor_id"), F.posexplode("positives").alias("rank", "positive")
    )
    return found.join(named, ["anchor", "rank"]).select(
        "anchor_id", F.col("positive.id").alias("positive_id"), F.col("place").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def prepared(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """id, label and packed integer components of the rows that take part."""
    source = table.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("v"),
    ).filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    return source.mapInArrow(_cleaned, "id bigint, label bigint, x binary")
