"""Groups of rows in tasks, split so that none is unbounded, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestream.session import materialize


def block_pairs(members: DataFrame, blocks: Column, spread_by: Column) -> DataFrame:
    """Each row once per pair of blocks of its group that it belongs to: columns `i` <= `j` name
    the pair, `own` the row's block. Two rows of different blocks are to be compared in their one
    common pair, two rows of one block in the pair of that block with itself."""
    own = F.pmod(spread_by, blocks).cast("int")
    placed = members.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    )
    return placed.withColumns({
        "i": F.least("own", "other"), "j": F.greatest("own", "other")
    }).drop("other")


def by_group(
    rows: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None],
    schema: str, partitions: int | None = None,
) -> DataFrame:
    """`work` on the rows of each group. Groups must be small; many share a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            edges = _changes(batch, keys)
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(start, end - start)
                if held and not _same(held[-1], part, keys):
                    yield from _done(held, work)
                    held = []
                held.append(part)
        if held:
            yield from _done(held, work)

    dealt = rows.repartition(partitions, *keys) if partitions else rows.repartition(*keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(run, schema)


def _done(held: list[pa.RecordBatch], work: Callable) -> Iterator[pa.RecordBatch]:
    made = work(pa.Table.from_batches(held))
    if made is not None and made.num_rows:
        yield made


def _changes(batch: pa.RecordBatch, keys: list[str]) -> list[int]:
    n = batch.num_rows
    change = np.zeros(n, bool)
    change[0] = True
    for key in keys:
        column = batch.column(key)
        if pa.types.is_integer(column.type):
            values = column.to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
        else:
            values = column.to_pylist()
            change[1:] |= np.fromiter((a != b for a, b in zip(values[1:], values, strict=False)), bool, n - 1)
    return [*np.flatnonzero(change).tolist(), n]


def _same(a: pa.RecordBatch, b: pa.RecordBatch, keys: list[str]) -> bool:
    return all(a.column(k)[a.num_rows - 1].as_py() == b.column(k)[0].as_py() for k in keys)


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of the edges between `n` nodes, so many as connect what they all connect."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def components(edges: DataFrame) -> DataFrame:
    """(node, label): label is equal for nodes that the edges (a, b) connect.

    Each round maps every node to its least neighbour and contracts the edges; with ids in random
    order a constant share of the nodes goes. Written tables cut the lineage after each round.
    """
    both = edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    left, n = materialize(both.distinct(), "edges")
    labels = None
    while n:
        step = left.select(F.col("a").alias("node"), F.col("b").alias("to")).union(
            left.select("b", "a")
        ).groupBy("node").agg(F.least("node", F.min("to")).alias("label"))
        step, _ = materialize(step, "step")
        if labels is None:
            labels = step
        else:
            moved = step.select(F.col("node").alias("label"), F.col("label").alias("new"))
            labels, _ = materialize(labels.join(moved, "label", "left").select(
                "node", F.coalesce("new", "label").alias("label")
            ), "labels")
        a = step.select(F.col("node").alias("a"), F.col("label").alias("x"))
        b = step.select(F.col("node").alias("b"), F.col("label").alias("y"))
        contracted = left.join(a, "a").join(b, "b").filter("x != y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")
        ).distinct()
        left, n = materialize(contracted, "edges")
    if labels is None:
        return both.select(F.col("a").alias("node"), F.col("a").alias("label"))
    return labels
