"""Near-duplicate documents: MinHash candidates, Bayesian pruning, exact Jaccard similarity.

A text is its set of five-word shingles; a text of one to four words is one shingle. Equal texts
are one class from the start and are compared once. Texts whose MinHash values agree on a whole
band share a bucket; with 50 bands of 5 values a pair at a similarity of 0.8 misses all buckets
with a probability of 2e-9. Inside a bucket, pairs compare their values 25 at a time and are
dropped as soon as the posterior probability of reaching the threshold is below `tolerance`. What
is left connects texts to groups. In a group every two texts are compared, pruned by the same rule
and then exactly. Large buckets and groups are cut into blocks, each pair of blocks a task's
work of its own, and only counts and spanning links leave a task.

Defined cases: NULL and empty texts and texts without words link to nothing, not even to each
other; repeated rows are copies of one text and keep a result each; an empty table gives an empty
result; columns other than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlestream.llm import text as tx
from candlestream.llm.groups import block_pairs, by_group, components, spanning
from candlestream.session import materialize

WIDTH = 5
THRESHOLD = 0.8
TOLERANCE = 1e-7

BANDS, BAND_ROWS = 50, 5
VALUES = BANDS * BAND_ROWS
STEP = 25

# Texts and shingles of a block; a pair of blocks is compared in memory.
BLOCK_TEXTS = 800
BLOCK_SHINGLES = 1_000_000

# Group members sent to all executors to fetch their texts; more are joined by shuffle.
BROADCAST_MEMBERS = 100_000

_SALTS = (tx.random_numbers(VALUES, 21) >> tx.U64(32)).astype(np.uint32)
_FACTORS = (tx.random_numbers(VALUES, 22) >> tx.U64(32)).astype(np.uint32) | np.uint32(1)


def shingles(texts: tx.Texts, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all rows, row after row, and how many each row has."""
    starts, stops, counts = tx.word_edges(texts)
    if not len(starts):
        return np.empty(0, np.uint64), counts
    hashes = tx.word_hashes(texts.data, starts, stops)
    ends = np.cumsum(counts)
    row = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(hashes))
    left = ends[row] - place
    runs = np.zeros(len(hashes), np.uint64)
    whole = tx.run_hashes(hashes, width)
    runs[:len(whole)] = whole
    for size in range(1, width):
        short = np.flatnonzero(counts == size)
        for r in short.tolist():
            own = hashes[ends[r] - size:ends[r]]
            runs[ends[r] - size] = tx.run_hashes(own, size)[0] + tx.U64(size)
    keep = (left >= width) | ((counts[row] < width) & (left == counts[row]))
    return runs[keep], np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))


def minhash(runs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """VALUES minima per row with shingles, in the order of these rows."""
    full = counts[counts > 0]
    starts = np.concatenate([[0], np.cumsum(full)[:-1]]).astype(np.int64)
    folded = (runs >> tx.U64(32)).astype(np.uint32)
    out = np.empty((len(full), VALUES), np.uint32)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat((folded ^ _SALTS[k]) * _FACTORS[k], starts)
    return out


_SKETCH = pa.schema([
    ("doc", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("sig", pa.binary()),
    ("bands", pa.list_(pa.int64())),
])


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, key, number of shingles, one byte of each value, and band keys."""
    places = tx.random_numbers(VALUES, 23).reshape(BANDS, BAND_ROWS)
    for batch in batches:
        for texts in tx.slices(batch.column("text")):
            runs, counts = shingles(texts)
            some = np.flatnonzero(counts)
            rows = pa.array(some + texts.first)
            if not len(some):
                continue
            minima = minhash(runs, counts)
            small = (tx.mix(minima.astype(np.uint64)) & tx.U64(255)).astype(np.uint8)
            wide = minima.astype(np.uint64).reshape(len(some), BANDS, BAND_ROWS)
            bands = tx.mix((tx.mix(wide + places) * places).sum(2, dtype=np.uint64))
            flat = pa.array(bands.view(np.int64).ravel())
            edges = pa.array(np.arange(len(some) + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc").take(rows), batch.column("key").take(rows),
                pa.array(counts[some]),
                pa.array([row.tobytes() for row in small], pa.binary()),
                pa.ListArray.from_arrays(edges, flat),
            ], schema=_SKETCH)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """After n compared values, how many must be equal for a pair to stay.

    The similarity has a uniform prior; one byte of unequal values is equal by chance once in 256.
    The posterior after m matches of n is proportional to c^m (1 - c)^(n - m), c the chance of a
    match.
    """
    s = (np.arange(20000) + 0.5) / 20000
    c = s + (1 - s) / 256
    needed = {}
    for n in range(STEP, VALUES + 1, STEP):
        needed[n] = 0
        for m in range(n + 1):
            weight = m * np.log(c) + (n - m) * np.log1p(-c)
            weight = np.exp(weight - weight.max())
            if weight[s >= threshold].sum() / weight.sum() < tolerance:
                needed[n] = m + 1
    return needed


def surviving(a: np.ndarray, b: np.ndarray, needed: dict[int, int], same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature matrices that no step drops; `same`: of one matrix."""
    equal = (a[:, None, :STEP] == b[None, :, :STEP]).sum(2)
    alive = equal >= needed[STEP]
    if same:
        alive &= np.tri(len(a), len(b), -1, dtype=bool).T
    left, right = np.nonzero(alive)
    equal = equal[left, right]
    for n in range(2 * STEP, VALUES + 1, STEP):
        part = slice(n - STEP, n)
        equal = equal + np.concatenate([
            (a[left[at:at + 65536], part] == b[right[at:at + 65536], part]).sum(1)
            for at in range(0, max(len(left), 1), 65536)
        ])
        stay = equal >= needed[n]
        left, right, equal = left[stay], right[stay], equal[stay]
    return left, right


def shared_counts(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share, by products of bit matrices, column block by block."""
    lengths = [len(x) for x in sets] + [len(x) for x in others]
    _, column = np.unique(np.concatenate([*sets, *others]), return_inverse=True)
    row = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(others)))
    width = 2048
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        at, end = np.searchsorted(column, [first, first + width])
        bits = np.zeros((len(lengths), width), np.float32)
        bits[row[at:end], column[at:end] - first] = 1
        total += bits[:len(sets)] @ bits[len(sets):].T
    return total


def _signatures(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, VALUES)


def _halves(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    own = table.column("own").to_numpy()
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    return np.flatnonzero(own == i), np.flatnonzero(own == j), i == j


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per row of `docs`: doc_id, text_key (MD5 of the text), class_id (the least id of
    the class), class_key (which text of the class stays) and n_links (other rows whose text is
    equal or reaches the threshold)."""
    needed = least_matches(threshold, tolerance)
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    source = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc"), F.unhex(F.md5(plain)).alias("key"),
        plain.alias("text"),
    )
    schema = "doc bigint, key binary, n bigint, sig binary, bands array<bigint>"
    sketches, _ = materialize(source.mapInArrow(_sketches, schema), "sketches")
    texts, _ = materialize(sketches.groupBy("key").agg(
        F.min("doc").alias("doc"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.first("sig").alias("sig"), F.first("bands").alias("bands"),
    ), "texts")

    groups, _ = materialize(_groups(texts, needed), "groups")
    linked, _ = materialize(_verified(source, texts, groups, threshold, needed), "links")
    counts = linked.filter("other IS NULL").groupBy("key").agg(F.sum("n").alias("n_linked"))
    labels = components(
        linked.filter("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b"))
    ).withColumnRenamed("node", "key")
    classes = texts.select("key", "doc", "copies").join(labels, "key", "left").join(
        counts, "key", "left"
    ).withColumn("label", F.coalesce("label", "key"))
    first = classes.groupBy("label").agg(F.min(F.struct("doc", "key")).alias("first"))
    classes = classes.join(first, "label").select(
        "key", F.col("first.doc").alias("class_id"), F.col("first.key").alias("class_key"),
        (F.col("copies") - 1 + F.coalesce("n_linked", F.lit(0))).alias("n_links"),
    )
    return source.select("doc", "key").join(classes, "key", "left").select(
        F.col("doc").alias("doc_id"), F.col("key").alias("text_key"),
        F.coalesce("class_id", "doc").alias("class_id"),
        F.coalesce("class_key", "key").alias("class_key"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def _groups(texts: DataFrame, needed: dict[int, int]) -> DataFrame:
    """(key, label) of texts that the pairs surviving in the buckets connect."""
    banded = texts.select("key", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(
        F.count("*").alias("m"), F.bit_xor(F.xxhash64("key")).alias("x"),
        F.sum(F.xxhash64("key").cast("decimal(20,0)")).alias("s"),
    ).filter("m > 1")
    # Buckets of the same texts are one.
    buckets = sizes.groupBy("m", "x", "s").agg(F.min("bucket").alias("bucket")).select("bucket", "m")
    members = banded.join(buckets, "bucket").join(texts.select("key", "sig"), "key")
    dealt = block_pairs(members, F.ceil(F.col("m") / BLOCK_TEXTS), F.xxhash64("key", "bucket"))

    def pairs(table: pa.Table) -> pa.RecordBatch | None:
        first, second, same = _halves(table)
        sig = _signatures(table)
        left, right = surviving(sig[first], sig[second], needed, same)
        edges = spanning(len(sig), first[left], second[right])
        if not edges:
            return None
        keys = table.column("key").combine_chunks()
        return pa.RecordBatch.from_arrays(
            [keys.take(pa.array([e[k] for e in edges])) for k in range(2)], names=["a", "b"]
        )

    return components(by_group(dealt, ["bucket", "i", "j"], pairs, "a binary, b binary")).select(
        F.col("node").alias("key"), "label"
    )


_SETS = pa.schema([("key", pa.binary()), ("runs", pa.binary())])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in tx.slices(batch.column("text")):
            runs, counts = shingles(texts)
            parts = np.split(runs, np.cumsum(counts)[:-1])
            yield pa.RecordBatch.from_arrays([
                batch.column("key").slice(texts.first, len(texts)),
                pa.array([np.unique(part).tobytes() for part in parts], pa.binary()),
            ], schema=_SETS)


def _verified(
    source: DataFrame, texts: DataFrame, groups: DataFrame, threshold: float, needed: dict[int, int]
) -> DataFrame:
    """(key, NULL, rows linked in one pair of blocks) and (key, other, NULL) for spanning links."""
    sizes = groups.join(texts.select("key", "n"), "key").groupBy("label").agg(
        F.count("*").alias("m"), F.sum("n").alias("total")
    )
    blocks = F.ceil(F.greatest(F.col("m") / BLOCK_TEXTS, F.col("total") / BLOCK_SHINGLES))
    blocks = F.least(blocks, F.col("m"))
    members, n = materialize(
        groups.join(sizes, "label").join(texts.select("key", "doc", "copies", "sig"), "key")
        .withColumn("blocks", blocks), "members",
    )
    wanted = members.select("key", F.col("doc").alias("one"))
    if n <= BROADCAST_MEMBERS:
        wanted = F.broadcast(wanted)
    found = source.join(wanted, "key").filter("doc <=> one").select("key", "text")
    sets, _ = materialize(
        found.mapInArrow(_sets, "key binary, runs binary").groupBy("key").agg(
            F.first("runs").alias("runs")
        ), "sets",
    )
    dealt = block_pairs(
        members.select("key", "label", "copies", "sig", "blocks").join(sets, "key"),
        F.col("blocks"), F.xxhash64("key"),
    )

    def links(table: pa.Table) -> pa.RecordBatch | None:
        first, second, same = _halves(table)
        sig = _signatures(table)
        left, right = surviving(sig[first], sig[second], needed, same)
        if not len(left):
            return None
        sets = [np.frombuffer(x, np.uint64) for x in table.column("runs").to_pylist()]
        size = np.array([len(x) for x in sets])
        copies = table.column("copies").to_numpy()
        shared = shared_counts([sets[x] for x in first], [sets[x] for x in second])[left, right]
        a, b = first[left], second[right]
        stay = shared >= threshold * (size[a] + size[b] - shared) - 1e-9
        a, b = a[stay], b[stay]
        if not len(a):
            return None
        linked = np.bincount(a, copies[b], len(sets)) + np.bincount(b, copies[a], len(sets))
        some = np.flatnonzero(linked)
        edges = spanning(len(sets), a, b)
        keys = table.column("key").combine_chunks()
        at = pa.array([*some.tolist(), *(e[0] for e in edges)])
        to = pa.array([*[None] * len(some), *(e[1] for e in edges)], pa.int64())
        n = pa.array([*linked[some].astype(int).tolist(), *[None] * len(edges)], pa.int64())
        return pa.RecordBatch.from_arrays([keys.take(at), keys.take(to), n], names=["key", "other", "n"])

    return by_group(
        dealt.drop("blocks"), ["label", "i", "j"], links, "key binary, other binary, n bigint"
    )
