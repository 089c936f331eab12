"""Whitened embeddings from exact cross-products of bit planes.

Components become integers. Each distinct vector counts once. Integers are shifted by the least of
their dimension, so that few bits hold them; bit b of a dimension, across rows, is a plane, packed
64 rows to a word. The cross-product of two dimensions is the sum over pairs of their planes of
2^(a+b) times the set bits of both planes' AND, which is exact. Tasks add these up in sums of 16
powers of two each, Spark adds the tasks' sums, and the driver gets one number per pair of
dimensions and sum: as many as the square of the dimensions, whatever the number of rows. There the
matrix is centred in integers, n times the cross-product minus the product of the sums, before it
becomes floating point for the eigenvectors.

Rows equal in all components are counted once before the shuffle, so a vector that a third of the
rows share costs nothing more.

Defined cases: a row with a NULL vector, or a NULL or non-finite component, takes no part; the
number of dimensions is the one that most of the other rows have (of equally many, the larger), and
rows of another number take no part; neither do empty vectors. Components are numbered by falling
eigenvalue, each with its largest entry positive. A component without variance, as far as double
precision can tell, has `explained` 0 and NULL for `whitened`; `identity_error` is over the others
and NULL where there is none. `deviation` is NULL where a bigint cannot hold it. Repeated rows and
NULL ids are returned each; an empty table gives an empty result; other columns are not read, so
their names cannot clash. A component beyond 2^61 after scaling is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlestream.session import materialize

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16

# Rows whose planes are held at once.
ROWS = 1 << 15
# Powers of two that share a sum: 2^16 times the pairs of planes leave room for 2^40 rows.
SUM_BITS = 16
# Eigenvalues below this share of the largest are rounding errors of the eigenvectors' computation.
NOTHING = 1e-12
_LIMIT = 2.0 ** 61


@dataclass(frozen=True)
class Fit:
    """The centre and the components of a whitening."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None


def _numbers(column: pa.Array, dims: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their components as doubles. Of all rows if `dims` is None."""
    sizes = np.diff(column.offsets.to_numpy())
    valid = np.asarray(column.is_valid()) & (sizes > 0 if dims is None else sizes == dims)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    finite = np.isfinite(values)
    if not finite.all():
        starts = column.offsets.to_numpy()
        bad = np.concatenate([[0], np.cumsum(~finite)])
        valid &= bad[starts[1:]] == bad[starts[:-1]]
    rows = np.flatnonzero(valid)
    if dims is None or not len(rows):
        return rows, sizes[rows]
    return rows, values[column.offsets.to_numpy()[rows][:, None] + np.arange(dims)]


def _scaled(values: np.ndarray, scale: int, offset: int) -> np.ndarray:
    scaled = np.floor(values * scale)
    if scaled.size and np.abs(scaled).max() >= _LIMIT:
        raise ValueError("a component is beyond 2^61 after scaling")
    return scaled.astype(np.int64) + offset


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, counts = np.unique(_numbers(batch.column("v"), None)[1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts, pa.int64())], names=["dims", "n"])


def _integers(dims: int, scale: int, offset: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = _numbers(batch.column("v"), dims)
            if len(rows):
                data = _scaled(values, scale, offset).astype("<i8").tobytes()
                width = 8 * dims
                cut = pa.array([data[k * width:(k + 1) * width] for k in range(len(rows))], pa.binary())
                yield pa.RecordBatch.from_arrays([cut], names=["x"])

    return run


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, dims)


def _ranges(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"), dims)
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dims)), pa.array(low), pa.array(high)], names=["d", "low", "high"]
            )

    return run


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Bit b of dimension d, across rows, as the words `[b, d]`; the last word ends in zeros."""
    padded = np.zeros((-(-len(y) // 64) * 64, y.shape[1]), np.int64)
    padded[:len(y)] = y
    out = np.empty((bits, y.shape[1], len(padded) // 64), np.uint64)
    for b in range(bits):
        out[b] = np.packbits(((padded >> b) & 1).astype(np.uint8), axis=0).T.copy().view(np.uint64)
    return out


def add_products(sums: np.ndarray, cut: np.ndarray) -> None:
    """Adds the weighted set bits of all pairs of planes, `[s, i, j]` for j >= i: what share s of
    the powers of two holds of the cross-product."""
    bits, dims, _ = cut.shape
    for a in range(bits):
        for i in range(dims):
            plane = cut[a, i]
            if not plane.any():
                continue
            for b in range(bits):
                common = np.bitwise_count(plane & cut[b, i:]).sum(1, dtype=np.int64)
                sums[(a + b) // SUM_BITS, i, i:] += common << ((a + b) % SUM_BITS)


def _scatter(dims: int, low: np.ndarray, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2 * bits // SUM_BITS + 1, dims, dims), np.int64)
        single = np.zeros((bits // SUM_BITS + 1, dims), np.int64)
        held: list[np.ndarray] = []
        n = 0

        def add() -> None:
            y = np.concatenate(held)
            for at in range(0, len(y), ROWS):
                cut = planes(y[at:at + ROWS], bits)
                add_products(sums, cut)
                for b in range(bits):
                    single[b // SUM_BITS] += np.bitwise_count(cut[b]).sum(1, dtype=np.int64) << (b % SUM_BITS)
            held.clear()

        for batch in batches:
            if batch.num_rows:
                held.append(_matrix(batch.column("x"), dims) - low)
                n += batch.num_rows
                if sum(map(len, held)) >= ROWS:
                    add()
        if held:
            add()
        if not n:
            return
        i, j = np.triu_indices(dims)
        rows = [(np.array([-1]), np.array([-1]), np.array([0]), np.array([n]))]
        rows += [(np.full(dims, -1), np.arange(dims), np.full(dims, s), single[s]) for s in range(len(single))]
        rows += [(i, j, np.full(len(i), s), sums[s][i, j]) for s in range(len(sums))]
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", "s", "v"])

    return run


def fit(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Fit | None:
    """Centre and components of the distinct vectors in column `v`; None if no row takes part."""
    sizes = vectors.mapInArrow(_sizes, "dims bigint, n bigint").groupBy("dims").agg(F.sum("n").alias("n"))
    commonest = sizes.orderBy(F.desc("n"), F.desc("dims")).first()
    if commonest is None:
        return None
    dims = commonest["dims"]
    distinct, n = materialize(
        vectors.mapInArrow(_integers(dims, scale, offset), "x binary").distinct(), "distinct-vectors"
    )
    spread = distinct.mapInArrow(_ranges(dims), "d bigint, low bigint, high bigint").groupBy("d").agg(
        F.min("low").alias("low"), F.max("high").alias("high")
    ).orderBy("d").collect()
    low = [r["low"] for r in spread]
    bits = max(1, max(r["high"] - r["low"] for r in spread).bit_length())
    added = distinct.mapInArrow(
        _scatter(dims, np.array(low, np.int64), bits), "i bigint, j bigint, s bigint, v bigint"
    ).groupBy("i", "j", "s").agg(F.sum("v").alias("v")).toArrow()

    shifted = [0] * dims
    cross = np.zeros((dims, dims), object)
    for i, j, s, v in zip(*(added.column(c).to_pylist() for c in "ijsv"), strict=True):
        if i >= 0:
            cross[i, j] += v << (SUM_BITS * s)
        elif j >= 0:
            shifted[j] += v << (SUM_BITS * s)
    sums = [y + n * least for y, least in zip(shifted, low, strict=True)]
    y = np.array(shifted, object)
    # n * n * covariance, exactly; dividing two integers gives the double nearest to the quotient.
    centred = n * np.triu(cross) - np.triu(np.outer(y, y))
    centred = centred + np.triu(centred, 1).T
    covariance = np.array([[int(c) / (n * n) for c in row] for row in centred])
    values, found = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, found = values[order], found[:, order]
    found = found * np.where(found[np.abs(found).argmax(0), np.arange(len(order))] < 0, -1.0, 1.0)
    trace = float(np.trace(covariance))
    live = values > NOTHING * max(trace, 0) if trace > 0 else np.zeros(len(values), bool)
    explained = np.where(live, values, 0.0) / (trace or 1.0)
    error = None
    if live.any():
        scaled = found[:, live] / np.sqrt(values[live])
        error = float(np.abs(scaled.T @ covariance @ scaled - np.eye(live.sum())).max())
    return Fit(n, sums, found, np.where(live, values, 0.0), explained, error)


_OUT = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
    ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of (n * x - sum)^2 per row, or None beyond a bigint."""
    # The products below are of numbers near the mean, so that int64 mostly holds them.
    base = [s // n for s in sums]
    y = x - np.array(base, np.int64)
    rest = [s - n * b for s, b in zip(sums, base, strict=True)]
    largest = max(int(np.abs(y).max()), 1)
    if largest ** 2 * x.shape[1] < 1 << 62 and largest * n * x.shape[1] < 1 << 62:
        squares, mixed = (y * y).sum(1), (y * np.array(rest, np.int64)).sum(1)
    else:
        wide = y.astype(object)
        squares, mixed = (wide * wide).sum(1), (wide * np.array(rest, object)).sum(1)
    constant = sum(r * r for r in rest)
    out = [n * n * int(a) - 2 * n * int(b) + constant for a, b in zip(squares, mixed, strict=True)]
    return [d if d < 1 << 63 else None for d in out]


def _whitened(model: Fit, scale: int, offset: int):
    dims, k = model.vectors.shape
    base = np.array([s // model.n for s in model.sums], np.int64)
    rest = np.array([(s - model.n * int(b)) / model.n for s, b in zip(model.sums, base, strict=True)])
    live = model.values > 0
    project = np.where(live, model.vectors / np.sqrt(np.where(live, model.values, 1.0)), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = _numbers(batch.column("v"), dims)
            if not len(rows):
                continue
            x = _scaled(values, scale, offset)
            made = ((x - base) - rest) @ project
            each = len(rows)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(np.repeat(rows, k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), each)),
                pa.array(np.full(each * k, model.n), pa.int64()),
                pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(np.repeat(np.arange(each), k))),
                pa.array(made.ravel(), mask=np.tile(~live, each)),
                pa.array(np.tile(model.explained, each)),
                pa.array([model.identity_error] * (each * k), pa.float64()),
            ], schema=_OUT)

    return run


def whiten(
    table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE, offset: int = OFFSET,
) -> DataFrame:
    """One row per row that takes part and component: vec_id, component, n, deviation, whitened,
    explained, identity_error."""
    source = table.select(
        F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v")
    )
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double,"
        " explained double, identity_error double"
    )
    model = fit(source.select("v"), components, scale, offset)
    if model is None:
        return table.sparkSession.createDataFrame([], schema)
    return source.mapInArrow(_whitened(model, scale, offset), schema)
