"""Texts of an Arrow column as one byte buffer, and their words and hashes as numpy arrays.

Used inside tasks by the operators that run in Python. Words are runs of bytes other than space
and 0x09-0x0D, so a word of a buffer never reaches into the next text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 21

U64 = np.uint64

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def random_numbers(n: int, seed: int) -> np.ndarray:
    """The same odd 64-bit numbers in every process."""
    step = np.arange(1, n + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)
    offset = U64(seed * 0xD1342543DE82EF95 % (1 << 64))
    return mix(step + offset) | U64(1)


@dataclass
class Texts:
    """Some rows of a batch: `data[starts[i]:ends[i]]` is the text of row `first + i`."""

    first: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def slices(column: pa.Array, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The column, NULL as empty text, cut by rows into buffers of about `limit` bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = filled.buffers()
    edges = np.frombuffer(offsets, np.int64)[filled.offset:filled.offset + len(filled) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < len(filled):
        end = max(at + 1, int(np.searchsorted(edges, edges[at] + limit, side="right")) - 1)
        part = whole[edges[at]:edges[end]]
        own = edges[at:end + 1] - edges[at]
        yield Texts(at, _LOWER[part] if lower else part, own[:-1], own[1:])
        at = end


def word_edges(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and how many words each row has."""
    n = len(texts.data)
    if n == 0:
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(texts), np.int64)
    inside = ~_BLANK[texts.data]
    edge = np.zeros(n + 1, bool)
    edge[texts.starts] = True
    edge[n] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:n]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:n]
    starts, stops = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    counts = np.searchsorted(starts, texts.ends) - np.searchsorted(starts, texts.starts)
    return starts, stops, counts


_BYTES = random_numbers(256, 7)
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_POWERS = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    known = _POWERS[name]
    if len(known) < n:
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if n <= 2 * SLICE_BYTES:
            _POWERS[name] = known
    return known[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, from differences of one running polynomial."""
    n = len(data)
    running = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[data] * _powers("base", _BASE, max(n, 1))[:n], out=running[1:])
    value = (running[stops] - running[starts]) * _powers("inverse", _INVERSE, n + 1)[starts]
    return mix(value + (stops - starts).astype(np.uint64))


_PLACES = random_numbers(64, 11)


def run_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` words; the last `width - 1` words start none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k:k + n] * _PLACES[k]
    return mix(total)
