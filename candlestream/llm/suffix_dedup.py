"""Byte strings of a given length that occur more than once, removed from documents.

Which strings repeat is read off a Burrows-Wheeler transform. Intervals of rows that share a prefix
are extended backwards, one symbol for all of them at a time; an interval whose end is not known
yet fixes the common prefix there to the present length and is extended further. So common
prefixes come by increasing value, and the search stops at the minimum length: rows that no
boundary parts by then share that many bytes. Classes of such rows that stand for more than one
place are repeated strings.

The corpus is cut so that no two equal strings are parted. Of all 64-byte grams in a string of
`length` bytes, the leftmost with the least hash is its anchor; equal strings have equal anchors.
Each string belongs to the stretch around its anchor that holds all neighbouring strings of the
same anchor, so each place of the corpus is in one stretch. Anchors that occur once are dropped;
the stretches of the others are dealt by anchor into units, and equal stretches, such as those of
copies, stand in a unit once, with a weight. A unit of some MB gets its own transform.

An anchor whose different stretches exceed a unit is divided: strings by how far they reach before
it, in two halves. All strings of a half share more bytes than the anchor's own, and these become
its key; so stretches that only share the anchor go apart, and equal pieces of stretches become
one. Halves still too large are divided again. At the end a part is a single reach, whose key is
the whole string, so that every part fits a unit.

Strings are judged on the input. Defined cases: NULL texts are empty; texts shorter than `length`
keep everything; repeated rows are places of their own, so repeated texts of that length go
entirely; an empty table gives an empty result; what is left of a text may part a character, whose
remaining bytes count in the digest but not in `text`; other columns are not read, so their names
cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlestream.llm import text as tx
from candlestream.llm.groups import by_group
from candlestream.session import materialize

LENGTH = 400
# Long enough that few grams repeat by chance; those that do only cost time. A power of two.
GRAM = 64

# Bytes of different stretches that share a transform, so few that its arrays stay in the caches,
# and that one anchor may bring.
UNIT_BYTES = 500_000
ANCHOR_BYTES = 3_000_000

# Bytes of spans to remove that are sent to all executors; more are joined by shuffle, where the
# rows of a text are dealt to so many tasks.
BROADCAST_BYTES = 32 << 20
DEALT = 16

# Bytes of texts, and window starts in a long text, handled at once; few, for the same reason.
PART = 1 << 17
_PLACE = tx.U64((1 << 24) - 1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place on, from those of half as many."""
    found = data.astype(np.uint64)
    for shift in (1, 2, 4):
        found = found[:-shift] | (found[shift:] << tx.U64(8 * shift))
    steps = [8 << k for k in range((GRAM // 8).bit_length() - 1)]
    for step, factor in zip(steps, tx.random_numbers(len(steps), 41), strict=True):
        mixed = found[:-step] >> tx.U64(29)
        mixed ^= found[:-step]
        mixed *= factor
        mixed += found[step:]
        found = mixed
    return tx.mix(found)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` values in a row, from minima forwards and backwards in blocks."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1:width - 1 + n])


def anchors(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Row, hash of the anchor, first and last start (in the row) of the strings of `length` bytes
    that have it, and the anchor's distance from the first, for the rows `data[starts[i]:ends[i]]`."""
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, none.astype(np.uint64), none, none, none
    hashes = _gram_hashes(data)
    keyed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    owner = (_sliding_least(keyed, length - GRAM + 1) & _PLACE).astype(np.int64)
    valid = np.zeros(len(owner) + 1, np.int64)
    long = ends - starts >= length
    valid[starts[long]] += 1
    np.subtract.at(valid, ends[long] - length + 1, 1)
    places = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    owner = owner[places]
    row = np.searchsorted(starts, places, side="right") - 1
    new = np.ones(len(places), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(places))[:len(first)] - 1
    row = row[first]
    reach = owner[first] - places[first]
    return row, hashes[owner[first]], places[first] - starts[row], places[last] - starts[row], reach


_SPAN = pa.struct([("lo", pa.int64()), ("hi", pa.int64()), ("reach", pa.int32())])
_SPANS_SQL = "array<struct<lo: bigint, hi: bigint, reach: int>>"
_ANCHORS = pa.schema([("h", pa.int64()), ("key", pa.binary()), ("spans", pa.list_(_SPAN))])


def _anchored(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in tx.slices(batch.column("text"), limit=PART):
                for row, h, lo, hi, reach in _parts(texts, length):
                    if not len(row):
                        continue
                    # One row per text and anchor: an anchor may recur in each line of a text.
                    order = np.lexsort((lo, h, row))
                    row, h, lo, hi, reach = (x[order] for x in (row, h, lo, hi, reach))
                    new = np.ones(len(row), bool)
                    new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
                    first = np.flatnonzero(new)
                    spans = pa.StructArray.from_arrays(
                        [pa.array(lo), pa.array(hi), pa.array(reach.astype(np.int32))], fields=list(_SPAN)
                    )
                    edges = pa.array(np.append(first, len(row)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(h[first].view(np.int64)),
                        batch.column("key").take(pa.array(row[first] + texts.first)),
                        pa.ListArray.from_arrays(edges, spans),
                    ], schema=_ANCHORS)

    return run


def _parts(texts: tx.Texts, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of the rows; a text beyond `PART` in parts that overlap by `length - 1` bytes."""
    if len(texts.data) <= PART + length:
        yield anchors(texts.data, texts.starts, texts.ends, length)
        return
    for k, (start, end) in enumerate(zip(texts.starts.tolist(), texts.ends.tolist(), strict=True)):
        for at in range(start, max(start + 1, end - length + 1), PART):
            part = texts.data[at:min(end, at + PART + length - 1)]
            row, h, lo, hi, reach = anchors(part, np.zeros(1, np.int64), np.array([len(part)]), length)
            yield row + k, h, lo + at - start, hi + at - start, reach


_STRETCHES = pa.schema([
    ("h", pa.int64()), ("key", pa.binary()), ("los", pa.list_(pa.int64())), ("reach", pa.int32()),
    ("copies", pa.int64()), ("bytes", pa.binary()),
])


def _stretched(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for key, text, copies, anchors in zip(
                *(batch.column(c) for c in ("key", "text", "copies", "anchors")), strict=True
            ):
                key, copies = key.as_py(), copies.as_py()
                data = text.as_buffer()
                # Equal stretches of a text, such as those of a line that recurs in it, are one row.
                same: dict[tuple[int, bytes], list[int]] = {}
                for h, span in ((a["h"], span) for a in anchors.as_py() for span in a["spans"]):
                    own = data.slice(span["lo"], span["hi"] + length - span["lo"]).to_pybytes()
                    los = same.get((h, own))
                    if los is None:
                        los = same[h, own] = []
                        rows.append((h, key, los, span["reach"], copies, own))
                        held += len(own)
                    los.append(span["lo"])
                    if held > tx.SLICE_BYTES:
                        yield _stretch_rows(rows)
                        rows, held, same = [], 0, {}
            if rows:
                yield _stretch_rows(rows)

    return run


def _stretch_rows(rows: list[tuple]) -> pa.RecordBatch:
    rows = [(h, key, los, reach, copies * len(los), own) for h, key, los, reach, copies, own in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _STRETCHES, strict=True)],
        schema=_STRETCHES,
    )


_HALVES = pa.schema([
    ("h", pa.int64()), ("cid", pa.binary()), ("sub", pa.int64()), ("off", pa.int64()), ("reach", pa.int32()),
    ("least", pa.int32()), ("most", pa.int32()), ("n", pa.int64()), ("bytes", pa.binary()),
])


def halves(own: bytes, reach: int, least: int, most: int, length: int) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    """Key, offset in the stretch, reach, least and most reach, and bytes of a stretch's strings whose
    reach, the distance from their start to the anchor, is in the one and the other half of
    `least` to `most`. The key stands for the bytes that all strings of that half share."""
    middle = (least + most) // 2
    last = reach - (len(own) - length)
    for a, b in ((least, middle), (middle + 1, most)):
        far, near = min(b, reach), max(a, last)
        if near <= far:
            shared = own[reach - a:reach - b + length]
            key = hashlib.blake2b(shared, digest_size=8, salt=f"{a}-{b}".encode()).digest()
            part = own[reach - far:reach - near + length]
            yield int.from_bytes(key, "little", signed=True), reach - far, far, a, b, part


def _halved(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = []
                columns = (batch.column(c).slice(at, 1024).to_pylist() for c in ("h", "cid", "reach", "least", "most", "n", "bytes"))
                for h, cid, reach, least, most, n, own in zip(*columns, strict=True):
                    for sub, off, far, a, b, part in halves(own, reach, least, most, length):
                        rows.append((h, cid, sub, off, far, a, b, n, part))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _HALVES, strict=True)], schema=_HALVES
                )

    return run


# What a key of seven symbols keeps if an end mark follows the first k.
_BEFORE_MARK = np.array([(1 << 63) - (1 << 9 * (7 - k)) for k in range(8)], np.uint64)


def bounded_order(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in the order of their first `length` symbols or more; rows whose first seven
    symbols differ from the row before; and whether a suffix has an end mark (0) as its seventh.
    End marks differ from each other, the earlier one first."""
    n = len(symbols)
    until = _until_mark(symbols)
    padded = np.zeros(n + 6, np.uint64)
    padded[:n] = symbols
    key = padded[:n].copy()
    for k in range(1, 7):
        key <<= tx.U64(9)
        key |= padded[k:k + n]
    # Symbols after an end mark have no part in a suffix.
    key &= _BEFORE_MARK[np.minimum(until, 7)]
    seventh = until == 6
    order = np.argsort(key)
    ordered = key[order]
    # Suffixes that end within the key are told apart by their end marks.
    ended = np.flatnonzero(until[order] <= 6)
    order[ended] = order[ended][np.lexsort((order[ended], ordered[ended]))]
    heads = np.ones(n, bool)
    heads[1:] = ordered[1:] != ordered[:-1]
    heads[ended] = True
    seeds = heads.copy()
    del key, ordered, padded
    rank = np.empty(n, np.int64)
    done = 7
    while True:
        starts = np.flatnonzero(heads)
        sizes = np.diff(np.append(starts, n))
        rank[order] = np.repeat(starts, sizes)
        if done >= length:
            break
        open_rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
        if not len(open_rows):
            break
        own = order[open_rows]
        pair = (rank[own].astype(np.uint64) << tx.U64(32)) | rank[own + done].astype(np.uint64)
        by = np.argsort(pair)
        order[open_rows] = own[by]
        pair = pair[by]
        heads[open_rows[1:]] |= pair[1:] != pair[:-1]
        done *= 2
    return order, seeds, seventh


def _even_parts(sizes: np.ndarray, rows: int = 1 << 20) -> Iterator[slice]:
    """Slices of intervals with about `rows` rows each."""
    total = np.cumsum(sizes)
    cuts = np.searchsorted(total, np.arange(rows, total[-1], rows))
    edges = np.unique(np.concatenate([[0], cuts, [len(sizes)]]))
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        yield slice(start, end)


def _until_mark(symbols: np.ndarray) -> np.ndarray:
    """How many symbols stand from each place to the next end mark."""
    marks = np.flatnonzero(symbols == 0)
    return np.repeat(marks, np.diff(marks, prepend=-1)) - np.arange(len(symbols))


def shared_rows(symbols: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and whether each shares less than `length` symbols with the one before.

    `symbols` are byte values plus one, with an end mark (0) after each stretch.
    """
    n = len(symbols)
    order, known, seventh = bounded_order(symbols, length)
    transform = symbols[order - 1]
    by_symbol = np.argsort(transform, kind="stable")
    to = np.empty(n, np.int32)
    to[by_symbol] = np.arange(n, dtype=np.int32)
    same = transform[by_symbol]
    following = np.full(n, n, np.int32)
    again = np.flatnonzero(same[1:] == same[:-1])
    following[by_symbol[again]] = by_symbol[again + 1]
    located = same.astype(np.int64) * n + by_symbol
    del same, by_symbol, again

    starts = np.flatnonzero(known)
    known = np.append(known, True)
    # Intervals of strings of seven symbols; strings that end sooner have no part in longer ones.
    head = order[starts]
    whole = (_until_mark(symbols)[head] >= 7) | seventh[head]
    low, high = starts[whole], np.append(starts[1:], n)[whole]
    for _ in range(7, length):
        if not len(low):
            break
        lows, highs = [], []
        for part in _even_parts(high - low):
            a, b = low[part], high[part]
            sizes = b - a
            owner = np.repeat(np.arange(len(a)), sizes)
            row = np.arange(len(owner)) + np.repeat(a - (np.cumsum(sizes) - sizes), sizes)
            # The last row of each symbol in an interval leads to the end of the longer string's.
            last = (following[row] >= b[owner]) & (transform[row] != 0)
            row, owner = row[last], owner[last]
            end = to[row].astype(np.int64) + 1
            new = ~known[end]
            row, owner, end = row[new], owner[new], end[new]
            known[end] = True
            lows.append(np.searchsorted(located, transform[row].astype(np.int64) * n + a[owner]))
            highs.append(end)
        low, high = np.concatenate(lows), np.concatenate(highs)
    return order, known[:-1]


def repeated_starts(stretches: list[bytes], weights: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(stretch, first, last): runs of places where strings of `length` bytes start that stand
    for more than one place, each stretch standing for as many as its weight."""
    data = np.frombuffer(b"".join(stretches), np.uint8)
    sizes = np.array([len(x) for x in stretches])
    ends = np.cumsum(sizes + 1)
    symbols = np.zeros(ends[-1], np.uint16)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[inside] = data.astype(np.uint16) + 1
    order, parted = shared_rows(symbols, length)
    group = np.cumsum(parted) - 1
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    stands_for = np.bincount(group, weights[owner[order]])
    repeated = np.zeros(len(symbols) + 1, np.int8)
    repeated[order[stands_for[group] > 1]] = 1
    repeated[:-1][_until_mark(symbols) < length] = 0
    step = np.diff(repeated, prepend=0)
    first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1) - 1
    own = owner[first]
    base = ends[own] - sizes[own] - 1
    return list(zip(own.tolist(), (first - base).tolist(), (last - base).tolist(), strict=True))


def _transformed(length: int):
    def run(table: pa.Table) -> pa.RecordBatch | None:
        rows = repeated_starts(table.column("bytes").to_pylist(), table.column("n").to_numpy(), length)
        if not rows:
            return None
        own, first, last = zip(*rows, strict=True)
        at = pa.array(own)
        return pa.RecordBatch.from_arrays([
            table.column("h").combine_chunks().take(at), table.column("cid").combine_chunks().take(at),
            pa.array(first, pa.int64()), pa.array(last, pa.int64()),
        ], names=["h", "cid", "first", "last"])

    return run


def _merged(length: int):
    def run(table: pa.Table) -> pa.RecordBatch:
        """Byte ranges of a text, those that touch or overlap as one."""
        los = table.column("los").combine_chunks()
        each = np.repeat(np.arange(len(los)), np.diff(los.offsets.to_numpy()))
        begin = los.flatten().to_numpy()
        lo = begin + table.column("first").to_numpy()[each]
        hi = begin + table.column("last").to_numpy()[each] + length
        order = np.argsort(lo, kind="stable")
        lo, hi = lo[order], np.maximum.accumulate(hi[order])
        new = np.ones(len(lo), bool)
        new[1:] = lo[1:] > hi[:-1]
        first = np.flatnonzero(new)
        ends = hi[np.append(first[1:], len(hi)) - 1]
        spans = [{"lo": a, "hi": b} for a, b in zip(lo[first].tolist(), ends.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array([table.column("key")[0].as_py()], pa.binary()), pa.array([spans], pa.list_(_RANGE))],
            names=["key", "spans"],
        )

    return run


_RANGE = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, held = [], 0
        for doc, text, spans in zip(*(batch.column(c) for c in ("doc", "text", "spans")), strict=True):
            data = text.as_buffer()
            left, removed, done = [], 0, 0
            found = spans.as_py() or []
            for span in found:
                left.append(data.slice(done, span["lo"] - done).to_pybytes())
                removed += span["hi"] - span["lo"]
                done = span["hi"]
            rest = b"".join([*left, data.slice(done).to_pybytes()])
            rows.append((
                doc.as_py(), data.size, removed, len(found), hashlib.sha256(rest).hexdigest(), rest.decode(errors="ignore")
            ))
            held += len(rest)
            if held > tx.SLICE_BYTES:
                yield _kept_rows(rows)
                rows, held = [], 0
        if rows:
            yield _kept_rows(rows)


def _kept_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.string()] * 2
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"],
    )


def _runs(distinct: DataFrame, length: int) -> DataFrame:
    """(h, cid, first, last): runs of starts of repeated strings in different stretches, which have
    columns h, cid, reach, least, most, bytes, n."""
    sizes, _ = materialize(
        distinct.groupBy("h").agg(F.sum(F.octet_length("bytes")).alias("size"), F.sum("n").alias("places"),
                                  F.max(F.col("most") - F.col("least")).alias("room")), "sizes",
    )
    total = sizes.agg(F.sum("size")).first()[0] or 0
    large, many = materialize(
        sizes.filter((F.col("size") > ANCHOR_BYTES) & (F.col("room") > 0)).select("h"), "large"
    )
    units = max(1, total // UNIT_BYTES)
    small = distinct.join(large, "h", "left_anti") if many else distinct
    runs = by_group(
        small.select("h", "cid", "bytes", "n", F.pmod(F.xxhash64("h"), F.lit(units)).cast("int").alias("unit")),
        ["unit"], _transformed(length), "h bigint, cid binary, first bigint, last bigint",
    )
    if not many:
        return runs
    parts, _ = materialize(distinct.join(large, "h").mapInArrow(
        _halved(length), "h bigint, cid binary, sub bigint, off bigint, reach int, least int, most int, n bigint, bytes binary"
    ).withColumn("part", F.unhex(F.md5("bytes"))), "halves")
    # Only keys that stand for several places go on.
    often = parts.groupBy("sub").agg(F.sum("n").alias("places")).filter("places > 1")
    smaller = parts.join(often, "sub", "left_semi").groupBy(
        F.col("sub").alias("h"), F.col("part").alias("cid"), "bytes", "reach", "least", "most"
    ).agg(F.sum("n").alias("n"))
    smaller, _ = materialize(smaller, "parts")
    found = _runs(smaller, length).withColumnsRenamed({"h": "sub", "cid": "part"})
    return runs.union(parts.select("h", "cid", "sub", "part", "off").join(found, ["sub", "part"]).select(
        "h", "cid", (F.col("off") + F.col("first")).alias("first"), (F.col("off") + F.col("last")).alias("last")
    ))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """(key, spans) for texts with bytes in strings that occur more than once: MD5 of the text and
    byte ranges `lo` to `hi`, sorted and apart."""
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc"), F.unhex(F.md5(plain)).alias("key"), plain.alias("text")
    )
    found, _ = materialize(
        source.select("key", "text").filter(F.octet_length("text") >= length)
        .mapInArrow(
            _anchored(length), f"h bigint, key binary, spans {_SPANS_SQL}"
        ), "anchors",
    )
    often = found.groupBy("h").agg(F.sum(F.size("spans")).alias("n")).filter("n > 1")
    spans = found.join(often, "h", "left_semi").groupBy("key").agg(
        F.collect_set(F.struct("h", "spans")).alias("anchors")
    )
    texts = source.select("key", "doc").groupBy("key").agg(
        F.min("doc").alias("one"), F.count("*").alias("copies")
    )
    wanted = spans.join(texts, "key").withColumnRenamed("key", "wanted")
    chosen = source.join(wanted, (F.col("key") == F.col("wanted")) & F.col("doc").eqNullSafe(F.col("one")))
    members, _ = materialize(
        chosen.select("key", "text", "copies", "anchors").mapInArrow(
            _stretched(length),
            "h bigint, key binary, los array<bigint>, reach int, copies bigint, bytes binary",
        ).withColumn("cid", F.unhex(F.md5("bytes"))), "stretches",
    )
    distinct = members.groupBy("h", "cid", "bytes", "reach").agg(F.sum("copies").alias("n")).withColumns(
        {"least": F.lit(0), "most": F.lit(length - GRAM)}
    )
    runs = _runs(distinct, length)
    return by_group(
        members.select("h", "cid", "key", "los").join(runs, ["h", "cid"]).select("key", "los", "first", "last"),
        ["key"], _merged(length), "key binary, spans array<struct<lo: bigint, hi: bigint>>",
    )


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and what is left
    as `text`."""
    spans, many = materialize(repeats(docs, doc_id, text, length), "spans")
    held = spans.agg(F.sum(F.size("spans"))).first()[0] or 0
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    source = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc"), plain.alias("text"),
        F.unhex(F.md5(plain)).alias("key"),
    )
    on = ["key"]
    if 64 * many + 16 * held <= BROADCAST_BYTES:
        spans = F.broadcast(spans)
    else:
        # A text may stand in many rows.
        on = ["key", "dealt"]
        source = source.withColumn("dealt", F.pmod(F.monotonically_increasing_id(), F.lit(DEALT)).cast("int"))
        spans = spans.withColumn("dealt", F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1))))
    return source.join(spans, on, "left").select("doc", "text", "spans").mapInArrow(
        _kept,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, text string",
    )
