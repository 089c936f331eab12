"""Language of texts from language-bitmask n-gram filters.

Every language has a Bloom filter of its typical byte n-grams. The filters are bit-sliced: a slot
holds one bit per language, in as many 64-bit words as there are languages for, so one n-gram's slots, taken together by AND, are the set of languages
that have it. A text's n-grams are looked up, each language's hits are counted, the hits that a
filter as full as that language's gives by chance are taken off, and the most hits decide.

An n-gram is typical of a language if its share there is at least `RATIO` of its largest share in
any language. Shares come from a sample of the labelled rows, about `SAMPLE_ROWS` per language,
chosen by a hash of id and text.

Defined cases: NULL texts and texts without a letter are `und` with score 0; a text too short for
an n-gram, or without hits, takes the most frequent learned language with score 0; of equal counts
the first language in alphabetical order is taken; rows without a language are predicted but not
learned from; without labelled rows everything is `und`; an empty table gives an empty result;
columns other than the named ones are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestream.llm import text as tx
from candlestream.session import materialize

SIZE = 4
SAMPLE_ROWS = 2000
RATIO = 0.3
LEAST_COUNT = 3

SLOT_BITS = 19
PROBES = 3

UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: Column) -> Column:
    """Whether the id's CRC-32 puts the document in the fold that is not learned from."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


def _grams(texts: tx.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Mixed n-grams of each row between two blanks, row after row, and how many per row."""
    edges = np.stack([texts.starts, texts.ends], 1).ravel()
    data = np.insert(texts.data, edges, 32).astype(np.uint64)
    lengths = texts.ends - texts.starts + 2
    counts = np.maximum(lengths - size + 1, 0)
    if len(data) < size:
        return np.empty(0, np.uint64), np.zeros(len(counts), np.int64)
    n = len(data) - size + 1
    value = np.zeros(n, np.uint64)
    for k in range(size):
        value = (value << tx.U64(8)) | data[k:k + n]
    starts = np.cumsum(lengths) - lengths
    inside = np.zeros(n + 1, np.int64)
    some = counts > 0
    inside[starts[some]] += 1
    np.subtract.at(inside, starts[some] + counts[some], 1)
    return tx.mix(value[np.cumsum(inside[:n]) > 0]), counts


def _counted(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("code").to_numpy()
            for texts in tx.slices(batch.column("text"), lower=True):
                grams, counts = _grams(texts, size)
                owner = np.repeat(codes[texts.first:texts.first + len(texts)], counts)
                for code in np.unique(owner).tolist():
                    distinct, n = np.unique(grams[owner == code], return_counts=True)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(n), code, np.int32)), pa.array(distinct.view(np.int64)),
                        pa.array(n.astype(np.int64)),
                    ], names=["code", "gram", "n"])

    return count


@dataclass(frozen=True)
class Filters:
    """`slots[s, l // 64]` has bit l % 64 set if a typical n-gram of `languages[l]` falls into slot s."""

    languages: list[str]
    usual: str
    slots: np.ndarray
    chance: np.ndarray
    size: int

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """The languages of each n-gram, as bits in the words of a row."""
        mask = tx.U64((1 << SLOT_BITS) - 1)
        found = self.slots[(grams & mask).astype(np.int64)]
        for k in range(1, PROBES):
            found = found & self.slots[((grams >> tx.U64(SLOT_BITS * k)) & mask).astype(np.int64)]
        return found


def learn(
    labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    size: int = SIZE, sample_rows: int = SAMPLE_ROWS, ratio: float = RATIO, least_count: int = LEAST_COUNT,
) -> Filters | None:
    """Filters from the rows of `labelled` with a language and a text; None without any."""
    rows = labelled.select(
        F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").alias("text"),
        F.col(f"`{lang}`").alias("lang"),
    )
    rows = rows.filter("text IS NOT NULL AND lang IS NOT NULL")
    found = sorted((r.lang, r.n) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect())
    if not found:
        return None
    languages = [name for name, _ in found]
    codes = labelled.sparkSession.createDataFrame(
        [(name, k, min(1.0, sample_rows / n)) for k, (name, n) in enumerate(found)],
        "lang string, code int, share double",
    )
    sample = rows.join(F.broadcast(codes), "lang").filter(
        F.pmod(F.xxhash64("doc", "text"), F.lit(1_000_000)) < F.col("share") * 1_000_000
    ).select("code", "text")
    counts = sample.mapInArrow(_counted(size), "code int, gram bigint, n bigint")
    counts, _ = materialize(counts.groupBy("gram", "code").agg(F.sum("n").alias("n")), "grams")
    totals = counts.groupBy("code").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), "code").withColumn("share", F.col("n") / F.col("total"))
    typical = shares.groupBy("gram").agg(
        F.max("share").alias("top"), F.collect_list(F.struct("code", "n", "share")).alias("all")
    ).select("gram", F.explode(F.filter(
        "all", lambda x: (x["share"] >= F.col("top") * ratio) & (x["n"] >= least_count)
    )).alias("x")).select(
        "gram", F.shiftright("x.code", 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("x.code").bitwiseAND(63)).alias("bits"),
    )
    probes = F.array(*[
        F.shiftrightunsigned("gram", SLOT_BITS * k).bitwiseAND((1 << SLOT_BITS) - 1)
        for k in range(PROBES)
    ])
    filled = typical.select(F.explode(probes).alias("slot"), "word", "bits").groupBy("slot", "word").agg(
        F.bit_or("bits").alias("bits")
    ).toArrow()
    kind = next(
        k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(k).itemsize * 8 >= min(len(found), 64)
    )
    slots = np.zeros((1 << SLOT_BITS, -(-len(found) // 64)), kind)
    at = filled.column("slot").to_numpy(), filled.column("word").to_numpy()
    slots[at] = filled.column("bits").to_numpy().view(np.uint64).astype(kind)
    full = np.array([
        np.count_nonzero(slots[:, k // 64] >> kind(k % 64) & kind(1)) for k in range(len(found))
    ])
    usual = max(found, key=lambda x: x[1])[0]
    return Filters(languages, usual, slots, (full / len(slots)) ** PROBES, size)


_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True


def _has_letter(texts: tx.Texts) -> np.ndarray:
    running = np.concatenate([[0], np.cumsum(_LETTERS[texts.data])])
    has = running[texts.ends] > running[texts.starts]
    for row in np.flatnonzero(~has).tolist():
        data = texts.data[texts.starts[row]:texts.ends[row]]
        has[row] = bool((data >= 128).any()) and any(c.isalpha() for c in data.tobytes().decode())
    return has


def _predicted(filters: Filters):
    names = np.array([*filters.languages, UNKNOWN], object)
    usual = filters.languages.index(filters.usual)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in tx.slices(batch.column("text"), lower=True):
                grams, counts = _grams(texts, filters.size)
                found = filters.hits(grams)
                edges = np.concatenate([[0], np.cumsum(counts)])
                hits = np.empty((len(texts), len(filters.languages)))
                for k in range(len(filters.languages)):
                    running = np.concatenate([[0], np.cumsum((found[:, k // 64] >> (k % 64)) & 1, dtype=np.int64)])
                    own = running[edges[1:]] - running[edges[:-1]]
                    chance = filters.chance[k]
                    hits[:, k] = np.maximum(own - counts * chance, 0) / (1 - chance)
                total = hits.sum(1)
                best = np.where(total > 0, hits.argmax(1), usual)
                score = np.divide(hits.max(1), total, out=np.zeros(len(texts)), where=total > 0)
                has = _has_letter(texts)
                best = np.where(has, best, len(filters.languages))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc").slice(texts.first, len(texts)),
                    batch.column("held_out").slice(texts.first, len(texts)),
                    pa.array(names[best].tolist(), pa.string()), pa.array(np.where(has, score, 0.0)),
                ], names=["doc_id", "held_out", "lang_pred", "score"])

    return predict


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    size: int = SIZE, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from labelled rows of other folds."""
    out = held_out(F.col(f"`{doc_id}`"))
    filters = learn(docs.filter(~out), doc_id, text, lang, size, sample_rows)
    source = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc"), out.alias("held_out"),
        F.col(f"`{text}`").alias("text"),
    )
    if filters is None:
        return source.select(
            F.col("doc").alias("doc_id"), "held_out", F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
        )
    return source.mapInArrow(
        _predicted(filters), "doc_id bigint, held_out boolean, lang_pred string, score double"
    )
