"""Benchmark passages in documents, on built-in functions only.

Texts are lower-cased and cut into words; a shingle is five words in a row. A window of a document
is as long as the benchmark item it is held against and starts at a shingle that the item has: a
window that starts earlier gains nothing, as its first shingles are not the item's. Each window
gets a 64-bit SimHash, each shingle counted as often as it occurs. Fingerprints are cut into four
blocks of 16 bits. If two differ in at most `radius` bits, some block differs in at most
`radius // 4`, so the items are listed under every block value that close and a join on equal
block values misses none. Pairs within the radius are then compared exactly: shared shingles over
all shingles, both with multiplicity, at least `threshold`.

Defined cases: NULL texts are empty; documents and items of less than five words have no shingle
and match nothing; repeated rows of one id give one result; empty tables give an empty result;
other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlestream.llm.native import let, once, shingle_hashes, words
from candlestream.session import materialize

WIDTH = 5
THRESHOLD = 0.8

BLOCKS, BLOCK_BITS = 4, 16
# At a similarity of 0.8 two fingerprints differ in 9.7 bits on average, 2.9 the deviation.
RADIUS = 19

# Items of more shingles are found by sliding windows, in time linear in an item's length; for shorter
# ones it is quicker to write the windows out. Results are the same.
LONG = 512

# Up to so many distinct benchmark shingles, places that cannot match are passed over by a Bloom
# filter sent with the plan, 32 bytes of one slot each per shingle; larger benchmarks are joined.
# Either way places are then joined exactly.
MAP_LIMIT = 60_000
PROBES = 3


def simhash(shingles: Column) -> Column:
    """64 bits, each the majority of that bit over all shingles (0 on a draw).

    Four bits are counted at once, in the four 16-bit lanes of a long; of more shingles than the lane
    with the sign can count, two bits in 32-bit lanes.
    """
    return let(shingles, lambda s: F.when(F.size(s) <= 0x7FFF, _simhash(s, 4)).otherwise(_simhash(s, 2)))


def _simhash(s: Column, per_long: int) -> Column:
    width = 64 // per_long
    lanes = F.array(*[
        F.lit(sum(((x >> bit) & 1) << (width * bit) for bit in range(per_long))).cast("bigint")
        for x in range(1 << per_long)
    ])

    def lane_of(h: Column, at: int) -> Column:
        some = F.shiftrightunsigned(h, at).bitwiseAND((1 << per_long) - 1)
        return F.element_at(lanes, (some + 1).cast("int"))

    def counted(at: int) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.aggregate(s, zero, lambda total, h: total + lane_of(h, at))

    sums = F.array(*[counted(at) for at in range(0, 64, per_long)])
    return let(sums, lambda counts: _majorities(counts, F.size(s), per_long))


def _majorities(counts: Column, n: Column, per_long: int) -> Column:
    width = 64 // per_long
    bits = F.lit(0).cast("bigint")
    for lane in range(64):
        held = F.shiftrightunsigned(F.get(counts, F.lit(lane // per_long)), width * (lane % per_long))
        ones = held.bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
        one = F.shiftleft(F.lit(1).cast("bigint"), lane)
        bits = bits + F.when(ones * 2 > n, one).otherwise(F.lit(0).cast("bigint"))
    return bits


def _block(fingerprint: Column, block: int) -> Column:
    shifted = F.shiftrightunsigned(fingerprint, block * BLOCK_BITS)
    return shifted.bitwiseAND((1 << BLOCK_BITS) - 1)


def blocks(fingerprint: Column) -> Column:
    return F.array(*[F.struct(F.lit(b).alias("block"), _block(fingerprint, b).alias("value"))
                     for b in range(BLOCKS)])


def similarity(a: Column, b: Column) -> Column:
    """Shared over all elements of two arrays, with multiplicity."""
    def count(array: Column, x: Column) -> Column:
        return F.size(F.filter(array, lambda y: y == x))

    common = F.array_intersect(a, b)
    single = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    shared = F.when(single, F.size(common)).otherwise(F.aggregate(
        common, F.lit(0), lambda total, x: total + F.least(count(a, x), count(b, x))
    ))
    return let(shared, lambda n: n / (F.size(a) + F.size(b) - n))


def _shingled(table: DataFrame, key: str, text: str, name: str) -> DataFrame:
    w = words(F.lower(F.col(f"`{text}`")))
    return table.select(F.col(f"`{key}`").alias(name), once(shingle_hashes(w, WIDTH)).alias("sh"))


def _hits(docs: DataFrame, vocabulary: DataFrame, size: int) -> DataFrame:
    """Documents with the places of shingles that the benchmark has (and some it has not)."""
    if size <= MAP_LIMIT:
        bits = max(16, (32 * size - 1).bit_length())
        seen = bytearray(1 << bits)
        for row in vocabulary.select("h").distinct().collect():
            for k in range(PROBES):
                seen[(row.h % (1 << 64)) >> (20 * k) & ((1 << bits) - 1)] = 1
        def known(filled: Column, h: Column) -> Column:
            found = None
            for k in range(PROBES):
                slot = F.shiftrightunsigned(h, 20 * k).bitwiseAND((1 << bits) - 1)
                at = (slot + 1).cast("int")
                hit = F.call_function("substring", filled, at, F.lit(1)) == F.lit(b"\x01")
                found = hit if found is None else found & hit
            return found

        # Bound once: a literal is part of the plan's text wherever it stands.
        places = let(F.lit(bytes(seen)), lambda filled: let(F.col("sh"), lambda sh: F.filter(
            F.sequence(F.lit(0), F.size(sh) - 1), lambda i: known(filled, F.get(sh, i))
        )))
        found = docs.withColumn("places", once(F.when(F.size("sh") > 0, places)))
        return found.select("doc", "sh", F.explode("places").alias("at"))
    numbered = docs.withColumn("n", F.monotonically_increasing_id())
    numbered, _ = materialize(numbered, "shingles")
    places = numbered.select("n", F.posexplode("sh").alias("at", "h"))
    places = places.join(vocabulary.select("h").distinct(), "h", "left_semi").select("n", "at")
    return numbered.join(places, "n").select("doc", "sh", "at")


def _near(windows: DataFrame, own: DataFrame, radius: int) -> DataFrame:
    """The windows with each item of their size `n` whose fingerprint is within the radius of `fp`."""
    keys = windows.select("*", F.explode(blocks(F.col("fp"))).alias("b")).select(
        *windows.columns, "b.block", "b.value"
    )
    near = F.expr(
        f"filter(sequence(0, {(1 << BLOCK_BITS) - 1}), m -> bit_count(m) <= {radius // BLOCKS})"
    )
    index = own.select(
        "item", F.size("item_sh").alias("n"), F.explode(blocks(F.col("item_fp"))).alias("b"),
    ).select(
        "item", "n", "b.block", F.explode(near).alias("mask"), "b.value",
    ).select("item", "n", "block", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))

    # The index holds some ten thousand rows per item: its size is guessed too small, so no broadcast.
    pairs = keys.join(index.hint("merge"), ["n", "block", "value"]).join(own.drop("item_sh"), "item")
    # A pair that meets in several blocks counts in the first.
    first = F.lit(True)
    for b in range(BLOCKS):
        apart = F.bit_count(_block(F.col("fp").bitwiseXOR(F.col("item_fp")), b)) > radius // BLOCKS
        first = first & ((F.col("block") <= b) | apart)
    return pairs.filter(first & (F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius))


def _sliding(docs: DataFrame, own: DataFrame, threshold: float, radius: int) -> DataFrame:
    """(doc, item, at, similarity) of the windows that reach the threshold, for long items.

    No window is written out. Running counts of each bit along a document give any window's
    fingerprint as a difference of two rows. Shared shingles slide too: of the shingles in a window
    that equal one the item holds c times, the first c count, so one at place q counts in the
    windows that begin after the c-th equal place before q and reach q.
    """
    numbered, _ = materialize(docs.withColumn("no", F.monotonically_increasing_id()), "shingles")
    vocabulary = own.select(F.explode("item_sh").alias("h"), F.size("item_sh").alias("n")).distinct()
    tokens = numbered.select("no", F.posexplode("sh").alias("at", "h"))
    hits, _ = materialize(tokens.join(vocabulary, "h").select("no", "at", "n"), "places")
    long = numbered.join(hits.select("no").distinct(), "no", "left_semi")
    tokens = long.select("no", F.posexplode("sh").alias("at", "h"))

    # Two bits to a long: no document holds the 2 ** 31 shingles that would fill a lane.
    before = Window.partitionBy("no").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ends = long.select("no", F.size("sh").alias("at"), F.lit(0).cast("bigint").alias("h"))
    lanes = [
        F.coalesce(F.sum(
            F.shiftrightunsigned("h", k).bitwiseAND(1)
            + F.shiftrightunsigned("h", k + 1).bitwiseAND(1) * F.lit(1 << 32)
        ).over(before), F.lit(0)) for k in range(0, 64, 2)
    ]
    sums, _ = materialize(tokens.unionByName(ends).select("no", "at", F.array(*lanes).alias("sums")), "counts")
    spans = hits.join(numbered.select("no", F.size("sh").alias("length")), "no").withColumn(
        "until", F.least(F.col("at") + F.col("n"), F.col("length"))
    )
    spans = spans.join(sums, ["no", "at"]).join(
        sums.select("no", F.col("at").alias("until"), F.col("sums").alias("until_sums")), ["no", "until"])
    held = F.zip_with("until_sums", "sums", lambda b, a: b - a)
    fingerprint = let(held, lambda counts: _majorities(counts, F.col("until") - F.col("at"), 2))
    found, _ = materialize(_near(spans.select(
        "no", "n", "at", (F.col("until") - F.col("at")).alias("size"), fingerprint.alias("fp")
    ), own, radius).select("no", "item", "at", "n", "size"), "near")

    counts = own.select("item", F.size("item_sh").alias("n"), F.explode("item_sh").alias("h")).groupBy(
        "item", "n", "h").agg(F.count("*").alias("c"))
    equal = found.select("no", "item").distinct().join(counts, "item").join(tokens, ["no", "h"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("no", "item", "h").orderBy("at")))
    equal, _ = materialize(equal.select("no", "item", "n", "h", "c", "at", "rank"), "equal")
    earlier = equal.select("no", "item", "h", (F.col("rank") + F.col("c")).alias("rank"), F.col("at").alias("earlier"))
    counted = equal.join(earlier, ["no", "item", "h", "rank"], "left").select("no", "item", F.inline(F.array(
        F.struct(F.greatest(F.col("earlier") + 1, F.col("at") - F.col("n") + 1, F.lit(0)).alias("at"), F.lit(1).alias("step")),
        F.struct((F.col("at") + 1).alias("at"), F.lit(-1).alias("step")),
    )))
    none = F.lit(None).cast("int")
    steps = counted.withColumns({"n": none, "size": none}).unionByName(found.withColumn("step", F.lit(0)))
    up_to = Window.partitionBy("no", "item").orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    shared = steps.withColumn("shared", F.sum("step").over(up_to)).filter("n IS NOT NULL")
    return shared.withColumn(
        "similarity", F.col("shared") / (F.col("size") + F.col("n") - F.col("shared"))
    ).filter(F.col("similarity") >= threshold).join(numbered.select("no", "doc"), "no").select(
        "doc", "item", "at", "similarity")


def leaks(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD,
    radius: int = RADIUS,
) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_windows): items found in documents, the best
    window's similarity and first word, and how many windows reached the threshold."""
    own = _shingled(items, item_id, item_text, "item").filter(F.size("sh") > 0).select(
        "item", F.col("sh").alias("item_sh"), simhash(F.col("sh")).alias("item_fp")
    )
    every, _ = materialize(own, "items")
    shingled = _shingled(docs, doc_id, text, "doc")
    own = every.filter(F.size("item_sh") <= LONG)
    vocabulary, size = materialize(
        own.select(F.explode("item_sh").alias("h"), F.size("item_sh").alias("n")).distinct(),
        "vocabulary",
    )
    sizes = vocabulary.groupBy("h").agg(F.collect_set("n").alias("sizes"))
    if size <= MAP_LIMIT:
        sizes = F.broadcast(sizes)

    placed = _hits(shingled, vocabulary, size)
    placed = placed.withColumn("h", F.get("sh", F.col("at"))).join(sizes, "h")
    windows = placed.select("doc", "at", F.explode("sizes").alias("n"), "sh").select(
        "doc", "at", "n", F.slice("sh", F.col("at") + 1, F.col("n")).alias("win")
    )
    windows, _ = materialize(windows, "windows")

    # Copies of one window are compared once.
    distinct = windows.groupBy("n", "win").agg(F.lit(1).alias("one")).select(
        "n", "win", simhash(F.col("win")).alias("fp")
    )
    pairs = _near(distinct, own, radius)
    verified = pairs.join(own.select("item", "item_sh"), "item").withColumn(
        "similarity", similarity(F.col("win"), F.col("item_sh"))
    ).filter(F.col("similarity") >= threshold).select("n", "win", "item", "similarity")

    found = windows.join(verified, ["n", "win"]).select("doc", "item", "at", "similarity")
    long = every.filter(F.size("item_sh") > LONG)
    if not long.isEmpty():
        found = found.unionByName(_sliding(shingled, long, threshold, radius))
    best = F.struct(F.col("similarity"), (-F.col("at")).alias("early"))
    return found.groupBy("doc", "item").agg(
        F.max(best).alias("best"), F.count("*").alias("n_windows")
    ).select(
        F.col("doc").alias("doc_id"), F.col("item").alias("item_id"),
        F.col("best.similarity").alias("similarity"),
        (-F.col("best.early")).cast("bigint").alias("start_word"), "n_windows",
    )
