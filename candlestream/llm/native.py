"""Column helpers shared by the operators that run on built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` computed once, also where lambdas refer to it many times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def once(value: Column) -> Column:
    """`value`, which later filters and projections read but never compute again: the optimizer
    leaves a column with a random part where it is. The condition always holds."""
    return F.when(F.rand(0) >= 0, value)


def words(text: Column) -> Column:
    """Maximal runs of bytes other than space, tab, line and page breaks; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def shingle_hashes(word_array: Column, width: int) -> Column:
    """One 64-bit hash per run of `width` words, in order; none for shorter texts."""
    return let(word_array, lambda w: F.when(
        F.size(w) >= width,
        F.transform(
            F.sequence(F.lit(0), F.size(w) - width),
            lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]),
        ),
    ).otherwise(F.array().cast("array<bigint>")))
