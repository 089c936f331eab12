"""Quality rules as a short-circuit cascade, on built-in functions only.

Each rule's cost and rejection rate are measured on a sample of the table; the rules then run in
order of rejections per second, each only on rows that passed the ones before. The order decides
what is spent, never what is kept: a text is kept when no rule rejects it.

Defined cases: a NULL or empty text has no words and fails `few_words`; repeated rows are judged
alike; an empty table gives an empty result; other columns are passed through, and one that is
called like the result column is replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlestream.llm.native import let, once, shingle_hashes, words
from candlestream.session import materialize

SYMBOLS = "[#*$%&|<>]"
CAPITALS = "[A-Z]"

MIN_WORDS = 50
REPEAT_PERCENT = 50

# Rows on which costs and rejection rates are measured.
SAMPLE_ROWS = 1000


def char_count(text: Column, chars: str) -> Column:
    """How many characters of `text` match the character class `chars`."""
    return F.regexp_count(text, F.lit(chars)).cast("bigint")


def word_chars(word_array: Column) -> Column:
    """Code points in words."""
    return F.aggregate(
        word_array, F.lit(0).cast("bigint"), lambda total, w: total + F.char_length(w)
    )


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(lines_with_words(text), lambda lines: (
        F.size(lines) - F.size(F.array_distinct(lines))
    )).cast("bigint")


def repeated_words(word_array: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the text.

    Most texts repeat no window, which a hash set tells; only the others sort theirs.
    """
    def positions(grams: Column) -> Column:
        numbered = F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return let(F.sort_array(numbered), lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: (
                F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                | ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"]))
            )),
            lambda x: x["i"],
        )))

    def covered(starts: Column) -> Column:
        gaps = F.transform(
            starts, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - p, F.lit(3)))
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    return let(shingle_hashes(word_array, 3), lambda grams: F.when(
        F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)
    ).otherwise(let(positions(grams), covered))).cast("bigint")


@dataclass(frozen=True)
class Facts:
    """What rules are stated in: columns that `given` names, or else expressions on the text."""

    text: Column
    words: Column
    given: frozenset[str] = frozenset()

    def _or(self, name: str, made: Callable[[], Column]) -> Column:
        return F.col(name) if name in self.given else made()

    def n_words(self) -> Column:
        return self._or("n_words", lambda: F.size(self.words).cast("bigint"))

    def word_chars(self) -> Column:
        return self._or("word_chars", lambda: word_chars(self.words))

    def n_symbols(self) -> Column:
        return self._or("n_symbols", lambda: char_count(self.text, SYMBOLS))

    def n_dup_lines(self) -> Column:
        return self._or("n_dup_lines", lambda: duplicate_lines(self.text))

    def n_repeat_words(self) -> Column:
        return self._or("n_repeat_words", lambda: repeated_words(self.words))

    def n_lines(self) -> Column:
        return F.size(lines_with_words(self.text))

    def n_capitals(self) -> Column:
        return char_count(self.text, CAPITALS)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Facts], Column]


# The first two make up `base_failed`; the shares of the others are far from running prose.
BASE_RULES = (
    Rule("few_words", lambda f: f.n_words() < MIN_WORDS),
    Rule("repetitive", lambda f: f.n_repeat_words() * 100 > f.n_words() * REPEAT_PERCENT),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda f: f.n_symbols() * 10 > f.n_words()),
    Rule("short_words", lambda f: f.word_chars() < f.n_words() * 2),
    Rule("long_words", lambda f: f.word_chars() > f.n_words() * 20),
    Rule("same_lines", lambda f: f.n_dup_lines() * 10 > f.n_lines() * 6),
    Rule("shouting", lambda f: f.n_capitals() * 2 > f.word_chars()),
)
FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def rank(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def _prepared(docs: DataFrame, text: str) -> tuple[DataFrame, Column, Column]:
    """Text without NULLs and its words as two more columns, named so that none is hidden."""
    plain, split = "__text", "__words"
    while plain in docs.columns or split in docs.columns:
        plain, split = plain + "_", split + "_"
    docs = docs.withColumn(plain, F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return docs.withColumn(split, once(words(F.col(plain)))), F.col(plain), F.col(split)


def measure(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> list[Measured]:
    """Rules with cost and rejection rate on a sample, the most rejections per second first.

    What a job takes to start, measured with an empty rule, is taken off each cost.
    """
    total = docs.count()
    if total == 0:
        return [Measured(rule, 0.0, 0.0) for rule in rules]
    share = min(1.0, sample_rows / total)
    table, plain, split = _prepared(docs.select(F.col(f"`{text}`").alias("t")), "t")
    table = table.select(plain, split)
    sample, _ = materialize(table.sample(share, seed=1) if share < 1 else table, "rules")
    facts = Facts(plain, split)

    def took(share_of: Column) -> tuple[float, float]:
        began = time.perf_counter()
        value = sample.agg(F.avg(share_of.cast("int"))).first()[0]
        return time.perf_counter() - began, value or 0.0

    idle = min(took(F.size(split) < 0)[0] for _ in range(2))
    found = []
    for rule in rules:
        seconds, rejected = took(rule.rejects(facts))
        found.append(Measured(rule, max(seconds - idle, 1e-3), rejected))
    return sorted(found, key=lambda m: -m.rank)


def cascade(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text",
    into: str = "failed_rule", sample_rows: int = SAMPLE_ROWS, with_facts: bool = False,
) -> DataFrame:
    """`docs` with the first rule in the measured order that rejects the text, or NULL.

    `with_facts` adds the counts of `FACTS` and `base_failed`, which then exist for every row; the
    rules read them instead of the text.
    """
    ordered = [m.rule for m in measure(docs, rules, text, sample_rows)]
    own = (into, *((*FACTS, "base_failed") if with_facts else ()))
    columns = [c for c in docs.columns if c not in own]
    table, plain, split = _prepared(docs.select(*[F.col(f"`{c}`") for c in columns]), text)
    facts = Facts(plain, split)
    if with_facts:
        table = table.select("*", *[getattr(facts, name)().alias(name) for name in FACTS])
        facts = Facts(plain, split, frozenset(FACTS))
    verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        verdict = F.when(rule.rejects(facts), rule.name).otherwise(verdict)
    added = [verdict.alias(into)]
    if with_facts:
        failed = [rule.rejects(facts) for rule in BASE_RULES]
        added += [F.col(name) for name in FACTS] + [(failed[0] | failed[1]).alias("base_failed")]
    return table.select(*[F.col(f"`{c}`") for c in columns], *added)
