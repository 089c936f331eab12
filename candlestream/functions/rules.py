"""Ordered advice rules: the first rule that holds names the label."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RuleList:
    """(SQL predicate, label) pairs in order of precedence, and the label when none holds.

    A predicate that is NULL does not fire, so a missing indicator passes on to the next rule.
    """

    rules: tuple[tuple[str, str], ...]
    default: str

    def __iter__(self) -> Iterator[tuple[str, str]]:
        return iter(self.rules)

    def labels(self) -> list[str]:
        return [label for _, label in self.rules] + [self.default]

    def column(self) -> Column:
        arms = " ".join(f"WHEN {test} THEN '{label}'" for test, label in self.rules)
        return F.expr(f"CASE {arms} ELSE '{self.default}' END")


def advise(df: DataFrame, rules: RuleList, name: str = "advice") -> DataFrame:
    return df.withColumn(name, rules.column())
