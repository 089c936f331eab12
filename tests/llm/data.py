"""Small tables with every odd case the operators name."""

from __future__ import annotations

import random

# Columns called like those the operators use inside.
CLASHES = ("key", "h", "doc", "n", "spans", "chunk", "code", "shard", "words", "label", "sh", "host")

SYLLABLES = "ba de fi go ku la me ni po ra si to vu".split()


def prose(seed: int, words: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words)]


def documents() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, lang): NULLs, empty and blank texts, one word, a very long text, repeated
    rows, copies, near copies on both sides of the threshold, a hot passage, ties."""
    base = prose(1, 200)
    near, far = [*base], [*base]
    near[100] = "other"
    for k in range(0, 200, 20):
        far[k] = "changed"
    passage = " ".join(prose(2, 70))
    rows = [
        (0, None, "en"), (1, "", "en"), (2, " \n\t ", None), (3, "word", "en"), (4, "word", "en"),
        (5, " ".join(base), "en"), (6, " ".join(near), "en"), (7, " ".join(far), "en"),
        (8, " ".join(base), "en"), (8, " ".join(base), "en"), (None, " ".join(prose(3, 90)), "fr"),
        (9, " ".join(prose(4, 20_000)), "fr"), (10, "Ünïcode ☃   und   mehr", "de"),
        (11, "a" * 3000, "de"), (12, "1234 5678 !!", "de"), (13, "four words are here", None),
    ]
    for k in range(14, 34):
        rows.append((k, " ".join([*prose(k, 40), passage, *prose(100 + k, 40)]), "en"))
    return rows


SCHEMA = "doc_id bigint, text string, lang string"


def frame(spark, rows=None, clashing: bool = True):
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)
    if clashing:
        for name in CLASHES:
            df = df.selectExpr("*", f"'x' AS {name}")
    return df
