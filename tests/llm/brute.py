"""Plain-Python versions of what the operators compute, for small tables."""

from __future__ import annotations

import re
from collections import Counter

BREAK = re.compile(r"[\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return [w for w in BREAK.split(text or "") if w]


def shingles(text: str | None, width: int = 5) -> set[tuple[str, ...]]:
    w = words(text)
    if 0 < len(w) < width:
        return {tuple(w)}
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def classes(docs: list[tuple[int, str | None]], threshold: float = 0.8) -> list[tuple[int, int, int]]:
    """(doc_id, least id of its class, links) per row."""
    sets = [shingles(t) for _, t in docs]
    parent, links = list(range(len(docs))), [0] * len(docs)

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    where: dict[tuple, list[int]] = {}
    for k, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    for k, s in enumerate(sets):
        for other, shared in Counter(o for x in s for o in where[x] if o > k).items():
            if shared >= threshold * (len(s) + len(sets[other]) - shared) - 1e-9:
                links[k] += 1
                links[other] += 1
                parent[root(other)] = root(k)
    least: dict[int, int] = {}
    for k, (doc, _) in enumerate(docs):
        least[root(k)] = min(least.get(root(k), doc), doc)
    return [(doc, least[root(k)], links[k]) for k, (doc, _) in enumerate(docs)]


def leaks(docs: list[tuple[int, str | None]], items: list[tuple[int, str | None]],
          threshold: float = 0.8) -> set[tuple[int, int, float]]:
    """(doc_id, item_id, best similarity of any window as long as the item)."""
    found = {}
    own = [(i, [tuple(w[k:k + 5]) for k in range(len(w) - 4)])
           for i, w in ((i, words((t or "").lower())) for i, t in items)]
    for doc, text in docs:
        w = words((text or "").lower())
        grams = [tuple(w[k:k + 5]) for k in range(len(w) - 4)]
        for item, sh in own:
            if not sh or not set(sh) & set(grams):
                continue
            target = Counter(sh)
            for at in range(len(grams)):
                window = Counter(grams[at:at + len(sh)])
                shared = sum((window & target).values())
                value = shared / (sum(window.values()) + len(sh) - shared)
                if value >= threshold:
                    found[doc, item] = max(found.get((doc, item), 0), value)
    return {(d, i, round(v, 9)) for (d, i), v in found.items()}


def without_repeats(texts: list[str | None], length: int) -> list[tuple[int, int, int, bytes]]:
    """Bytes, removed bytes, removed runs and what is left, per text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        end = 0
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                for k in range(max(i, end), i + length):
                    gone[k] = 1
                end = i + length
        runs = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(d)))
        out.append((len(d), sum(gone), runs, bytes(b for b, g in zip(d, gone, strict=True) if not g)))
    return out
