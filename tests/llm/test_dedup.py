"""Repeated byte strings and near duplicates against plain Python."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from candlestream.llm import groups, jaccard_join, suffix_dedup
from tests.llm import brute, data


def kept(rows, length):
    found = brute.without_repeats([r[1] for r in rows], length)
    return Counter((r[0], n, gone, runs, hashlib.sha256(left).hexdigest())
                   for r, (n, gone, runs, left) in zip(rows, found, strict=True))


@pytest.mark.parametrize("anchor_bytes", [suffix_dedup.ANCHOR_BYTES, 1000])
def test_repeats_of_odd_documents(spark, monkeypatch, anchor_bytes):
    monkeypatch.setattr(suffix_dedup, "ANCHOR_BYTES", anchor_bytes)
    monkeypatch.setattr(suffix_dedup, "UNIT_BYTES", 20_000)
    got = suffix_dedup.removed(data.frame(spark), length=100).collect()
    assert Counter(tuple(r)[:5] for r in got) == kept(data.documents(), 100)
    for r in got:
        assert hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 or not r.text.isascii()


def repeated(text, times):
    return " ".join([text] * times)


HOT = " ".join(data.prose(50, 60))


def test_one_hot_anchor_over_the_bound_goes_through_the_transform(spark, monkeypatch):
    """A passage in many different texts, with less and with more than the length around it."""
    monkeypatch.setattr(suffix_dedup, "ANCHOR_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "UNIT_BYTES", 4000)
    transformed = []
    own = suffix_dedup._runs

    def counted(distinct, length):
        transformed.append(distinct.count())
        return own(distinct, length)

    monkeypatch.setattr(suffix_dedup, "_runs", counted)
    rng = random.Random(1)
    for passage in (HOT[:90], HOT[:250]):
        rows = []
        for k in range(60):
            before, after = (" ".join(data.prose(1000 * k + x + rng.randint(0, 3), 40)) for x in (1, 7))
            rows.append((k, f"{before[:rng.randint(0, 200)]} {passage} {after[:rng.randint(0, 200)]}", "en"))
        transformed.clear()
        got = suffix_dedup.removed(data.frame(spark, rows), length=100).collect()
        assert Counter(tuple(r)[:5] for r in got) == kept(rows, 100)
        assert len(transformed) > 2


def test_a_line_that_recurs_in_a_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ANCHOR_BYTES", 2000)
    rows = [(1, repeated("the same line of 70 bytes, over and over again, ends here, always so.\n", 300), None),
            (2, "x" * 20_000, None), (3, "ab" * 4000 + "c", None), (4, " ".join(data.prose(3, 300)), None)]
    got = suffix_dedup.removed(data.frame(spark, rows), length=100).collect()
    assert Counter(tuple(r)[:5] for r in got) == kept(rows, 100)


def test_halves_hold_each_string_once():
    own = " ".join(data.prose(4, 60)).encode()[:250]
    length, reach = 100, 30
    for least, most in ((0, 36), (0, 60), (25, 30), (30, 30)):
        got = [(off + k, far - k) for _, off, far, a, b, part in suffix_dedup.halves(own, reach, least, most, length)
               for k in range(len(part) - length + 1) if part == own[off:off + len(part)] and a <= far - k <= b]
        wanted = [(s, reach - s) for s in range(len(own) - length + 1) if least <= reach - s <= most]
        assert sorted(got) == wanted


def test_what_is_left_of_parted_characters(spark):
    rows = [(1, "é" + "ab" * 60, None), (2, "è" + "ab" * 60, None)]
    for r in suffix_dedup.removed(data.frame(spark, rows), length=100).collect():
        assert r.text == rows[r.doc_id - 1][1][0] and r.n_spans == 1
    # The second bytes of the two characters differ, their first are equal.
    rows = [(1, "x" + "ab" * 60 + "é", None), (2, "y" + "ab" * 60 + "è", None)]
    for r in suffix_dedup.removed(data.frame(spark, rows), length=100).collect():
        assert r.text == rows[r.doc_id - 1][1][0] and r.n_removed == 121


def test_repeats_by_shuffle_and_in_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_BYTES", -1)
    got = suffix_dedup.removed(data.frame(spark), length=100).collect()
    assert Counter(tuple(r)[:5] for r in got) == kept(data.documents(), 100)
    text = np.frombuffer(b"".join(bytes([97 + k % 7 * k % 11]) for k in range(9000)), np.uint8)
    whole = suffix_dedup.anchors(text, np.zeros(1, np.int64), np.array([len(text)]), 90)
    monkeypatch.setattr(suffix_dedup, "PART", 1000)
    texts = suffix_dedup.tx.Texts(0, text, np.zeros(1, np.int64), np.array([len(text)]))
    def places(parts):
        return {(h, s) for _, hs, lo, hi, _ in parts for h, a, b in zip(hs.tolist(), lo, hi, strict=True) for s in range(a, b + 1)}
    assert places(suffix_dedup._parts(texts, 90)) == places([whole])


def test_repeats_of_nothing(spark):
    assert suffix_dedup.removed(data.frame(spark, [])).collect() == []
    with pytest.raises(ValueError, match="length"):
        suffix_dedup.repeats(data.frame(spark), length=10)


def test_transform_against_counting():
    rng = random.Random(5)
    for _ in range(60):
        length = rng.choice([33, 40, 57])
        base = [bytes(rng.choices(b"abcd", k=rng.randint(30, 120))) for _ in range(3)]
        stretches = set()
        for _ in range(rng.randint(1, 8)):
            own = bytearray(rng.choice(base) + rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(b"xyz")
            stretches.add(bytes(own))
        stretches = sorted(stretches)
        weights = np.array([rng.choice([1, 1, 2]) for _ in stretches])
        seen = Counter()
        for s, n in zip(stretches, weights.tolist(), strict=True):
            for i in range(len(s) - length + 1):
                seen[s[i:i + length]] += n
        want = {(k, i) for k, s in enumerate(stretches) for i in range(len(s) - length + 1)
                if seen[s[i:i + length]] > 1}
        runs = suffix_dedup.repeated_starts(stretches, weights, length)
        assert {(k, i) for k, a, b in runs for i in range(a, b + 1)} == want


@pytest.mark.parametrize("block", [jaccard_join.BLOCK_TEXTS, 3])
def test_near_duplicates_of_odd_documents(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_TEXTS", block)
    rows = [r for r in data.documents() if r[0] is not None]
    got = jaccard_join.near_duplicates(data.frame(spark, rows)).select("doc_id", "class_id", "n_links")
    assert Counter(map(tuple, got.collect())) == Counter(brute.classes([r[:2] for r in rows]))


def test_near_duplicates_of_a_chain(spark, monkeypatch):
    """Each text is near the next only; all are one class."""
    monkeypatch.setattr(jaccard_join, "BROADCAST_MEMBERS", -1)
    words = data.prose(9, 400)
    rows = [(k, " ".join(words[8 * k:8 * k + 120]), None) for k in range(30)]
    got = jaccard_join.near_duplicates(data.frame(spark, rows)).select("doc_id", "class_id", "n_links")
    assert sorted(map(tuple, got.collect())) == sorted(brute.classes([r[:2] for r in rows]))


def test_near_duplicates_of_nothing(spark):
    assert jaccard_join.near_duplicates(data.frame(spark, [])).collect() == []
    got = jaccard_join.near_duplicates(data.frame(spark, [(None, None, None)] * 2)).collect()
    assert [(r.doc_id, r.class_id, r.n_links) for r in got] == [(None, None, 0)] * 2


def test_pruning_loses_no_pair_at_the_threshold():
    needed = jaccard_join.least_matches()
    rng = np.random.default_rng(3)
    equal = rng.random((200_000, jaccard_join.VALUES)) < 0.8
    for n, least in needed.items():
        assert (equal[:, :n].sum(1) < least).mean() < 1e-4
    assert needed[jaccard_join.VALUES] > 0.6 * jaccard_join.VALUES


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    got = groups.components(spark.createDataFrame(edges, "a long, b long")).collect()
    parent = list(range(300))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    touched = {x for e in edges if e[0] != e[1] for x in e}
    assert {r.node: r.label for r in got} == {x: root(x) for x in touched}
