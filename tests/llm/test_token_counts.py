"""Token counts against the library itself."""

import random

import public_tokenizers
import pytest
from candlestream.llm import token_counts
from tests.llm import data

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return token_counts._library(PATH).own


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(PATH, token_counts.whole_tokens(PATH))


def number(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_every_proven_string_is_one_token_in_a_text(library):
    proven = token_counts.whole_tokens(PATH)
    ascii_words = [w for w in proven if w.isascii()]
    assert len(proven) > 30_000 and "the" in proven and "The" not in proven
    assert number(library, " ".join(ascii_words)) == len(ascii_words)


def test_every_plain_character(library, counter):
    for c in map(chr, range(token_counts.PLAIN_END)):
        for text in (c, f"a{c}b", f"1{c}{c}2 '{c}s", f"{c}!{c}", f"{c}'ll"):
            assert counter.count(text) == number(library, text), repr(text)


def test_random_texts(library, counter):
    rng = random.Random(3)
    parts = [*"aB'sS tdéß1!?.,٣²中文ǺéκΣς½ǅ\x1c ́가\U0001F600\n", "<|endoftext|>", "<|startoftext|>",
             "<|endoftext|", "don't", "'RE", "İ", "hello", "unbelievable", " ", " "]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert counter.count(text) == number(library, text), repr(text)


def test_long_texts_in_parts(library, counter, monkeypatch):
    texts = [" ".join(data.prose(1, 3000)), "x" * 5000, "añ\n" * 2000, "中文 词\n" * 1000, "<|endoftext|>" * 300]
    whole = [number(library, t) for t in texts]
    assert [counter.count(t) for t in texts] == whole
    monkeypatch.setattr(token_counts, "LIST_CHARS", 100)
    assert [counter.count(t) for t in texts] == whole


def test_the_bound_of_kept_counts_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_COUNTS", 3)
    small = token_counts.Counter(PATH, token_counts.whole_tokens(PATH))
    text = " ".join(data.prose(6, 500))
    assert small.count(text) == number(library, text)


def test_odd_documents(spark, library):
    rows = [*data.documents(), (50, "İstanbul <|endoftext|> 中文", "tr"), (51, "<|startoftext|>", None)]
    got = token_counts.counts(data.frame(spark, rows), PATH, limit=100)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "bigint", "boolean"]
    expected = [(d, len((t or "").encode()), number(library, t or "")) for d, t, _ in rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    found = sorted((tuple(r) for r in got.collect()), key=key)
    assert found == sorted(((*e, e[2] > 100) for e in expected), key=key)


def test_no_documents(spark):
    assert token_counts.counts(data.frame(spark, []), PATH).collect() == []
