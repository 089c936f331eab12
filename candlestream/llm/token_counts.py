"""Token counts of texts without merging what the vocabulary holds whole.

A byte-pair vocabulary with word ends cuts a text into pre-tokens and merges each on its own. Most
pre-tokens are vocabulary entries, but an entry need not come out of the merges as one token. So
`whole_tokens` proves it beforehand, once per vocabulary, on the driver: it lists the strings
that the tokenizer, given them alone, takes as one pre-token and encodes as their own entry. Since
merges never look beyond a pre-token, such a string is one token wherever it stands as a
pre-token. Texts are cut into pre-tokens; those on the list count one, and only the rest are
merged by the library, the shorter ones once per worker.

Texts of characters below `PLAIN_END` are lower-cased and cut here; these characters are letters,
digits or spaces alike for every library, and none composes with another. All other texts are
normalised and cut by the tokenizer's own parts. Added tokens inside a text count one each, as the
library has it.

The list is sent to the tasks; it is bounded by the vocabulary. Rows are counted where they lie:
nothing is shuffled.

Defined cases: a NULL text is empty; empty and blank texts have no tokens; repeated rows are
counted each; texts of any length are cut piece by piece, so that only the text itself is held; an
empty table gives an empty result; columns other than id and text are not read, so their names
cannot clash.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2048

# Below this code point all libraries agree on letters, digits, white space and lower case.
PLAIN_END = 0x250

# Merged counts that a worker keeps, and the longest pre-token it keeps one of.
KEPT_COUNTS, KEPT_LENGTH = 400_000, 64

# Longer texts are cut into pre-tokens in parts of about so many characters.
LIST_CHARS = 1 << 20



def _class(categories: str) -> str:
    """What the lower case of the characters below `PLAIN_END` has of Unicode categories, for a pattern."""
    found = {c for plain in range(PLAIN_END) for c in chr(plain).lower() if unicodedata.category(c)[0] in categories}
    return re.escape("".join(sorted(found)))


# The pre-tokens of the tokenizer file in lower case, a fixed pattern. Nothing but the third and
# the fourth choice begin alike.
_SPACE = r"\t-\r\x20\x85\xa0"
BREAK = re.compile(rf"[{_SPACE}]")
PRE_TOKEN = re.compile(
    rf"[{_class('L')}]+|[{_class('N')}]|'(?:s|t|re|ve|m|ll|d)|[^{_SPACE}{_class('L')}{_class('N')}]+"
)


class _Library:
    """A tokenizer file and its parts."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.own = Tokenizer.from_file(path)
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        self.added = sorted((t["content"] for t in stated["added_tokens"]), key=len, reverse=True)
        self.vocabulary = stated["model"]["vocab"]
        self.word_end = stated["model"]["end_of_word_suffix"] or ""

    def byte_form(self, text: str) -> str:
        return "".join(part for part, _ in self.bytes.pre_tokenize_str(text))

    def merged(self, byte_form: str) -> int:
        return len(self.own.model.tokenize(byte_form))


@functools.cache
def _library(path: str) -> _Library:
    return _Library(path)


def whole_tokens(path: str) -> list[str]:
    """Pre-tokens, in the vocabulary's form of bytes, that the tokenizer encodes as one token.

    Every entry that ends a word is tried: its text must be its own only pre-token, and the
    merges must lead to the entry itself.
    """
    library = _library(path)
    # One character of each first byte, and enough to have every later byte.
    sample = map(chr, (*range(0x800), 0x800, *range(0x1000, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x10000)))
    form = {c: b for x in sample for c, b in zip(library.byte_form(x), x.encode(), strict=True)}
    proven = []
    for entry, number in library.vocabulary.items():
        if not (library.word_end and entry.endswith(library.word_end)):
            continue
        word = entry.removesuffix(library.word_end)
        try:
            text = bytes(form[c] for c in word).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        pre = library.own.pre_tokenizer.pre_tokenize_str(library.own.normalizer.normalize_str(text))
        if [p for p, _ in pre] == [word] and library.own.encode(text, add_special_tokens=False).ids == [number]:
            proven.append(word)
    return proven


class _Counts(dict):
    """Tokens of a pre-token in the form of bytes: one if proven whole, else merged by the library."""

    def __init__(self, library: _Library, whole: list[str]) -> None:
        super().__init__(dict.fromkeys(whole, 1))
        self.library, self.free = library, KEPT_COUNTS

    def __missing__(self, pre: str) -> int:
        return self.keep(pre, self.library.merged(pre))

    def keep(self, pre: str, n: int) -> int:
        if self.free and len(pre) <= KEPT_LENGTH:
            self[pre] = n
            self.free -= 1
        return n


class _PlainCounts(_Counts):
    """The same of a pre-token as it stands in the text."""

    def __init__(self, library: _Library, whole: list[str]) -> None:
        super().__init__(library, [w for w in whole if w.isascii()])
        self.whole = frozenset(w for w in whole if not w.isascii())

    def __missing__(self, pre: str) -> int:
        form = self.library.byte_form(pre)
        return self.keep(pre, 1 if form in self.whole else self.library.merged(form))


class Counter:
    """Counts the tokens of texts with a list of proven whole tokens."""

    def __init__(self, path: str, whole: list[str]) -> None:
        self.library = _library(path)
        self.plain = _PlainCounts(self.library, whole)
        self.other = _Counts(self.library, whole)
        self.added = re.compile("|".join(map(re.escape, self.library.added)) or r"(?!)")

    def count(self, text: str) -> int:
        parts = self.added.split(text)
        return len(parts) - 1 + sum(map(self._part, parts))

    def _part(self, text: str) -> int:
        if text.isascii() or max(text) < chr(PLAIN_END):
            pieces = _pieces(text.lower())
            return sum(sum(map(self.plain.__getitem__, PRE_TOKEN.findall(piece))) for piece in pieces)
        own = self.library.own
        pieces = _pieces(own.normalizer.normalize_str(text))
        return sum(self.other[p] for piece in pieces for p, _ in own.pre_tokenizer.pre_tokenize_str(piece))


def _pieces(text: str) -> Iterator[str]:
    """Parts of about `LIST_CHARS` characters that end before white space, which no pre-token holds."""
    at = 0
    while len(text) - at > LIST_CHARS and (found := BREAK.search(text, at + LIST_CHARS)):
        yield text[at:found.start()]
        at = found.start()
    yield text[at:]


_COUNTERS: dict[str, Counter] = {}


def _counted(path: str, whole):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path, whole.value)
        count = _COUNTERS[path].count
        for batch in batches:
            tokens = [count(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(tokens, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit per row of `docs`."""
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))
    plain = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    source = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), plain.alias("text"),
        F.octet_length(plain).cast("bigint").alias("n_bytes"),
    )
    counted = source.mapInArrow(_counted(path, whole), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
