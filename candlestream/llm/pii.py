"""Personal data replaced by surrogates: keyed, of the same type and format, and distinct.

Patterns find e-mail addresses, secrets and access keys, IP addresses of both versions, IBANs with
right check digits, phone, card and social-security numbers, and names after a title. A name is any
number of words: given names, initials, particles such as `van der`, surnames with hyphens or
apostrophes. A name nowhere preceded by a title in its text is not found. Digits make a card if
their check digit is right, or if they are 15 or 16 and begin as issuers' numbers do; four numbers
after a word for a version are no address.

A mention is reduced to its entity: digits without separators, text without
case. The table of distinct entities gets surrogates from an HMAC of a key, type and entity; where
two entities of a type share a surrogate, or a surrogate is an entity that occurs in the texts, all
but the first draw again until none clash, while settled ones are kept aside; after `WIDEN` draws
the form is widened by more characters or another network, so that a format with few forms ends
too. So equal entities have equal surrogates in all texts (coreference), and different ones
different surrogates. A mention is written in its own format: separators, case, script and length
stay; a card keeps or lacks a valid check digit as before, an IBAN its country; a name keeps title,
gender, script, particles and number of words. Initials take part in a keyed cycle of the letters of
their script.

The key comes from the caller or from the session's `spark.candlestream.pii.key`; where neither
names one, each call draws its own, so that nobody can compute surrogates again.

A name's words are entities of their own. The last word after a title is a surname, with one
surrogate in all texts; the words before it are given names, of the gender of the title or, where
that tells none, of the same given name elsewhere in the text. A word that is a surname anywhere in a
text is one everywhere in it, and both kinds are also replaced where they stand without a title.
Words such as `Said` end a name.

Texts without any of the literals that a mention needs pass through; the others are written once,
read for mentions, and joined by their MD5 to what replaces them. A surrogate table row is joined
to the mentions, never collected.

Defined cases: a NULL text stays NULL, an empty one empty; repeated rows are replaced alike;
overlapping mentions go to the one that starts first, then to the longer; an empty table gives an
empty result; a secret or a local part of an e-mail address without a letter or digit is no mention;
other columns are passed through, and one called like an added column is replaced.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import ipaddress
import operator
import re
import secrets
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlestream.session import materialize

KEY_CONF = "spark.candlestream.pii.key"
# Draws in an entity's own form before the form is widened.
WIDEN = 4

# Titles tell the gender; the names that replace others are fixed lists per script and gender.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Sra", "Señora", "Mme", "Madame", "госпожа", "κυρία"),
    "m": ("Mr", "Herr", "Sr", "Señor", "Monsieur", "господин", "κύριος"),
    "n": ("Dr", "Doctor", "Doktor", "Prof", "Professor", "Dott", "Mx", "доктор", "профессор", "Δρ", "καθηγητής"),
}
# Titles that also count in lower case, before a full stop or a space.
LOWER_TITLES = ("mr", "mrs", "dr", "prof")
PARTICLES = (
    "van von vom der den de del della di da dos das du la le lo el al bin ibn ter ten te zu zur zum af av y"
).split()
# Words with a capital that follow a name and are no part of it.
AFTER_NAMES = (
    "Said Says Asked Asks Told Tells Replied Replies Answered Added Wrote Writes Spoke Thinks Thought Knew Knows"
    " Went Goes Came Comes Made Makes Took Takes Gave Gets Got Met Saw Is Was Are Were Has Had Have Does Did Do"
    " Will Would Can Could Should Must And Or But Nor Not Of In On At To From For With By As If So Then Also The"
    " An This That These Those He She It They We You His Her Its Their Who Whose When Where Why How After Before"
    " Sagt Sagte Ist War Hat Hatte Und Oder Der Die Das Dit Est Et La Le Les Dijo Dice Es El Los Las Disse Ha"
    " сказал сказала был была и είπε είναι και"
).split()
GIVEN = {
    "latin": {
        "f": ("Anna", "Clara", "Elena", "Eva", "Ida", "Julia", "Laura", "Lea", "Marta", "Nina", "Olga",
              "Paula", "Rosa", "Sara", "Sofia", "Vera"),
        "m": ("Adam", "Bruno", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Karl", "Leon",
              "Marco", "Nils", "Oscar", "Paul", "Simon", "Victor"),
    },
    "cyrillic": {
        "f": ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"),
        "m": ("Антон", "Борис", "Денис", "Иван", "Максим", "Олег", "Павел", "Роман"),
    },
    "greek": {
        "f": ("Άννα", "Ελένη", "Ιωάννα", "Κατερίνα", "Μαρία", "Σοφία"),
        "m": ("Αλέξης", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"),
    },
}
FAMILY = {
    "latin": ("Albers", "Baron", "Castel", "Dorn", "Engel", "Falk", "Garner", "Hollis", "Jansen",
              "Keller", "Lindner", "Moreau", "Novak", "Ortega", "Perrin", "Rossi", "Salas", "Torres",
              "Vidal", "Weber"),
    "cyrillic": ("Белый", "Волков", "Громов", "Зимин", "Лесной", "Морозов", "Орлов", "Соколов"),
    "greek": ("Αγγέλου", "Βασιλείου", "Γεωργίου", "Δήμου", "Λάμπρου", "Νικολάου"),
}
SYLLABLES = {
    "latin": ("ba", "da", "fe", "ga", "ka", "le", "mi", "no", "ra", "si", "ta", "vo"),
    "cyrillic": ("ба", "да", "ге", "ка", "ле", "ми", "но", "ра"),
    "greek": ("βα", "δα", "γε", "κα", "λε", "μι", "νο", "ρα"),
}

_ALL_TITLES = "|".join(re.escape(t) for ts in TITLES.values() for t in ts)
_GENDER = {t: g for g, ts in TITLES.items() for t in ts} | {t: {"mr": "m", "mrs": "f"}.get(t, "n") for t in LOWER_TITLES}
_LOWER = "|".join(LOWER_TITLES)
_TITLE = rf"(?:(?:{_ALL_TITLES})\b\.?\s{{1,2}}|(?:{_LOWER})(?:\.\s{{0,2}}| {{1,2}}))"
_CAPITAL = r"[^\W\d_a-zà-öø-ÿа-яά-ώ]"
_LETTERS = r"(?:[A-Z]['’](?=[A-Z]))?" + _CAPITAL + r"[^\W\d_]+(?:['’](?![sS]\b)[^\W\d_]{2,})*"
_SURNAME = rf"{_LETTERS}(?:-{_LETTERS})*"
_INITIAL = rf"{_CAPITAL}(?:\.-?{_CAPITAL})*(?:\.\s{{0,2}}|\s)(?={_CAPITAL}|(?:{'|'.join(PARTICLES)})\s)"
_PARTICLE = rf"(?:{'|'.join(PARTICLES)})\s{{1,2}}"
_AFTER = "|".join(AFTER_NAMES)
_NO_TITLE = rf"(?!(?:{_ALL_TITLES})\b)"
_NAME = (
    rf"(?:{_NO_TITLE}{_INITIAL})*(?:{_PARTICLE})*{_NO_TITLE}{_SURNAME}"
    rf"(?:\s(?:{_INITIAL})*(?:{_PARTICLE})*(?!(?i:{_AFTER})\b){_NO_TITLE}{_SURNAME})*"
)


def _marks() -> str:
    """Vowel signs, accents and joiners, which are part of words, as ranges of a character class."""
    found = [c for c in range(0x300, 0x10000) if unicodedata.category(chr(c))[0] == "M"]
    ends = [c for c, after in zip(found, [*found[1:], 0], strict=True) if after != c + 1]
    starts = [c for c, before in zip(found, [0, *found[:-1]], strict=True) if before != c - 1]
    ranges = [f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True)]
    return "".join([*ranges, "\u200c\u200d\U00011000-\U00011fff\U0001e000-\U0001e94a"])


PATTERNS = {
    "email": r"(?=[._%+-]{0,64}[^\W_])[\w" + _marks() + r".%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?i:\b(?:token|secret|password|passwd|api[_-]?key)\b[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(?=[_\-+/=]*[A-Za-z0-9])(?P<value>[A-Za-z0-9_\-+/=]{12,})",
    "hex": r"(?<![A-Za-z0-9])(?=[0-9a-f]{0,31}[0-9])(?:[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{32})(?![A-Za-z0-9])",
    "key": r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_.-]*[0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}"
           r"|AIza[A-Za-z0-9_-]{35}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
           r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv6": r"(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:[0-9A-Fa-f]{1,4}:|::)[0-9A-Fa-f:]{1,37}(?![\w:])",
    "ip": r"(?<![\d.vV])(?<!(?i:version) )(?<!(?i:release) )(?<!(?i:version): )(?<!(?i:ver)\. )"
          r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)"
             r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|(?<![\w.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
             r"|(?<![\w.,+/-])0\d{1,4}[ /-]\d{2,4}(?:[ -]?\d{2,4}){1,2}(?![\w/-]|[.,]\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "name": rf"\b(?=[{''.join(sorted({t[0] for t in _GENDER}))}])(?P<title>(?:{_TITLE}){{1,4}})(?P<value>{_NAME})",
}
_COMPILED = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
_DIGIT = re.compile("[0-9]")

# What a text must hold for a mention of some kind: a digit or an @, a title, or a word for a secret
# with a sign of assignment. Titles that hold another one need no test.
_SECRET_WORDS = ("token", "secret", "passw", "api")
_TITLE_SIGNS = [
    t for t in (*(x for x in _GENDER if x not in LOWER_TITLES), *(x + end for x in LOWER_TITLES for end in ". "))
    if not any(other in t and other != t for other in _GENDER if other not in LOWER_TITLES)
]


def maybe(text: Column) -> Column:
    """Whether a text may hold a mention: literals only, which cost far less than patterns."""
    def one_of(literals, column: Column) -> Column:
        return functools.reduce(operator.or_, [column.contains(x) for x in literals])

    assigned = one_of("=:", text) & one_of(_SECRET_WORDS, F.lower(text))
    return F.coalesce(one_of("0123456789@", text) | assigned | one_of(_TITLE_SIGNS, text), F.lit(False))


def maybe_text(text: str) -> bool:
    """The same of one text."""
    low = text.lower()
    return bool(
        _DIGIT.search(text) or "@" in text or any(t in text for t in _TITLE_SIGNS)
        or (("=" in text or ":" in text) and any(w in low for w in _SECRET_WORDS))
    )


def script(word: str) -> str:
    if any("\u0400" <= c <= "\u04ff" for c in word):
        return "cyrillic"
    return "greek" if any("\u0370" <= c <= "\u03ff" for c in word) else "latin"


# A word of a name, with the apostrophes that belong to it, and its runs of letters.
WORD = re.compile(r"(?<![^\W\d_])(?:[A-Z]['’](?=[A-Z]))?[^\W\d_]+(?:['’](?![sS]\b)[^\W\d_]{2,})*")
RUN = re.compile(r"[^\W\d_]+")


def _accepted(kind: str, m: re.Match) -> bool:
    if kind == "card":
        digits = re.sub(r"\D", "", m[0])
        return luhn(digits) == int(digits[-1]) or (len(digits) in (15, 16) and digits[0] in "23456")
    if kind == "iban":
        plain = m[0].replace(" ", "")
        return 15 <= len(plain) <= 34 and _iban_check(plain[:2], plain[4:]) == plain[2:4]
    if kind == "ipv6":
        try:
            ipaddress.IPv6Address(m[0])
        except ValueError:
            return False
    return True


def _possible(text: str) -> list[str]:
    """Kinds whose signs a text holds."""
    kinds = ["email"] if "@" in text else []
    if _DIGIT.search(text):
        kinds += ["hex", "key", "iban", "ip", "phone", "ssn", "card"]
        if text.count(":") > 1:
            kinds.append("ipv6")
    if ("=" in text or ":" in text) and any(w in (low := text.lower()) for w in _SECRET_WORDS):
        kinds.append("secret")
    if any(t in text for t in _TITLE_SIGNS):
        kinds.append("name")
    return [kind for kind in PATTERNS if kind in kinds]


def _matches(text: str) -> Iterator[tuple[str, re.Match]]:
    """Matches of all kinds from left to right, none overlapping: the first, then the longest."""
    def following(kind: str, at: int) -> re.Match | None:
        return next((m for m in _COMPILED[kind].finditer(text, at) if _accepted(kind, m)), None)

    ahead = {kind: m for kind in _possible(text) if (m := following(kind, 0))}
    while ahead:
        kind, m = min(ahead.items(), key=lambda x: (x[1].start(), -x[1].end()))
        yield kind, m
        for other in [k for k, x in ahead.items() if x.start() < m.end()]:
            if found := following(other, m.end()):
                ahead[other] = found
            else:
                del ahead[other]


def _name_words(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """Start, end and role of a name's words: `given`, `family` (those of the last word, parted by
    hyphens) or `initial`; particles have none."""
    words = [m for m in WORD.finditer(text, start, end)
             if not (m[0] in PARTICLES and m.end() < end and text[m.end()].isspace())]
    last = max((k for k, m in enumerate(words) if k == 0 or text[m.start() - 1] != "-"), default=0)
    return [
        (*m.span(), "family" if k >= last else "initial" if len(m[0]) == 1 else "given") for k, m in enumerate(words)
    ]


def _of_patterns(text: str) -> Iterator[tuple[int, int, str, str]]:
    for kind, m in _matches(text):
        if kind == "secret":
            yield *m.span("value"), kind, m["value"]
        elif kind == "hex":
            yield *m.span(), "secret", m[0]
        elif kind == "name":
            titles = [_GENDER[t] for t in re.findall(rf"{_ALL_TITLES}|\b(?:{_LOWER})\b", m["title"])]
            gender = next((g for g in titles if g != "n"), "n")
            words = [text[a:b] for a, b, _ in _name_words(text, *m.span("value"))]
            yield *m.span("value"), f"name-{gender}-{script(words[-1])}-{len(words)}", " ".join(words).casefold()
        elif kind == "email":
            yield *m.span(), kind, m[0].lower()
        elif kind == "ipv6":
            yield *m.span(), kind, ipaddress.IPv6Address(m[0]).compressed
        elif kind in ("ip", "key"):
            yield *m.span(), kind, m[0]
        elif kind == "iban":
            yield *m.span(), kind, m[0].replace(" ", "")
        else:
            yield *m.span(), kind, re.sub(r"\D", "", m[0])


def _bare(text: str, found: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int, str, str]]:
    """Words of the names in `found` that stand outside of it, with a capital or without case."""
    known = {
        text[a:b].casefold() for start, end, kind, _ in found if kind.startswith("name-")
        for a, b, role in _name_words(text, start, end) if role != "initial"
    }
    at = 0
    for word in WORD.finditer(text) if known else ():
        for m in [word] if word[0].casefold() in known else RUN.finditer(text, *word.span()):
            while at < len(found) and found[at][1] <= m.start():
                at += 1
            inside = at < len(found) and found[at][0] < m.end()
            if not inside and not m[0][0].islower() and m[0].casefold() in known:
                yield *m.span(), f"name-n-{script(m[0])}-1", m[0].casefold()


def mentions(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, type and entity of each mention, from left to right; words of names that stand
    without a title are of the type `name-n-<script>-1`."""
    found = list(_of_patterns(text))
    return sorted([*found, *_bare(text, found)])


def parts(text: str) -> Iterator[tuple[int, int, str, str, bool]]:
    """Start, end, type and entity of what is replaced at once, and whether a mention starts there:
    mentions, but names word by word."""
    found = list(_of_patterns(text))
    family: set[str] = set()
    genders: dict[str, str] = {}
    for start, end, kind, _ in found:
        if kind.startswith("name-"):
            for a, b, role in _name_words(text, start, end):
                word, gender = text[a:b].casefold(), kind.split("-")[1]
                if role == "family":
                    family.add(word)
                elif gender != "n":
                    genders.setdefault(word, gender)
    for start, end, kind, entity in [*found, *_bare(text, found)]:
        if not kind.startswith("name-"):
            yield start, end, kind, entity, True
            continue
        own = kind.split("-")[1]
        for k, (a, b, role) in enumerate(_name_words(text, start, end)):
            word = text[a:b].casefold()
            if role == "initial":
                part = f"initial-{script(word)}"
            elif word in family:
                part = f"name-n-{script(word)}-1"
            else:
                part = f"name-{own if own != 'n' else genders.get(word, 'n')}-{script(word)}-given"
            yield a, b, part, word, k == 0


@functools.cache
def _alike(c: str) -> str:
    """Letters, digits or marks of the script and case of `c`; empty if `c` is none of them.

    Latin letters give those without accents. Others come from the 256 characters around `c`, and
    those that change in number or form when their case is changed twice are left out.
    """
    kind = unicodedata.category(c)
    if kind[0] not in "LNM":
        return ""
    if c.isdigit() and c.isascii():
        return "0123456789"
    name = unicodedata.name(c, "").split("-")[0].split(" ")[0]
    if name == "LATIN" and kind[0] == "L":
        return "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isupper() else "abcdefghijklmnopqrstuvwxyz"
    around = map(chr, range(ord(c) & ~255, (ord(c) | 255) + 1))
    found = "".join(
        x for x in around if unicodedata.category(x) == kind and unicodedata.name(x, "").split(" ")[0] == name
        and x.upper().lower() == x.lower() and len(x.upper()) == len(x.lower()) == 1
    )
    return found if len(found.replace(c, "")) > 0 else "0123456789" if kind[0] == "N" else "abcdefghijklmnopqrstuvwxyz"


class _Draw:
    """Numbers from an HMAC of a key and an entity."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int) -> None:
        self.seed = hmac.new(key, f"{kind}\0{entity}\0{attempt}".encode(), hashlib.sha256).digest()
        self.block, self.pool = 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hashlib.sha256(self.seed + self.block.to_bytes(4, "big")).digest()
            self.block += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value % n

    def of(self, choices):
        return choices[self.below(len(choices))]

    def like(self, text: str) -> str:
        """Digits for digits, letters and marks of the same script and case, all else as it is."""
        return "".join(self.of(own) if (own := _alike(c)) else c for c in text)


def luhn(digits: str) -> int:
    """What the check digit of `digits` with its last one left out should be."""
    total = 0
    for k, c in enumerate(reversed(digits[:-1])):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _iban_check(country: str, body: str) -> str:
    """The two check digits of an IBAN."""
    number = "".join(str(int(c, 36)) for c in f"{body}{country}00")
    return f"{98 - int(number) % 97:02d}"


def initial(key: bytes, letter: str) -> str:
    """What stands for an initial: the next letter in a keyed cycle of its script's letters, so that
    different ones stay different and none stays itself."""
    own = "".join(sorted({*_alike(letter.lower()), letter.lower()}))
    cycle = sorted(own, key=lambda c: hmac.new(key, f"initial\0{c}".encode(), hashlib.sha256).digest())
    return cycle[(cycle.index(letter.lower()) + 1) % len(cycle)]


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """What stands for an entity, in the entity's plain form, which later attempts widen."""
    draw = _Draw(key, kind, entity, attempt)
    more = max(0, attempt - WIDEN + 1)
    if kind == "email":
        local, _, domain = entity.partition("@")
        host, _, top = domain.rpartition(".")
        name = draw.like(local)
        known = host if re.search(r"(^|\.)example$", host) else None
        new = known.rpartition("example")[0] if known is not None else host
        name += draw.like("a" * more)
        return f"{name}@{draw.like(new)}{'example' if known is not None else ''}.{top}"
    if kind == "ip":
        parts = entity.split(".")
        keep = 1 if parts[0] in ("10", "127") else 2 if entity.startswith(("192.168.", "172.16.")) else 0
        if more and keep:
            parts, keep = ["10", *parts[1:]], 1
        if more > WIDEN:
            keep = 0
        if more > 3 * WIDEN:
            return "fd" + ":".join([f"{draw.below(256):02x}", *(f"{draw.below(1 << 16):x}" for _ in range(7))])
        return ".".join([*parts[:keep], *(str(draw.below(254) + 1) for _ in parts[keep:])])
    if kind == "ipv6":
        if attempt > WIDEN:
            return ":".join(f"{draw.below(1 << 16):x}" for _ in range(8))
        kept = re.match(r"(?:fe80|f[cd][0-9a-f]{2}|ff[0-9a-f]{2}):", entity)
        head = kept[0] if kept else ""
        return head + re.sub(
            r"[0-9a-f]+", lambda m: draw.of("123456789abcdef") + "".join(draw.of("0123456789abcdef") for _ in m[0][1:]),
            entity[len(head):],
        )
    if kind == "iban":
        country, body = entity[:2], draw.like(entity[4:]) + "".join(str(draw.below(10)) for _ in range(more))
        return f"{country}{_iban_check(country, body)}{body}"
    if kind == "key":
        head = re.match(r"AKIA|ASIA|gh[pousr]_|AIza|sk-|xox[abprs]-|eyJ", entity)[0]
        return head + draw.like(entity[len(head):] + "a" * more)
    if kind == "secret":
        hexes = set(entity) <= set("0123456789abcdef")
        if hexes:
            return "".join(draw.of("0123456789abcdef") for _ in range(len(entity) + more))
        return draw.like(entity + "a" * more)
    if kind.startswith("name-"):
        _, gender, alphabet, n = kind.split("-")
        syllables = "".join(draw.of(SYLLABLES[alphabet]) for _ in range(attempt))
        given = [name for g, names in GIVEN[alphabet].items() if gender in (g, "n") for name in names]
        return (draw.of(given if n == "given" else FAMILY[alphabet]) + syllables).casefold()
    if kind == "card":
        digits = draw.of("123456789") + "".join(str(draw.below(10)) for _ in range(len(entity) - 2 + more))
        check = luhn(digits + "0")
        valid = luhn(entity) == int(entity[-1])
        return digits + str(check if valid else (check + 1 + draw.below(9)) % 10)
    if kind == "phone":
        keep = len(entity) - 10 if len(entity) > 10 else 0
        return entity[:keep] + "".join(str(draw.below(10)) for _ in range(len(entity) - keep + more))
    return "".join(str(draw.below(10)) for _ in range(len(entity) + more))


def formatted(mention: str, kind: str, plain: str) -> str:
    """A surrogate in the format of a mention."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(plain)
        return "".join(next(digits) if c.isdigit() else c for c in mention) + "".join(digits)
    if kind == "iban":
        rest = iter(plain)
        return "".join(next(rest, "") if c != " " else c for c in mention) + "".join(rest)
    if kind.startswith(("name-", "initial-")):
        return plain.upper() if mention.isupper() and len(mention) > 1 else plain.capitalize()
    if kind == "email" and mention.isupper():
        return plain.upper()
    return plain


def _detected(secret: bytes):
    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for start, end, kind, entity, counts in parts(text):
                    plain = initial(secret, entity) if kind.startswith("initial-") else None
                    rows.append((key, start, end, kind, entity, counts, plain))
            if rows:
                kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    names=["key", "start", "end", "kind", "entity", "counts", "own"],
                )

    return detect


def _drawn(key: bytes):
    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, entities, attempts = (batch.column(c).to_pylist() for c in ("kind", "entity", "attempt"))
            made = [surrogate(key, k, e, a) for k, e, a in zip(kinds, entities, attempts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kind"), batch.column("entity"), batch.column("attempt"), pa.array(made, pa.string())],
                names=["kind", "entity", "attempt", "plain"],
            )

    return draw


def own_key(spark: SparkSession) -> bytes:
    """The session's key, or one that nobody knows."""
    stated = spark.conf.get(KEY_CONF, None)
    return stated.encode() if stated else secrets.token_bytes(32)


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, plain) for distinct (kind, entity): no two entities of a kind share a
    surrogate and no surrogate is an entity of its kind, all kinds of names taken as one."""
    group = F.substring_index("kind", "-", 1).alias("group")
    real = entities.select(group, F.col("entity").alias("plain")).distinct().withColumn("taken", F.lit(True))
    drawn, settled, attempt = entities.select("kind", "entity"), None, 0
    while True:
        made, _ = materialize(
            drawn.withColumn("attempt", F.lit(attempt))
            .mapInArrow(_drawn(key), "kind string, entity string, attempt int, plain string").drop("attempt"),
            "surrogates",
        )
        # Settled entities keep theirs; of those that draw now, the least has a surrogate.
        own = F.struct("kind", "entity")
        made = made.select("*", group)
        first = made.groupBy("group", "plain").agg(F.min(own).alias("first"))
        taken = real if settled is None else real.union(
            settled.select(group, "plain").withColumn("taken", F.lit(True))
        ).distinct()
        judged = made.join(first, ["group", "plain"]).join(taken, ["group", "plain"], "left").withColumn(
            "clash", (F.col("first") != own) | F.coalesce("taken", F.lit(False))
        )
        judged, _ = materialize(judged.select("kind", "entity", "plain", "clash"), "judged")
        kept = judged.filter("NOT clash").drop("clash")
        settled = kept if settled is None else settled.union(kept)
        drawn, left = materialize(judged.filter("clash").select("kind", "entity"), "clashing")
        if not left:
            return settled
        attempt += 1


def _replaced(name: str, schema_names: list[str]):
    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            at = batch.schema.names.index(name)
            for text, edits in zip(batch.column(at).to_pylist(), batch.column("__edits").to_pylist(), strict=True):
                parts, done = [], 0
                for e in edits or []:
                    parts += [text[done:e["start"]], formatted(text[e["start"]:e["end"]], e["kind"], e["plain"])]
                    done = e["end"]
                texts.append("".join([*parts, text[done:]]) if edits else text)
                counts.append(sum(e["counts"] for e in edits or []))
            columns = {c: batch.column(c) for c in batch.schema.names}
            columns[name] = pa.array(texts, pa.string())
            columns["n_replaced"] = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([columns[c] for c in schema_names], names=schema_names)

    return replace


def replace_pii(docs: DataFrame, text: str = "text", key: bytes | None = None) -> DataFrame:
    """`docs` with surrogates in `text`, and how many mentions were replaced in `n_replaced`."""
    key = own_key(docs.sparkSession) if key is None else key
    kept = [c for c in docs.columns if c not in ("n_replaced", "__key", "__edits")]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    column = F.col(f"`{text}`")
    some, _ = materialize(docs.filter(maybe(column)).withColumn("__key", F.unhex(F.md5(column))), "suspects")
    found = some.select(F.col("__key").alias("key"), column.alias("text")).mapInArrow(
        _detected(key),
        "key binary, start bigint, end bigint, kind string, entity string, counts boolean, own string",
    )
    found, _ = materialize(found.distinct(), "mentions")
    entities = found.filter(F.isnull("own")).select("kind", "entity").distinct()
    table, _ = materialize(surrogates(entities, key), "table")
    edits = found.join(table, ["kind", "entity"], "left").withColumn("plain", F.coalesce("own", "plain"))
    edits = edits.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "kind", "plain", "counts"))).alias("__edits")
    )
    names = [*kept, "n_replaced"]
    schema = docs.withColumn("n_replaced", F.lit(0).cast("bigint")).schema
    changed = some.join(edits.withColumnRenamed("key", "__key"), "__key", "left").drop("__key").mapInArrow(
        _replaced(text, names), schema
    )
    return docs.filter(~maybe(column)).withColumn("n_replaced", F.lit(0).cast("bigint")).unionByName(changed)
