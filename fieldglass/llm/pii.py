"""Personal data: regular expressions propose spans, checksums and forms confirm them, and words nearby adjust the score."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back

#: Code points before and after a span in which words count.
NEARBY = 40
#: What a word that speaks for a kind adds to a span's score, and one that speaks against it takes off.
FOR, AGAINST = 0.25, 0.3
#: Spans of at least this score are found. Those of the base (see KINDS) always are.
THRESHOLD = 0.6

Spans = Iterator[tuple[int, int]]


def _words(*words: str) -> str:
    """A pattern for any of some words, in letters of either case, that are no part of longer ones."""
    either = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in words)
    return rf"(?:^|[^A-Za-z])(?:{either})(?:[^A-Za-z]|$)"


def digits(span: str) -> str:
    return re.sub("[^0-9]", "", span)


def luhn(number: str) -> bool:
    """Whether the last digit is right: of every second digit before it, doubled, the digits are added."""
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(number))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def mod_97(account: str) -> bool:
    """Whether an account number, its first four characters moved to the end and letters read as 10 to 35, leaves 1."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")


def _emails(text: str) -> Spans:
    """As the kind's pattern finds them; but from each @ on and back, as a run of a thousand letters without any would cost the
    pattern a million steps."""
    end = 0
    for m in _AT_DOMAIN.finditer(text):
        first = max(end, text.rfind("@", end, m.start()) + 1)
        start = first + len(text[first : m.start()].rstrip(_LOCAL))
        if start < m.start():
            end = m.end()
            yield start, end


def _by(pattern: str) -> Callable[[str], Spans]:
    found = re.compile(pattern)
    return lambda text: (m.span() for m in found.finditer(text))


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. `pattern` proposes spans, leftmost first; `propose` finds the same in time linear in the text,
    where the pattern itself wouldn't. `confirm` tells which of them stay, by the span; a span that is not of the base must
    also stand free of letters and digits. `prior` is the score without any words nearby."""

    name: str
    base: bool
    pattern: str
    confirm: Callable[[str], bool]
    prior: float
    near: str
    against: str
    propose: Callable[[str], Spans]


def _kind(name: str, base: bool, pattern: str, confirm: Callable[[str], bool], prior: float, near: str, against: str, propose: Callable[[str], Spans] | None = None) -> Kind:
    return Kind(name, base, pattern, confirm, prior, near, against, propose or _by(pattern))


_OF_CARDS = _words("card", "credit", "debit", "visa", "amex", "mastercard", "diners", "cvv", "carte", "karte", "tarjeta")
_OF_PHONES = _words("tel", "phone", "telephone", "call", "fax", "mobile", "cell", "telefon", "portable", "móvil")
_OF_NUMBERS = _words("order", "invoice", "isbn", "issn", "serial", "version", "sku", "ref")

#: In the order in which spans are listed. The base kinds' patterns are fixed values.
KINDS = [
    _kind("email", True, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True, 0.9, _words("mail", "email", "contact"), _words("git", "ssh"), _emails),
    _kind(
        "ip", True, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(map(byte, s.split("."))), 0.8, _words("ip", "address", "host", "login"), _words("version", "release", "section"),
        _by(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    ),
    _kind("card", True, r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s)), 0.85, _OF_CARDS, _OF_NUMBERS, _by(r"[0-9]++(?:[\x20-][0-9]++)*+")),
    _kind("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15, 0.8, _OF_PHONES, _OF_NUMBERS),
    # What the method adds: numbers that only words nearby tell from others, and accounts by their checksum.
    _kind("card", False, r"[0-9]{4}[\x20-]?[0-9]{6}[\x20-]?[0-9]{3,5}", lambda s: s[0] in "3456" and 13 <= len(digits(s)) <= 15 and luhn(digits(s)), 0.45, _OF_CARDS, _OF_NUMBERS),
    _kind("phone", False, r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", lambda s: True, 0.45, _OF_PHONES, _OF_NUMBERS),
    _kind("iban", False, r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", lambda s: mod_97(s.replace(" ", "")), 0.7, _words("iban", "account", "bank", "konto", "compte", "cuenta"), _OF_NUMBERS),
    _kind("ssn", False, r"[0-9]{3}-[0-9]{2}-[0-9]{4}", lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000", 0.45, _words("ssn", "social", "security", "taxpayer"), _OF_NUMBERS),
]
ORDER = ["email", "ip", "card", "phone", "iban", "ssn"]
_CONTEXT = [(re.compile(k.near), re.compile(k.against)) for k in KINDS]
_JOINED = re.compile("[A-Za-z0-9]")


def score(kind: int, text: str, start: int, end: int) -> float:
    """A span's prior, more if a word nearby speaks for its kind, less if one speaks against it; 0 to 1."""
    around = text[max(0, start - NEARBY) : start], text[end : end + NEARBY]
    near, against = (any(p.search(part) for part in around) for p in _CONTEXT[kind])
    return min(1.0, max(0.0, KINDS[kind].prior + FOR * near - AGAINST * against))


class _Taken:
    """Spans in order, none of which overlap, to be asked whether another overlaps one."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, self.ends = [s for s, _ in spans], [e for _, e in spans]

    def __contains__(self, span: tuple[int, int]) -> bool:
        at = bisect_left(self.starts, span[1]) - 1
        return at >= 0 and self.ends[at] > span[0]


def find(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float, bool]]:
    """The spans of a whole text: kind, start, end (code points, end exclusive), score and whether it is of the base; by kind, as
    listed in ORDER, and start.

    A kind's proposals don't overlap, and one that isn't confirmed is dropped without another try at its place. A span that the
    base lacks is dropped where it overlaps one of the base, or one of a kind before its own in KINDS that is found.
    """
    found: list[tuple[str, int, int, float, bool]] = []
    base: list[_Taken] = []
    before: list[_Taken] = []
    for i, kind in enumerate(KINDS):
        spans = [(s, e) for s, e in kind.propose(text) if kind.confirm(text[s:e])]
        if kind.base:
            base.append(_Taken(spans))
            found += [(kind.name, s, e, score(i, text, s, e), True) for s, e in spans]
            continue
        free = [(s, e) for s, e in spans if not (s and _JOINED.match(text, s - 1)) and not _JOINED.match(text, e) and not any((s, e) in t for t in base)]
        scored = [(s, e, score(i, text, s, e)) for s, e in free]
        scored = [x for x in scored if x[2] >= threshold]
        found += [(kind.name, s, e, p, False) for s, e, p in scored if not any((s, e) in t for t in before)]
        before.append(_Taken([(s, e) for s, e, _ in scored]))
    return sorted(found, key=lambda f: (ORDER.index(f[0]), f[1], f[2]))


def spans(text: Column, threshold: float = THRESHOLD) -> Column:
    """`find` for a column: an array of kind, start, end, score, base. Null and empty texts have none."""

    @F.arrow_udf("array<struct<kind: string, start: long, end: long, score: double, base: boolean>>")
    def found(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in give_back(parts):
            counts, rows = [0], []
            for value in part:
                rows += find(value.as_py() or "", threshold)
                counts.append(len(rows))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
            flat = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["kind", "start", "end", "score", "base"])
            yield pa.ListArray.from_arrays(pa.array(np.array(counts, np.int32)), flat)

    return found(text)


def find_personal_data(docs: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's personal data: doc_id, text, found (an array of kind, start, end, score, base; see `find`).

    Nulls: a null text counts as an empty one, without any; a null id is kept. Repeated rows are returned each. Time is linear in
    a text's length. An empty table gives no rows. Other columns, whatever their names, are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("found", spans(F.col("text"), threshold))


def as_text(found: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, *, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """`docs` with each span of personal data in `text_col` replaced by its kind in angle brackets; of spans that overlap, the
    first (of those that start together, the first kind) stands for all. Other columns and rows stay as they are; a null text
    stays null."""

    @F.arrow_udf("string")
    def without(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in give_back(parts):
            out = []
            for value in part:
                text = value.as_py()
                if text is not None:
                    pieces, at = [], 0
                    for kind, start, end, *_ in sorted(find(text, threshold), key=lambda f: f[1]):
                        if start >= at:
                            pieces += [text[at:start], f"<{kind.upper()}>"]
                        at = max(at, end)
                    text = "".join([*pieces, text[at:]])
                out.append(text)
            yield pa.array(out, pa.string())

    return docs.withColumn(text_col, without(F.col(text_col)))
