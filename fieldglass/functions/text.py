"""String functions on columns. All but metaphone and similarity stay in the JVM."""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Sequence
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Administrative qualifiers around a city's name, tried in this order; the group is the name.
QUALIFIERS = (
    r"(?i)^\d+(?:st|nd|rd|th)\s+arrondissement of\s+(.+)$",
    r"(?i)^(.+?)\s+city district$",
    r"^(.+?)\s+Municipality$",
    r"(?i)^(.+?)\s+district$",
)
#: Particles that belong to the surname after them.
PARTICLES = ("abu", "al", "bani", "ben", "bin", "da", "de", "del", "della", "den", "der", "di", "do", "dos", "du", "el", "la", "le", "st", "ten", "ter", "van", "von")
#: Characters that an encoded title keeps besides letters and digits.
TITLE_SAFE = "-._~/:@!$&'()*+,;="


@cache
def _folds() -> tuple[str, str]:
    """Letters of the Latin blocks that decompose to one letter and marks, and those letters."""
    pairs = ((chr(i), "".join(c for c in unicodedata.normalize("NFD", chr(i)) if not unicodedata.combining(c))) for i in range(0xC0, 0x2000))
    pairs = [(a, b) for a, b in pairs if len(b) == 1 and a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_accents(c: Column) -> Column:
    """Without accents, in lower case and trimmed."""
    return F.trim(F.lower(F.translate(F.regexp_replace(c, r"\p{M}", ""), *_folds())))


def normal_name(c: Column) -> Column:
    """A name for comparison: folded, with sharp s and dotless i spelled out, hyphens as spaces and no points."""
    c = F.replace(F.replace(F.replace(fold_accents(c), F.lit("ß"), F.lit("ss")), F.lit("ı"), F.lit("i")), F.lit("-"), F.lit(" "))
    c = F.replace(F.regexp_replace(c, r"\.(?=\S)", ". "), F.lit("."), F.lit(""))
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def name_tokens(c: Column) -> Column:
    """The parts of a normal name; none for an empty one."""
    return F.filter(F.split(normal_name(c), " "), lambda t: t != "")


def latin_letters(c: Column) -> Column:
    """Folded, with nothing but a-z and spaces kept."""
    return F.trim(F.regexp_replace(fold_accents(c), "[^a-z ]", ""))


def strip_notes(c: Column) -> Column:
    """Without bracketed footnotes and parentheses."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\[[\w\s]*\]", ""), r"\(.*?\)", ""))


def strip_code(c: Column) -> Column:
    """Without a code of three capitals in parentheses at the end."""
    return F.trim(F.regexp_replace(c, r"\s*\([A-Z]{3}\)\s*$", ""))


def split_place(c: Column) -> Column:
    """A struct (first, last) of the comma-separated parts of a place; a single part is the last."""
    text = strip_notes(c)
    text = F.when(F.lower(text).isin("nan", "—", "-"), "").otherwise(text)
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p))
    return F.struct(F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).otherwise("").alias("first"), F.element_at(parts, -1).alias("last"))


def strip_qualifier(c: Column, patterns: Sequence[str] = QUALIFIERS) -> Column:
    """The plain name in the first pattern that matches, else null."""
    return F.coalesce(*(F.when(c.rlike(p), F.regexp_extract(c, p, 1)) for p in patterns))


def given_and_surname(c: Column) -> Column:
    """`SURNAME Given ...` as `Given Surname`, with a capital after each character that is no letter."""
    parts = F.split(F.trim(c), r"\s+")
    upper = F.filter(parts, lambda p: (p == F.upper(p)) & (F.length(p) > 1))
    other = F.filter(parts, lambda p: ~((p == F.upper(p)) & (F.length(p) > 1)))
    titled = F.array_join(F.transform(F.split(F.lower(F.array_join(upper, " ")), r"(?<=[^\p{L}])"), F.initcap), "")
    return F.trim(F.concat_ws(" ", F.get(other, F.lit(0)), titled))


def surname(c: Column, particles: Sequence[str] = PARTICLES) -> Column:
    """The last part of a name with the particles right before it, the first part aside; a name of one part is its own surname."""
    parts = F.filter(F.split(F.trim(c), r"\s+"), lambda p: p != "")
    before = F.slice(F.reverse(parts), 2, F.greatest(F.size(parts) - 2, F.lit(0)))
    known = F.array(*map(F.lit, particles))
    run = F.aggregate(
        before, F.struct(F.lit(True).alias("on"), F.lit(0).alias("n")),
        lambda s, p: F.struct((s.on & F.array_contains(known, F.lower(p))).alias("on"), (s.n + F.when(s.on & F.array_contains(known, F.lower(p)), 1).otherwise(0)).alias("n")),
        lambda s: s.n,
    )
    return F.array_join(F.slice(parts, -(run + 1), run + 1), " ")


def title_of_link(c: Column, prefix: str = "/wiki/") -> Column:
    """The title in a link whose path starts with `prefix`, else null; links may be absolute, or lack host or scheme. A percent
    sign that encodes nothing stands for itself."""
    path = F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    raw = F.regexp_replace(F.replace(F.substr(path, F.lit(len(prefix) + 1)), F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(F.startswith(path, F.lit(prefix)), F.replace(F.url_decode(raw), F.lit("_"), F.lit(" ")))


def link_of_title(c: Column) -> Column:
    """A title as a path: spaces as underscores, the rest percent-encoded but for the safe characters."""
    encoded = F.replace(F.url_encode(F.replace(c, F.lit(" "), F.lit("_"))), F.lit("+"), F.lit("%20"))
    return reduce(lambda out, ch: F.replace(out, F.lit(f"%{ord(ch):02X}"), F.lit(ch)), TITLE_SAFE, encoded)


def page_address(language: Column, title: Column, site: str = "wikipedia.org") -> Column:
    """The address of a title's page in a language."""
    return F.concat(F.lit("https://"), language, F.lit(f".{site}/wiki/"), link_of_title(title))


def last_token(c: Column) -> Column:
    return F.element_at(F.split(F.trim(c), r"\s+"), -1)


def id_list(c: Column, separator: str = ";") -> Column:
    """The ids in a joined list; none for an empty one."""
    return F.filter(F.split(c, separator), lambda x: x != "")


def joined_ids(c: Column, separator: str = ";") -> Column:
    return F.array_join(F.array_sort(F.array_distinct(c)), separator)


def compatible(a: Column, b: Column) -> Column:
    """Whether two parts of a name agree: equal, or one is the other's initial."""
    first = F.substring(a, 1, 1) == F.substring(b, 1, 1)
    return (a == b) | (((F.length(a) == 1) | (F.length(b) == 1)) & first)


def tail_compatible(a: Column, b: Column) -> Column:
    """Whether the shorter list of parts agrees with the end of the longer, part by part."""
    return F.forall(F.zip_with(F.reverse(a), F.reverse(b), lambda x, y: x.isNull() | y.isNull() | compatible(x, y)), lambda ok: ok)


@F.pandas_udf(T.StringType())
def metaphone(names: pd.Series) -> pd.Series:
    """A phonetic key of English consonants; vowels count at the start only."""
    return names.map(_metaphone, na_action="ignore")


def _metaphone(name: str) -> str:
    s = "".join(c for c in unicodedata.normalize("NFD", name.upper()) if "A" <= c <= "Z")
    for start, new in (("KN", "N"), ("GN", "N"), ("PN", "N"), ("WR", "R"), ("AE", "E"), ("X", "S"), ("WH", "W")):
        if s.startswith(start):
            s = new + s[len(start) :]
            break
    out: list[str] = []
    at = lambda i: s[i] if 0 <= i < len(s) else ""
    i = 0
    while i < len(s):
        c, after, before = s[i], at(i + 1), at(i - 1)
        if c == before and c != "C":
            i += 1
            continue
        soft, vowel_next = after in "EIY" and after, after and after in "AEIOU"
        code = c
        if c in "AEIOU":
            code = c if i == 0 else ""
        elif c == "B":
            code = "" if before == "M" and not after else "B"
        elif c == "C":
            code = "X" if after == "H" or s[i : i + 3] == "CIA" else "" if soft and before == "S" else "S" if soft else "K"
            i += after == "H"
        elif c == "D":
            code = "J" if after == "G" and at(i + 2) in ("E", "I", "Y") else "T"
        elif c == "G":
            code = "" if (after == "H" and at(i + 2) not in tuple("AEIOU")) or (after == "N" and i + 2 >= len(s)) else "J" if soft else "K"
            code = "" if before == "D" and soft else code
        elif c == "H":
            code = "H" if vowel_next and before not in tuple("CSPTG") else ""
        elif c == "K":
            code = "" if before == "C" else "K"
        elif c == "P":
            code = "F" if after == "H" else "P"
        elif c == "Q":
            code = "K"
        elif c == "S":
            code = "X" if after == "H" or s[i : i + 3] in ("SIO", "SIA") else "S"
        elif c == "T":
            code = "0" if after == "H" else "X" if s[i : i + 3] in ("TIO", "TIA") else "" if s[i : i + 3] == "TCH" else "T"
        elif c == "V":
            code = "F"
        elif c in "WY":
            code = c if vowel_next else ""
        elif c == "X":
            code = "KS"
        elif c == "Z":
            code = "S"
        out.append(code)
        i += 1
    return "".join(out)


#: Strings of this length and more are compared one pair at a time, as frequent characters then count for nothing.
LONG = 200
#: Cells (pairs by characters by characters) that are looked at together.
CELLS = 4_000_000


def _points(texts: Sequence[str], lengths: np.ndarray, most: int, none: int) -> np.ndarray:
    out = np.full((len(texts), most), none, np.int32)
    out[np.arange(most) < lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def _longest(a: np.ndarray, b: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each span (row, a from, a to, b from, b to) the longest run that both sides have in it: where it starts in a and in
    b, and its length. Of runs of one length the first in a counts, then the first in b."""
    wide, high = (spans[:, 4] - spans[:, 3]).max(), (spans[:, 2] - spans[:, 1]).max()
    at_b = spans[:, 3, None] + np.arange(wide)
    inside = at_b < spans[:, 4, None]
    other = np.where(inside, b[spans[:, 0, None], np.minimum(at_b, b.shape[1] - 1)], -2)
    size, start_a, start_b = (np.zeros(len(spans), np.int64) for _ in range(3))
    run = np.zeros((len(spans), wide), np.int16)
    for step in range(high):
        at_a = spans[:, 1] + step
        mine = np.where(at_a < spans[:, 2], a[spans[:, 0], np.minimum(at_a, a.shape[1] - 1)], -1)
        run[:, 1:] = run[:, :-1]
        run[:, 0] = 0
        run = np.where(other == mine[:, None], run + np.int16(1), np.int16(0))
        best = run.argmax(axis=1)  # the first of the longest that end here
        length = run[np.arange(len(spans)), best].astype(np.int64)
        #: Runs of one length that end later start later, so only a longer one counts.
        better = length > size
        size[better], start_a[better], start_b[better] = length[better], (at_a + 1 - length)[better], (spans[:, 3] + best + 1 - length)[better]
    return start_a, start_b, size


def likenesses(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Twice the matching characters over all characters of each pair of strings, 1 for two empty ones: the longest run that both
    have, and in turn those to the left and to the right of it. All pairs of strings below LONG go together, step by step, each
    step finding the longest runs of all open parts; longer ones go one by one."""
    la, lb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    matched = np.zeros(len(a), np.int64)
    together = np.flatnonzero((la < LONG) & (lb < LONG))
    order = together[np.argsort(np.maximum(la, lb)[together], kind="stable")]
    first = 0
    while first < len(order):
        largest = np.maximum(la, lb)[order[first:]] ** 2
        last = first + max(1, int(np.searchsorted(np.arange(1, len(largest) + 1) * largest, CELLS)))
        rows = order[first:last]
        first = last
        one = _points([a[i] for i in rows], la[rows], max(1, int(la[rows].max())), -1)
        two = _points([b[i] for i in rows], lb[rows], max(1, int(lb[rows].max())), -2)
        zero = np.zeros(len(rows), np.int64)
        spans = np.stack([np.arange(len(rows)), zero, la[rows], zero, lb[rows]], axis=1)
        while len(spans := spans[(spans[:, 1] < spans[:, 2]) & (spans[:, 3] < spans[:, 4])]):
            at_a, at_b, size = _longest(one, two, spans)
            found = size > 0
            spans, at_a, at_b, size = spans[found], at_a[found], at_b[found], size[found]
            np.add.at(matched, rows[spans[:, 0]], size)
            left = np.stack([spans[:, 0], spans[:, 1], at_a, spans[:, 3], at_b], axis=1)
            right = np.stack([spans[:, 0], at_a + size, spans[:, 2], at_b + size, spans[:, 4]], axis=1)
            spans = np.concatenate([left, right])
    total = la + lb
    out = np.where(total > 0, 2.0 * matched / np.maximum(total, 1), 1.0)
    for i in np.flatnonzero((la >= LONG) | (lb >= LONG)):
        out[i] = difflib.SequenceMatcher(None, a[i], b[i]).ratio()
    return out


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Twice the matching characters over all characters of two strings; null if either is."""
    there = (a.notna() & b.notna()).to_numpy()
    out = pd.Series(np.nan, index=a.index, dtype="float64").astype(object).where(there, None)
    out[there] = likenesses(a[there].tolist(), b[there].tolist())
    return out.astype("Float64")
