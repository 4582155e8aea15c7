"""Matching of people's names, one to one within blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.functions.text import _metaphone, fold_accents, likenesses, name_tokens, normal_name
from fieldglass.staging import fresh, shuffle_partitions, stage


def _soundex(s: str) -> str:
    digits = {c: d for d, letters in (("1", "BFPV"), ("2", "CGJKQSXZ"), ("3", "DT"), ("4", "L"), ("5", "MN"), ("6", "R")) for c in letters}
    s = "".join(c for c in s.upper() if "A" <= c <= "Z")
    out, last = s[:1], digits.get(s[:1], "")
    for c in s[1:]:
        code = digits.get(c, "")
        if code and code != last:
            out += code
        if c not in "HW":
            last = code
    return (out + "000")[:4] if s else ""


def _agree(a: str, b: str) -> bool:
    return a == b or (1 in (len(a), len(b)) and a[:1] == b[:1])


def _within(few: list[str], many: list[str]) -> bool:
    """Whether all of `few` agree with parts of `many`, in order."""
    at = 0
    for part in few:
        while at < len(many) and not _agree(part, many[at]):
            at += 1
        if at == len(many):
            return False
        at += 1
    return True


def _ends(short: list[str], long: list[str], same: Callable[[str, str], bool]) -> bool:
    """First parts agree, last parts are the same in some way, and those between fit."""
    return _agree(short[0], long[0]) and same(short[-1], long[-1]) and _within(short[1:-1], long[1:-1])


def _sounds(key: Callable[[str], str]) -> Callable[[str, str], bool]:
    """Whether two different parts have one key; keys are kept, as parts come up in many pairs."""
    known: dict[str, str] = {}

    def same(a: str, b: str) -> bool:
        if len(known) > 100_000:
            known.clear()
        for part in (a, b):
            if part not in known:
                known[part] = key(part)
        return a != b and known[a] == known[b]

    return same


#: Kinds of match of the shorter list of parts with the longer, in the order in which they are tried, with
#: their ranks.
RULES: list[tuple[str, int, Callable[[list[str], list[str]], bool]]] = [
    ("tail", 4, lambda s, l: len(s) > 1 and s == l[-len(s) :]),
    ("initials+tail", 3, lambda s, l: len(s) > 1 and all(map(_agree, s, l[-len(s) :]))),
    ("prefix", 3, lambda s, l: len(s) > 1 and all(map(_agree, s, l))),
    ("middle-optional", 3, lambda s, l: len(s) > 1 and _ends(s, l, str.__eq__)),
    ("phonetic", 2, lambda s, l: len(s) > 1 and _ends(s, l, _sounds(_metaphone))),
    ("mononym", 1, lambda s, l: len(s) == 1 and s[0] in l),
    ("soundex", 0, lambda s, l: len(s) > 1 and _ends(s, l, _sounds(_soundex))),
]


#: What matches are called in results where that isn't their rule's own name. Equal folded names go before all rules.
KINDS = {"tail": "initials+tail"}
EQUAL = ("norm", 5)


def match_kind(a: list[str], b: list[str]) -> tuple[str, int] | None:
    """The kind and rank of the match of two names given by their parts."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    return next(((kind, rank) for kind, rank, rule in RULES if short and rule(short, long)), None)


def _as_partner(folded: str, parts: Sequence[str]) -> set[str]:
    """What a name of the right side is filed under. By every rule the last part of the shorter name agrees with a part of the
    longer one, or sounds like its last part; with `_as_seeker` each pair that can match shares a key."""
    keys = {f"folded {folded}", *(f"part {p}" for p in parts), *(f"starts {p[:1]}" for p in parts)}
    return keys | _sounding(parts) | {k for p in parts[-1:] for k in (f"last {p}", f"last starts {p[:1]}")}


def _sounding(parts: Sequence[str]) -> set[str]:
    """Names that match by sound agree in their first part, and so in its first letter."""
    return {k for p in parts[-1:] for k in (f"sound {parts[0][:1]} {_metaphone(p)}", f"code {parts[0][:1]} {_soundex(p)}")}


def _as_seeker(folded: str, parts: Sequence[str]) -> set[str]:
    """What a name of the left side is looked for under."""
    keys = {f"folded {folded}"} | _sounding(parts)
    for last in parts[-1:]:
        keys |= {f"part {last}", f"part {last[:1]}"} | ({f"starts {last}"} if len(last) == 1 else set())
    for part in parts:
        keys |= {f"last {part}", f"last {part[:1]}"} | ({f"last starts {part}"} if len(part) == 1 else set())
    return keys


def _with_keys(df: DataFrame, name: str, keys_of: Callable[[str, Sequence[str]], set[str]]) -> DataFrame:
    """A row for each key of each name, with the name folded and normal."""

    @F.pandas_udf("array<string>")
    def keys(folded: pd.Series, parts: pd.Series) -> pd.Series:
        return pd.Series([sorted(keys_of(f, list(p))) for f, p in zip(folded, parts, strict=True)], dtype=object)

    known = df.where(F.col(name).isNotNull()).repartition(shuffle_partitions(df.sparkSession), "block", name).withColumns({"folded": fold_accents(F.col(name)), "normal": normal_name(F.col(name)), "parts": name_tokens(F.col(name))})
    return known.withColumn("key", F.explode(keys("folded", "parts"))).drop("parts")


def _judged(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of pairs of names those that match: how, of which rank and how like each other they are, both as what is less is better."""
    split = lambda normal: [p for p in normal.split(" ") if p]
    for part in parts:
        columns = zip(part["folded"], part["normal"], part["right_folded"], part["right_normal"], strict=True)
        found = [EQUAL if fa == fb else match_kind(split(na), split(nb)) for fa, na, fb, nb in columns]
        part = part[[f is not None for f in found]]
        found = [f for f in found if f]
        out = part[["block", "id", "left_name", "right_name"]].copy()
        out["kind"], out["less_rank"] = [KINDS.get(k, k) for k, _ in found], [-r for _, r in found]
        out["less_like"] = -likenesses(part["normal"].tolist(), part["right_normal"].tolist())
        yield out


def assign(edges: DataFrame, block: str, left: str, right: str, best: Sequence[str]) -> DataFrame:
    """One-to-one pairs out of `edges` (block, left, right and other columns): those that a loop over all edges takes that goes in
    the order `best`, then left, then right (all ascending), and takes an edge whose two ends are free.

    Edges that are the first of all at either end are what that loop takes whatever happens elsewhere. So each round takes them
    all, by two aggregations and two joins, and drops the other edges of their ends, until no edge is left. Rounds follow the
    longest chain of edges of which each waits for the one before it. Rows are not null in block, left and right; a pair
    that is there several times is one. `edges` is staged.
    """
    order = F.struct(*best, left, right)
    columns, taken, rest = edges.columns, [], edges
    got, gave = fresh(edges, "got", "gave")
    while True:
        mine = rest.groupBy(block, left).agg(F.min(order).alias("first")).select(block, left, F.col(f"first.{right}").alias(right))
        theirs = rest.groupBy(block, right).agg(F.min(order).alias("first")).select(block, right, F.col(f"first.{left}").alias(left))
        now = mine.join(theirs, [block, left, right])
        ends = rest.join(now.select(block, left, F.col(right).alias(got)), [block, left], "left").join(now.select(block, right, F.col(left).alias(gave)), [block, right], "left")
        marked = stage(ends)
        taken.append(marked.where(F.col(got) == F.col(right)).select(*columns).dropDuplicates([block, left, right]))
        rest = marked.where(F.col(got).isNull() & F.col(gave).isNull()).select(*columns)
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, taken)


def match_names(left: DataFrame, right: DataFrame, block: str, left_name: str, right_id: str, right_name: str, confirmed: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Match names of `left` (block, name) to rows of `right` (block, id, name), one to one within a block.

    First the pairs in `confirmed` (id, left name); then right names that several ids share are put aside; then equal names;
    then the pairs of the best rank and likeness, ties by left name and id, each name once. Returns the matches (block, id,
    left name, right name, kind), the ids left over and the names left over. Only names that the joins leave come to the
    last step. There, pairs that can match share a key by which they are joined, and `assign` takes them in rounds, so that
    no block has to fit a task. A null block or name matches nothing.
    """
    names = left.select(F.col(block).alias("block"), F.col(left_name).alias("left_name")).distinct()
    ids = right.select(F.col(block).alias("block"), F.col(right_id).alias("id"), F.col(right_name).alias("right_name"))
    by_hand = ids.sparkSession.createDataFrame([], "id string, left_name string") if confirmed is None else confirmed
    by_hand = ids.join(by_hand.select(F.col("id").cast(ids.schema["id"].dataType), "left_name"), "id").withColumn("kind", F.lit("confirmed")).select("block", "id", "left_name", "right_name", "kind")
    rest = ids.join(by_hand, "id", "left_anti")
    single = rest.withColumn("n", F.count("*").over(Window.partitionBy("block", "right_name"))).where("n = 1").drop("n")
    open_names = names.join(by_hand, ["block", "left_name"], "left_anti")
    equal = single.join(open_names, (single.block == open_names.block) & (single.right_name == open_names.left_name)).select(single.block, "id", "left_name", "right_name", F.lit("equal").alias("kind"))
    equal = stage(equal)
    seekers = _with_keys(open_names.join(equal, ["block", "left_name"], "left_anti"), "left_name", _as_seeker)
    partners = _with_keys(single.join(equal, "id", "left_anti"), "right_name", _as_partner)
    partners = partners.withColumnsRenamed({"folded": "right_folded", "normal": "right_normal"})
    pair = ["block", "left_name", "id"]
    pairs = seekers.join(partners, ["block", "key"]).drop("key").repartition(shuffle_partitions(left.sparkSession), *pair).dropDuplicates(pair)
    types = {f.name: f.dataType.simpleString() for f in ids.schema}
    edges = stage(pairs.mapInPandas(_judged, f"block {types['block']}, id {types['id']}, left_name string, right_name string, kind string, less_rank int, less_like double"))
    ranked = assign(edges, "block", "left_name", "id", ["less_rank", "less_like"])
    matched = stage(by_hand.unionByName(equal).unionByName(ranked.select("block", "id", "left_name", "right_name", "kind")))
    return matched, ids.join(matched, "id", "left_anti"), names.join(matched, ["block", "left_name"], "left_anti")
