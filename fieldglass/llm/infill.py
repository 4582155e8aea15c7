"""Fill-in-the-middle: documents cut at token borders by a parallel automaton scan.

Tokens are a run of white space with the word after it, and white space at the end. The automaton has two states, between words
and within one, and counts each step out of a word, where a token ends. A chunk of text doesn't know the state it begins in,
so it gives its result for each: the state at its end and the ends it counts. Such functions compose, in any grouping, and
their composition tells each chunk its entry state and the ends before it; then the chunk that holds a wanted end finds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

BETWEEN, WITHIN = 0, 1
#: Texts of more bytes are cut into chunks of so many, which are scanned apart from each other.
CHUNK = 1 << 20
#: Bytes that a task scans at a time.
BYTES_AT_ONCE = 1 << 22
#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Scan:
    """Chunks (bytes of texts in UTF-8, laid end to end; `at` holds where each begins, and the end) and their functions."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        self.data, self.at = data, at
        space = _SPACE[data]
        ends = np.zeros(len(data), bool)
        np.logical_and(space[1:], ~space[:-1], out=ends[1:])
        full = at[1:] > at[:-1]
        first, last = at[:-1][full], at[1:][full] - 1
        ends[first] = False  # what comes before a chunk isn't known to it
        self.places = np.flatnonzero(ends)
        self.before = np.searchsorted(self.places, at)
        self.opens = np.zeros(len(full), bool)
        self.opens[full] = space[first]
        inner = np.diff(self.before)
        #: By start state and chunk: the state at the end, and how many ends it counts. A chunk without bytes changes nothing.
        self.next = np.repeat([[BETWEEN], [WITHIN]], len(full), axis=1)
        self.next[:, full] = np.where(space[last], BETWEEN, WITHIN)
        self.ends = np.stack([inner, inner + self.opens])

    def chars(self) -> np.ndarray:
        """The code points of each chunk."""
        return np.diff(np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])[self.at])

    def select(self, chunk: np.ndarray, start: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The code points of `chunk`, entered in state `start`, before its `nth` end (from 1)."""
        early = ((start == WITHIN) & self.opens[chunk]).astype(np.int64)  # the chunk's first byte ends a word that began before it
        inner = nth - early - 1
        place = self.at[chunk].copy()
        later = inner >= 0
        place[later] = self.places[self.before[chunk[later]] + inner[later]]
        points = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        return points[place] - points[self.at[chunk]]


def scans(column: pa.Array) -> Iterator[tuple[int, Scan]]:
    """The chunks of a string or binary column, some bytes of them at a time, with the row at which they start."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + BYTES_AT_ONCE, "right")) - 1)
        yield first, Scan(data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def _cuts(text: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    """For whole texts in one chunk each: the tokens, and the code points before the two cuts."""
    h = np.stack([h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False)])
    n, places = np.zeros(len(text), np.int64), np.zeros((2, len(text)), np.int64)
    for first, scan in scans(text):
        rows = np.arange(len(scan.at) - 1)
        own = slice(first, first + len(rows))
        n[own] = scan.ends[BETWEEN] + (np.diff(scan.at) > 0)
        wanted = np.sort(h[:, own] % (n[own] + 1), axis=0)
        chars = scan.chars()
        for which in (0, 1):
            k = wanted[which]
            inside = (k > 0) & (k < n[own])
            found = np.where(k == 0, 0, chars)
            found[inside] = scan.select(rows[inside], np.full(inside.sum(), BETWEEN), k[inside])
            places[which, own] = found
    return pa.StructArray.from_arrays([pa.array(n), *(pa.array(p) for p in places)], ["n", "first", "second"])


def _function(part: pa.Array) -> pa.Array:
    """A chunk's function: by start state the state at its end and the ends it counts; and its code points."""
    found = [(scan.next, scan.ends, scan.chars()) for _, scan in scans(part)]
    pairs = lambda i, kind: pa.array(np.concatenate([f[i] for f in found], axis=1).T.tolist() if found else [], pa.list_(kind))
    chars = pa.array(np.concatenate([f[2] for f in found]) if found else [], pa.int64())
    return pa.StructArray.from_arrays([pairs(0, pa.int32()), pairs(1, pa.int64()), chars], ["next", "ends", "chars"])


def _selected(part: pa.Array, start: pa.Array, nth: pa.Array) -> pa.Array:
    """The code points of a chunk before its nth end, for the state it is entered in."""
    start, nth = start.to_numpy(zero_copy_only=False), nth.to_numpy(zero_copy_only=False)
    found = [scan.select(np.arange(len(scan.at) - 1), start[first : first + len(scan.at) - 1], nth[first : first + len(scan.at) - 1]) for first, scan in scans(part)]
    return pa.array(np.concatenate(found) if found else [], pa.int64())


def composed(functions: Column) -> Column:
    """The composition of chunks' functions (array of next, ends, chars, in order) for a text, which begins between words: for
    each chunk and for the end of all (the last) the state it is entered in, and the ends and code points before it.

    A text has at most 2 GB, so that its chunks are a few thousand."""
    start = F.struct(F.lit(BETWEEN).alias("state"), F.lit(0).cast("long").alias("ends"), F.lit(0).cast("long").alias("chars"))

    def step(so_far: Column, f: Column) -> Column:
        now = F.element_at(so_far, -1)
        by_state = lambda c: F.get(f[c], now["state"])
        return F.array_append(so_far, F.struct(by_state("next").alias("state"), (now["ends"] + by_state("ends")).alias("ends"), (now["chars"] + f["chars"]).alias("chars")))

    return F.aggregate(functions, F.array(start), step)


def _hashes(ident: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def giant_cuts(giants: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """n, first and second by row for texts (row, text, h1, h2: not null; staged) that are scanned in chunks, dealt to all tasks."""
    size = F.octet_length("text")
    pieces = giants.select("row", "text", F.explode(F.sequence(F.lit(0), F.floor((size - 1) / chunk).cast("int"))).alias("chunk"))
    pieces = pieces.select("row", "chunk", F.expr(f"substring(CAST(text AS BINARY), chunk * {chunk} + 1, {chunk})").alias("part"))
    pieces = stage(pieces.repartition("row", "chunk"))
    functions = pieces.select("row", "chunk", F.arrow_udf(_function, "next array<int>, ends array<long>, chars long")("part").alias("f")).select("row", F.struct("chunk", "f.next", "f.ends", "f.chars").alias("f"))
    entries = functions.groupBy("row").agg(F.array_sort(F.collect_list("f")).alias("fs")).select("row", composed(F.col("fs")).alias("entry"))
    known = entries.join(giants.select("row", "h1", "h2"), "row").withColumn("n", F.element_at("entry", -1)["ends"] + 1)
    cuts = [F.col(h) % (F.col("n") + 1) for h in ("h1", "h2")]
    known = stage(known.select("row", "n", "entry", F.least(*cuts).alias("k1"), F.greatest(*cuts).alias("k2")))
    #: The chunk of the kth end is the last that is entered with fewer than k ends before it.
    wanted = known.select("row", "n", "entry", F.posexplode(F.array("k1", "k2")).alias("which", "k"))
    fewer = F.size(F.filter(F.slice("entry", 1, F.size("entry") - 1), lambda e: e["ends"] < F.col("k")))
    wanted = wanted.withColumn("chunk", (fewer - 1).cast("int")).withColumn("at", F.get("entry", "chunk"))
    inside = wanted.where((F.col("k") > 0) & (F.col("k") < F.col("n")))
    inside = inside.select("row", "which", "chunk", F.col("at.state").alias("state"), (F.col("k") - F.col("at.ends")).alias("nth"), F.col("at.chars").alias("before"))
    found = pieces.join(inside, ["row", "chunk"]).select("row", "which", (F.col("before") + F.arrow_udf(_selected, "long")("part", F.col("state").cast("long"), "nth")).alias("place"))
    places = found.groupBy("row").agg(*(F.max(F.when(F.col("which") == i, F.col("place"))).alias(f"p{i}") for i in (0, 1)))
    whole = F.element_at("entry", -1)["chars"]
    ends = lambda k, p: F.coalesce(F.col(p), F.when(F.col(k) == 0, F.lit(0)).otherwise(whole))
    return known.join(places, "row", "left").select("row", "n", ends("k1", "p0").alias("first"), ends("k2", "p1").alias("second"))


def transform(
    docs: DataFrame, *, rate: int = 50, spm: int = 80, seed: int = 42, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rearrange documents for filling in the middle: doc_id, n, form, prefix_chars, middle_chars, text, output.

    A text of n tokens (see above) is cut at two of its n + 1 borders, drawn by a hash of the id; `rate` percent of the texts
    are rearranged, of these `spm` percent with the suffix first (spm), the others with the prefix first (psm). A text that is
    empty or holds a mark stays as it is (plain, null lengths). Texts of more than `chunk` bytes are scanned in chunks of that
    size by all tasks; others, a chunk each, where they lie.

    Nulls: a null text counts as an empty one; a null id is hashed as an empty one, and kept. Rows of one id are cut by the same
    draws; repeated rows are returned each. An empty table gives no rows. Other columns, whatever their names, are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    h = _hashes(F.col("doc_id"), seed)
    rows = rows.select("*", *(c.alias(f"h{i}") for i, c in enumerate(h, 1)))
    small = F.octet_length("text") <= chunk
    giants = stage(rows.where(~small).withColumn("row", F.monotonically_increasing_id()))
    found = giants.join(giant_cuts(giants, chunk), "row").drop("row")
    short = rows.where(small).withColumn("cut", F.arrow_udf(_cuts, "n long, first long, second long")("text", "h1", "h2")).select(*rows.columns, "cut.*")
    found = short.unionByName(found)
    marked = F.greatest(*(F.instr("text", m) for m in (PREFIX, SUFFIX, MIDDLE))) > 0
    plain = (F.length("text") == 0) | marked | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm")
    at = lambda a, b: F.substring(F.col("text"), F.col(a).cast("int") + 1, b)
    most = F.lit((1 << 31) - 1)
    prefix, middle, suffix = F.substring(F.col("text"), F.lit(1), F.col("first").cast("int")), at("first", (F.col("second") - F.col("first")).cast("int")), at("second", most)
    output = F.when(F.col("form") == "plain", F.col("text")).when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
    output = output.otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    own = lambda c: F.when(F.col("form") != "plain", c)
    return found.withColumn("form", form).select("doc_id", "n", "form", own(F.col("first")).alias("prefix_chars"), own(F.col("second") - F.col("first")).alias("middle_chars"), "text", output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    after = lambda mark: F.substring_index(output, mark, -1)
    between = lambda a, b: F.substring_index(F.substring_index(output, b, 1), a, -1)
    psm = F.concat(between(PREFIX, SUFFIX), after(MIDDLE), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
