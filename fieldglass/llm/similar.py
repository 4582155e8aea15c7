"""Near-duplicates by similarity of word shingles: pigeonring over parts of a document's shingle set, rarest shingles for short
texts, wide SimHash fingerprints to prune, and an exact check.

Fingerprints of 64 bits, of which a few may differ, find only a part of the pairs of a similarity as low as 0.8: one in five
of their bits or so differs. So here the ring's segments are not bits but shingles: a hash deals a document's shingles to
parts. Two sets that differ in few shingles differ in few parts, so some part is the same in both, and documents that share
a part are candidates. Short texts, of which very many may share most of what they have, are filed by their rarest shingles
instead: of a set of n, all but the ceil(0.8 n) - 1 most frequent ones, of which two similar sets share one in any case. A wide
fingerprint tells nearly always whether candidates can be similar enough, by the distribution for sets of their sizes, and
the sets themselves decide. Copies that differ little are found by pigeonring over the first 64 bits as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, drop, give_back, join_hot, shuffle_partitions, stage

#: Words of a fingerprint, of 64 bits each: the more, the fewer candidates that fail.
WIDE = 16
#: Parts of a set by which a document is filed, at most, and the shingles of a part for sets with more parts than that (from half
#: as many up). A pair of similarity 0.8 has a part in common with a chance of 0.226 for the largest parts, and with all 48
#: of them none with a chance of 0.000005; at 0.82 with one of 0.0000001.
PARTS, PART_SIZE = 48, 6
#: Sets of more shingles are filed by their parts. Those of as many and fewer, and larger ones that they may be similar to, by their
#: rarest shingles.
SMALL = 64
#: Sizes up to which the chance that a bit differs is found exactly; that for larger sets is smaller.
EXACT = 256
#: Documents, and words of them, that a task takes at a time; a longer text is taken alone.
DOCS_AT_ONCE, WORDS_AT_ONCE = 512, 1_000_000
#: Bits of a shingle's hash: what the number of the text among those leaves.
HASH_BITS = 64 - 9
#: Words whose hashes a worker keeps; beyond it they are made anew.
KEPT_WORDS = 500_000
#: Pairs of fingerprints that are compared at a time.
CELLS = 2_000_000
#: Nodes of a key up to which their fingerprints are compared in its task.
RUN = 512
#: Sets of a block, and shingles of them, about: two blocks are compared in one task.
BLOCK, BLOCK_SHINGLES = 4096, 4_000_000
#: Numbers of 64 bits that hold the sets of a task, at most; of more different shingles they stay lists.
WORDS_OF_SETS = 4_000_000
EMPTY = 0


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """64-bit numbers, each spread over all bits; one to one for each seed."""
    x = (x ^ np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class WordHashes(dict):
    """XXH64 of words, kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word, 42)
        return out


def shingle_sets(texts: list[str | None], shingle: int, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of each of at most DOCS_AT_ONCE texts, hashed and sorted, one text after the other, and how many
    each has.

    Words are those between ASCII white space, A-Z lower-cased; a text of fewer words than a shingle has one, of all of
    them, and one without words has none.
    """
    if len(texts) > DOCS_AT_ONCE:
        raise ValueError(f"more than {DOCS_AT_ONCE} texts")
    words = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.fromiter((h for own in words for h in map(known.__getitem__, own)), np.uint64, int(lengths.sum()))
    owner, end = np.repeat(np.arange(len(texts)), lengths), np.repeat(np.cumsum(lengths), lengths)
    at = np.arange(len(flat))
    short = np.minimum(lengths, shingle)[owner]
    first = (at + short <= end) & ((short == shingle) | (at + short == end))
    starts, size = at[first], short[first]
    out = np.zeros(len(starts), np.uint64)
    for j in range(shingle):
        inside = size > j
        out[inside] = mixed(out[inside] + flat[starts[inside] + j], j)
    #: Text and hash in one number, which sorts fast.
    both = (owner[first].astype(np.uint64) << np.uint64(HASH_BITS)) | (out >> np.uint64(64 - HASH_BITS))
    both.sort()
    both = both[np.r_[True, both[1:] != both[:-1]]] if len(both) else both
    return both & np.uint64((1 << HASH_BITS) - 1), np.bincount((both >> np.uint64(HASH_BITS)).astype(np.int64), minlength=len(texts))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of `counts` values, modulo 2 ** 64."""
    total = np.r_[np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)]
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def set_ids(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set; EMPTY for an empty one."""
    return np.where(counts > 0, mixed(_sums(mixed(shingles, 11), counts) + counts.astype(np.uint64), 12) | np.uint64(1), np.uint64(EMPTY))


def wide_prints(shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """SimHash fingerprints of 64 * WIDE bits: sets x WIDE.

    Every eighth bit of a hash is counted at once, in the eight bytes of one number, over 255 hashes at a time.
    """
    full = np.flatnonzero(counts)
    pieces = -(-counts[full] // 255)
    of_set = np.cumsum(pieces) - pieces
    place = np.arange(int(pieces.sum())) - np.repeat(of_set, pieces)
    starts = np.repeat((np.cumsum(counts) - counts)[full], pieces) + 255 * place
    out = np.zeros((len(counts), WIDE), np.uint64)
    if not len(full):
        return out
    for word in range(WIDE):
        hashes, ones = mixed(shingles, 20 + word), np.zeros((len(full), 64), np.int64)
        for bit in range(8):
            lanes = np.add.reduceat((hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101), starts)
            ones[:, bit::8] = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64), of_set, axis=0)
        out[full, word] = np.packbits(2 * ones > counts[full][:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def parts_of(level: np.ndarray) -> np.ndarray:
    """Into how many parts sets of 2 ** level shingles, up to twice as many, are dealt: small sets into more, of fewer shingles."""
    size = np.left_shift(1, level)
    few = np.select([level <= 1, level == 2, level == 3, level == 4, level == 5, level == 6], [size, 6, 8, 12, 16, 32], 0)
    return np.where(few > 0, few, -(-2 * size // PART_SIZE))


def part_keys(shingles: np.ndarray, counts: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """For each set the keys of its parts: (set number, key).

    Sets are dealt to parts by their size, to a factor of two; one that another of the next factor may be similar to is filed
    by that as well. Two sets whose part has the same shingles share a key. Sets of up to SMALL shingles have none.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    dealt = mixed(shingles, 31) >> np.uint64(20)
    value = mixed(shingles, 32)
    low = np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64)
    high = np.floor(np.log2(np.maximum(counts, 1) / similarity)).astype(np.int64)
    found = []
    for level, some in ((low, counts > SMALL), (high, (counts > SMALL) & (high > low))):
        part = (dealt % parts_of(level)[owner].astype(np.uint64)).astype(np.int64)
        kept = np.flatnonzero(some[owner] & (part < PARTS))
        place = owner[kept] * PARTS + part[kept]
        order = np.argsort(place, kind="stable")
        place = place[order]
        first = np.flatnonzero(np.diff(place, prepend=-1))
        if not len(first):
            continue
        sums = np.add.reduceat(value[kept[order]], first)
        number, part = np.divmod(place[first], PARTS)
        found.append((number, mixed(sums + ((level[number] * PARTS + part).astype(np.uint64) << np.uint64(40)), 33)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _differ(m: int, n: int, common: int) -> float:
    """The chance that a bit of the fingerprints of two sets of m and n shingles differs, `common` of which are in both."""
    def chances(k: int) -> np.ndarray:
        steps = np.arange(k + 1)
        logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, k + 1)))])
        return np.exp(logs[k] - logs[steps] - logs[k - steps] - k * np.log(2))

    def one(size: int) -> np.ndarray:  # for each number of ones among the common shingles, the chance that the bit is 1
        above = np.concatenate([np.cumsum(chances(size - common)[::-1])[::-1], [0.0]])
        need = size // 2 + 1 - np.arange(common + 1)  # ones that the others must give
        return above[np.clip(need, 0, size - common + 1)]

    a, b = one(m), one(n)
    return float((chances(common) * (a * (1 - b) + b * (1 - a))).sum())


@cache
def most_bits(similarity: float, deviations: float = 5.0) -> np.ndarray:
    """How many bits of two fingerprints may differ if the sets' similarity may reach `similarity`, by the sizes of the sets (up to
    EXACT + 1): the mean for the least similar such sets, and some standard deviations. -1 where sizes are too different.

    A bit is 1 if it is so in over half of the shingles, so that it is less often 1 for an even number of shingles than for
    an odd one; that makes small sets differ more than large ones, the more the smaller.
    """
    bits, out = 64 * WIDE, np.full((EXACT + 2, EXACT + 2), -1, np.int64)
    out[0, 0] = 0
    for m in range(1, EXACT + 2):
        for n in range(m, min(EXACT + 1, int(m / similarity + 1e-9)) + 1):
            common = int(np.ceil(similarity * (m + n) / (1 + similarity) - 1e-9))
            if common <= m:
                p = _differ(m, n, common)
                out[m, n] = out[n, m] = min(bits, int(np.ceil(bits * p + deviations * np.sqrt(bits * p * (1 - p)))))
    return out


def allowed_bits(table: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The most bits by which fingerprints of sets of such sizes may differ, or -1. Large sets take the largest of the table's
    numbers for sizes like theirs."""
    large = np.maximum(one, other) > EXACT
    if not large.any():
        return table[one, other]
    level = np.maximum(0, np.ceil(np.log2(np.maximum(np.maximum(one, other), 1) / EXACT))).astype(np.int64)
    x, y = one >> level, other >> level
    out = table[np.minimum(x, EXACT), np.minimum(y, EXACT)]
    for dx, dy in ((0, 1), (1, 0), (1, 1)):
        out = np.where(large, np.maximum(out, table[np.minimum(x + dx, EXACT + 1), np.minimum(y + dy, EXACT + 1)]), out)
    return out


def nearest_tree(prints: np.ndarray, most: int | np.ndarray, root: np.ndarray | None = None, not_these: tuple[np.ndarray, np.ndarray] | None = None, sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A shortest spanning forest of fingerprints by differing bits, of edges of at most `most`: (one, other, bits). What is
    linked by pairs within some distance is so by the forest's edges within that distance. Memory is in proportion to the
    number of fingerprints. With `sizes`, of the sets, `most` is a table by them.

    Those of one `root` are together already and get no edges to each other. Pairs in `not_these` (both ways) are no edges.
    """
    n = len(prints)
    nearest, bits = np.zeros(n, np.int64), np.full(n, 64 * WIDE + 1)
    one, other, far, at = [], [], [], 0
    open_, place = np.arange(n), np.arange(n)
    if not_these is not None:
        order = np.argsort(not_these[0], kind="stable")
        not_from, not_to = not_these[0][order], not_these[1][order]
    for _ in range(n - 1):
        open_ = open_[open_ != at]
        differ = np.bitwise_count(prints[open_] ^ prints[at]).sum(axis=1, dtype=np.int64)
        if sizes is not None:
            differ[differ > allowed_bits(most, sizes[open_], np.broadcast_to(sizes[at], len(open_)))] = 64 * WIDE + 1
        if root is not None:
            differ[root[open_] == root[at]] = -1
        if not_these is not None:
            barred = not_to[np.searchsorted(not_from, at) : np.searchsorted(not_from, at, side="right")]
            if len(barred):
                place[:] = -1
                place[open_] = np.arange(len(open_))
                barred = place[barred]
                barred = barred[barred >= 0]
                differ[barred] = np.where(differ[barred] < 0, -1, 64 * WIDE + 1)
        closer = differ < bits[open_]
        bits[open_[closer]], nearest[open_[closer]] = differ[closer], at
        at = int(open_[np.argmin(bits[open_])])
        if 0 <= bits[at] <= (64 * WIDE if sizes is not None else most):
            one.append(int(nearest[at]))
            other.append(at)
            far.append(int(bits[at]))
    return np.array(one, np.int64), np.array(other, np.int64), np.array(far, np.int64)


def nearest_pairs(prints: np.ndarray, sizes: np.ndarray, root: np.ndarray, not_these: np.ndarray, table: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each fingerprint the `k` nearest of another root that are as near as sets of their sizes may be: (one, other, bits), each
    pair once. Pairs in `not_these` (both ways, two rows) are left out. Memory is in proportion to the number of fingerprints and k."""
    n, found = len(prints), []
    order = np.argsort(not_these[0], kind="stable")
    barred_from, barred_to = not_these[0][order], not_these[1][order]
    step = max(1, CELLS // max(n, 1))
    for first in range(0, n, step):
        rows = np.arange(first, min(n, first + step))
        differ = np.zeros((len(rows), n), np.int16)
        for word in range(prints.shape[1]):
            differ += np.bitwise_count(prints[rows, word][:, None] ^ prints[:, word][None])
        may = (differ <= allowed_bits(table, *np.broadcast_arrays(sizes[rows][:, None], sizes[None]))) & (root[rows][:, None] != root[None])
        own = slice(np.searchsorted(barred_from, rows[0]), np.searchsorted(barred_from, rows[-1], side="right"))
        may[barred_from[own] - first, barred_to[own]] = False
        some = np.flatnonzero(may.any(axis=1))
        far = np.where(may[some], differ[some], np.int16(64 * WIDE + 1))
        near = np.argpartition(far, k - 1, axis=1)[:, :k] if k < n else np.broadcast_to(np.arange(n), far.shape)
        at, place = np.nonzero(np.take_along_axis(far, near, 1) <= 64 * WIDE)
        other = near[at, place]
        found.append(np.stack([rows[some][at], other, far[at, other]]).astype(np.int64))
    one, other, bits = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    _, first_of = np.unique(np.minimum(one, other) * np.int64(n) + np.maximum(one, other), return_index=True)
    return one[first_of], other[first_of], bits[first_of]


def _batches(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts of a batch, some at a time: where they start, and they."""
    texts, first, size = [], 0, 0
    for i, value in enumerate(column):
        text = value.as_py()
        n = len(text) // 4 if text else 0
        if texts and (len(texts) >= DOCS_AT_ONCE or size + n > WORDS_AT_ONCE):
            yield first, texts
            texts, first, size = [], i, 0
        texts.append(text)
        size += n
    if texts:
        yield first, texts


def with_prints(rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """For rows (text, and others): the others, node (a hash of the shingle set), fp (the first word of its fingerprint), print
    (the whole fingerprint), size (shingles), keys (of the set's parts) and few (the shingles of small sets, else none)."""
    others = [c for c in rows.columns if c != "text"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in give_back(batches):
            for first, texts in _batches(batch.column(len(others))):
                shingles, counts = shingle_sets(texts, shingle, known)
                number, keys = part_keys(shingles, counts, similarity)
                order = np.argsort(number, kind="stable")
                ends = np.r_[0, np.cumsum(np.bincount(number, minlength=len(texts)))].astype(np.int32)
                prints = wide_prints(shingles, counts)
                small = np.floor(counts * similarity + 1e-9) <= SMALL
                data = [
                    pa.array(set_ids(shingles, counts).view(np.int64)), pa.array(prints[:, 0].view(np.int64)), pa.array([p.tobytes() for p in prints], pa.binary()), pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[order].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.where(small, counts, 0))].astype(np.int32)), pa.array(shingles[np.repeat(small, counts)].view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays([*batch.slice(first, len(texts)).columns[:-1], *data], [*others, "node", "fp", "print", "size", "keys", "few"])

    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in others)
    return rows.select(*others, "text").mapInArrow(task, f"{kinds}node long, fp long, print binary, size long, keys array<long>, few array<long>")


def _runs(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[np.ndarray]]:
    """Rows sorted by key, in whole runs of their key, which is the first column."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        own = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(columns)]
        if not len(own[0]):
            continue
        cut = int(np.searchsorted(own[0], own[0][-1]))  # the last run may go on in the next batch
        if cut or (held and held[-1][0][-1] != own[0][-1]):
            parts = [*held, [c[:cut] for c in own]]
            yield [np.concatenate([p[i] for p in parts]) for i in range(columns)]
            held = []
        held.append([c[cut:].copy() for c in own])
    if held:
        yield [np.concatenate([p[i] for p in held]) for i in range(columns)]


def _by_key(df: DataFrame) -> DataFrame:
    return df.repartition(shuffle_partitions(df.sparkSession), "key").sortWithinPartitions("key")


def rarest(nodes: DataFrame, similarity: float) -> DataFrame:
    """(key, node) of the rarest shingles of `nodes` (node, few; staged): of n, the first n - ceil(similarity * n) + 1 in the order of
    how many nodes have them, then of the shingles themselves. Two sets as similar as that share one of these: of the two last
    ones, that which comes first in the order isn't reached by the other's if none is shared, and too few shingles are left."""
    each = stage(nodes.where(F.size("few") > 0).select("node", F.explode("few").alias("shingle")))
    counts = each.groupBy("shingle").agg(F.count("*").alias("n"))
    counted = join_hot(each, counts.where("n > 1"), "shingle")  # what one node has alone is shared with none, but takes its place
    alone = each.groupBy("node").agg(F.count("*").alias("size"))
    ordered = counted.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("listed")).join(alone, "node")
    kept = F.col("size") - F.ceil(F.col("size") * similarity - 1e-9) + 1 - (F.col("size") - F.size("listed"))
    return ordered.where(kept > 0).select(F.explode(F.slice("listed", 1, kept.cast("int"))).alias("s"), "node").select(F.xxhash64("s.shingle", F.lit("rare")).alias("key"), "node")


def shared_keys(nodes: DataFrame, similarity: float) -> DataFrame:
    """(key, node) of the keys that several of `nodes` (node, keys, few; staged) have; staged."""

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, node in _runs(batches, 2):
            same = key[1:] == key[:-1]
            kept = np.flatnonzero(np.r_[False, same] | np.r_[same, False])
            yield pa.RecordBatch.from_arrays([pa.array(key[kept]), pa.array(node[kept])], ["key", "node"])

    filed = nodes.select(F.explode("keys").alias("key"), "node").unionByName(rarest(nodes.select("node", "few"), similarity))
    return stage(_by_key(filed).mapInArrow(shared, "key long, node long"))


def forests(filed: DataFrame, similarity: float) -> DataFrame:
    """Edges (a, b) that keep together all nodes of a key whose fingerprints differ in as many bits at most as those of similar sets
    of their sizes may: for each key a spanning forest of such pairs, and each task's edges without those that its others make
    needless. In a key of more than RUN nodes all are kept together: who is alike there is for `linked` to tell, in many tasks.
    `filed` has rows (key, node, print, size) without nulls."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, up = most_bits(similarity), {}

        def top(x: int) -> int:
            while (over := up.get(x, x)) != x:
                up[x] = x = up.get(over, over)
            return x

        for key, node, prints, shingles in _runs(batches, 4):
            prints = np.frombuffer(b"".join(prints), np.uint64).reshape(len(key), WIDE)
            edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            sizes = np.diff(edges)
            pair = edges[:-1][sizes == 2]  # most runs
            bits = np.bitwise_count(prints[pair] ^ prints[pair + 1]).sum(axis=1, dtype=np.int64)
            pair = pair[bits <= allowed_bits(table, shingles[pair], shingles[pair + 1])]
            found = [(pair, pair + 1)]
            for i in np.flatnonzero(sizes > 2).tolist():
                first, n = edges[i], sizes[i]
                if n > RUN:
                    found.append((np.full(n - 1, first), np.arange(first + 1, first + n)))
                else:
                    one, two, _ = nearest_tree(prints[first : first + n], table, sizes=shingles[first : first + n])
                    found.append((one + first, two + first))
            kept = []
            for a, b in zip(*(node[np.concatenate([f[i] for f in found])].tolist() for i in range(2)), strict=True):
                x, y = top(a), top(b)
                if x != y:
                    up[max(x, y)] = min(x, y)
                    kept.append((a, b))
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in kept], pa.int64()), pa.array([b for _, b in kept], pa.int64())], ["a", "b"])

    return _by_key(filed).mapInArrow(trees, "a long, b long")


def links_among(prints: np.ndarray, shingles: list[np.ndarray], side: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between sets as similar as `similarity` or more, whose fingerprints are pruned first: (one,
    other). If both sides are there, of links between the sides only.

    Goes breadth first; each set is compared with those not yet reached, so that sets that are all alike cost one comparison
    each, and memory stays in proportion to the sets."""
    sizes, table, sides = np.array([len(s) for s in shingles], np.int64), most_bits(similarity), bool(np.any(side != side[:1]))
    _, ids = np.unique(np.concatenate(shingles), return_inverse=True)
    several = np.bincount(ids)[ids] > 1 if len(ids) else np.zeros(0, bool)  # others are in no intersection
    owner, ids = np.repeat(np.arange(len(sizes)), sizes)[several], np.unique(ids[several], return_inverse=True)[1]
    starts = np.searchsorted(owner, np.arange(len(sizes) + 1))
    width = int(ids.max(initial=0)) // 64 + 1
    member = None
    if len(sizes) * width <= WORDS_OF_SETS:
        member = np.zeros((len(sizes), width), np.uint64)
        np.bitwise_or.at(member, (owner, ids >> 6), np.uint64(1) << (ids & 63).astype(np.uint64))
    else:
        mark = np.zeros(64 * width, bool)

    def common(at: int, others: np.ndarray) -> np.ndarray:
        if member is not None:
            return np.bitwise_count(member[others] & member[at]).sum(axis=1, dtype=np.int64)
        own = ids[starts[at] : starts[at + 1]]
        mark[own] = True
        length = starts[others + 1] - starts[others]
        place = np.arange(int(length.sum())) + np.repeat(starts[others] - np.cumsum(length) + length, length)
        out = np.bincount(np.repeat(np.arange(len(others)), length), mark[ids[place]], minlength=len(others)).astype(np.int64)
        mark[own] = False
        return out

    left, open_, queue, one, other = np.arange(len(sizes)), np.ones(len(sizes), bool), [], [], []
    while queue or len(left) > 1:
        if queue:
            at = queue.pop()
        else:
            at, left = int(left[0]), left[1:]
        near = left[side[left] != side[at]] if sides else left
        for some in np.array_split(near, len(near) * width // WORDS_OF_SETS + 1):
            if not len(some):
                continue
            bits = np.bitwise_count(prints[some] ^ prints[at]).sum(axis=1, dtype=np.int64)
            some = some[bits <= allowed_bits(table, sizes[some], np.broadcast_to(sizes[at], len(some)))]
            if not len(some):
                continue
            both = common(at, some)
            found = some[both >= similarity * (sizes[some] + sizes[at] - both) - 1e-9]
            open_[found] = False
            one += [at] * len(found)
            other += found.tolist()
            queue += found.tolist()
        left = left[open_[left]]
    return np.array(one, np.int64), np.array(other, np.int64)


def linked(together: DataFrame, nodes: DataFrame, rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links (a, b), enough to keep all linked nodes connected, among nodes that candidates connect: `together` (node, root;
    staged). The sets are made from the texts again: few documents have a candidate.

    All sets of one root are compared, each once. Where they are more than a task is to hold they are cut into blocks, and each two
    blocks meet in a task of their own: a set goes to as many tasks as its root has blocks."""
    sized = together.join(nodes.select("node", "row", "print", "size"), "node")
    blocks = sized.groupBy("root").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    large = blocks.where("blocks > 1")
    placed = stage(join_hot(together, large, "root", "left").join(nodes.select("node", "row", "print"), "node").select("row", "node", "root", "print", F.coalesce("blocks", F.lit(1)).alias("blocks")))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in give_back(batches):
            for first, texts in _batches(batch.column(4)):
                shingles, counts = shingle_sets(texts, shingle, known)
                cuts = np.cumsum(counts)
                data = [shingles[b - n : b].tobytes() for n, b in zip(counts.tolist(), cuts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.slice(first, len(texts)).columns[:-1], pa.array(data, pa.binary())], ["node", "root", "blocks", "print", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for team, node, side, prints, shingles in _runs(give_back(batches), 5):
            edges = np.flatnonzero(np.r_[True, team[1:] != team[:-1], True])
            a, b = [], []
            for first, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if end - first > 1:
                    own = np.frombuffer(b"".join(prints[first:end]), np.uint64).reshape(end - first, WIDE)
                    one, other = links_among(own, [np.frombuffer(s, np.uint64) for s in shingles[first:end]], side[first:end], similarity)
                    a.append(node[first + one])
                    b.append(node[first + other])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    sets = rows.select("row", "text").join(placed, "row").select("node", "root", "blocks", "print", "text").mapInArrow(sets_of, "node long, root long, blocks int, print binary, shingles binary")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = sets.withColumn("own", own).withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    team = F.xxhash64("root", F.least("own", "met"), F.greatest("own", "met"))
    dealt = dealt.select(team.alias("key"), "node", (F.col("own") > F.col("met")).cast("int").alias("side"), "print", "shingles")
    return stage(_by_key(dealt).mapInArrow(compare, "a long, b long"))


def similar_classes(rows: DataFrame, shingle: int, similarity: float, near_prints: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """For rows (row, text, and others; staged): the others, row, node and fp, rows of one shingle set sharing a node, and
    (node, root) of those nodes that others are linked to. Nodes whose sets are as similar as `similarity` or more are linked.

    Candidates are the pairs (a, b) of fingerprints that `near_prints` finds among different ones (fp), by pigeonring, and for those
    that are similar although more of 64 bits differ, the nodes of each key whose wide fingerprints are near enough. They are never
    listed: spanning forests tell which nodes they connect, and among those the sets decide.
    """
    filed = stage(with_prints(rows, shingle, similarity))
    firsts = ("fp", "print", "size", "keys", "few")
    nodes = stage(filed.groupBy("node").agg(F.min("row").alias("row"), *(F.first(c).alias(c) for c in firsts)))
    shared = shared_keys(nodes, similarity)
    by_key = stage(forests(shared.join(nodes.select("node", "print", "size"), "node").select("key", "node", "print", "size"), similarity))
    drop(shared)
    prints = stage(nodes.select("fp", "node"))
    of_print = prints.groupBy("fp").agg(F.min("node").alias("least"), F.count("*").alias("n"))
    same = join_hot(prints, of_print.where("n > 1"), "fp").where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b"))
    end = lambda name: of_print.select(F.col("fp").alias(name), F.col("least").alias(f"{name} node"))
    near = stage(near_prints(of_print.select("fp")).distinct())
    near = join_hot(near, end("a"), "a")
    near = stage(near.select(F.col("a node").alias("x"), "b"))
    near = join_hot(near, end("b"), "b").select(F.col("x").alias("a"), F.col("b node").alias("b"))
    together = stage(components(by_key.unionByName(same).unionByName(near)))
    links = linked(together, nodes, rows, shingle, similarity)
    for df in (nodes, by_key, prints, together):
        drop(df)
    return filed.drop("print", "size", "keys", "few"), stage(components(links))
