"""SimHash near-duplicates with pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import similar
from .common import components, fresh, give_back, join_hot, shuffle_partitions, stage

BITS = 64
#: An odd multiplier that spreads wide keys; those that meet by chance fail the check of the links.
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Differing bits up to which fingerprints are candidates where sets decide; parts of the sets find those that differ in more.
NEAR = 4


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The SimHash of a whole text, as a signed 64-bit number; 0 for null and for a text without words.

    Lower-cases A-Z only, takes the words between ASCII white space and their shingles with repeats (all words, if they
    are fewer), and sets each bit that is 1 in over half of the shingles' XXH64 (seed 42).
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    last = ends[k - 1 :].tolist()
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(first, last, strict=True)), np.uint64, len(last))
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, out: str, text_col: str = "text", shingle: int = 4) -> DataFrame:
    """`docs` with their fingerprints in column `out`."""

    @F.pandas_udf(T.LongType())
    def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in give_back(texts):
            yield pd.Series([fingerprint(t, shingle) for t in part], dtype="int64")

    return docs.withColumn(out, fingerprints(F.col(text_col)))


def segments(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of distance + 1 consecutive segments of near equal width, the ring of the pigeonring."""
    m = distance + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _links_in_run(prints: np.ndarray, start: int, ring: list[tuple[int, int]], distance: int, out: list) -> None:
    """A spanning forest of the links within one run of candidates that share a key: at most one link a fingerprint.

    Goes breadth first; each fingerprint is compared with those not yet reached, so copies that are all alike cost one
    comparison each, and memory stays in proportion to the run.
    """
    left, queue = np.unique(prints), []
    while queue or len(left) > 1:
        if queue:
            at = queue.pop()
        else:
            at, left = left[0], left[1:]
        if not len(left):
            break
        near = _chained(left ^ at, start, ring, distance)
        if near.any():
            found = left[near]
            out.append(np.stack([np.full(len(found), at), found]))
            queue.extend(found)
            left = left[~near]


def _chained(differ: np.ndarray, start: int, ring: list[tuple[int, int]], distance: int) -> np.ndarray:
    """Which differences pass the chain from segment `start`: after l segments at most l * distance / m bits differ;
    after all of them that is the full Hamming check."""
    m, so_far, ok = len(ring), np.zeros(len(differ), np.uint8), np.ones(len(differ), bool)
    for step in range(1, m + 1):
        shift, width = ring[(start + step - 1) % m]
        so_far = so_far + np.bitwise_count((differ >> np.uint64(shift)) & np.uint64((1 << width) - 1))
        ok &= so_far * m <= step * distance
        if not ok.any():
            break
    return ok


def candidate_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) between different fingerprints (column fp, distinct) of Hamming distance `distance` or less, of
    which enough are returned to keep every two fingerprints connected that are connected by all links.

    Pigeonring: with m = distance + 1 segments in a ring, two such fingerprints have a segment from which every chain
    of l segments differs in at most l * distance / m bits. So the first segment is equal and the second differs in
    one bit at most: each fingerprint is filed, for each of the m starts, under the first segment and the second with
    one bit masked, for each bit. Fingerprints that share a file are checked chain by chain, to the full distance.
    """
    ring, m = segments(distance), distance + 1

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for start in range(m):
                (s1, w1), (s2, w2) = ring[start], ring[(start + 1) % m]
                one = (fp >> np.uint64(s1)) & np.uint64((1 << w1) - 1)
                two = (fp >> np.uint64(s2)) & np.uint64((1 << w2) - 1)
                for bit in range(w2 if m > 1 else 1):
                    rest = two & ~np.uint64(1 << bit) if distance else two
                    both = (one << np.uint64(w2 % BITS)) | rest if w1 + w2 <= 52 else (one * MIX ^ rest) * MIX >> np.uint64(12)
                    key = (np.uint64(start) << np.uint64(58)) | (np.uint64(bit) << np.uint64(52)) | both
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], ["file", "fp"])
                    if not distance:
                        break

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            out: list[np.ndarray] = []
            edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
            sizes = np.diff(edges)
            for i in np.flatnonzero(sizes > 8):
                a, b = edges[i], edges[i + 1]
                _links_in_run(fp[a:b], int(key[a] >> 58), ring, distance, out)
            small = np.repeat(sizes <= 8, sizes)
            for step in range(1, 8):  # short runs all at once: rows `step` apart
                pair = np.flatnonzero(small[step:] & (key[step:] == key[:-step]))
                for start in range(m):
                    at = pair[key[pair] >> 58 == start]
                    if len(at):
                        at = at[_chained(fp[at] ^ fp[at + step], start, ring, distance)]
                        out.append(np.stack([fp[at], fp[at + step]]))
            found = np.unique(np.sort(np.concatenate(out, axis=1).view(np.int64), axis=0), axis=1) if out else np.zeros((2, 0), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            key, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last run may go on in the next batch
            if cut or (held and held[-1][0][-1] != key[-1]):
                parts = [*held, (key[:cut], fp[:cut])]
                yield linked(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                held = []
            held.append((key[cut:].copy(), fp[cut:].copy()))
        if held:
            yield linked(np.concatenate([p[0] for p in held]), np.concatenate([p[1] for p in held]))

    filed = prints.select("fp").mapInArrow(files, "file long, fp long")
    filed = filed.repartition(shuffle_partitions(prints.sparkSession), "file").sortWithinPartitions("file")
    return filed.mapInArrow(runs, "a long, b long")


def _classes(docs: DataFrame, distance: int | None, shingle: int | None, similarity: float) -> tuple[DataFrame, DataFrame]:
    """For docs (row, doc_id, text; staged, or read once only where `distance` is given): rows (doc_id, node, fp; staged) and, for
    each node, best: the struct (no_id, doc_id, text_hash, row) that is the least of its class."""
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    if distance is None:
        rows, roots = similar.similar_classes(docs, shingle or 5, similarity, lambda prints: candidate_links(prints, NEAR))
    else:
        rows = stage(with_fingerprint(docs, "fp", "text", shingle or 4).drop("text").withColumn("node", F.col("fp")))
        roots = components(candidate_links(rows.select("fp").distinct(), distance))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "row")
    nodes = rows.groupBy("node").agg(F.min(order).alias("best"))
    classed = stage(nodes.join(roots, "node", "left").select("node", "best", F.coalesce("root", "node").alias("root")))
    least = classed.groupBy("root").agg(F.min("best").alias("best"))
    return rows, join_hot(classed.select("node", "root"), least, "root").select("node", "best")


def near_duplicates(
    docs: DataFrame, *, distance: int | None = None, shingle: int | None = None, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Classes of near-duplicates: doc_id, fp (a fingerprint, signed), component_id (smallest doc_id reachable over links),
    one row for each row of `docs`.

    Without `distance`, texts are linked whose sets of `shingle` words (5, if not given) have a Jaccard similarity of
    `similarity` or more; see similar.similar_classes. Of links just at 0.8 between texts of more than SMALL shingles, one in 200,000 or
    fewer can be missed (see similar.PARTS). With it, those whose 64-bit SimHash over shingles of `shingle` words (4,
    if not given), repeats included, differ in at most so many bits; see candidate_links. Documents of one set, or of one
    fingerprint, are one node, however many they are, so copies are never paired.

    Nulls: a null text counts as one without words. Texts without words have fingerprint 0 and an empty set, and are linked
    like any other: to each other. A null id is returned as null and is never the smallest (the id of a class without any
    other is null). Repeated rows each get their row. An empty table gives no rows. Other columns, whatever their names,
    are not looked at.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    rows, classes = _classes(stage(docs) if distance is None else docs, distance, shingle, similarity)
    return join_hot(rows, classes, "node").select("doc_id", "fp", F.col("best.doc_id").alias("component_id"))


def drop_near_duplicates(
    docs: DataFrame, *, distance: int | None = None, shingle: int | None = None, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with one document of each class: the one with the smallest id.

    Takes part like near_duplicates. Of rows that share that id, the one with the least text hash stays, then any one
    of equal rows; a class without an id keeps one row too.
    """
    row, = fresh(docs, "dedup_row")
    docs = stage(docs.withColumn(row, F.monotonically_increasing_id()), compression="zstd")
    narrow = docs.select(F.col(row).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    _, classes = _classes(narrow, distance, shingle, similarity)
    kept = classes.select(F.col("best.row").alias(row)).distinct()
    return docs.join(kept, row, "left_semi").drop(row)
