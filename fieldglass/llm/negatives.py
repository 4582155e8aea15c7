"""Hard-negative mining by a norm-bucketed search: candidates in order of their norms, cut into buckets, and buckets left out
by the Cauchy-Schwarz bound."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, give_back, shuffle_partitions, stage
from .topk import _exact, quantised
from .vectors import QUERY_BYTES, fit_width, matrix, usable

#: Candidates in a bucket.
BUCKET = 256
#: Windows whose scores against one bucket are held together.
WINDOWS_AT_ONCE = 2048
#: Windows of a block of anchors: what the driver and each task hold for them is in proportion.
MOST_WINDOWS = 65_536
#: The largest norms of all, at most so many, are searched first; what they give bounds the search of all others.
FIRST_ROWS = 16_384
#: Open ends of a window, and no score.
LEAST, MOST = -np.iinfo(np.int64).max, np.iinfo(np.int64).max


@dataclass(frozen=True)
class Windows:
    """What is searched for: for each window its anchor (a row of `vectors`), and the least and the largest score that count;
    only candidates whose label is the anchor's (or, if `other`, is another) count, and none of the anchor's own id."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    anchor: np.ndarray
    least: np.ndarray
    most: np.ndarray
    other: bool
    #: Scores that a window's kth best reaches for sure.
    floor: np.ndarray


def build_buckets(rows: DataFrame) -> DataFrame:
    """The index of rows (id, label: long, vec array<long>): buckets of rows in falling order of their norms, each with its
    largest norm and the rows themselves. A bucket comes from one task; the last of a task may be short. Rows of one norm,
    however many, are dealt out by their ids and a hash of them, so that copies without number still lie over many tasks."""
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    ordered = rows.withColumn("norm", F.sqrt(square)).withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.desc("norm"), "id", "spread"]
    ordered = ordered.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)

    def pack(ids: np.ndarray, labels: np.ndarray, norms: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
        kind = next(k for k in (np.int16, np.int32, np.int64) if np.abs(vectors).max(initial=0) <= np.iinfo(k).max)
        data = [ids.astype(np.int64).tobytes(), labels.astype(np.int64).tobytes(), vectors.astype(kind).tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([norms.max()]), pa.array([len(ids)]), pa.array([vectors.shape[1]]), pa.array([np.dtype(kind).str]), *(pa.array([d], pa.binary()) for d in data)],
            ["norm", "n", "width", "kind", "ids", "labels", "vectors"],
        )

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 0), np.int64)]
        for batch in batches:
            more = matrix(batch.column(3), np.int64)
            width = max(held[3].shape[1], more.shape[1])
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            held = [*(np.concatenate(x) for x in zip(held[:3], new, strict=True)), np.concatenate([fit_width(held[3], width), fit_width(more, width)])]
            while len(held[0]) >= BUCKET:
                yield pack(*(x[:BUCKET] for x in held))
                held = [x[BUCKET:] for x in held]
        if len(held[0]):
            yield pack(*held)

    return ordered.select("id", "label", "norm", "vec").mapInArrow(buckets, "norm double, n long, width long, kind string, ids binary, labels binary, vectors binary")


class _Best:
    """The `k` best hits of each window so far, and each window's running kth score: no hit below it is kept."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.kth = k, floor.copy()
        self.hits: list[np.ndarray] = [np.zeros((3, 0), np.int64)]
        self.waiting = 0

    def add(self, window: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        self.hits.append(np.stack([window, -score, ident]))
        self.waiting += len(window)
        if self.waiting > 4 * self.k * len(self.kth) or self.waiting > 2_000_000:
            self.settle()

    def settle(self) -> np.ndarray:
        """Windows, negated scores and ids, in order, `k` a window at most; raises the kth scores."""
        found = np.concatenate(self.hits, axis=1)
        found = found[:, np.lexsort(found[::-1])]
        first = np.searchsorted(found[0], found[0])
        place = np.arange(found.shape[1]) - first
        last = place == self.k - 1
        self.kth[found[0][last]] = np.maximum(self.kth[found[0][last]], -found[1][last])
        self.hits, self.waiting = [found[:, place < self.k]], 0
        return self.hits[0]


def search_buckets(batches: Iterator[pa.RecordBatch], windows: Windows, k: int) -> np.ndarray:
    """Window, negated score and id of the `k` best hits of each window among one task's buckets, in order.

    By Cauchy and Schwarz no score exceeds the product of the two norms. A bucket is looked at only for windows for which the
    anchor's norm times the bucket's largest reaches both the window's lower limit and its running kth score (a tie may still
    have a smaller id). Buckets of large norms come first in a file, and raise the kth scores for those after them.
    """
    norms = np.sqrt((windows.vectors.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)  # rounding must not prune
    best = _Best(windows.floor, k)
    reach = np.where(windows.least <= windows.most, norms[windows.anchor], -np.inf)
    for batch in batches:
        for place in range(batch.num_rows):
            bucket = batch.slice(place, 1).to_pylist()[0]
            open_ = np.flatnonzero((reach * max(bucket["norm"], 1e-9) >= np.maximum(windows.least, best.kth)) & (reach >= 0))
            if not len(open_):
                continue
            rows = np.frombuffer(bucket["vectors"], bucket["kind"]).reshape(bucket["n"], bucket["width"])
            ids, labels = np.frombuffer(bucket["ids"], np.int64), np.frombuffer(bucket["labels"], np.int64)
            for first in range(0, len(open_), WINDOWS_AT_ONCE):
                part = open_[first : first + WINDOWS_AT_ONCE]
                anchors, own = np.unique(windows.anchor[part], return_inverse=True)
                scores = _exact(fit_width(windows.vectors[anchors], rows.shape[1]), rows)
                may = (windows.labels[anchors][:, None] == labels[None]) ^ windows.other
                may &= windows.ids[anchors][:, None] != ids[None]
                scores = scores[own]
                at, row = np.nonzero(may[own] & (scores >= np.maximum(windows.least[part], best.kth[part])[:, None]) & (scores <= windows.most[part][:, None]))
                best.add(part[at], scores[at, row], ids[row])
    return best.settle()


def _hits(index: DataFrame, windows: Windows, k: int) -> DataFrame:
    """The `k` best hits (w, rank, id, score) of each window in the whole index, best first, ties to the smaller id.

    The buckets of the largest norms are searched first; the kth scores that they give, one number a window, are the others' floor.
    """
    spark = index.sparkSession

    def run(buckets: DataFrame, floor: np.ndarray) -> DataFrame:
        sent = spark.sparkContext.broadcast(Windows(**{**windows.__dict__, "floor": floor}))  # one block of anchors

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = search_buckets(batches, sent.value, k)
            yield from give_back([pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(-found[1]), pa.array(found[2])], ["w", "score", "id"])])

        found = buckets.mapInArrow(task, "w long, score long, id long")
        best = Window.partitionBy("w").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    if (index.agg(F.sum("n")).first()[0] or 0) <= 2 * FIRST_ROWS:
        return run(index, windows.floor)
    cut = F.lit(index.select("norm").orderBy(F.desc("norm")).limit(FIRST_ROWS // BUCKET).agg(F.min("norm")).first()[0])
    first = stage(run(index.where(F.col("norm") > cut), windows.floor))
    kth = first.where(F.col("rank") == k).select("w", "score").toArrow()
    floor = windows.floor.copy()
    floor[kth.column("w").to_numpy()] = kth.column("score").to_numpy()
    rest = run(index.where(F.col("norm") <= cut), floor)
    best = Window.partitionBy("w").orderBy(F.desc("score"), "id")
    both = first.unionByName(rest).withColumn("rank", F.row_number().over(best))
    return both.where(F.col("rank") <= k)


def _percent(share: int, score: np.ndarray, up: bool) -> np.ndarray:
    """score * share / 100, rounded up or down to a whole number, exactly."""
    found = [-(-int(s) * share // 100) if up else int(s) * share // 100 for s in score]
    return np.array(found, np.int64)


def _anchor_blocks(anchors: DataFrame, at_once: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The different rows (id, label, vec), about `at_once` at a time, or as many as QUERY_BYTES take."""
    anchors = stage(anchors.distinct())
    widest = anchors.agg(F.max(F.size("vec"))).first()[0] or 1
    at_once = max(1, min(at_once, QUERY_BYTES // (8 * max(widest, 1))))
    blocks = max(1, -(-anchors.count() // at_once))
    for i in range(blocks):
        part = anchors.where(F.pmod(F.xxhash64("id", "label", "vec"), F.lit(blocks)) == i) if blocks > 1 else anchors
        table = part.toArrow()
        yield table.column("id").to_numpy(), table.column("label").to_numpy(), matrix(table.column("vec"), np.int64)


def mine(
    vectors: DataFrame, anchors: Callable[[DataFrame], DataFrame] | None = None, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: int = 256, at_once: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | str = "label",
) -> DataFrame:
    """Hard negatives for the rows of `vectors` that `anchors` keeps (all, if not given).

    Scores are integer inner products of components floor(scale * x). An anchor's positives are its `positives` best other
    rows of the same label; for each of them come the `negatives` best rows of another label whose score is from `low` to
    `high` percent of the positive's. Best is the highest score, ties go to the smaller id. Anchors come in blocks of bounded
    size, each searched in all rows. Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score; an anchor without positives, or a positive without negatives, gives no row. `label` may be an expression.

    Nulls: rows whose id, label or vector is null, or whose vector holds null or non-finite components, take no part. Vectors of
    different length: a component that one lacks adds nothing; an empty vector scores 0. Rows with the anchor's own id are
    neither positives nor negatives of it. Other repeated rows are each a row, and a positive that is there twice comes twice;
    anchors alike in id, label and vector are one anchor. A positive score below zero leaves no window, one of zero only
    zero. Without rows or anchors there are no rows. Products must fit 63 bits. Other columns, whatever their names, are not
    looked at.
    """
    spark: SparkSession = vectors.sparkSession
    given = F.col(label) if isinstance(label, str) else label

    def clean(df: DataFrame) -> DataFrame:
        raw, = fresh(df, "raw")
        df = df.select(F.col(id_col).cast("long").alias("id"), given.cast("long").alias("label"), F.col(vector_col).alias(raw))
        df = df.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col(raw)))
        return df.select("id", "label", quantised(raw, scale).alias("vec"))

    index = stage(build_buckets(clean(vectors)))
    parts: list[DataFrame] = []
    for ids, labels, rows in _anchor_blocks(clean(anchors(vectors) if anchors else vectors), at_once or max(1, MOST_WINDOWS // positives)):
        nothing = np.full(len(ids), LEAST)
        same = Windows(ids, labels, rows, np.arange(len(ids)), nothing, np.full(len(ids), MOST), False, nothing)
        found = _hits(index, same, positives).select("w", "rank", "id", "score").toArrow()  # one block's
        anchor, rank, positive, score = (found.column(i).to_numpy() for i in range(4))
        order = np.lexsort((rank, anchor))
        anchor, positive, score = anchor[order], positive[order], score[order]
        other = Windows(ids, labels, rows, anchor, _percent(low, score, True), _percent(high, score, False), True, np.full(len(anchor), LEAST))
        pairs = pa.table({"w": np.arange(len(anchor)), "anchor_id": ids[anchor], "positive_id": positive, "positive_score": score})
        windows = F.broadcast(spark.createDataFrame(pairs, "w long, anchor_id long, positive_id long, positive_score long"))  # one block's
        made = _hits(index, other, negatives).join(windows, "w")
        parts.append(stage(made.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
    return reduce(DataFrame.unionByName, parts)
