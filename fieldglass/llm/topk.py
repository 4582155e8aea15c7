"""Exact top-k search by inner product, with block-at-a-time pruning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, stage
from .vectors import fit_width, matrix, search_in_blocks, usable

BLOCK = 256
#: Blocks that are searched together; a task holds no more than these.
BLOCKS_AT_ONCE = 64
#: Below every score; its negative is a number too.
NONE = -np.iinfo(np.int64).max


def build_blocks(vectors: DataFrame) -> DataFrame:
    """The block index of rows (id long, vec array<long>): blocks of document ranges, each with its forward index (the rows
    themselves) and each term's (component's) largest and smallest value.

    Documents are put in order of their strongest component first, so that a block's documents resemble each other and its
    bounds are tight. A block comes from one task; the last of a task may be short.
    """
    size = F.transform("vec", F.abs)
    at = F.array_position(size, F.array_max(size))
    strongest = F.coalesce(at * F.signum(F.element_at("vec", F.greatest(at, F.lit(1)).cast("int"))), F.lit(0)).cast("int")
    ordered = vectors.where(F.size("vec") > 0).withColumn("strongest", strongest).unionByName(vectors.where(F.size("vec") <= 0).withColumn("strongest", F.lit(0)))
    ordered = ordered.repartitionByRange(shuffle_partitions(vectors.sparkSession), "strongest", "id").sortWithinPartitions("strongest", "id")

    def pack(ids: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        kind = next(k for k in (np.int16, np.int32, np.int64) if np.abs(rows).max(initial=0) <= np.iinfo(k).max)
        data = [ids.astype(np.int64).tobytes(), rows.astype(kind).tobytes(), rows.max(axis=0).astype(np.int64).tobytes(), rows.min(axis=0).astype(np.int64).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([len(ids)]), pa.array([rows.shape[1]]), pa.array([np.dtype(kind).str]), *(pa.array([d], pa.binary()) for d in data)], NAMES)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = np.zeros(0, np.int64), np.zeros((0, 0), np.int64)
        for batch in batches:
            more = matrix(batch.column(1), np.int64)
            width = max(rows.shape[1], more.shape[1])
            ids, rows = np.concatenate([ids, batch.column(0).to_numpy()]), np.concatenate([fit_width(rows, width), fit_width(more, width)])
            while len(ids) >= BLOCK:
                yield pack(ids[:BLOCK], rows[:BLOCK])
                ids, rows = ids[BLOCK:], rows[BLOCK:]
        if len(ids):
            yield pack(ids, rows)

    return ordered.select("id", "vec").mapInArrow(blocks, "n long, width long, kind string, ids binary, rows binary, largest binary, smallest binary")


NAMES = ["n", "width", "kind", "ids", "rows", "largest", "smallest"]


def _exact(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products; by floating point only where every sum stays below 2 ** 53 and so is exact."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(queries.shape[1], 1)
    if bound < 2**53:
        return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    return queries.astype(np.int64) @ rows.T.astype(np.int64)


def search_blocks(batches: Iterator[pa.RecordBatch], query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The `k` best of one task's blocks for each query: ids and scores (queries x k), empty places of id -1.

    A block's bound for a query is the sum over the terms of the query's weight times the block's largest value (smallest,
    for a negative weight). Each query takes the blocks in falling order of their bounds, as far as the bound reaches its
    kth score. Queries that come to the same block at the same turn are scored together.
    """
    best, ids = np.full((len(query_ids), k), NONE), np.full((len(query_ids), k), -1)
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCKS_AT_ONCE):
            part = batch.slice(first, BLOCKS_AT_ONCE).to_pylist()
            width = max(b["width"] for b in part)
            q = fit_width(queries, width)
            most, least = (np.stack([fit_width(np.frombuffer(b[c], np.int64)[None], width)[0] for b in part]) for c in ("largest", "smallest"))
            bounds = _exact(np.maximum(q, 0), most) + _exact(np.minimum(q, 0), least)
            order = np.argsort(-bounds, axis=1, kind="stable")
            open_ = np.arange(len(query_ids))
            for turn in range(len(part)):
                block = order[open_, turn]
                going = bounds[open_, block] >= best[open_, -1]  # a tie may still have a smaller id
                open_, block = open_[going], block[going]
                if not len(open_):
                    break
                for b in np.unique(block):
                    own, info = open_[block == b], part[b]
                    rows = np.frombuffer(info["rows"], info["kind"]).reshape(info["n"], info["width"])
                    found = np.frombuffer(info["ids"], np.int64)
                    score = _exact(q[own][:, : info["width"]], rows)
                    score[query_ids[own][:, None] == found[None]] = NONE  # not the query's own row
                    all_scores = np.concatenate([best[own], score], axis=1)
                    all_ids = np.concatenate([ids[own], np.where(score == NONE, -1, found[None])], axis=1)
                    keep = np.lexsort((all_ids, -all_scores), axis=-1)[:, :k]
                    best[own], ids[own] = np.take_along_axis(all_scores, keep, 1), np.take_along_axis(all_ids, keep, 1)
    return ids, best


def quantised(column: str, scale: int = 256):
    """Each component x as floor(scale * x), x as double."""
    return F.transform(column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int, *, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each query row its `k` best rows of `vectors` by integer inner product of quantised components: query_id, rank
    (from 1), vec_id, score. Rows with the query's own id are no candidates; ties go to the smaller id.

    Nulls: rows whose id or vector is null, or whose vector holds null or non-finite components, take no part. Vectors of
    different length: a component that one lacks adds nothing; an empty vector scores 0. Repeated candidates are each a
    candidate; repeated queries are one. Without candidates or queries there are no rows. Products must fit 63 bits. Other
    columns, whatever their names, are not looked at.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("raw")).where(F.col("id").isNotNull() & usable(F.col("raw")))
        return df.select("id", quantised("raw", scale).alias("vec"))

    index = stage(build_blocks(clean(vectors)))

    def search(ids: np.ndarray, rows: np.ndarray) -> DataFrame:
        sent = spark.sparkContext.broadcast((ids, rows))  # one block of queries

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, queries = sent.value
            found, scores = search_blocks(batches, query_ids, queries, k)
            q, at = np.nonzero(scores > NONE)
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[q]), pa.array(found[q, at]), pa.array(scores[q, at])], ["query_id", "vec_id", "score"])

        return index.mapInArrow(task, "query_id long, vec_id long, score long")

    return search_in_blocks(clean(queries), np.int64, search, k)
