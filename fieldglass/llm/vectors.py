"""Vector tables: which rows take part, a query set in blocks of bounded size, and the merging of partial results."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Bytes of queries that are sent to all executors at a time, and queries at most: what a task holds for them is in proportion.
QUERY_BYTES, QUERIES_AT_ONCE = 32_000_000, 65_536


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are there and finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False))), F.lit(False))


def matrix(column: pa.Array, kind: type, width: int | None = None) -> np.ndarray:
    """An array column without nulls as a matrix; shorter rows get zeros, and those beyond `width` lose the rest."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    most = int(lengths.max(initial=0)) if width is None else width
    if (lengths == most).all():
        return flat.reshape(len(lengths), most)
    out = np.zeros((len(lengths), most), kind)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row[at < most], at[at < most]] = flat[at < most]
    return out


def fit_width(rows: np.ndarray, width: int) -> np.ndarray:
    """`rows` with zeros added or columns cut to get `width`; a component that the other side lacks adds nothing."""
    return rows[:, :width] if rows.shape[1] >= width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def query_blocks(queries: DataFrame, kind: type, at_once: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The different rows (id, vec) of `queries`, about `at_once` at a time (as many as QUERY_BYTES take, if not given): ids and a
    matrix."""
    queries = stage(queries.select("id", "vec").distinct())
    if at_once is None:
        widest = queries.agg(F.max(F.size("vec"))).first()[0] or 1
        at_once = max(1, min(QUERIES_AT_ONCE, QUERY_BYTES // (8 * widest)))
    blocks = max(1, -(-queries.count() // at_once))
    for i in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)) == i) if blocks > 1 else queries
        table = part.toArrow()
        yield table.column("id").to_numpy(), matrix(table.column("vec"), kind)


def search_in_blocks(queries: DataFrame, kind: type, search: Callable[[np.ndarray, np.ndarray], DataFrame], k: int, at_once: int | None = None) -> DataFrame:
    """Run `search` for each block of queries and keep each query's `k` best (query_id, vec_id, score), best first, ties to
    the smaller vec_id, with rank from 1. Beyond one block each block's result is written, once, before the next begins."""
    parts: list[DataFrame] = []
    waiting: DataFrame | None = None
    for ids, rows in query_blocks(queries, kind, at_once):
        if waiting is not None:
            parts.append(stage(waiting))
        found = search(ids, rows)
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        waiting = found.select("query_id", "rank", "vec_id", "score")
    parts.append(stage(waiting) if parts else waiting)
    return reduce(DataFrame.unionByName, parts)
