"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard, in flat arrays."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stage
from .vectors import fit_width, matrix, search_in_blocks, usable

#: Different vectors in a shard, about: as many as let all tasks have two shards, but no fewer than this; and bytes of a shard's
#: vectors at most (double precision), which bounds what a task holds. A task holds about three times that and its graph.
SHARD_ROWS, SHARD_BYTES = 8192, 64_000_000
#: Rows for which the graph is extended, or queries that walk through it, at a time.
AT_ONCE = 256


@dataclass
class Graph:
    """rows: the vectors, scaled together. levels: from the bottom up, the nodes of the level and a flat array of their
    neighbours (-1: none)."""

    rows: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]


def _diverse(rows: np.ndarray, at: np.ndarray, near: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Of each node's candidates (`near`, nearest first, -1: none) at most `most`: those that are nearer to the node than
    to any candidate already taken, then the nearest of the others."""
    n, width = near.shape
    taken, count = np.full((n, most), -1, np.int32), np.zeros(n, np.int64)
    chosen = np.zeros((n, width), bool)
    vectors = np.zeros((n, most, rows.shape[1]), np.float32)
    for j in range(width):
        to_taken = np.einsum("nmd,nd->nm", vectors, rows[near[:, j]])
        to_taken[np.arange(most)[None] >= count[:, None]] = -np.inf
        ok = np.flatnonzero((near[:, j] >= 0) & (count < most) & (score[:, j] > to_taken.max(axis=1)))
        taken[ok, count[ok]], vectors[ok, count[ok]], chosen[ok, j] = near[ok, j], rows[near[ok, j]], True
        count[ok] += 1
    for j in range(width):
        ok = np.flatnonzero((near[:, j] >= 0) & ~chosen[:, j] & (count < most))
        taken[ok, count[ok]] = near[ok, j]
        count[ok] += 1
    return taken


def _link_back(rows: np.ndarray, near: np.ndarray, one: np.ndarray, other: np.ndarray, score: np.ndarray) -> None:
    """Put each of `one` into the list of its `other`, in place. Where a list has no room for all, diverse ones of the old and of as
    many of the new as a list holds, the nearest, stay."""
    order = np.lexsort((-score, other))
    one, other = one[order], other[order]
    owners, first, count = np.unique(other, return_index=True, return_counts=True)
    place, most = np.arange(len(other)) - np.repeat(first, count), near.shape[1]
    fresh = np.full((len(owners), most), -1, np.int32)
    kept = place < most
    fresh[np.repeat(np.arange(len(owners)), count)[kept], place[kept]] = one[kept]
    for a in range(0, len(owners), AT_ONCE):
        own = owners[a : a + AT_ONCE]
        both = np.concatenate([near[own], fresh[a : a + AT_ONCE]], axis=1)
        scores = np.where(both >= 0, np.einsum("nkd,nd->nk", rows[both], rows[own]), -np.inf)
        by_score = np.argsort(-scores, axis=1, kind="stable")
        both, scores = np.take_along_axis(both, by_score, 1), np.take_along_axis(scores, by_score, 1)
        full = np.flatnonzero((both >= 0).sum(axis=1) > most)
        out = both[:, :most]
        out[full] = _diverse(rows, own[full], both[full], scores[full], most)
        near[own] = out


def insert_all(rows: np.ndarray, level: np.ndarray, links: int, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The levels (nodes, neighbours) of a graph into which all `rows` are inserted in their order, some at a time: at most a
    quarter of those before, so that the graph is well grown beside them.

    A node goes down from the top, from the nearest nodes found on one level to the next. On each level that it belongs to it
    is linked to diverse ones of the `width` nearest that a walk finds, and of those inserted with it before it; they get it
    into their lists, which hold `2 * links`.
    """
    at_level = [np.flatnonzero(level >= at) for at in range(int(level.max(initial=0)) + 1)]
    at_level = [nodes for at, nodes in enumerate(at_level) if not at or len(nodes) > 1]
    own_rows = [rows if not at else rows[nodes] for at, nodes in enumerate(at_level)]
    near = [np.full((len(nodes), 2 * links), -1, np.int32) for nodes in at_level]
    forward = [np.full((len(nodes), links), -1, np.int32) for nodes in at_level]
    a = 0
    while a < len(rows):
        b = min(len(rows), a + max(AT_ONCE, min(4 * AT_ONCE, a // 4)))
        start: np.ndarray | None = None
        for at in range(len(at_level) - 1, -1, -1):
            nodes, own = at_level[at], own_rows[at]
            m, e = np.searchsorted(nodes, (a, b)).tolist()
            members = nodes[m:e] - a
            ids, score = np.full((len(members), 1), -1, np.int32), np.full((len(members), 1), -np.inf, np.float32)
            if m:
                begin = np.zeros((b - a, 1), np.int32) if start is None else np.searchsorted(nodes[:m], start).astype(np.int32)
                if at:
                    found, found_score = _walk_in_parts(own[:m], near[at][:m], rows[a:b], begin, 8)
                    best = np.take_along_axis(found, np.argsort(-found_score, axis=1, kind="stable")[:, :4], 1)
                    start = nodes[np.where(best >= 0, best, best[:, :1])]
                if len(members):
                    ids, score = _walk_in_parts(own[:m], near[at][:m], rows[a:b][members], begin[members], width)
            if not len(members):
                continue
            with_it = own[m:e] @ own[m:e].T
            with_it[np.triu_indices(len(members))] = -np.inf
            score = np.concatenate([score, with_it], axis=1)
            ids = np.concatenate([ids, np.broadcast_to(np.arange(m, e, dtype=np.int32), with_it.shape)], axis=1)
            best, score = _best(score, min(width, score.shape[1]))
            ids = np.where(np.isfinite(score), np.take_along_axis(ids, best, 1), -1)
            forward[at][m:e] = _diverse(own, np.arange(m, e), ids, score, links)
            near[at][m:e, :links] = forward[at][m:e]
            row, column = np.nonzero(forward[at][m:e] >= 0)
            other = forward[at][m:e][row, column]
            _link_back(own, near[at], (row + m).astype(np.int32), other, np.einsum("ed,ed->e", own[row + m], own[other]))
        a = b
    return [(nodes.astype(np.int32), _reachable(lists, first)) for nodes, lists, first in zip(at_level, near, forward, strict=True)]


def _walk_in_parts(rows: np.ndarray, near: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [_walk(rows, near, queries[i : i + AT_ONCE], start[i : i + AT_ONCE], width) for i in range(0, len(queries), AT_ONCE)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _reachable(near: np.ndarray, forward: np.ndarray, spare: int = 8) -> np.ndarray:
    """A node that no list holds gets into the spare places of the nearest of its own list that has one left, or of the node
    before it: without that, a vector far from all others would never be found."""
    n = len(near)
    held = np.bincount(near[near >= 0], minlength=n)
    more, count = np.full((n, spare), -1, np.int32), np.zeros(n, np.int64)
    for i in np.flatnonzero(held == 0).tolist() if n > 1 else ():
        j = next((j for j in forward[i].tolist() if j >= 0 and count[j] < spare), None)
        j = (next(j % n for j in range(i + n - 1, i, -1) if count[j % n] < spare)) if j is None else j
        more[j, count[j]] = i
        count[j] += 1
    return np.concatenate([near, more[:, : count.max(initial=0)]], axis=1)


def _best(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The `k` best columns of each row, best first."""
    at = np.argpartition(-score, k - 1, axis=1)[:, :k] if k < score.shape[1] else np.broadcast_to(np.arange(score.shape[1]), score.shape)
    own = np.take_along_axis(score, at, 1)
    order = np.argsort(-own, axis=1, kind="stable")
    return np.take_along_axis(at, order, 1).astype(np.int32), np.take_along_axis(own, order, 1)


def insertion_order(vectors: np.ndarray, seed: int = 0) -> np.ndarray:
    """Long vectors first, as they are near to most queries by inner product and early nodes have the long links; vectors of
    one length in any order, drawn from `seed`."""
    order = np.random.default_rng(seed).permutation(len(vectors))
    lengths = np.sqrt((vectors[order].astype(np.float64) ** 2).sum(axis=1))
    return order[np.argsort(-np.round(lengths / (lengths.max(initial=0) or 1.0), 4), kind="stable")]


def build_graph(vectors: np.ndarray, *, links: int = 24, width: int = 64, seed: int = 0) -> Graph:
    """The graph of one shard. A node reaches level l with chance links ** -l, drawn from `seed`. Nodes are best given in
    order of insertion_order.

    Links go by inner product. Where lengths differ, short vectors would be in nobody's list; there each node has a second
    set of links, with one more component that gives all vectors the same length.
    """
    lengths = (vectors.astype(np.float64) ** 2).sum(axis=1)
    scale = float(np.sqrt(lengths.max(initial=0))) or 1.0
    rows = (vectors / scale).astype(np.float32)
    rest = np.sqrt(np.maximum(1 - lengths / scale**2, 0))
    level_rows = np.c_[rows, rest].astype(np.float32) if rest.max(initial=0) > 0.05 else None
    level = np.floor(-np.log(1 - np.random.default_rng(seed).random(len(rows))) / np.log(links)).astype(int)
    levels = insert_all(rows, level, links, width)
    if level_rows is not None:
        for at, (_, more) in enumerate(insert_all(level_rows, level, links, width)):
            nodes, near = levels[at]
            for a in range(0, len(near), AT_ONCE):
                part = more[a : a + AT_ONCE]
                part[(part[:, :, None] == near[a : a + AT_ONCE, None, :]).any(axis=2)] = -1
            levels[at] = nodes, np.concatenate([near, more], axis=1)
    return Graph(rows, levels)


def _walk(rows: np.ndarray, near: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """From `start` (queries x any) go along the graph, always on from the best node not yet left, until the `width` best
    nodes seen have all been left. All queries take their steps together."""
    n, rows_at = len(queries), np.arange(len(queries))
    width = min(width, len(rows))
    ids = np.full((n, width), -1, np.int32)
    score = np.full((n, width), -np.inf, np.float32)
    seen = np.zeros((n, len(rows)), bool)
    k = min(width, start.shape[1])
    ids[:, :k] = start[:, :k]
    score[:, :k] = np.einsum("nkd,nd->nk", rows[start[:, :k]], queries)
    seen[rows_at[:, None], start[:, :k]] = True
    left = score == -np.inf
    while True:
        pending = np.where(left, -np.inf, score)
        at = pending.argmax(axis=1)
        go = np.flatnonzero(pending[rows_at, at] > -np.inf)
        if not len(go):
            return ids, score
        left[go, at[go]] = True
        next_ = near[ids[go, at[go]]]
        new = (next_ >= 0) & ~seen[go[:, None], next_]
        seen[go[:, None], np.where(new, next_, ids[go, at[go]][:, None])] = True
        found = np.where(new, np.einsum("gkd,gd->gk", rows[next_], queries[go]), -np.inf).astype(np.float32)
        all_score, all_ids = np.concatenate([score[go], found], axis=1), np.concatenate([ids[go], next_], axis=1)
        all_left = np.concatenate([left[go], ~new], axis=1)
        keep = np.argpartition(-all_score, width - 1, axis=1)[:, :width]
        score[go], ids[go], left[go] = (np.take_along_axis(x, keep, 1) for x in (all_score, all_ids, all_left))


def search_graph(graph: Graph, queries: np.ndarray, k: int, width: int) -> np.ndarray:
    """About the `k` nearest nodes of each query (-1: none), found with a beam of `width`."""
    out = np.full((len(queries), k), -1, np.int64)
    if not len(graph.rows):
        return out
    q = queries.astype(np.float32)
    for a in range(0, len(q), AT_ONCE):
        own, start = q[a : a + AT_ONCE], None
        for nodes, near in reversed(graph.levels):
            rows = graph.rows[nodes]
            if start is None:
                at = np.zeros((len(own), 1), np.int32)
            else:
                at = np.searchsorted(nodes, start).astype(np.int32)
            bottom = near is graph.levels[0][1]
            ids, score = _walk(rows, near, own, at, max(width, k) if bottom else 8)
            order = np.argsort(-score, axis=1, kind="stable")
            ids = np.take_along_axis(ids, order, 1)
            ok = np.take_along_axis(score, order, 1) > -np.inf
            start = np.where(ok, nodes[ids], nodes[ids[:, :1]])
        found = np.where(ok, start, -1)[:, :k]
        out[a : a + AT_ONCE, : found.shape[1]] = found
    return out


def build_index(vectors: DataFrame, *, keep_ids: int, shard_rows: int | None = None, links: int = 24, width: int = 64) -> DataFrame:
    """An index of rows (id long, vec array): one row a shard, with its vectors, the ids of each and its graph.

    Equal vectors are one node, which keeps its `keep_ids` smallest ids: as ties go to the smaller id, no search for
    fewer can return another of them. All but those ids are dropped before the shuffle, so a vector that very many rows
    hold is not gathered anywhere.
    """
    smallest = Window.partitionBy("vec").orderBy("id")
    nodes = vectors.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= keep_ids)
    nodes = stage(nodes.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    size = nodes.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("widest")).first()
    if shard_rows is None:
        wanted = max(SHARD_ROWS, -(-size["n"] // (2 * shuffle_partitions(nodes.sparkSession))))
        shard_rows = max(1, min(wanted, SHARD_BYTES // (8 * max(size["widest"] or 1, 1))))
    shards = max(1, -(-size["n"] // shard_rows))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("vec"), F.lit(shards)))

    def build(table: pa.Table) -> pa.Table:
        rows = matrix(table.column("vec"), np.float64)
        ids = table.column("ids").combine_chunks()
        order = np.argsort(pc.list_element(ids, 0).to_numpy(), kind="stable")  # the same however rows arrive
        order = order[insertion_order(rows[order])]
        graph = build_graph(rows[order], links=links, width=width)
        own = ids.take(pa.array(order))
        data = {"vectors": rows[order], "rows": graph.rows, "levels": graph.levels, "ids": own.flatten().to_numpy(), "ends": np.cumsum(np.diff(own.offsets.to_numpy()))}
        return pa.table({"shard": table.column("shard")[:1], "data": pa.array([pickle.dumps(data, protocol=5)], pa.binary())})

    #: One file a shard, so that each is read where it lies, by a task of its own, for every block of queries.
    return stage(nodes.groupBy("shard").applyInArrow(build, "shard long, data binary"), maxRecordsPerFile="1")


def nearest(vectors: DataFrame, queries: DataFrame, k: int, *, width: int = 80, shard_rows: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each query row about its `k` nearest rows of `vectors`, by largest inner product: query_id, rank (from 1), vec_id
    and score (in double precision, on the vectors as given). Every row is indexed; each query walks through every shard's
    graph, and the shards' results are merged. Rows with the query's own id are no candidates; ties go to the smaller id.

    Nulls: rows whose id or vector is null, whose vector is zero or empty, or holds null or non-finite components, take no
    part. Vectors of different length: a component that one lacks adds nothing. Repeated queries are one; of repeated
    candidates (same id and vector) one counts. Without candidates or queries there are no rows. Other columns, whatever
    their names, are not looked at.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vec"))
        return df.where(F.col("id").isNotNull() & usable(F.col("vec")) & F.exists("vec", lambda x: x != 0))

    index = build_index(clean(vectors).distinct(), keep_ids=k + 1, shard_rows=shard_rows)

    def search(ids: np.ndarray, rows: np.ndarray) -> DataFrame:
        sent = spark.sparkContext.broadcast((ids, rows))  # one block of queries

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            query_ids, all_queries = sent.value
            for batch in batches:
                for shard in batch.column(0):
                    data = pickle.loads(shard.as_py())
                    vectors, first = data["vectors"], np.r_[0, data["ends"][:-1]]
                    queries = fit_width(all_queries, vectors.shape[1])
                    nodes = search_graph(Graph(data["rows"], data["levels"]), queries, k + 1, width)
                    q, at = np.nonzero(nodes >= 0)
                    node = nodes[q, at]
                    score = np.einsum("rd,rd->r", queries[q], vectors[node])
                    count = (data["ends"] - first)[node]
                    row = np.repeat(np.arange(len(q)), count)
                    found = data["ids"][np.repeat(first[node], count) + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)]
                    q, score = q[row], score[row]
                    other = found != query_ids[q]
                    q, score, found = q[other], score[other], found[other]
                    order = np.lexsort((found, -score, q))
                    q, score, found = q[order], score[order], found[order]
                    top = np.arange(len(q)) - np.searchsorted(q, q) < k
                    yield pa.RecordBatch.from_arrays([pa.array(query_ids[q[top]]), pa.array(found[top]), pa.array(score[top])], ["query_id", "vec_id", "score"])

        return index.select("data").mapInArrow(task, "query_id long, vec_id long, score double")

    return search_in_blocks(clean(queries), np.float64, search, k)
