"""What the operators of this subpackage share: words, memory of workers, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.staging import drop, fresh, running_total, shared_folder, shuffle_partitions, stage, stage_only

__all__ = ["WORD", "components", "drop", "fresh", "give_back", "join_hot", "join_salted", "running_total", "shared_folder", "shuffle_partitions", "stage", "stage_only"]

#: A word: a run of characters other than ASCII white space. bytes.split() cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"

T = TypeVar("T")


def give_back(batches: Iterable[T]) -> Iterator[T]:
    """The batches; after the last, freed memory goes back to the system. Workers stay for the next stage, and an executor's
    memory must hold those that wait as well."""
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def components(links: DataFrame) -> DataFrame:
    """Connected components of undirected `links` (a, b: long, not null). Returns node, root: the least node reachable.

    Alternates two steps until nothing changes: every node passes the least of its neighbours to its larger ones, then
    to its smaller ones. Stars come together in a logarithmic number of rounds; each round is written out, so that the
    lineage stays short. Least neighbours are pre-aggregated, and a node with very many links is a skewed join that
    adaptive execution splits.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        old, edges = edges, stage(small.distinct())
        drop(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = now


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """`left` joined (inner or left) with `right`, which has at most one row a key, where a few keys may hold most of `left`.

    Keys that hold more than their task's share of `left`, of which there are fewer than shuffle partitions, meet their rows
    by a broadcast, where the rows lie; the others by a shuffle. `left` is read three times: stage it.
    """
    tasks = shuffle_partitions(left.sparkSession)
    share = left.count() // tasks + 1
    hot = [r[0] for r in left.groupBy(key).count().where((F.col("count") > share) & F.col(key).isNotNull()).select(key).collect()]
    if not hot:
        return left.join(right, key, how)
    is_hot = lambda df: F.coalesce(df[key].isin(hot), F.lit(False))
    few = F.broadcast(right.where(is_hot(right)))  # fewer rows than shuffle partitions
    return left.where(is_hot(left)).join(few, key, how).unionByName(left.where(~is_hot(left)).join(right, key, how))


def join_salted(left: DataFrame, right: DataFrame, key: str, spread: str) -> DataFrame:
    """`left` joined with `right`, which has at most one row a key, where a few keys may hold most of `left` and rows of `right`
    may be large, so that they aren't to be broadcast: rows of a hot key are dealt to all tasks by `spread`, a column of
    `left`, and each task gets its copy of the key's row of `right`. `left` is read twice: stage it."""
    tasks = shuffle_partitions(left.sparkSession)
    share = left.count() // tasks + 1
    hot = [r[0] for r in left.groupBy(key).count().where((F.col("count") > share) & F.col(key).isNotNull()).select(key).collect()]
    if not hot:
        return left.join(right, key)
    salt = lambda df, c: F.when(F.coalesce(df[key].isin(hot), F.lit(False)), c).otherwise(0)
    dealt = left.withColumn("salt", salt(left, F.pmod(F.xxhash64(spread), F.lit(tasks)).cast("int")))
    copies = right.withColumn("salt", F.explode(F.sequence(F.lit(0), salt(right, F.lit(tasks - 1)))))
    return dealt.join(copies, [key, "salt"]).drop("salt")
