"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, fresh, running_total, stage

#: Sources are named by the caller, with a weight each, so a table of them fits the driver; beyond this many it refuses.
MAX_SOURCES = 10_000


@dataclass(frozen=True)
class Mix:
    """The documents of a mix.

    plan: one row a document: doc_id, source_id, size, source_size, target, taken, row and units, an array of (pass, shard,
    words, key): each place in which the mix takes the document, the words it takes there, and the key by which the
    shard is shuffled.
    quotas: number of blocks for each source (rows) and shard (columns).
    """

    plan: DataFrame
    quotas: np.ndarray


def water_fill(weights: np.ndarray, sizes: np.ndarray, total: float, most: float) -> np.ndarray:
    """Targets that share `total` by weight and stop at `most` times a source's size; the excess is shared again."""
    targets, open_ = np.zeros(len(sizes)), np.ones(len(sizes), bool)
    while weights[open_].sum() > 0:
        left = total - targets[~open_].sum()
        targets[open_] = left * weights[open_] / weights[open_].sum()
        over = open_ & (targets > most * sizes)
        if not over.any():
            break
        targets[over] = most * sizes[over]
        open_ &= ~over
    return targets


def split_quotas(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Deal `quotas` blocks of each source to `shards` shards of equal block counts: sources x shards.

    A tree halves the shards; at each node the left half's blocks are one draw from the multivariate hypergeometric
    distribution, as if all of the node's blocks had been shuffled together. So the counts add up exactly.
    """
    if shards == 1:
        return quotas[:, None]
    left = shards // 2
    drawn = int(quotas.sum()) * left // shards
    taken = draw(quotas, drawn, rng)
    return np.hstack([split_quotas(taken, left, rng), split_quotas(quotas - taken, shards - left, rng)])


def draw(quotas: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """One multivariate hypergeometric draw, source by source."""
    out, left = np.zeros_like(quotas), int(quotas.sum())
    for i, q in enumerate(map(int, quotas)):
        rest = left - q
        if not q or not n:
            k = 0
        else:
            k = int(rng.hypergeometric(q, rest, n)) if max(q, rest) < 10**9 else draw_large(q, rest, n, rng)
        out[i], n, left = k, n - k, rest
    return out


def draw_large(good: int, bad: int, n: int, rng: np.random.Generator) -> int:
    """A hypergeometric draw beyond numpy's range, by the ratio of uniforms: a point under the root of the distribution is tried
    until one lies there."""
    both, low, high = good + bad, max(0, n - bad), min(good, n)
    mean, top = n * good / both, (n + 1) * (good + 1) // (both + 2)
    spread = math.sqrt(mean * bad / both * (both - n) / max(both - 1, 1) + 0.5)
    log = lambda k: -math.fsum(map(math.lgamma, (k + 1, good - k + 1, n - k + 1, bad - n + k + 1)))
    most = log(min(max(top, low), high))
    while True:
        u, v = 1 - rng.random(), rng.random()
        k = math.floor(mean + 0.5 + (1.7155277699214135 * spread + 0.8989161620588988) * (v - 0.5) / u)  # 2 sqrt(2 / e), 3 - 2 sqrt(3 / e)
        if low <= k <= high and 2 * math.log(u) <= log(k) - most:
            return k


def plan_mix(
    docs: DataFrame, weigh, *, total: float = 1.5, most: float = 2.0, shards: int = 64, blocks_a_source: int = 256,
    seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None,
) -> Mix:
    """Plan a mix of `total` times all words, no source above `most` times its own.

    `weigh` gets the list of source names in order of code point (null last) and returns a weight for each, or is a
    mapping of weights. A source's documents are hashed to blocks; its blocks are permuted, and passes over them are
    taken until the words reach the target: the number of blocks that takes is the source's quota, exact to the block,
    and the last document gives only the words that are left. The splitting tree deals the quotas to the shards, each
    of which gets its own run of the permuted blocks; within a shard, documents are shuffled by a keyed hash.

    Nulls: a null text has size 0; null is a source of its own; a null id is kept. Empty texts have size 0 and are taken
    with 0 words. Repeated rows are rows of their own. With no rows or no words all targets are 0. Reruns agree: all
    draws come from `seed` and the rows. Other columns, whatever their names, are not looked at.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    narrow = stage(
        docs.select(
            F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"),
            F.xxhash64(text_col).alias("text_hash"), row.alias("row"),
        )
    )
    found = narrow.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    names, sizes = [r.source for r in found], np.array([r["size"] for r in found], np.int64)
    weights = [weigh.get(n, 0) for n in names] if isinstance(weigh, Mapping) else weigh(names)
    targets = water_fill(np.array(weights, float), sizes.astype(float), total * float(sizes.sum()), most)
    goals = np.rint(targets).astype(np.int64)

    rows = [(i, n, int(s), float(t), int(g)) for i, (n, s, t, g) in enumerate(zip(names, sizes, targets, goals, strict=True))]
    sources = spark.createDataFrame(rows, "source_id int, source string, source_size long, target double, goal long")
    sources = F.broadcast(sources)  # at most MAX_SOURCES rows
    block = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.lit(blocks_a_source)).cast("int")
    keyed = narrow.join(sources.select("source_id", "source"), narrow.source.eqNullSafe(sources.source)).select(
        "doc_id", "source_id", "size", block.alias("block"),
        F.xxhash64("source_id", block, F.lit(seed + 1)).alias("block_key"),
        F.xxhash64("doc_id", "text_hash", F.lit(seed + 2)).alias("doc_key"),
        "row",
    )
    #: Blocks in permuted order, documents within a block by key: the words before each document in its source.
    placed = running_total(stage(keyed), ["source_id"], ["block_key", "doc_key", "doc_id", "row"], {"before": "size"})
    placed = stage(placed)

    #: Blocks by source: at most blocks_a_source x sources rows, whatever the number of documents.
    blocks = placed.groupBy("source_id", "block", "block_key").agg(F.min("before").alias("first")).toPandas()
    blocks = blocks.sort_values(["source_id", "block_key", "block"])
    ranks, n_blocks, quotas = {}, np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
    for s, own in blocks.groupby("source_id"):
        ranks[s], n_blocks[s] = own["block"].to_numpy(), len(own)
        passes, rest = divmod(int(goals[s]), int(sizes[s])) if sizes[s] else (0, 0)
        quotas[s] = passes * len(own) + (np.searchsorted(own["first"].to_numpy(), rest) if rest else 0)
    dealt = split_quotas(quotas, shards, np.random.default_rng(seed))
    ends = np.cumsum(dealt, axis=1)
    bounds = [(int(s), int(n_blocks[s]), ends[s].tolist()) for s in ranks]
    bounds = spark.createDataFrame(bounds, "source_id int, n_blocks int, ends array<long>")
    rank = [(int(s), int(b), i) for s, own in ranks.items() for i, b in enumerate(own)]
    rank = spark.createDataFrame(rank, "source_id int, block int, rank int")
    with_rank = placed.join(F.broadcast(rank), ["source_id", "block"]).join(F.broadcast(bounds), "source_id").join(sources.drop("source"), "source_id")

    whole = F.when(F.col("source_size") > 0, F.floor(F.col("goal") / F.col("source_size"))).otherwise(0)
    rest = F.col("goal") - whole * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    passes = F.sequence(F.lit(0), F.when(F.col("before") < rest, whole).otherwise(whole - 1).cast("int"))

    def unit(p):
        at = p * F.col("n_blocks") + F.col("rank")
        return F.struct(
            p.cast("int").alias("pass"), F.size(F.filter("ends", lambda e: e <= at)).alias("shard"),
            F.when(p < whole, F.col("size")).otherwise(last).cast("long").alias("words"),
            F.xxhash64("doc_key", p, F.lit(seed + 3)).alias("key"),
        )

    units = F.when((whole > 0) | (F.col("before") < rest), F.transform(passes, unit)).otherwise(F.array().cast("array<struct<pass:int,shard:int,words:long,key:long>>"))
    out = with_rank.withColumn("units", units).withColumn("taken", F.aggregate("units", F.lit(0).cast("long"), lambda a, u: a + u.words))
    return Mix(out.select("doc_id", "source_id", "size", "source_size", "target", "taken", "units", "row"), dealt)


def places(plan: DataFrame) -> DataFrame:
    """For a plan (staged): row and places, for each unit of the document in order of passes its shard and slot, the place (from 0)
    that the shard's local shuffle gives it."""
    units = plan.select("row", F.explode("units").alias("u")).select("row", F.col("u.pass").alias("turn"), F.col("u.shard").alias("shard"), F.col("u.key").alias("key"), F.lit(1).cast("long").alias("one"))
    ranked = running_total(stage(units), ["shard"], ["key", "row", "turn"], {"slot": "one"})
    found = F.array_sort(F.collect_list(F.struct("turn", "shard", "slot")))
    return ranked.groupBy("row").agg(F.transform(found, lambda u: F.struct(u.shard, u.slot)).alias("places"))


def mix(docs: DataFrame, weigh, *, whole: bool = True, **options) -> DataFrame:
    """The mixed documents: each row of `docs` as often as the plan takes it, with mix_shard and mix_key.

    Rows lie in the order of their shards, and within a shard in that of mix_key, which is its local shuffle. With `whole`, the
    document at which a source reaches its target comes whole if at least half of it is taken, else not at all; otherwise
    mix_words tells how many words to keep.
    Takes the options of plan_mix and treats nulls, repeated rows and clashing names as it does.
    """
    row, shard, key, words, unit = fresh(docs, "mix_row", "mix_shard", "mix_key", "mix_words", "mix_unit")
    #: Numbered once and written: the numbers join the plan to the texts.
    docs = stage(docs.withColumn(row, F.monotonically_increasing_id()), compression="zstd")
    plan = plan_mix(docs, weigh, row_col=row, **options).plan.select(F.col("row").alias(row), F.explode("units").alias(unit), F.col("size").alias(words))
    if whole:
        plan = plan.where((2 * F.col(f"{unit}.words") >= F.col(words)))
    plan = plan.select(row, F.col(f"{unit}.shard").alias(shard), F.col(f"{unit}.key").alias(key), F.col(f"{unit}.words").alias(words))
    return docs.join(plan, row).drop(row).orderBy(shard, key)
