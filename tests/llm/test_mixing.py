import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from fieldglass.llm import mixing, queries
from fieldglass.llm.common import stage

from .fixtures import documents, empty

WEIGH = lambda names: [(3, 1, 2)[i % 3] for i in range(len(names))]


def slow_targets(sizes, weights, total, most):
    """Share by weight, cut what is above, share the excess, until none is."""
    left, targets, open_ = total, {}, dict(enumerate(sizes))
    while open_:
        whole = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / whole > most * sizes[i]]
        if not over:
            return [targets.get(i, left * weights[i] / whole) for i in range(len(sizes))]
        for i in over:
            targets[i] = most * sizes[i]
        left -= sum(targets[i] for i in over)
        for i in over:
            del open_[i]
    return [targets[i] for i in range(len(sizes))]


def check(rows, docs, shards=64):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for d in docs:
        sizes[d["source"]] += words(d["text"])
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    targets = dict(zip(names, slow_targets([sizes[n] for n in names], WEIGH(names), 1.5 * sum(sizes.values()), 2), strict=True))
    source = defaultdict(list)
    for d in docs:
        source[d["doc_id"], words(d["text"])].append(d["source"])
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((d["doc_id"], words(d["text"])) for d in docs)
    taken, units, by_shard = Counter(), defaultdict(list), Counter()
    for r in rows:
        name = names[r["source_id"]]
        assert r["source_size"] == sizes[name] and r["target"] == pytest.approx(targets[name])
        assert 0 <= r["taken"] == sum(u["words"] for u in r["units"]) and r["taken"] <= 2 * r["size"]
        taken[name] += r["taken"]
        for u in r["units"]:
            assert 0 <= u["shard"] < shards
            by_shard[u["shard"]] += u["words"]
    for name in names:
        assert abs(taken[name] - targets[name]) <= 0.5


def test_odd_rows(spark):
    docs = documents(spark)
    check(mixing.plan_mix(docs, WEIGH).plan.collect(), docs.collect())
    assert mixing.plan_mix(empty(spark), WEIGH).plan.collect() == []
    assert mixing.mix(empty(spark), WEIGH).collect() == []


def test_hot_source_and_reruns(spark):
    rows = [(i, "w " * (i % 37 + 1), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(2000)]
    docs = documents(spark, rows)
    one = mixing.plan_mix(docs, WEIGH, shards=8)
    check(one.plan.collect(), docs.collect(), 8)
    two = mixing.plan_mix(docs.repartition(3), WEIGH, shards=8)
    strip = lambda m: sorted(str(r.asDict() | {"row": 0}) for r in m.plan.collect())
    assert strip(one) == strip(two) and (one.quotas == two.quotas).all()


def test_tree_is_exact():
    rng = np.random.default_rng(1)
    quotas = np.array([1000, 3, 0, 517], np.int64)
    for shards in (1, 2, 7, 64):
        dealt = mixing.split_quotas(quotas, shards, rng)
        assert dealt.shape == (4, shards) and (dealt.sum(axis=1) == quotas).all() and (dealt >= 0).all()
        assert dealt.sum(axis=0).max() - dealt.sum(axis=0).min() <= 6
    big = mixing.draw(np.array([5 * 10**9, 3 * 10**9]), 10**9, rng)
    assert big.sum() == 10**9 and abs(big[0] / 10**9 - 0.625) < 0.01


def test_water_fill():
    for sizes, weights in (([10, 100, 5], [3, 1, 2]), ([0, 0], [1, 1]), ([7], [2]), ([1, 1, 1000], [100, 1, 1])):
        got = mixing.water_fill(np.array(weights, float), np.array(sizes, float), 1.5 * sum(sizes), 2.0)
        assert got == pytest.approx(slow_targets(sizes, weights, 1.5 * sum(sizes), 2))


def test_mix_rows(spark):
    docs = documents(spark, [(i, "w " * 10, "en", "a" if i % 4 else "b") for i in range(400)])
    mixed = mixing.mix(docs, {"a": 1, "b": 1}, shards=4)
    assert mixed.columns == [*docs.columns, "mix_shard", "mix_key", "mix_words"]
    rows = mixed.collect()
    counts = Counter(r["doc_id"] for r in rows)
    assert max(counts.values()) <= 2 and Counter(r["source"] for r in rows) == {"a": 400, "b": 200}
    shards = Counter(r["mix_shard"] for r in rows)
    assert set(shards) == set(range(4))


def test_mix_is_shuffled_within_shards(spark):
    docs = documents(spark, [(i, "w " * (i % 9 + 1), "en", "a" if i % 4 else "b") for i in range(400)])
    rows = mixing.mix(docs, {"a": 1, "b": 1}, shards=4).collect()
    order = [(r["mix_shard"], r["mix_key"]) for r in rows]
    assert order == sorted(order) and len(set(order)) == len(order)
    units = [(u["shard"], u["key"]) for r in mixing.plan_mix(docs, {"a": 1, "b": 1}, shards=4).plan.collect() for u in r["units"]]
    assert set(order) <= set(units)


def test_query(spark, small):
    rows = queries.op6_mix_sources(spark, small)
    assert rows.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    check(mixing.plan_mix(docs, WEIGH).plan.collect(), docs.collect())


def test_large_draws():
    """The mean and spread of draws beyond numpy's range, and within it the same distribution as numpy's."""
    rng = np.random.default_rng(7)
    found = np.array([mixing.draw_large(5 * 10**9, 3 * 10**9, 10**6, rng) for _ in range(2000)])
    assert abs(found.mean() - 625_000) < 5 * 484 / 2000**0.5 and found.std() == pytest.approx(484, rel=0.08)
    small = Counter(mixing.draw_large(6, 5, 4, rng) for _ in range(20_000))
    for k in range(5):
        want = math.comb(6, k) * math.comb(5, 4 - k) / math.comb(11, 4)
        assert small[k] / 20_000 == pytest.approx(want, abs=0.015)
    assert mixing.draw_large(3, 0, 3, rng) == 3 and mixing.draw_large(3, 9, 12, rng) == 3


def test_places_are_gapless_and_by_key(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    plan = stage(mixing.plan_mix(docs, WEIGH, shards=5).plan)
    placed = {r["row"]: r["places"] for r in mixing.places(plan).collect()}
    by_shard = defaultdict(list)
    for r in plan.collect():
        assert [p["shard"] for p in placed.get(r["row"], [])] == [u["shard"] for u in r["units"]]
        for u, p in zip(r["units"], placed.get(r["row"], []), strict=True):
            by_shard[u["shard"]].append((p["slot"], u["key"]))
    for own in by_shard.values():
        assert [slot for slot, _ in sorted(own)] == list(range(len(own)))
        assert [k for _, k in sorted(own)] == sorted(k for _, k in own)
    rows = queries.op6_mix_sources(spark, small).collect()
    assert sum(len(r["slots"]) for r in rows) == sum(len(r["shards"]) for r in rows) > 0
