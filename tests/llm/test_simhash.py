import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldglass.llm import queries, simhash

from .fixtures import documents, empty


def slow_print(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    out = 0
    for bit in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles) > len(shingles):
            out |= 1 << bit
    return out


def slow_classes(prints, distance):
    """The class of each fingerprint by looking at all pairs."""
    up = {p: p for p in prints}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and bin(a ^ b).count("1") <= distance:
                up[top(a)] = top(b)
    return {p: top(p) for p in prints}


@settings(max_examples=50, deadline=None)
@given(st.text(max_size=60) | st.none())
def test_fingerprint(text):
    if text is not None:
        text = text.encode("utf-8", "ignore").decode()
    assert simhash.fingerprint(text) & (2**64 - 1) == slow_print(text)


def expected(docs, distance=4):
    prints = [slow_print(t) for _, t in docs]
    classes = slow_classes(set(prints), distance)
    least = {}
    for (i, _), p in zip(docs, prints):
        if i is not None:
            least[classes[p]] = min(i, least.get(classes[p], i))
    return [(i, p, least.get(classes[p])) for (i, _), p in zip(docs, prints)]


def key(x):
    return tuple((v is None, v or 0) for v in x)


def check(spark, docs, distance=4):
    got = [(r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.near_duplicates(docs, distance=distance).collect()]
    assert sorted(got, key=key) == sorted(expected([(r["doc_id"], r["text"]) for r in docs.collect()], distance), key=key)


def test_odd_rows(spark):
    check(spark, documents(spark))
    assert simhash.near_duplicates(empty(spark)).collect() == []


def links_of(spark, prints, distance):
    frame = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    return [(r["a"] & (2**64 - 1), r["b"] & (2**64 - 1)) for r in simhash.candidate_links(frame, distance).collect()]


def test_links_keep_all_classes(spark):
    """Dense clusters, chains and chance neighbours, for several distances: classes are those of all pairs, links are true."""
    rng = random.Random(7)
    for distance in (0, 1, 3, 4, 7):
        prints = set()
        for _ in range(12):
            p = rng.getrandbits(64)
            for _ in range(25):
                prints.add(p)
                q = p
                for _ in range(rng.randint(1, 2 * distance + 2)):
                    q ^= 1 << rng.randrange(64)
                p = q if rng.random() < 0.5 else p
                prints.add(q)
        links = links_of(spark, prints, distance)
        assert all(bin(a ^ b).count("1") <= distance for a, b in links)
        up = {p: p for p in prints}

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in links:
            up[top(a)] = top(b)
        want = slow_classes(prints, distance)
        pairs = lambda of: {frozenset(x for x in prints if of(x) == r) for r in map(of, prints)}
        assert pairs(top) == pairs(want.get)


def test_run_of_near_copies_is_a_forest(spark):
    """Within one file of many alike fingerprints links stay fewer than fingerprints."""
    base = random.Random(3).getrandbits(64)
    prints = {base} | {base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)}
    links = links_of(spark, prints, 4)
    assert len(links) < 70 * len(prints)


def test_drop(spark):
    docs = documents(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in expected([(r["doc_id"], r["text"]) for r in docs.collect()])}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == want
    assert simhash.drop_near_duplicates(empty(spark)).collect() == []


def test_query(spark, small):
    rows = queries.op3_simhash_dedup(spark, small).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert sorted((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in rows) == sorted(expected(docs))
    assert all(len(r["fingerprint"]) == 16 for r in rows)
