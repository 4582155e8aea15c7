import math

import numpy as np
from pyspark.sql import functions as F

from fieldglass.llm import hnsw, queries, topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, id int, vec string, rank int, score int, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", 2, 3, 4) for i, v in rows], SCHEMA)


ODD = [
    (0, [0.5, -0.25, 1.0]), (1, [0.5, -0.25, 1.0]), (2, None), (3, [0.1, None, 0.2]), (4, [float("nan"), 0.0, 0.0]), (5, [float("inf"), 0.0, 0.0]),
    (6, [0.0, 0.0, 0.0]), (7, []), (8, [0.3]), (None, [0.1, 0.2, 0.3]), (9, [-1.0, 0.5, 0.001]), (9, [-1.0, 0.5, 0.001]), (10, [-0.004, 0.0039, 2.5]),
    (100, [0.9, 0.9, -0.9]), (100, [0.9, 0.9, -0.9]), (50, [-0.5, -0.25, -1.0]),
]


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def slow_top(rows, queries_, k, make, score, nonzero=False):
    rows = [(i, make(v)) for i, v in rows if i is not None and good(v) and (not nonzero or any(v))]
    out = {}
    for q, v in {(i, tuple(v)) for i, v in rows if queries_(i)}:
        found = sorted((-score(v, w), i) for i, w in rows if i != q)
        out[q] = [(i, -s) for s, i in found][:k]
    return out


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def test_exact_on_odd_rows(spark):
    df = frame(spark, ODD)
    got = topk.exact_top_k(df, df.where("vec_id % 50 = 0"), 5).collect()
    want = slow_top(ODD, lambda i: i % 50 == 0, 5, lambda v: [math.floor(256 * float(np.float32(x))) for x in v], dot)
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert by == {q: v for q, v in want.items() if v}
    none = frame(spark, [])
    assert topk.exact_top_k(none, none, 5).collect() == [] and topk.exact_top_k(df, none, 5).collect() == []


def test_exact_with_pruning_and_ties(spark):
    """Clustered vectors, many of them equal, over several blocks."""
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (np.round(centres[i % 6] + 0.1 * rng.normal(size=8), 1) if i % 4 else np.ones(8)).tolist()) for i in range(3000)]
    df = frame(spark, rows)
    got = topk.exact_top_k(df, df.where("vec_id % 100 = 0"), 5).collect()
    want = slow_top(rows, lambda i: i % 100 == 0, 5, lambda v: [math.floor(256 * float(np.float32(x))) for x in v], dot)
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == {(q, k + 1, i, s) for q, v in want.items() for k, (i, s) in enumerate(v)}


def test_query_blocks(spark):
    df = frame(spark, [(i, [i / 7, -i / 3]) for i in range(200)]).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    parts = list(vectors.query_blocks(df.union(df), np.float64, at_once=50))
    assert len(parts) == 4 and sorted(i for ids, _ in parts for i in ids.tolist()) == list(range(200))

    def search(ids, rows):
        return spark.createDataFrame([(int(i), int(i) + 1, float(r[0])) for i, r in zip(ids, rows, strict=True)], "query_id long, vec_id long, score double")

    found = vectors.search_in_blocks(df, np.float64, search, 3, at_once=50).collect()
    assert sorted(r["query_id"] for r in found) == list(range(200)) and {r["rank"] for r in found} == {1}


def test_nearest_on_odd_rows(spark):
    df = frame(spark, ODD)
    got = hnsw.nearest(df, df.where("vec_id % 50 = 0"), 4).collect()
    rows = [(i, tuple(v)) for i, v in ODD if i is not None and good(v) and any(v)]
    rows = [(i, list(map(float, np.float32(v)))) for i, v in dict.fromkeys(rows)]
    want = slow_top(rows, lambda i: i % 50 == 0, 4, list, dot, nonzero=True)
    by = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 9)))
    assert by == {q: [(i, round(s, 9)) for i, s in v] for q, v in want.items() if v}
    none = frame(spark, [])
    assert hnsw.nearest(none, none, 4).collect() == []


def test_one_vector_held_by_many_rows(spark):
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 else [i / 100, 1.0, -1.0]) for i in range(600)]
    df = frame(spark, rows)
    got = hnsw.nearest(df, df.where("vec_id = 1"), 5).collect()
    assert [(r["rank"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"])] == [(k + 1, i) for k, i in enumerate((2, 4, 5, 7, 8))]


def test_recall(spark):
    """Vectors of different lengths in several shards."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 24)) * rng.uniform(0.5, 2, (3000, 1))
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    got = hnsw.nearest(df, df.where("vec_id % 20 = 0"), 20, shard_rows=1000).collect()
    x = x.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, 3000, 20):
        score = x @ x[q]
        score[q] = -np.inf
        own = [r for r in got if r["query_id"] == q]
        assert len(own) == 20 and all(abs(r["score"] - score[r["vec_id"]]) < 1e-9 for r in own)
        hits += len(set(np.argsort(-score)[:20].tolist()) & {r["vec_id"] for r in own})
    assert hits / 3000 > 0.95


def test_queries(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    pairs = [(r["vec_id"], r["embedding"]) for r in rows]
    want = slow_top(pairs, lambda i: i % 50 == 0, 5, lambda v: [math.floor(256 * x) for x in v], dot)
    got = queries.op2_exact_top_k(spark, small).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == {(q, k + 1, i, s) for q, v in want.items() for k, (i, s) in enumerate(v)}
    got = queries.op5_hnsw_neighbours(spark, small).collect()
    want = slow_top(pairs, lambda i: i % 20 == 0, 20, list, dot)
    hits = sum(r["vec_id"] in {i for i, _ in want[r["query_id"]]} for r in got)
    assert len(got) == 20 * len(want) and hits / len(got) > 0.9
