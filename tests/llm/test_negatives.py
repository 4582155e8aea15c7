import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldglass.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, id string, w string, raw string, norm string, spread string, vec string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, anchors, positives=5, count=10, low=30, high=90):
    whole = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    rows = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if i is not None and label is not None and whole(v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a, va, la in {(i, tuple(v), label) for i, v, label in rows if i in anchors}:
        scored = sorted((-score(va, v), i, label) for i, v, label in rows if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:positives]:
            found = [x for x in scored if x[2] != la and low * -s <= 100 * -x[0] <= high * -s][:count]
            out += [(a, p, r, n, -s, -t) for r, (t, n, _) in enumerate(found, 1)]
    return Counter(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, *("x" * 6)) for i, v, label in rows], SCHEMA)


def mined(df, anchors, **options):
    return Counter(tuple(r) for r in negatives.mine(df, lambda v: v.where(F.col("vec_id").isin(list(anchors))), **options).select(*COLUMNS).collect())


@pytest.mark.parametrize("first_rows,at_once", [(256, 4), (16_384, None)])
def test_all_against_brute_force(spark, monkeypatch, first_rows, at_once):
    """Norms of all sizes, ties and copies, in two passes and several blocks of anchors."""
    monkeypatch.setattr(negatives, "FIRST_ROWS", first_rows)
    draw = random.Random(5)
    rows = []
    for i in range(1500):
        size = draw.choice([0.01, 0.3, 1.0, 5.0])
        rows.append((i, [round(draw.gauss(0.2, 1) * size, 3) for _ in range(6)], draw.randrange(3)))
    rows += [(2000 + i, rows[i % 7][1], i % 3) for i in range(300)]  # a large group of copies
    anchors = set(range(0, 1500, 150)) | {2000, 2001}
    assert mined(frame(spark, rows).repartition(7), anchors, at_once=at_once) == brute(rows, anchors)


def test_odd_rows(spark):
    rows = [
        (1, [1.0, 0.0], 0), (2, [0.5, 0.5], 0), (2, [0.5, 0.5], 0), (3, [0.4, 0.1], 1), (4, [0.4, 0.1], 2), (4, [0.3, 0.1], 2), (5, [], 1), (6, [0.2], 1), (7, [0.3, 0.0, 9.0], 1),
        (None, [1.0, 1.0], 1), (8, None, 1), (9, [1.0, None], 1), (10, [float("nan"), 1.0], 1), (11, [float("inf"), 1.0], 1), (12, [0.4, 0.2], None), (1, [0.1, 0.9], 1), (13, [-1.0, 0.0], 0),
        (14, [0.0, 0.0], 3), (15, [0.0, 0.0], 3),
    ]
    anchors = {1, 2, 5, 13, 14}
    found = mined(frame(spark, rows), anchors)
    assert found == brute(rows, anchors) and found
    assert not mined(frame(spark, rows), set())
    assert not mined(frame(spark, []), anchors)
    assert not mined(frame(spark, [(1, [1.0], 0), (2, [1.0], 0)]), {1, 2})  # no other label


def test_buckets_beyond_the_bound_are_left_out(spark, monkeypatch):
    """A bucket whose bound stays below the window's lower limit is never scored."""
    import numpy as np

    looked = []
    exact = negatives._exact
    monkeypatch.setattr(negatives, "_exact", lambda q, r: looked.append(len(r)) or exact(q, r))
    rows = [(i, [1.0 if i < 300 else 0.001, 0.0], 1) for i in range(600)]
    index = negatives.build_buckets(frame(spark, rows).select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), negatives.quantised("embedding").alias("vec")).coalesce(1)).coalesce(1)
    batches = index.orderBy(F.desc("norm")).toArrow().to_batches()
    one = lambda x: np.array([x], np.int64)
    window = negatives.Windows(one(-1), one(0), np.array([[256, 0]]), one(0), one(256 * 256 // 2), one(256 * 256 * 2), True, one(negatives.LEAST))
    found = negatives.search_buckets(batches, window, 10)
    assert found.shape[1] == 10 and sum(looked) < 600


def test_query(spark, small):
    found = queries.op13_hard_negatives(spark, small)
    assert found.columns == COLUMNS
    rows = [(r["vec_id"], list(r["embedding"]), (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert Counter(tuple(r) for r in found.collect()) == brute(rows, {i for i, _, _ in rows if i % 100 == 0})
