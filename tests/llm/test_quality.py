import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldglass.llm import quality, queries

from .fixtures import documents, empty

LABELS = "doc_id long, quality int, toxic int"


def slow_posteriors(rows):
    """Means of hosts and paths in plain Python: {(host, path): (n, s, strength, host_score, prior)}."""
    paths, hosts = {}, {}
    for h, p, x in rows:
        for table, key in ((paths, (h, p)), (hosts, h)):
            n, s = table.get(key, (0, 0.0))
            table[key] = (n + 1, s + x)
    n, s = len(rows), sum(r[2] for r in rows)
    prior = s / n

    def strength(sites):
        if len(sites) < 2:
            return 1e4
        total, squares = sum(a for a, _, _ in sites), sum(a * a for a, _, _ in sites)
        gap, var = sum(a * (b / a - m) ** 2 for a, b, m in sites), sum(a * m * (1 - m) for a, _, m in sites)
        size = (total - squares / total) / (len(sites) - 1)
        spread = (gap / ((len(sites) - 1) * var / total) - 1) / max(size - 1, 1e-9)
        return 1e4 if spread <= 0 else min(max(1 / spread - 1, 1.0), 1e4)

    k = strength([(a, b, prior) for a, b in hosts.values()])
    score = {h: (b + k * prior) / (a + k) for h, (a, b) in hosts.items()}
    k = strength([(a, b, score[h]) for (h, _), (a, b) in paths.items()])
    return {(h, p): (a, b, k, score[h], prior) for (h, p), (a, b) in paths.items()}


def test_site_posteriors(spark):
    rng = np.random.default_rng(0)
    rows = [(f"h{i % 7}", f"p{i % 3}", float(rng.beta(1 + i % 7, 3))) for i in range(600)] + [("lone", "p", 0.9)]
    got = {(r["host"], r["path"]): (r["n"], r["s"], r["strength"], r["host_score"], r["prior"]) for r in quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    want = slow_posteriors(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])


def test_sparse_sites_shrink(spark):
    rows = [("big", "p", 0.1)] * 300 + [("good", "p", 0.9)] * 300 + [("lone", "p", 0.1)]
    got = {r["host"]: r["host_score"] for r in quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert got["big"] < 0.12 < 0.15 < got["lone"] < 0.6


def test_logistic_fit():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 3)) * [1, 5, 0.1] + [0, 2, 1]
    y = (rng.random(4000) < 1 / (1 + np.exp(-(x @ [1.5, -0.4, 0] + 0.5)))).astype(float)
    w = quality.fit_logistic(x, y)
    assert w[:2] == pytest.approx([1.5, -0.4], abs=0.2)


def test_odd_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, None), (6, 0, 0), (8, None, 1), (None, 0, 1), (99, 1, 1), (1, 1, 0)], LABELS)
    out = quality.classify(docs, labels)
    assert out.columns == [*docs.columns, "quality_"]  # the input has a column of that name
    rows = out.select("doc_id", "quality_.*").collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["keep"] is not None for r in rows)
    assert quality.classify(empty(spark), labels).collect() == []
    assert quality.classify(docs, spark.createDataFrame([], LABELS)).count() == docs.count()


def test_separates(spark, middle):
    labels = spark.read.parquet(f"{middle}/labels.parquet")
    rows = queries.op1_quality(spark, middle).join(labels, "doc_id").collect()
    clean = [r for r in rows if r["quality"] and not r["toxic"]]
    assert np.mean([r["keep"] for r in clean]) > 0.99
    assert np.mean([r["keep"] for r in rows if not r["quality"]]) < 0.05
    assert np.mean([r["keep"] for r in rows if r["toxic"]]) < 0.15


def test_scores_are_those_of_the_formula(spark, small):
    """Score and keep of each row by plain Python, from the document classifier's own chances; score and classify agree."""
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    docs = docs.unionByName(docs.limit(3)).withColumn("source", F.when(F.col("doc_id") % 11 != 0, F.col("source")))
    got = quality.classify(docs, labels).select("doc_id", "source", "lang", "quality.*").collect()
    rows = [(r["source"], r["lang"], r["doc_score"]) for r in got]
    sites, hosts = slow_posteriors(rows), Counter()
    sums = Counter()
    for h, _, p in rows:
        hosts[h] += 1
        sums[h] += p
    n = len(rows)
    prior, hs = sum(sums.values()) / n, {h: (hosts[h], sums[h]) for h in hosts}
    total, squares = n, sum(a * a for a, _ in hs.values())
    gap, var = sum(a * (b / a - prior) ** 2 for a, b in hs.values()), n * prior * (1 - prior)
    spread = (gap / ((len(hs) - 1) * var / total) - 1) / max((total - squares / total) / (len(hs) - 1) - 1, 1e-9)
    strong = 1e4 if spread <= 0 else min(max(1 / spread - 1, 1.0), 1e4)
    logit = lambda x: math.log(min(max(x, 1e-6), 1 - 1e-6) / (1 - min(max(x, 1e-6), 1 - 1e-6)))
    for r in got:
        a, b, strength, _, _ = sites[r["source"], r["lang"]]
        p, (hn, hsum) = r["doc_score"], hs[r["source"]]
        host = (hsum - p + strong * prior) / (hn - 1 + strong)
        path = (b - p + strength * host) / (a - 1 + strength)
        want = 1 / (1 + math.exp(-(logit(p) + logit(path) - logit(prior))))
        assert (r["host_score"], r["path_score"], r["score"]) == pytest.approx((host, path, want), rel=1e-6)
        assert r["keep"] == (r["score"] >= 0.5)
    names = ["doc_id", "score", "keep", "doc_score", "toxic_score", "host_score", "path_score"]
    plain = lambda rows: sorted([round(v, 9) if isinstance(v, float) else v for v in r] for r in rows)
    assert plain(quality.score(docs, labels).select(*names).collect()) == plain([tuple(r[c] for c in names) for r in got])


def test_separates_held_out_labels(spark):
    """Fitted on two thirds of the labels, judged on the others."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = quality.score(docs, labels.where("doc_id % 3 <> 0")).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    rate = lambda ok: np.mean([r["keep"] for r in rows if ok(r)])
    assert len(rows) > 1000 and rate(lambda r: r["quality"] and not r["toxic"]) > 0.99
    assert rate(lambda r: not r["quality"]) < 0.02 and rate(lambda r: r["toxic"]) < 0.05


def test_lexicon_finds_words_and_beginnings():
    """Words that mark toxic texts, also by how they begin; others aren't taken, however few texts they are in."""
    rng = random.Random(3)
    plain = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    text = lambda *more: " ".join([*rng.choices(plain, k=30), *more, "rare" + "".join(rng.choices("abcdefgh", k=5))])
    rows = [(text("vile" if i % 2 else "nastyx" + rng.choice("abcdefghij") * 3), 1) for i in range(60)] + [(text(), 0) for _ in range(500)] + [(None, 1), ("", 0)]
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    found = quality.toxic_lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert {"vile", "nasty*", "nastyx*"} <= found.counts.keys() and not any(w.startswith("word") for w in found.counts)
    last = lambda text, own=None: quality.features(text, found.word_weights(own))[-1]
    assert last("so vile") > 2.5 and last("nastyxqq") > 2.5 and quality.features("a plain text", found.word_weights())[-3:] == [0, 0, 0]
    assert last("so vile", True) < last("so vile")
    few = quality.Lexicon({"x": (3, 2)}, 60, 500)
    assert few.weight("x", True) < few.weight("x", None) < few.weight("x", False) < last("so vile")


def test_labelled_rows_are_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0)] * 20 + [(2, 0, 1)], LABELS)
    seen, lexicon = [], quality.toxic_lexicon
    monkeypatch.setattr(quality, "toxic_lexicon", lambda rows: seen.append(rows.count()) or lexicon(rows))
    for most in (50, 10_001, 20_000):
        quality.fit_classifier(docs, labels, most=most)
    assert seen == [50, 10_001, 10_001]
