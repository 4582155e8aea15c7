import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldglass.llm import langid, queries

from .fixtures import documents, empty


def slow_grams(text):
    """Letters, with one space for anything else, in threes."""
    out, spaced = "", (" " + text.lower() + " ") if text else " "
    for c in spaced:
        c = c if c.isalpha() else " "
        if c != " " or not out.endswith(" "):
            out += c
    return Counter(out[i : i + 3] for i in range(len(out) - 2))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=30) | st.none(), min_size=1, max_size=5))
def test_ngrams(texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    which, bucket, has = langid.ngrams(texts)
    for i, t in enumerate(texts):
        counts = sorted(Counter(bucket[which == i].tolist()).values())
        assert sum(counts) == sum(slow_grams(t).values())
        assert has[i] == any(c.isalpha() for c in (t or "").lower())


def slow_em(p, n, rounds):
    theta = np.full(len(p), 1 / len(p))
    for _ in range(rounds):
        share = p * theta[:, None]
        share /= share.sum(axis=0)
        theta = (share * n).sum(axis=1) / n.sum()
    return theta


def test_expectation_maximisation():
    rng = np.random.default_rng(0)
    p, n = rng.dirichlet(np.ones(40), 4), rng.integers(1, 9, 40)
    lengths = np.array([25, 15])
    got, score = langid._fit(p.astype(np.float32), n.astype(np.float32), lengths, np.full((4, 2), 0.25, np.float32), 30)
    for i, part in enumerate((slice(0, 25), slice(25, 40))):
        want = slow_em(p[:, part], n[part], 30)
        assert np.allclose(got[:, i], want, atol=1e-3)
        assert np.isclose(score[i], (n[part] * np.log((p[:, part] * want[:, None]).sum(axis=0))).sum(), rtol=1e-3)


def test_mixture_of_two_languages(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    model = langid.train(docs)
    by = {r["lang"]: r["text"] for r in docs.where("n_chars > 2000").select("lang", "text").collect()}
    half = lambda lang: by[lang][:1500]
    shares, _ = langid.mixtures([half("en") + " " + half("de"), half("fr")], model.table.value)
    at = {name: i for i, name in enumerate(model.languages)}
    assert 0.35 < shares[at["en"], 0] < 0.65 and 0.35 < shares[at["de"], 0] < 0.65
    assert shares[at["fr"], 1] > 0.95 and np.allclose(shares.sum(axis=0), 1)


def test_mixture_of_all_languages(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    model = langid.train(docs)
    by = {r["lang"]: r["text"][:1500] for r in docs.where("n_chars > 2000").select("lang", "text").collect()}
    assert len(by) == len(model.languages) == 4
    (found,) = spark.createDataFrame([(" ".join(by.values()),)], "text string").select(langid.identify(F.col("text"), model).alias("f")).collect()
    assert sorted(found["f"]["langs"]) == model.languages
    assert all(0.15 < s < 0.35 for s in found["f"]["shares"]) and np.isclose(sum(found["f"]["shares"]), 1)
    shares, _ = langid.mixtures(list(by.values()), model.table.value)
    assert all(shares[model.languages.index(lang), i] > 0.95 for i, lang in enumerate(by))


def test_odd_rows(spark):
    docs = documents(spark)
    rows = langid.predict(docs).collect()
    texts = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts.elements())
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["lang_pred"] in ("en", "fr", "de", "und")
        if r["doc_id"] in (3, 4, 5, 7):
            assert (r["lang_pred"], r["score"], r["langs"]) == ("und", 0.0, [])
    assert langid.predict(empty(spark)).collect() == []


def test_without_languages(spark):
    rows = langid.predict(documents(spark, [(1, "some text", None, "a")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows] == [("und", 0.0)]


def test_held_out_accuracy(spark, middle):
    found = queries.op7_language_id(spark, middle).join(spark.read.parquet(f"{middle}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    rows = found.collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.99


def slow_mixture(text, table, least=0.01):
    """Shares by following the rule one text and one set at a time, with fits that run on to the end."""
    which, bucket, _ = langid.ngrams([text])
    keys, n = np.unique(bucket, return_counts=True)
    p, full = table[:, keys].astype(float), slow_em(table[:, keys].astype(float), n, 400)
    order = sorted(range(len(table)), key=lambda i: -full[i])
    best, found = None, None
    for size in range(1, len(table) + 1):
        own = order[:size]
        if size > 1 and full[own[-1]] < least:
            break
        theta = slow_em(p[own], n, 400)
        score = (n * np.log((p[own] * theta[:, None]).sum(axis=0))).sum() / 3 - np.log(n.sum()) / 2 * (size - 1)
        if best is None or score > best:
            best, found = score, dict(zip(own, theta, strict=True))
    return [found.get(i, 0.0) for i in range(len(table))]


def test_mixtures_choose_as_by_brute_force(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    model = langid.train(docs)
    by = {}
    for r in docs.where("lang is not null and n_chars > 300").select("lang", "text").limit(400).collect():
        by.setdefault(r["lang"], []).append(r["text"])
    names = sorted(by)
    texts = [by[a][i][: 40 + 60 * i] + " " + by[b][i][: 30 + 20 * i] for i in range(4) for a in names for b in names]
    texts += [by[a][0][:25] for a in names] + ["zq xj", " ".join(by[a][1][:200] for a in names)]
    shares, _ = langid.mixtures(texts, model.table.value)
    for i, t in enumerate(texts):
        want = slow_mixture(t, model.table.value)
        assert np.allclose(shares[:, i], want, atol=5e-3), (t, shares[:, i], want)


def test_long_texts_count_alike(monkeypatch):
    text = "Ab,  c-défg " * 50 + "!!! " * 10 + "xyz. 漢字 Ω" * 30
    whole = langid.bucket_counts([None, text, "ab", ""])
    for size in (1, 2, 3, 7, 64, 100):
        monkeypatch.setattr(langid, "CHARS_AT_ONCE", size)
        assert all(np.array_equal(a, b) for a, b in zip(whole, langid.bucket_counts([None, text, "ab", ""]), strict=True))
