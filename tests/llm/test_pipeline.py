import re
from collections import Counter

import corpus_pipeline
import pytest

from fieldglass.llm import langid, mixing, packing, quality, simhash
from fieldglass.llm.common import stage

from .fixtures import documents, empty


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_classifier", "near_dedup", "mix_sources", "best_fit_packing"]


@pytest.fixture(scope="module")
def results(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    out = [docs]
    for _, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], middle)))
    return out


def test_stages_keep_the_columns(results):
    for df in results[:-1]:
        assert df.columns == results[0].columns


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_each_stage_decides_as_its_operator(spark, middle, results):
    docs, known, good, single, mixed, packed = results
    found = docs.select("doc_id", langid.identify(docs["text"], langid.train(docs)).alias("f"))
    assert ids(known) == {r["doc_id"] for r in found.collect() if r["f"]["lang"] != "und"}
    labels = spark.read.parquet(f"{middle}/labels.parquet")
    assert ids(good) == {r["doc_id"] for r in quality.classify(known, labels).select("doc_id", "quality.keep").collect() if r["keep"]}
    bad = {r["doc_id"] for r in labels.collect() if r["quality"] and not r["toxic"]} & ids(known) - ids(good)
    assert not bad
    assert ids(single) == {r["component_id"] for r in simhash.near_duplicates(good).collect()}
    assert ids(mixed) <= ids(single) and mixed.count() > single.count()
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    had, took = Counter(), Counter()
    for r in single.collect():
        had[r["source"]] += words(r["text"])
    rows = mixed.collect()
    for r in rows:
        took[r["source"]] += words(r["text"])
    assert abs(sum(took.values()) / sum(had.values()) - 1.5) < 0.1
    starts = Counter(r["doc_id"] for r in packed.where("piece = 0").collect())
    assert starts == Counter(r["doc_id"] for r in rows)
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").isEmpty()


def test_run(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_odd_rows(spark, small):
    for docs in (documents(spark), empty(spark)):
        for _, function in corpus_pipeline.STAGES[:-1]:
            columns, docs = docs.columns, stage(function(spark, docs, small))
            assert docs.columns == columns
        corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert mixing and packing
