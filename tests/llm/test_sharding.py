import zlib
from collections import Counter, defaultdict

from fieldglass.llm import queries
from fieldglass.llm.common import components, running_total
from fieldglass.llm.sharding import assign_shards

from .fixtures import documents, empty


def check(rows, docs, shards):
    size = lambda t: len((t or "").encode()) + 16
    crc = lambda t: zlib.crc32((t or "").encode())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((d["doc_id"], size(d["text"]), crc(d["text"])) for d in docs)
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    share, most = sum(size(d["text"]) for d in docs) / shards, max((size(d["text"]) for d in docs), default=0)
    for s in range(shards):
        assert abs(sum(r["size"] for r in by[s]) - share) <= most
    # contiguous: a shard's rows lie between those of the shards beside it, without a gap
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    at = 0
    for r in ordered:
        assert r["start"] == at
        at += r["size"]


def test_odd_rows(spark):
    docs = documents(spark)
    check(assign_shards(docs, 3).collect(), docs.collect(), 3)
    assert assign_shards(empty(spark), 3).collect() == []


def test_hot_copies_are_split(spark):
    docs = documents(spark, [(i % 5, "same text", "en", "a") for i in range(3000)] + [(i, f"other {i}", "en", "b") for i in range(1000)])
    check(assign_shards(docs, 7).collect(), docs.collect(), 7)


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = queries.op10_byte_shards(spark, small)
    assert found.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = found.collect()
    assert {r["law"] for r in rows} == {"bytes"} and len(rows) == docs.count()
    check(assign_shards(docs, 40).collect(), docs.collect(), 40)


def test_running_total(spark):
    rows = [(i % 3, (i * 7919) % 1000, i, i % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, o int, i int, v long")
    got = {r["i"]: r["before"] for r in running_total(df, ["k"], ["o", "i"], {"before": "v"}).collect()}
    for k, o, i, _ in rows:
        assert got[i] == sum(r[3] for r in rows if r[0] == k and (r[1], r[2]) < (o, i))


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 140)] + [(-5, 7), (200, 201), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: -5 for i in range(61)}, -5: -5, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
