import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fieldglass.llm import packing, queries

from .fixtures import documents, empty

PATH = public_tokenizers.path("word_bpe_49k.json")


def slow_bins(lengths, capacity):
    """Best-fit decreasing, one piece after the other."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [b for b in bins if b[0] >= n]
        if fits:
            min(fits, key=lambda b: b[0])[0] -= n
        else:
            bins.append([capacity - n])
    return len(bins)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_plan_is_best_fit_decreasing(case):
    capacity, lengths = case
    counts = Counter(lengths)
    rows = packing.best_fit_decreasing(counts, capacity)
    bins = defaultdict(list)
    for n, count in counts.items():
        own = sorted(r.tolist() for r in rows if r[0] == n)
        for rank in range(count):
            _, first, bin_, each, offset = [r for r in own if r[1] <= rank][-1]
            b, slot = divmod(rank - first, each)
            bins[bin_ + b].append((offset + slot * n, n))
    assert len(bins) == slow_bins(lengths, capacity)
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= capacity


def test_capacities():
    rng, tree, open_ = random.Random(0), packing.Capacities(100), Counter()
    for _ in range(2000):
        r = rng.randint(0, 100)
        change = -1 if open_[r] and rng.random() < 0.5 else 1
        tree.add(r, change)
        open_[r] += change
        n = rng.randint(0, 100)
        assert tree.tightest(n) == min((k for k, v in open_.items() if v and k >= n), default=None)


def test_steps_stay_bounded():
    counts = {n: 10**6 + n for n in range(1, 4097)}
    assert len(packing.best_fit_decreasing(counts, 4096)) < 4 * 4096 * 12


TEXTS = ["don't I'LL we've ' s x's'", "Á à́ ̀x İstanbul ΣΑΣ ς", "<|endoftext|> x<|startoftext|>y", "a\x0bb\x0cc\rd \xa0e f\x1cg\x85h", "ﬁ Å x², ①. 12,345.6 é️👩‍👩‍👧", "", None]


def test_ids_are_those_of_whole_texts(spark, small):
    plain = Tokenizer.from_file(PATH)
    texts = TEXTS + [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    for text, got in zip(texts, packing.token_bytes(texts, PATH, 1), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_ids_of_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    got = np.frombuffer(next(packing.token_bytes([text], PATH, None)), "<u4").tolist()
    assert got == Tokenizer_.encode(text, add_special_tokens=False).ids


Tokenizer_ = Tokenizer.from_file(PATH)


def check(rows, docs, capacity=4096):
    pieces = defaultdict(dict)
    want = []
    for d in docs:
        ids = [*Tokenizer_.encode(d["text"] or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            part = ids[a : a + capacity]
            want.append((d["doc_id"], k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert Counter(want) == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    for r in rows:
        assert r["offset"] not in pieces[r["sequence_id"]]
        pieces[r["sequence_id"]][r["offset"]] = r["length"]
    for own in pieces.values():
        at = 0
        for offset, n in sorted(own.items()):
            assert offset == at
            at += n
        assert at <= capacity
    assert len(pieces) == slow_bins([w[3] for w in want], capacity)


def test_odd_rows(spark):
    docs = documents(spark)
    check(packing.pack(docs, PATH).collect(), docs.collect())
    check(packing.pack(docs, PATH, capacity=16).collect(), docs.collect(), 16)
    assert packing.pack(empty(spark), PATH).collect() == []


def test_keeps_ids(spark):
    for r in packing.pack(documents(spark), PATH, capacity=50, keep_ids=True).collect():
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]


def test_query(spark, small):
    check(queries.op4_best_fit_packing(spark, small).collect(), spark.read.parquet(f"{small}/documents.parquet").collect())


def ids_by_tokenizer(texts):
    made = Tokenizer.from_file(PATH).encode_batch_fast(texts, add_special_tokens=False)
    return [np.array(e.ids, "<u4").tobytes() for e in made]


LETTERS = [c for c in map(chr, range(0x80, 0x30000)) if c.isalpha()]


def test_ids_of_every_letter_before_every_mark():
    for mark in packing.MARKS.decode():
        words = [f"a{c}{mark}" for c in LETTERS]
        assert list(packing.token_bytes(words, PATH, None)) == ids_by_tokenizer(words)


def test_ids_of_random_strings():
    rng = random.Random(11)
    pool = LETTERS + list(packing.MARKS.decode()) * 800 + list("abc xyz'\u00e9 ") * 400 + [chr(i) for i in range(0x300, 0x370)] * 20 + ["\u0130", "\u0958"] * 300
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(20_000)]
    assert list(packing.token_bytes(texts, PATH, None)) == ids_by_tokenizer(texts)
