import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from fieldglass.llm import lm, queries

from .fixtures import documents, empty


def small_network(seed=3):
    rng = np.random.default_rng(seed)
    net = lm.Network.initial(rng.integers(1, 900, lm.CLASSES * lm.WIDTH), seed)
    for v in net.w.values():
        v += rng.normal(0, 0.3, v.shape).astype(np.float32)
    return net


def slow_states(net, symbols, end):
    """The states after an end and each symbol but the last, one gate at a time."""
    n, h, out = lm.HIDDEN, np.zeros(lm.HIDDEN), []
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    for x in [end, *symbols[:-1]]:
        gx, gh = net.w["x"][x], h @ net.w["u"] + net.w["b"]
        r, z = sigmoid(gx[:n] + gh[:n]), sigmoid(gx[n : 2 * n] + gh[n : 2 * n])
        new = np.tanh(gx[2 * n :] + r * gh[2 * n :])
        h = (1 - z) * new + z * h
        out.append(h)
    return out


def slow_score(net, symbols, end):
    total = 0.0
    for h, y in zip(slow_states(net, symbols, end), symbols, strict=True):
        c = y // lm.WIDTH
        for logits, at in ((h @ net.w["wc"] + net.w["bc"], c), (h @ net.w["wo"][c] + net.w["bo"][c], y % lm.WIDTH)):
            total += logits[at] - math.log(np.exp(logits).sum())
    return total / math.log(10)


def texts_of(rng, n, end, longest=300):
    return [np.append(rng.integers(0, lm.CLASSES * lm.WIDTH, rng.integers(0, longest)), end).astype(np.int32) for _ in range(n)]


def test_scores_carry_state_over_windows():
    net, rng = small_network(), np.random.default_rng(0)
    texts = texts_of(rng, 12, 5)
    want = [slow_score(net, t.tolist(), 5) for t in texts]
    for slots, window in ((1, 7), (5, 64), (512, 16)):
        assert lm.score_texts(net, texts, 5, slots, window) == pytest.approx(want, rel=1e-4)
    assert lm.score_texts(net, [], 5).tolist() == []


def test_chances_sum_to_one():
    net = small_network()
    h = np.tanh(np.random.default_rng(1).normal(size=(1, lm.HIDDEN))).astype(np.float32)
    every = np.arange(lm.CLASSES * lm.WIDTH)
    for bounded in (False, True):
        chance, _ = net.log_chance(np.repeat(h, len(every), axis=0), every, bounded=bounded)
        assert np.exp(chance.astype(float)).sum() == pytest.approx(1, abs=1e-4)


def test_gradient():
    """One step's gradient of the output layers against differences."""
    net, rng = small_network(), np.random.default_rng(2)
    h, y = np.tanh(rng.normal(size=(6, lm.HIDDEN))).astype(np.float32), rng.integers(0, lm.CLASSES * lm.WIDTH, 6)
    for k in net.w:
        net.w[k] = net.w[k].astype(np.float64)
    grad = {k: np.zeros_like(v) for k, v in net.w.items()}
    _, back = net.log_chance(h.astype(float), y, grad)
    loss = lambda: -net.log_chance(h.astype(float), y)[0].sum()
    for k, at in (("wc", (3, 7)), ("bc", (4,)), ("bo", (int(y[0]) // lm.WIDTH, 2)), ("wo", (int(y[0]) // lm.WIDTH, 5, 1))):
        was = net.w[k][at]
        net.w[k][at] = was + 1e-5
        up = loss()
        net.w[k][at] = was - 1e-5
        down = loss()
        net.w[k][at] = was
        assert grad[k][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-5)
    assert back.shape == h.shape


def test_training_learns_what_context_tells():
    """Symbols that alternate: what comes next is known from what came before, not from how often it comes."""
    n = lm.CLASSES * lm.WIDTH
    counts = np.zeros(n, int)
    counts[[10, 500, 3]] = 1000, 1000, 50
    net = lm.Network.initial(counts)
    texts = [np.array([10, 500] * 40 + [3], np.int32) for _ in range(64)]
    before = lm.score_texts(net, texts, 3).sum()
    for _ in range(4):
        lm.train_texts(net, texts, 3)
    after = lm.score_texts(net, texts, 3).sum()
    assert after > 0.35 * before


def test_training_sees_every_token(spark, tmp_path, monkeypatch):
    """Texts of any length go to the network whole, each once, and end with an end."""
    import pickle

    train_texts = lm.train_texts

    def noted(net, texts, end, **more):
        (tmp_path / f"{random.getrandbits(64)}").write_bytes(pickle.dumps([t.tolist() for t in texts]))
        train_texts(net, texts, end, **more)

    monkeypatch.setattr(lm, "train_texts", noted)
    lengths = [0, 1, 31, 32, 33, 200, 513, 3000, 20000]
    docs = [" ".join(f"w{(i * 7 + j * j) % 50}" for j in range(n)) for i, n in enumerate(lengths)]
    words = Counter(w for d in docs for w in [*d.encode().split(), lm.END])
    ranks = {w: i for i, (w, _) in enumerate(words.most_common())}
    vocabulary = lm.Vocabulary(ranks, np.array([n for _, n in words.most_common()]), sum(words.values()), len(words))
    lm.train(spark.createDataFrame([(d,) for d in docs], "text string"), vocabulary)
    symbol = vocabulary.symbol_of_rank()
    want = sorted([int(symbol[ranks[w]]) for w in [*d.encode().split(), lm.END]] for d in docs)
    assert sorted(t for f in tmp_path.iterdir() for t in pickle.loads(f.read_bytes())) == want


def test_a_long_text_takes_no_more_room_than_its_symbols():
    texts = [np.zeros(50_000, np.int32), *(np.zeros(20, np.int32) for _ in range(500))]
    symbols, number, _ = lm._lay_out(texts, 96)
    assert symbols.size < 4 * 60_000 and [int((number == i).sum()) for i in (0, 1, 500)] == [50_000, 20, 20]


def test_averages():
    import pickle

    total, w = lm._average([(1, pickle.dumps({"a": np.ones(2)})), (3, pickle.dumps({"a": np.full(2, 5.0)}))])
    assert total == 4 and w["a"].tolist() == [4, 4]


def test_most_frequent(spark):
    rows = [(f"w{i}".encode(), 1 + i * i % 977) for i in range(3000)]
    df = spark.createDataFrame(rows, "word binary, n long")
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert lm.most_frequent(df) == want
    some = lm.most_frequent(df, 100)
    assert 50 < len(some) <= 100 and some == want[: len(some)]


def slow_counts(docs):
    out = Counter()
    for i, t in docs:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            out.update((t or "").encode().lower().split())
            out[b""] += 1
    return out


def check(rows, docs):
    counts = slow_counts(docs)
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in docs:
        tokens = [*(t or "").encode().lower().split(), b""]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        want.append((str(i), zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, len(tokens), sum(counts[w] > 0 for w in tokens), total, base))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-9)
    assert all(np.isfinite(r["score"]) and r["score"] <= 0 for r in rows)


def test_odd_rows(spark):
    docs = documents(spark)
    check(lm.score(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])
    assert lm.score(empty(spark)).collect() == []
    held = documents(spark, [(i, "a b", "en", "s") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2])
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 for r in lm.score(held).collect())


def test_scores_do_not_depend_on_how_rows_are_dealt(spark, middle, monkeypatch):
    """The same scores, but for rounding, from one task, from many, and from rows in another order; with several groups."""
    monkeypatch.setattr(lm, "GROUP_TOKENS", 60_000)
    docs = spark.read.parquet(f"{middle}/documents.parquet").where("doc_id < 300").select("doc_id", "text")
    scores = lambda df: {r["doc_id"]: (r["n_known"], r["base_score"], r["score"], r["n_tokens"]) for r in lm.score(df).collect()}
    one = scores(docs.coalesce(1))
    for other in (docs.repartition(64, "doc_id"), docs.orderBy(docs["text"].desc()).repartition(5)):
        got = scores(other)
        assert got.keys() == one.keys()
        for k, (known, base, score, n) in got.items():
            assert known == one[k][0] and base == pytest.approx(one[k][1], rel=1e-9) and abs(score - one[k][2]) < 1e-3 * n


def test_unlisted_words_are_joined_by_themselves(spark, monkeypatch):
    """Words outside the table, whatever bytes they are of, count as they should."""
    monkeypatch.setattr(lm, "TABLE_WORDS", 5)
    docs = documents(spark, [(i, f"a b a b c{i % 3} d{i % 7} É{i} x\u0000y", "en", "s") for i in range(40)])
    check(lm.score(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_query_beats_counts_on_held_out_texts(spark, middle):
    rows = queries.op8_recurrent_lm(spark, middle).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{middle}/documents.parquet").collect()])
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_gradient_through_time():
    """One window's gradient of the recurrent weights against differences, with texts that begin within it and state before it."""
    net, rng = small_network(5), np.random.default_rng(4)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    steps, k = 7, 3
    y = rng.integers(0, lm.CLASSES * lm.WIDTH, (steps, k)).astype(np.int32)
    x = rng.integers(0, 40, (steps, k)).astype(np.int32)
    starts, own = rng.random((steps, k)) < 0.2, np.ones((steps, k), bool)
    own[-2:, 2] = False
    h0 = np.tanh(rng.normal(size=(k, lm.HIDDEN)))

    def loss():
        cell, h, total = lm.Cell(net.w), h0.copy(), 0.0
        for t in range(steps):
            h[starts[t]] = 0
            cell.step(x[t], h, *np.empty((4, k, lm.HIDDEN)))
            total -= net.log_chance(h[own[t]], y[t][own[t]])[0].sum()
        return total

    grad, rows = lm.gradient(net, x, y, starts, own, h0.copy())
    at_row = {int(r): i for i, r in enumerate(rows)}
    assert sorted(at_row) == sorted(set(x.ravel().tolist()))
    places = [("u", (3, 5)), ("u", (0, 30)), ("u", (7, 60)), ("b", (2,)), ("b", (33,)), ("b", (70,)), ("wc", (1, 2)), ("x", (int(x[0, 0]), 4)), ("x", (int(x[2, 1]), 29)), ("x", (int(x[4, 2]), 66))]
    for key, at in places:
        was = net.w[key][at]
        net.w[key][at] = was + 1e-5
        up = loss()
        net.w[key][at] = was - 1e-5
        down = loss()
        net.w[key][at] = was
        got = grad[key][(at_row[at[0]], at[1])] if key == "x" else grad[key][at]
        assert got == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-6), (key, at)


def test_a_long_text_beside_short_ones_takes_little_room():
    import tracemalloc

    net, texts = small_network(), [np.zeros(500_000, np.uint16), *(np.zeros(5, np.uint16) for _ in range(511))]
    tracemalloc.start()
    assert np.isfinite(lm.score_texts(net, texts, 5)).all()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100_000_000


def test_words_are_those_of_bytes():
    """Cut and lower-cased by Arrow as bytes.lower().split() does, with an end after each text, whatever the parts."""
    import pyarrow as pa

    odd = "\x1c \x85 \u00a0 \u2028 \u3000 \x00 É İ \u212a ß AbC"
    texts = [None, "", " ", "\t\n\v\f\r ", "a", " a", "a ", "A  b\x0bC\x0cd\re\nf\tg", odd, f"  {odd}\n", odd.replace(" ", ""), "x" * 300, None, "", "B a"]
    want = [[*(t or "").encode().lower().split(), lm.END] for t in texts]
    column, large = (pa.array(["no", *texts], kind).slice(1) for kind in (pa.string(), pa.large_string()))
    for given in (column, large, large.cast(pa.string())):
        for most in (1, 20, 400, 8_000_000):
            got = []
            for first, begins, words in lm.words_of(given, most):
                assert first == len(got)
                got += [words[a:b].to_pylist() for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]
            assert got == want
    assert list(lm.words_of(pa.array([], pa.string()))) == []


def test_chances_take_no_more_work_than_their_rows(monkeypatch):
    """A class's logits once a row, and those within the class once a row, however rows are spread over the classes."""
    net, n, taken, exp = small_network(), 3000, [], np.exp
    y = np.random.default_rng(6).zipf(1.3, n) % (lm.CLASSES * lm.WIDTH)
    h = np.zeros((n, lm.HIDDEN), np.float32)
    monkeypatch.setattr(np, "exp", lambda a, **more: (taken.append(a.size), exp(a, **more))[1])
    net.log_chance(h, y, {k: np.zeros_like(v) for k, v in net.w.items()}, True)
    assert sum(taken) == n * (lm.CLASSES + lm.WIDTH)


def test_a_token_takes_few_calls(monkeypatch):
    """The way back goes by one product a token for all gates, not by one for each."""
    net, rng, products, matmul = small_network(), np.random.default_rng(7), [], np.matmul
    x, y = (rng.integers(0, 90, (50, 4)).astype(np.int32) for _ in range(2))
    monkeypatch.setattr(np, "matmul", lambda *of, **more: (products.append(1), matmul(*of, **more))[1])
    monkeypatch.setattr(net, "log_chance", lambda h, *_: (None, np.zeros_like(h)))
    lm.gradient(net, x, y, np.zeros(x.shape, bool), np.ones(x.shape, bool), np.zeros((4, lm.HIDDEN), np.float32))
    assert len(products) <= 50 * (3 + 1)


def test_saturated_gates():
    """Where exp overflows, gates are 0 or 1 and states stay finite, without a warning."""
    import warnings

    net, texts = small_network(), texts_of(np.random.default_rng(8), 6, 5)
    net.w["x"] *= 1000
    with np.errstate(over="ignore"):
        want = [slow_score(net, t.tolist(), 5) for t in texts]
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert lm.score_texts(net, texts, 5) == pytest.approx(want, rel=1e-4)
        lm.train_texts(net, texts, 5)
    assert all(np.isfinite(v).all() for v in net.w.values())
