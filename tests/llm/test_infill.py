import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldglass.llm import infill, queries

from .fixtures import documents, empty

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "text", "output"]


def brute(ident, text, rate=50, spm=80, seed=42):
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted(x % (n + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return ident, n, "plain", None, None, text, text
    if h[3] % 100 < spm:
        return ident, n, "spm", len(prefix), len(middle), text, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return ident, n, "psm", len(prefix), len(middle), text, f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(docs, **options):
    own = {k: v for k, v in options.items() if k != "chunk"}
    found = infill.transform(docs, **options)
    assert found.columns == COLUMNS
    rows = found.withColumn("back", infill.restore(F.col("output"), F.col("form"))).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in rows) == Counter(brute(d["doc_id"], d["text"], **own) for d in docs.collect())
    assert all(r["back"] == r["text"] for r in rows)
    return rows


def texts(n, most):
    draw = random.Random(n)
    pieces = ["a", "bc", " ", "  ", "\n", "\t\x0b", "é", "漢字", "😀", "\x00", " ", " ", "<", "<P", "S>", ">", "word"]
    return [(i % (n - 3), "".join(draw.choices(pieces, k=draw.randrange(most))), "en", "a") for i in range(n)]


@pytest.mark.parametrize("chunk", [1, 2, 5, 64, 1 << 20])
def test_chunks_of_any_size(spark, chunk):
    rows = check(documents(spark, texts(120, 40)), chunk=chunk, rate=90, spm=50)
    assert {r["form"] for r in rows} == {"plain", "spm", "psm"}


def test_odd_rows(spark):
    for chunk in (4, 1 << 20):
        check(documents(spark), chunk=chunk)
        check(documents(spark, [(i, t, "en", "a") for i in range(12) for t in ("x <P> y", "a <S", "<M>", " ", "\n\n a", "a \n", None, "")]), chunk=chunk, rate=100)
    assert infill.transform(empty(spark)).collect() == []


def test_a_giant_is_scanned_in_chunks(spark):
    giant = "word é 😀\n" * 400_000 + " tail  "
    check(documents(spark, [(i, giant, "en", "a") for i in (1, 2)] + [(None, "x" * 3_000_000, "en", "a"), (3, " " * 2_500_000, "en", "b"), (4, "short one", "en", "b")]), rate=100)


def test_functions_compose_in_any_grouping():
    draw = random.Random(3)
    data = "".join(draw.choices("ab \n", k=400)).encode()
    cuts = sorted(draw.sample(range(401), 30))
    at = np.array([0, *cuts, 400])
    whole, parts = infill.Scan(np.frombuffer(data, np.uint8), np.array([0, 400])), infill.Scan(np.frombuffer(data, np.uint8), at)
    then = lambda f, g: [(g[s][0], n + g[s][1]) for s, n in f]
    own = lambda scan, i: [(int(scan.next[s, i]), int(scan.ends[s, i])) for s in (0, 1)]

    def together(a, b):
        if b - a == 1:
            return own(parts, a)
        cut = draw.randrange(a + 1, b)
        return then(together(a, cut), together(cut, b))

    for _ in range(20):
        assert together(0, len(at) - 1) == own(whole, 0)


def test_sliced_and_large_columns():
    values = ["", "a b", " é", "c", "", "d  "]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["zz", *values], kind).slice(1)
        found = [(first, scan.ends.tolist(), scan.chars().tolist()) for first, scan in infill.scans(column)]
        assert found == [(0, [[0, 1, 0, 0, 0, 1], [0, 1, 1, 0, 0, 1]], [0, 3, 2, 1, 0, 3])]
    assert list(infill.scans(pa.array([], pa.string()))) == []


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = queries.op12_fill_in_middle(spark, small)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = [(*b[:5], sha(b[6]), sha(b[5])) for b in (brute(d["doc_id"], d["text"]) for d in docs.collect())]
    assert Counter(tuple(r) for r in found.collect()) == Counter(wanted)
