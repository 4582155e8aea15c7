import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from fieldglass.llm import pii, queries

from .fixtures import documents, empty

#: The four base kinds, as they are defined.
BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(re.sub("[^0-9]", "", s)) <= 19 and luhn_by_hand(re.sub("[^0-9]", "", s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(re.sub("[^0-9]", "", s)) <= 15),
}


def luhn_by_hand(number):
    total = 0
    for i, d in enumerate(number[::-1]):
        d = int(d)
        total += sum(divmod(2 * d, 10)) if i % 2 else d
    return total % 10 == 0


def base_spans(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in BASE.items() for m in re.finditer(p, text or "") if ok(m.group())]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


@pytest.mark.parametrize("alphabet", ["a@.-1", "1. 2-", "+1() -.9", "01.25", "4 -@a.é+9", "AB12 3"])
def test_base_against_the_patterns(alphabet):
    draw = random.Random(alphabet)
    for _ in range(4000):
        text = "".join(draw.choices(alphabet, k=draw.randrange(60)))
        assert [f[:3] for f in pii.find(text) if f[4]] == base_spans(text), text
    cards = ["4539578763621486", "4539 5787 6362 1486", "6304-0000-0000-0000-000", "12345678901234567890", "4539578763621487"]
    for _ in range(300):
        text = "".join(draw.choice([*cards, " ", "x", "-", "+49 170 1234567", "a.b@c.de", "10.0.0.255", "10.0.0.256"]) for _ in range(6))
        assert [f[:3] for f in pii.find(text) if f[4]] == base_spans(text), text


def test_checksums():
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487") and pii.luhn("0")
    assert pii.mod_97("GB82WEST12345698765432") and not pii.mod_97("GB82WEST12345698765433")
    assert pii.byte("000255") and not pii.byte("256") and not pii.byte("9" * 5000) and pii.byte("000")


def test_words_nearby_decide_what_the_base_lacks():
    kinds = lambda text: [(f[0], text[f[1] : f[2]], f[4]) for f in pii.find(text)]
    assert kinds("please call (310) 555-4510 now") == [("phone", "(310) 555-4510", False)]
    assert kinds("numbers such as (310) 555-4510 here") == []
    assert kinds("call order (310) 555-4510") == []  # a word for, a word against
    assert kinds("my SSN is 123-45-6789.") == [("ssn", "123-45-6789", False)] and kinds("part 123-45-6789") == [] and kinds("ssn 666-45-6789") == []
    assert kinds("pay to GB82 WEST 1234 5698 7654 32 today") == [("iban", "GB82 WEST 1234 5698 7654 32", False)]
    assert kinds("pay to GB82 WEST 1234 5698 7654 33 today") == [] and kinds("serial GB82WEST12345698765432") == []
    assert kinds("Amex card 378282246310005") == [("card", "378282246310005", False)] and kinds("amount 378282246310005") == []
    assert kinds("call +1 (310) 555-4510") == [("phone", "+1 (310) 555-4510", True)]  # not once more without its prefix
    assert kinds("tel 1310 555 4510") == []  # part of a longer number
    text = "mail me: a@b.example, or by phone +1 310 555 4510"
    assert [f[3] for f in pii.find(text)] == pytest.approx([1.0, 1.0]) and [f[3] for f in pii.find("x a@b.example")] == pytest.approx([0.9])
    assert pii.find("version 1.2.3.4")[0][3] == pytest.approx(0.5) and pii.find("version 1.2.3.4")[0][4]  # the base stays
    assert pii.find("call (310) 555-4510", threshold=0.8) == []


def test_time_is_linear_in_long_texts():
    for text in ["a" * 2_000_000, "1" * 2_000_000, "1 " * 1_000_000, "1." * 1_000_000, "+1 " * 700_000, "a@" * 1_000_000, "A1 " * 700_000, "a@b.c " * 100_000, "(310) 555-" * 200_000]:
        began = time.time()
        pii.find(text)
        assert time.time() - began < 20, text[:6]


def test_odd_rows(spark):
    docs = documents(spark)
    rows = pii.find_personal_data(docs).collect()
    assert sorted(str((r["doc_id"], r["text"])) for r in rows) == sorted(str((d["doc_id"], d["text"] or "")) for d in docs.collect())
    assert all(r["found"] == [] for r in rows)
    assert pii.find_personal_data(empty(spark)).collect() == [] and pii.redact(empty(spark)).collect() == []
    long = documents(spark, [(1, "é😀 x@y.z " * 50_000 + "+1 310 555 4510", "en", "a"), (None, "😀 10.1.1.1", None, None), (1, None, "en", "a"), (1, "", "en", "a")])
    for r in pii.find_personal_data(long).collect():
        assert [(s["kind"], s["start"], s["end"]) for s in r["found"]] == base_spans(r["text"])


def test_redaction(spark):
    text = "mail a@b.example or 4539 5787 6362 1486, +1 310 555 4510 (host 10.0.0.1)"
    docs = documents(spark, [(1, text, "en", "a"), (2, None, "en", "a"), (2, "clean", None, "a")])
    found = pii.redact(docs)
    assert found.columns == docs.columns
    assert sorted(str(r["text"]) for r in found.collect()) == ["None", "clean", "mail <EMAIL> or <CARD>, <PHONE> (host <IP>)"]
    assert "<CARD>" in pii.redact(documents(spark, [(1, "+4539578763621486", "en", "a")])).first()["text"]  # no phone of 16 digits


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = queries.op11_personal_data(spark, small)
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    rows = {r["doc_id"]: r for r in found.collect()}
    some = 0
    for d in docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect():
        own, r = base_spans(d["text"]), rows[d["doc_id"]]
        assert [r[f"n_{k}"] for k in BASE] == [sum(s[0] == k for s in own) for k in BASE]
        assert r["base_sha256"] == hashlib.sha256(joined(own).encode()).hexdigest()
        assert {s for s in joined(own).split(",") if s} <= set(r["spans"].split(","))
        some += len(own)
    assert some
