import re
import time
from collections import defaultdict

from fieldglass.llm import chat, queries

SCHEMA = "conv_id int, turn int, role string, text string, row string, key string, lines string, position int"

ROWS = [
    (1, 0, "user", "Hello world\nsecond line here"), (1, 1, "assistant", "On Monday x wrote:\n> hello   WORLD\nI agree"), (1, 2, "user", "> > hello world\n> I agree\nThanks"),
    (1, 3, "user", "new topic"), (1, 4, "a", ">second line here\nwhat?"), (1, 5, "b", None), (1, 6, "u", "> new topic\n\n  ok  "), (1, 7, "u", "> never said\nhm"),
    (None, 0, None, "x"), (None, 1, "u", ">x\r\n>x\r\ny"), (2, None, "u", "> x\nq"), (2, 3, "u", ""), (3, 0, "u", "same"), (3, 0, "u", "same"), (3, 1, "u", "> same"),
    (4, 0, "u", "long " * 5000), (4, 1, "u", "> " + "long " * 5000 + "\nyes"), (4, 2, "u", ">>> yes\n>> nothing\n> yes\nno"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x", "y", "z", 9) for r in rows], SCHEMA)


def norm(s):
    return re.sub(r"\s+", " ", s.lower()).strip()


def levels(text):
    out = []
    for line in re.split("\r\n|\r|\n", text or ""):
        m = re.match(r"((?:[ \t]*>)+)", line)
        out.append((m[1].count(">"), line[m.end() :].strip(" ")) if m else (0, line))
    return out


def quotable(lines, level):
    text = "\n".join(c if k == level else "" for k, c in lines)
    return {norm(p) for p in [text, *re.split(r"\n\s*\n", text), *text.split("\n")]} - {""}


def slow(rows):
    """Links by looking at every earlier message; (conv, turn, text) -> list of (reply_to, root_turn, position)."""
    messages = [{"conv": c, "turn": t, "role": r, "lines": levels(x), "i": i} for i, (c, t, r, x) in enumerate(rows)]
    for m in messages:
        m["root"], m["reply_to"] = m, None
        found = []
        for level in sorted({k for k, _ in m["lines"]} - {0}):
            for p in quotable(m["lines"], level):
                firsts = [o for o in messages if o["conv"] == m["conv"] and o["turn"] is not None and p in quotable(o["lines"], 0)]
                if firsts:
                    o = min(firsts, key=lambda o: o["turn"])
                    if m["turn"] is not None and o["turn"] < m["turn"]:
                        found.append((level, -len(p), o["turn"], o["i"]))
        if found:
            m["parent"] = messages[min(found)[3]]
            m["reply_to"] = m["parent"]["turn"]
    for m in messages:
        while "parent" in m["root"]:
            m["root"] = m["root"]["parent"]
    out = []
    for m in messages:
        own = [c for i, (k, c) in enumerate(m["lines"]) if k == 0 and not (re.search(r"(?i)\b(wrote|writes|said)\s*:\s*$", c) and i + 1 < len(m["lines"]) and m["lines"][i + 1][0] > 0)]
        out.append((m["conv"], m["turn"], "\n".join(own).strip(), m["reply_to"], m["root"]["turn"]))
    return out


def check(spark, rows):
    got = chat.link_quotations(frame(spark, rows)).collect()
    key = lambda t: tuple((x is None, x or 0) if not isinstance(x, str) else x for x in t)
    assert sorted(((r["conversation_id"], r["turn"], r["text"], r["reply_to"], r["root_turn"]) for r in got), key=key) == sorted(slow(rows), key=key)
    by = defaultdict(list)
    for r in got:
        by[r["conversation_id"]].append(r)
    none_first = lambda x: (x is not None, x or 0)
    for own in by.values():
        own.sort(key=lambda r: r["position"])
        assert [r["position"] for r in own] == list(range(len(own)))
        roots = [none_first(r["root_turn"]) for r in own]
        assert roots == sorted(roots)
    return got


def test_odd_rows(spark):
    got = check(spark, ROWS)
    at = {(r["conversation_id"], r["turn"]): r for r in got}
    assert at[1, 2]["reply_to"] == 1 and at[1, 2]["root_turn"] == 0 and at[1, 7]["reply_to"] is None
    assert at[None, 0]["formatted"] == "<|unknown|>\nx\n<|end|>\n"
    assert chat.link_quotations(frame(spark, [])).collect() == []


def test_long_chain_and_hot_conversation(spark):
    rows = [(1, i, "u", f"reply {i}" if not i else f"> reply {i - 1}\nreply {i}") for i in range(70)]
    rows += [(9, i, "u", "the same line") for i in range(500)]
    got = check(spark, rows)
    assert {r["root_turn"] for r in got if r["conversation_id"] == 1} == {0}


def test_very_long_lines(spark):
    """Lines that a matcher would recurse on, or look at again from each place."""
    rows = [
        (1, 0, "u", "a" + " " * 100_000 + "b"), (1, 1, "u", "> a" + " " * 100_000 + "b\nq" + "\t " * 50_000 + "x\n" + " " * 100_000 + "\n\n" + " " * 100_000 + "z"),
        (2, 0, "u", "same"), (2, 1, "u", ">" * 100_000 + " same"), (2, 2, "u", "> " * 50_000), (2, 3, "u", "said" + " " * 100_000 + "said:" + " " * 100_000),
        (3, 0, "u", "\n".join(f"line {i} of it" for i in range(20_000))), (3, 1, "u", "> line 700 of it\nyes"), (3, 2, "u", "a" + "\n" * 100_000 + "b"),
    ]
    began = time.monotonic()
    got = {(r["conversation_id"], r["turn"]): r for r in chat.link_quotations(frame(spark, rows)).collect()}
    assert time.monotonic() - began < 30
    assert [got[k]["reply_to"] for k in ((1, 1), (2, 1), (2, 2), (3, 1), (3, 2))] == [0, 0, None, 0, None]
    assert got[2, 1]["text"] == got[2, 2]["text"] == "" and got[1, 1]["text"].startswith("q") and got[1, 1]["text"].endswith("z")


def test_hot_root(spark):
    rows = [(i % 7, 0, "u", f"root {i % 7}") for i in range(7)] + [(0, i, "u", f"> root 0\nanswer {i}") for i in range(1, 400)] + [(0, 400 + i, "u", f"> answer {i}\nso") for i in range(1, 50)]
    got = check(spark, rows)
    assert sum(r["root_turn"] == 0 and r["reply_to"] is not None for r in got) == 448


def test_query(spark, small):
    rows = queries.op9_quotation_chat(spark, small).collect()
    plain = spark.read.parquet(f"{small}/conversations.parquet").collect()
    assert sorted((r["conv_id"], r["turn"], r["text"], r["reply_to"]) for r in rows) == sorted((c, t, x, q) for c, t, x, q, _ in slow([(r["conv_id"], r["turn"], r["role"], r["text"]) for r in plain]))
