"""Scans over one order, ranks with ties, lineages of ratings and one-to-one matching, each against a loop."""

import difflib
import io
import random
import tracemalloc
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldglass.functions import text
from fieldglass.operators import names, ratings, stats
from fieldglass.operators import relational as R
from fieldglass.sources import readers
from fieldglass.staging import carry, numbered, stage

from .test_operators import fold_log


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_carry(spark):
    draw = random.Random(1)
    rows = [(draw.choice("ab"), i, draw.choice([None, None, i]), draw.choice([None, None, None, f"s{i}"])) for i in draw.sample(range(1000), 400)]
    df = spark.createDataFrame(rows, "k string, o int, v int, s string")
    for keys in ([], ["k"]):
        for own in (True, False):
            got = {r["o"]: (r["x"], r["y"]) for r in carry(df, keys, ["o"], {"x": "v", "y": "s"}, own=own).collect()}
            seen = {}
            for k, o, v, s in sorted(rows, key=lambda r: r[1]):
                key = k if keys else None
                before = seen.get(key, (None, None))
                now = (v if v is not None else before[0], s if s is not None else before[1])
                assert got[o] == (now if own else before)
                seen[key] = now
    assert carry(df.where("false"), [], ["o"], {"x": "v"}).collect() == []
    assert sorted((r["o"], r["n"]) for r in numbered(df, ["o"], "n", 1).collect()) == [(o, i) for i, o in enumerate(sorted(r[1] for r in rows), 1)]


def test_min_rank(spark):
    draw = random.Random(2)
    rows = [(draw.choice(["x", "y", None]), draw.choice([None, 1.5, 2.0, 2.0, 3.5, -1.0, float(draw.randrange(9))])) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    for falling in (False, True):
        for by in ([], ["g"]):
            want = Counter()
            for g, v in rows:
                peers = [w for h, w in rows if w is not None and (not by or h == g)]
                want[g, v, None if v is None else 1 + sum(w > v if falling else w < v for w in peers)] += 1
            assert Counter(tuple(r) for r in R.min_rank(df, "v", "rank", falling, by).select("g", "v", "rank").collect()) == want
    assert R.min_rank(df.where("false"), "v", "rank").collect() == []
    assert R.competition_rank(df.where("false"), "v").collect() == []
    ranked = R.competition_rank(spark.createDataFrame([("a", 5), ("b", 5), ("c", 2)], "k string, n int"), "n")
    assert sorted((r["k"], r["rank"], r["percent_of_most"]) for r in ranked.collect()) == [("a", 1, 100.0), ("b", 1, 100.0), ("c", 3, 40.0)]


def test_no_window_over_all_rows(spark):
    lines = spark.createDataFrame([(i, f"20240{i % 9 + 1}01AABB{i}") for i in range(50)], "line_no int, value string")
    pairs = spark.createDataFrame([(i % 7, float(i % 5)) for i in range(50)], "x int, y double")
    for df in (ratings.parse_log(lines), readers.sections(lines, "(x)"), R.competition_rank(pairs, "x"), stats.spearman_min_rank(pairs, "x", "y")):
        rows = [line for line in plan(df).splitlines() if "SinglePartition" in line and "Window" in line]
        assert not rows


def random_log(draw, length, codes, renames):
    out = []
    year, month = 2020, 1
    for i in range(length):
        if i == 0 or draw.random() < 0.1:
            month += draw.randrange(3)
            year, month = year + (month - 1) // 12, (month - 1) % 12 + 1
            line = f"{year}{month:02d}{draw.randrange(1, 28):02d}"
        else:
            line = draw.choice(["", f"{draw.randrange(1, 28):02d}"])
        for _ in range(draw.randrange(1, 4)):
            a, b = draw.choice(codes), draw.choice(codes)
            what = draw.random()
            line += f"{a}{draw.choice([b, b, 'XX'])}" if what < renames else f"{a}{b}{draw.randrange(-9, 20)}" if what < 0.8 else f"{a}{draw.randrange(-5, 30)}"
        out.append(line)
    return "\n".join(out)


@pytest.mark.parametrize("seed,renames", [(1, 0.3), (2, 0.6), (3, 0.05), (4, 0.0)])
def test_lineages_against_a_fold(spark, seed, renames):
    """Renames upon renames, of codes that hold nothing too, on codes that hold something, back and forth, and dissolutions."""
    log = random_log(random.Random(seed), 60, ["AA", "BB", "CC", "DD", "EE"], renames)
    lines = spark.createDataFrame(list(enumerate(log.split("\n"))), "line_no int, value string").repartition(3)
    got = {(r["code"], (r["month"].year, r["month"].month)): r["rating"] for r in ratings.rating_history(lines).collect()}
    assert got == fold_log(log)


def greedy(edges):
    used_left, used_right, out = set(), set(), set()
    for w, block, left, right in sorted(edges):
        if (block, left) not in used_left and (block, right) not in used_right:
            used_left.add((block, left))
            used_right.add((block, right))
            out.add((block, left, right))
    return out


@pytest.mark.parametrize("seed,weights", [(1, 1000), (2, 3), (3, 1)])
def test_assign_against_the_loop(spark, seed, weights):
    """With one weight for all edges each waits for the one before it, so that there are as many rounds as pairs."""
    draw = random.Random(seed)
    edges = {(block, left, right): draw.randrange(weights) for block in "ab" for left in range(8) for right in range(8) if draw.random() < 0.6}
    df = spark.createDataFrame([(w, *e) for e, w in edges.items()], "w int, block string, l int, r int")
    got = names.assign(stage(df.unionByName(df.limit(3))), "block", "l", "r", ["w"])
    assert {(r["block"], r["l"], r["r"]) for r in got.collect()} == greedy([(w, *e) for e, w in edges.items()]) and got.count() == len({tuple(r) for r in got.collect()})
    assert names.assign(stage(df.where("false")), "block", "l", "r", ["w"]).collect() == []


def test_names_against_all_pairs(spark):
    """The same matches as looking at every pair of a block and taking the best first."""
    draw = random.Random(7)
    first, last = ["ana", "anna", "a", "bob", "b", "ana maria", "jo", "é"], ["smith", "smyth", "smid", "k", "koch", "kock", "de silva", "pelé"]
    some = lambda: draw.choice([f"{draw.choice(first)} {draw.choice(last)}", draw.choice(last), f"{draw.choice(first)[0].upper()}. {draw.choice(last)}"])
    left = {(draw.choice("xy"), some()) for _ in range(40)}
    right = [(draw.choice("xy"), f"{i:02d}", some()) for i in range(40)] + [(None, "98", "bob koch"), ("x", "99", None)]
    matched, ids, rest = names.match_names(spark.createDataFrame([*left, ("x", None), (None, "ana")], "b string, n string"), spark.createDataFrame(right, "b string, i string, n string"), "b", "n", "i", "n")
    got = {(r["block"], r["left_name"], r["id"]): r["kind"] for r in matched.collect()}
    forms = lambda values: {r["n"]: r for r in spark.createDataFrame([(v,) for v in values], "n string").select("n", text.fold_accents(F.col("n")).alias("folded"), text.normal_name(F.col("n")).alias("normal"), text.name_tokens(F.col("n")).alias("parts")).collect()}
    form = forms({n for _, n in left} | {n for _, _, n in right if n})
    alike = Counter((b, n) for b, _, n in right)
    single = [(b, i, n) for b, i, n in right if alike[b, n] == 1 and b and n]
    want = {(b, n, i): "equal" for b, i, n in single if (b, n) in left}
    used, taken = {(b, n) for b, n, _ in want}, {i for _, _, i in want}
    edges = []
    for b, n in left - used:
        for c, i, m in single:
            if b == c and i not in taken:
                x, y = form[n], form[m]
                found = names.EQUAL if x["folded"] == y["folded"] else names.match_kind(x["parts"], y["parts"])
                if found:
                    edges.append(((-found[1], -difflib.SequenceMatcher(None, x["normal"], y["normal"]).ratio(), n, i), b, n, i, found[0]))
    for b, n, i in greedy([e[:4] for e in edges]):
        want[b, n, i] = next(names.KINDS.get(e[4], e[4]) for e in edges if e[1:4] == (b, n, i))
    assert got == want and len(edges) > 20
    assert {r["id"] for r in ids.collect()} == {i for _, i, _ in right} - {i for _, _, i in want}


def test_likenesses_equal_difflib():
    draw = random.Random(11)
    a, b = [], []
    for _ in range(20_000):
        letters = draw.choice(["ab", "abc é", "abcdefghij ", "ab😀"])
        x = "".join(draw.choices(letters, k=draw.randrange(30)))
        a.append(x)
        b.append("".join(draw.choices(letters, k=draw.randrange(30))) if draw.random() < 0.5 else "".join(c for c in x if draw.random() < 0.8))
    for n in (150, 199, 200, 230):
        a.append("".join(draw.choices("abcd", k=n)))
        b.append("".join(draw.choices("abcd", k=n)))
    assert text.likenesses(a, b).tolist() == [difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)]
    assert text.likenesses([], []).tolist() == []


def test_roster(spark):
    layout = ["top", "  Côte d'Ivoire (CIV)", "ROLE  x", "1  GK  DIOMANDE  Aka Tom  O'NEIL-DIOMANDE VAN  A  05/03/1999  Club A  188  12  0", "23  DF  x  Jo  ROE  R  none  Club B  -  x  3  more", "4  DF  short", "", "Head coach  FAE  Emerse  FAÉ  Côte d'Ivoire  x", "Head coach  x", "Spain (ESP)", "7  FW  X  Ana  POL  P  31/02/2000  Club C  170  5  1"]
    lines = spark.createDataFrame(list(enumerate(layout)), "line_no int, value string")
    players, coaches = readers.roster_rows(readers.sections(lines, r"^([A-Za-zÀ-ÖØ-öø-ÿ .'-]+)\s+\([A-Z]{3}\)$", skip="^ROLE"))
    got = [(r["section"], r["number"], r["name"], str(r["born"]), r["height"], r["caps"], r["goals"]) for r in players.orderBy("line_no").collect()]
    assert got == [("Côte d'Ivoire", 1, "Aka O'Neil-Diomande Van", "1999-03-05", 188, 12, 0), ("Côte d'Ivoire", 23, "Jo Roe", "None", None, None, 3), ("Spain", 7, "Ana Pol", "None", 170, 5, 1)]
    assert [(r["section"], r["name"], r["nationality"]) for r in coaches.collect()] == [("Côte d'Ivoire", "Emerse Faé", "Côte d'Ivoire")]


def large_workbook(rows):
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Big" r:id="a"/><sheet name="Small" r:id="b"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="a" Target="worksheets/sheet1.xml"/><Relationship Id="b" Target="/xl/worksheets/sheet2.xml"/></Relationships>')
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si><t>text é {i}</t><r><t>!</t></r></si>" for i in range(1000)) + "</sst>")
        with book.open("xl/worksheets/sheet1.xml", "w") as sheet:
            sheet.write(f'<worksheet xmlns="{main}"><sheetData>'.encode())
            for i in range(rows):
                sheet.write(f'<row r="{i + 1}"><c r="A{i + 1}" t="s"><v>{i % 1000}</v></c><c r="C{i + 1}"><v>{i}</v></c><c r="AA{i + 1}" t="inlineStr"><is><t>in</t></is></c><c r="AB{i + 1}"/></row>'.encode())
            sheet.write(b"</sheetData></worksheet>")
        book.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{main}"><sheetData><row><c><v>7</v></c></row></sheetData></worksheet>')
    return out.getvalue()


def test_a_large_workbook_is_a_stream(spark, tmp_path):
    """Memory doesn't grow with a sheet's rows; sheets are tasks of their own."""
    peaks = []
    for rows in (5_000, 50_000):
        content = large_workbook(rows)
        book = zipfile.ZipFile(io.BytesIO(content))
        tracemalloc.start()
        assert sum(1 for _ in readers.sheet_cells(book, "xl/worksheets/sheet1.xml", readers._Strings(book))) == 3 * rows
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.2 * peaks[0] + 500_000
    (tmp_path / "books").mkdir()
    (tmp_path / "books" / "a.xlsx").write_bytes(large_workbook(25_000))
    cells = readers.read_xlsx(spark, str(tmp_path / "books"))
    got = {r["sheet"]: (r["n"], r["last"]) for r in cells.groupBy("sheet").agg(F.count("*").alias("n"), F.max("row_no").alias("last")).collect()}
    assert got == {"Big": (75_000, 24_999), "Small": (1, 0)}
    some = cells.where("sheet = 'Big' and row_no = 12345").orderBy("col_no").collect()
    assert [(r["col_no"], r["value"]) for r in some] == [(0, "text é 345!"), (2, "12345"), (26, "in")]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.xlsx").write_bytes(b"")
    assert readers.read_xlsx(spark, str(tmp_path / "none")).collect() == []


def test_links_of_a_page_take_time_in_proportion(spark):
    import time

    took = []
    for n in (4_000, 16_000):
        page = "<p>" + "".join(f"some words <a href='/{i}'>x{i}</a> " for i in range(n)) + "</p>"
        parser = readers._Rows()
        began = time.time()
        parser.feed(page)
        took.append(time.time() - began)
        assert len(parser.links) == n
    assert took[1] < 12 * took[0] + 0.5


def test_bridge(spark):
    make = spark.createDataFrame
    rows, ids, codes = make([("a",), ("b",), ("c",), (None,)], "name string"), make([("a", 1), ("a", 3), ("b", 2), (None, 9)], "n string, i int"), make([(1, "x")], "i int, iso string")
    got = R.bridge(rows, "name", [(ids, "n", "i"), (codes, "i", "iso")])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", 1, "x", 2), ("b", 2, None, 1), ("c", None, None, 0), (None, None, None, 0)], key=str)


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    """Without a folder for checkpoints, a cluster's warehouse must be one that all executors reach."""
    from types import SimpleNamespace

    from fieldglass import staging

    kept = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}
    conf = SimpleNamespace(get=lambda key, *none: kept.get(key, *none), set=kept.__setitem__)
    session = lambda master: SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master), _jvm=spark._jvm, _jsc=spark._jsc)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="checkpoint.dir"):
            staging.shared_folder(session(master))
    assert staging.shared_folder(session("local[4]")).startswith("/") and "spark.checkpoint.dir" in kept
    kept["spark.checkpoint.dir"] = "file:///shared/folder/"
    assert staging.shared_folder(session("yarn")) == "file:///shared/folder"
