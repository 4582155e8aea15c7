from pyspark.sql import functions as F

from fieldglass.operators import reports
from fieldglass.sources import readers, tables

PAGE = """<h2>France (FRA)</h2><table><tr><th colspan=9>Squad</th></tr>
<tr><th>No.</th><th>Pos.</th><th>Player</th><th>Date of birth</th><th>Caps</th><th>Club</th></tr>
<tr><td>1</td><td>1 GK</td><td><a href="/wiki/A_B">A B</a>[1]</td><td>1 May 2000</td><td>3</td><td>X (captain)</td></tr>
<tr><td>2</td><td></td><td></td><td></td><td></td><td></td></tr></table>
<h2>By league</h2><table><tr><th>Club</th><th>Players</th><th>Share</th></tr><tr><td>X</td><td>12</td><td>3</td></tr></table>
<h3>Non-member codes</h3><table><tr><td>h</td></tr><tr><td>ZZ</td><td>Z</td><td>z</td></tr></table>"""
BOX = "<table><tr><th>Full name<td>A B<tr><th>Place of birth<td>Lyon, Rhône, <a href='/wiki/France'>France</a><sup>[2]</sup></table>"


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_people_in_tables(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, BOX), (3, None)], "id int, html string")
    found = readers.html_rows(pages, "id", "html")
    got = tables.table_records(found, "id")
    assert rows(got, "id", "section", "number", "position", "name", "born", "place", "caps", "club", "href") == [(1, "France (FRA)", "1", "1 GK", "A B", "1 May 2000", None, "3", "X", "/wiki/A_B")]
    before = tables.rows_before(found.where("id = 1"), "id", "(?i)non.*member")
    assert {r["table_no"] for r in before.collect()} == {0, 1} and 0 not in {r["row_no"] for r in before.collect()}
    assert rows(tables.infobox_place(found, "id")) == [(2, "Lyon", "France")]


def test_sheets(spark):
    years = list(range(2000, 2012))
    grid = [["Country", "Code", *years]] + [[f"c{i}", chr(65 + i) * 3, *[str(0.5 + i)] * 12] for i in range(22)]
    cells = [("p", "s", r, c, str(v)) for r, row in enumerate(grid) for c, v in enumerate(row)] + [("p", "s", 1, 5, "..")]
    df = spark.createDataFrame(cells, "path string, sheet string, row_no int, col_no int, value string")
    header = tables.header_years(df)
    assert header.count() == 12
    got = tables.coded_years(df, header)
    assert got.count() == 22 * 12 and ("p", "s", "AAA", 2003, 0.5) in rows(got)
    grid = [["t", *years], ["Wales"], ["GDHI total", *[5] * 12], ["GDHI per head", *[15000] * 12], ["Scotland"], ["per head", "50", "16,000"]]
    cells = [("p", "s", r, c, str(v)) for r, row in enumerate(grid) for c, v in enumerate(row)]
    df = spark.createDataFrame(cells, "path string, sheet string, row_no int, col_no int, value string")
    got = rows(tables.section_rows(df, tables.header_years(df), ["Wales", "Scotland"]), "section", "year", "value")
    assert ("Scotland", 2001, 16000.0) in got and ("Wales", 2000, 15000.0) in got and len(got) == 13


def test_coordinates_converge(spark):
    people = spark.createDataFrame([(1, "Lyon", "fr"), (2, "3rd arrondissement of Lyon", "fr"), (3, "Lyon", "fr"), (4, "Paris", "fr"), (5, "Nice District", "fr"), (6, "Lyon", "us"), (7, None, "fr")], "pid int, city string, country string")
    claims = spark.createDataFrame([(1, "LYON ", 45.0, 4.0), (2, "Croix", 45.1, 4.1), (3, "Lyon", 45.2, 4.2), (4, "France", 46.0, 2.0), (5, "Old Nice", 43.0, 7.0), (6, "Lyon", None, 1.0), (7, "x", 1.0, 1.0)], "pid int, label string, lat double, lon double")
    got = rows(reports.converge_coordinates(people, claims, "pid", "city", "country", "pid"), "pid", "lat", "how")
    assert got == sorted([(1, 45.0, "claim"), (2, 45.0, "sibling"), (3, 45.2, "claim"), (4, None, "diverges"), (5, None, None), (6, None, None), (7, None, "diverges")], key=str)


def test_consistency(spark):
    schema = "i int, nation string, born string, name string, caps int"
    left = spark.createDataFrame([(1, "fr", "2000-01-01", "Ana Díaz", 3), (2, "fr", "2000-01-02", "Bo", 1), (3, "fr", "2000-01-02", "Cy", 1), (4, "de", None, "Di", 0), (5, "es", "1999-01-01", "El", 0)], schema)
    right = spark.createDataFrame([(11, "fr", "2000-01-01", "A. Diaz", 4), (12, "fr", "2000-01-03", "BO", 1), (13, "de", None, "Di", 0), (14, "de", None, "Zo", 0)], schema)
    got = rows(reports.consistency_report(left, right, "nation", "i", "born", "name", ["caps"]))
    assert got == sorted([("field", "fr", 1, 11, "caps: 3 / 4"), ("left only", "fr", 3, None, "cy"), ("left only", "es", 5, None, "el"), ("right only", "de", None, 14, "zo"), ("count", "fr", None, None, "3 / 2"), ("count", "de", None, None, "1 / 2"), ("nation", "es", None, None, "1 / 0")], key=str)


def test_small_reports(spark):
    docs = spark.createDataFrame([("fr", [("a", 1), ("b", 2)], [("c", 3)])], "c string, players array<struct<name:string,caps:int>>, coaches array<struct<name:string,caps:int>>")
    assert rows(reports.flatten_people(docs, "c", ["players", "coaches"])) == [("fr", "coaches", 0, "c", 3), ("fr", "players", 0, "a", 1), ("fr", "players", 1, "b", 2)]
    ids = spark.createDataFrame([(1, ["b", "a"]), (1, ["a", "c"]), (2, [])], "k int, ids array<string>")
    assert rows(reports.union_ids(ids, ["k"], "ids")) == [(1, ["a", "b", "c"])]
    df = spark.createDataFrame([(1, "2020", 3), (1, "2022", 1), (2, "", 2), (1, "x", 0)], "k int, y string, s int")
    assert rows(reports.latest_year(df, ["k"], "y")) == [(1, "2022")]
    assert rows(reports.first_in_order(df, ["k"], ["s"]), "k", "s") == [(1, 0), (2, 2)]
    assert rows(reports.conditional_counts(df, {"big": "s > 1", "one": "k = 1"})) == [(4, 2, 3)]
