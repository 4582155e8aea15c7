import io
import json
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from fieldglass.plans import files
from fieldglass.sources import readers, sinks, tables


def put(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_json_maps(spark, tmp_path):
    path = put(tmp_path / "a.json", json.dumps({"4": {"alpha2": "fr", "name": "France"}, "5": {"alpha2": "de"}}))
    assert rows(readers.read_json_map(spark, path, "alpha2 string, name string", "id")) == [("4", "fr", "France"), ("5", "de", None)]
    path = put(tmp_path / "b.json", json.dumps({"fr": {"2020": 1.5, "2021": None}, "de": {"2020": 2}}))
    assert rows(readers.read_nested_map(spark, path, "code", "year", "v")) == [("de", "2020", 2.0), ("fr", "2020", 1.5), ("fr", "2021", None)]
    path = put(tmp_path / "c.json", '[{"a": 1},\n {"a": 2}]')
    assert rows(readers.read_json(spark, path, "a int")) == [(1,), (2,)]


def test_csv_with_mark_and_quotes(spark, tmp_path):
    path = put(tmp_path / "a.csv", '﻿nation,player\nfr,"Doe, ""J"""\n')
    df = readers.read_csv(spark, path)
    assert df.columns == ["nation", "player"] and rows(df) == [("fr", 'Doe, "J"')]
    assert rows(readers.read_csv(spark, put(tmp_path / "p.csv", "lat,lon,population\n1.5,2,30\n"), "lat double, lon double, population long")) == [(1.5, 2.0, 30)]
    assert rows(readers.read_csv(spark, put(tmp_path / "w.csv", "a\ncafé – €\n", "cp1252"), encoding="windows-1252")) == [("café – €",)]


def test_positions_and_lines(spark, tmp_path):
    line = lambda *v: "\t".join([*v, *[""] * (15 - len(v))])
    text = line("1", "n", "", "", "1.5", "2.5", *[""] * 8, "100") + "\n" + line("2", "n", "", "", "x", "2", *[""] * 8, "0")
    assert rows(readers.read_population_points(spark, put(tmp_path / "p.tsv", text))) == [(1.5, 2.5, 100)]
    lines = readers.read_lines(spark, put(tmp_path / "l.txt", "1\tA\r\nb\nc"))
    assert rows(lines) == [(0, "1\tA"), (1, "b"), (2, "c")] and readers.looks_like(lines, r"^\d+\t") and not readers.looks_like(lines, "^x")
    assert rows(readers.read_names(spark, put(tmp_path / "n.tsv", "FR\tFrance\nFR_loc\tin France"))) == [("FR", "France")]


def test_wide_years(spark):
    df = spark.createDataFrame([("fr", "1,000", "n/a"), ("de", "..", "7")], "iso string, hdi_2020 string, hdi_2021 string")
    want = [("de", 2021, 7.0), ("fr", 2020, 1000.0)]
    assert rows(readers.wide_years(df, ["iso"])) == want and rows(readers.wide_or_long(df, ["iso"])) == want
    long = spark.createDataFrame([("de", "2021", "7"), ("fr", "2020", "1,000")], "iso string, year string, value string")
    assert rows(readers.wide_or_long(long, ["iso"])) == want
    assert rows(readers.with_proxy(long, "a", "b"), "iso", "indicator", "is_proxy") == [("de", "a", False), ("de", "b", True), ("fr", "a", False), ("fr", "b", True)]


def test_jsonstat(spark, tmp_path):
    cube = {"id": ["geo", "time"], "size": [2, 3], "dimension": {"geo": {"category": {"index": {"X": 0, "Y": 1}}}, "time": {"category": {"index": {"2019": 0, "2020": 1, "2021": 2}}}}, "value": {"0": 1.5, "2": 0, "4": 7, "5": None}}
    got = readers.read_jsonstat(spark, put(tmp_path / "j.json", json.dumps(cube)))
    assert sorted((r["at"]["geo"], r["at"]["time"], r["value"]) for r in got.collect()) == [("X", "2019", 1.5), ("X", "2021", 0.0), ("Y", "2020", 7.0)]


def test_services(spark, tmp_path):
    doc = {"results": {"bindings": [{"item": {"value": "u/Q1"}, "label": {"value": "Q12"}}, {"item": {"value": "u/Q2"}, "label": {"value": "Rome"}}, {"item": {"value": "u/Q3"}}]}}
    assert rows(readers.read_bindings(spark, put(tmp_path / "s.json", json.dumps(doc)), ["item", "label"])) == [("u/Q1", ""), ("u/Q2", "Rome"), ("u/Q3", None)]
    (tmp_path / "pages").mkdir()
    for i in (1, 2):
        put(tmp_path / "pages" / f"{i}.json", json.dumps({"page": i, "rows": [{"a": i}, {"a": i * 10}]}))
    assert rows(readers.read_pages(spark, str(tmp_path / "pages"), "a int", "rows")) == [(1,), (10,), (2,), (20,)]
    cache = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-25")], "k int, at string")
    assert rows(readers.cached_within(cache, "at", F.lit("2024-02-10")), "k") == [(2,)]


def test_country_metadata(spark):
    base = spark.createDataFrame([("fr", {"en": "Paris", "it": "Parigi"}), ("de", None)], "iso2 string, capital map<string,string>")
    got = readers.country_metadata(base, spark.createDataFrame([("fr", 5, "2020")], "iso2 string, population int, pop_year string"), spark.createDataFrame([("fr", {"it": "PARIGI", "de": "Paris"})], "iso2 string, names map<string,string>"))
    by = {r["iso2"]: r for r in got.collect()}
    assert by["fr"]["capital"] == {"en": "Paris", "it": "PARIGI", "de": "Paris"} and by["fr"]["population"] == 5 and by["de"]["capital"] == {}


def test_sections(spark):
    lines = spark.createDataFrame(list(enumerate(["top", "France (FRA)", "1  GK  DOE John", "Page 1", "2  DF  ROE Jane", "Spain (ESP)", "3  FW  X"])), "line_no int, value string")
    got = rows(readers.sections(lines, r"^.+ \(([A-Z]{3})\)$", "^Page", 3), "section", "fields")
    assert got == [("ESP", ["3", "FW", "X"]), ("FRA", ["1", "GK", "DOE John"]), ("FRA", ["2", "DF", "ROE Jane"])]


def test_html(spark):
    html = "<h2>Group <i>A</i></h2><table><tr><th>No<th>Name<tr><td>1</td><td><a href='/wiki/X_Y'>X Y</a><sup>2</sup></table><h3>B</h3><p><a href='#z'>z</a><script>var t='<td>'</script>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<table><tr><td>open")], "id int, html string")
    got = [tuple(r) for r in readers.html_rows(pages, "id", "html").orderBy("id", "row_no").collect()]
    assert got == [(1, "Group A", 0, 0, ["No", "Name"], []), (1, "Group A", 0, 1, ["1", "X Y"], ["/wiki/X_Y"]), (3, "", 0, 0, ["open"], [])]
    links = readers.html_links(pages, "id", "html")
    assert rows(links) == [(1, "B", "z", "#z"), (1, "Group A", "X Y", "/wiki/X_Y")]
    assert rows(readers.last_link(links, "id", "^/wiki/"), "anchor") == [("X Y",)]


def workbook(rows_):
    cell = lambda r, c, v: f'<c r="{chr(65 + c)}{r + 1}" t="s"><v>{v}</v></c>' if isinstance(v, int) and c == 0 else f'<c r="{chr(65 + c)}{r + 1}"><v>{v}</v></c>'
    strings, body = [], ""
    for r, row in enumerate(rows_):
        body += f'<row r="{r + 1}">'
        for c, v in enumerate(row):
            if isinstance(v, str) and c == 0:
                strings.append(v)
                v = len(strings) - 1
            if v is not None:
                body += cell(r, c, v)
        body += "</row>"
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="Data" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


def test_xlsx(spark, tmp_path):
    years = list(range(2005, 2017))
    (tmp_path / "a.xlsx").write_bytes(workbook([["Title"], ["Nation", *years], ["Wales", *[1000 + y for y in years]], ["Scotland", None, 5000.5]]))
    cells = readers.read_xlsx(spark, str(tmp_path / "a.xlsx"))
    assert ("Data", 1, 1, "2005") in rows(cells, "sheet", "row_no", "col_no", "value")
    got = rows(readers.sheet_years(cells), "label", "year", "value")
    assert ("Wales", 2010, 3010.0) in got and ("Scotland", 2006, 5000.5) in got and len(got) == 13
    assert rows(readers.sheet_summary(cells, ["Wales", "Scotland"]), "label", "value") == [("Scotland", 5000.5), ("Wales", 3005.0)]
    table = spark.createDataFrame([("w", "2018 to 2020", "0", "80"), ("w", "2019", "0", "82"), ("w", "2019", "1", "81"), ("w", "2019", "0", "12")], "n string, period string, age string, v string")
    assert rows(readers.life_table(table, ["n"], "period", "age", "v")) == [("w", 2019, 81.0, True)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", None), (2, "é", 0.5)], "k int, s string, v double")
    path = str(tmp_path / "t.parquet")
    assert sinks.write_if_changed(df, path) and not sinks.write_if_changed(df.orderBy("k"), path) and sinks.write_if_changed(df.where("k = 1"), path)
    assert spark.read.parquet(path).count() == 1
    sinks.write_model({"a": df, "b": df}, str(tmp_path / "model"))
    assert spark.read.parquet(str(tmp_path / "model/b.parquet")).count() == 2
    one = df.where("k = 1")
    sinks.write_json_document(one, str(tmp_path / "d.json"))
    sinks.write_json_document(one, str(tmp_path / "n.json"), keep_nulls=True, pretty=True)
    assert (tmp_path / "d.json").read_text() == '{"k":1,"s":"a"}' and json.loads((tmp_path / "n.json").read_text()) == {"k": 1, "s": "a", "v": None}
    assert (tmp_path / "n.json").read_text().endswith("}\n")
    with pytest.raises(ValueError, match="one row"):
        sinks.write_json_document(df, str(tmp_path / "x.json"))
    sinks.write_csv(df, str(tmp_path / "c"), bom=True)
    assert readers.read_csv(spark, str(tmp_path / "c")).columns == ["k", "s", "v"]
    cells = spark.createDataFrame([(0, 1, 1.23456), (1, 0, 2.0)], "i int, j int, v double")
    sinks.write_grid(cells, str(tmp_path / "g.json"), 2, 2, "v")
    assert json.loads((tmp_path / "g.json").read_text()) == {"ny": 2, "nx": 2, "values": [None, 1.235, 2.0, None]}


def test_streaming(spark, tmp_path, small):
    from fieldglass.streaming import refresh

    events = spark.read.parquet(f"{small}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    schema = events.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    stream = refresh.event_stream(spark, str(tmp_path / "in"), schema)
    refresh.keep_latest(stream, str(tmp_path / "out"), str(tmp_path / "ck"), "user_id", "ts").awaitTermination(120)
    versions = sorted((tmp_path / "out").iterdir(), key=lambda p: int(p.name[1:]))
    got = {r["user_id"]: r["ts"] for r in spark.read.parquet(str(versions[-1])).collect()}
    assert got == {r["user_id"]: r["m"] for r in events.groupBy("user_id").agg(F.max("ts").alias("m")).collect()}
    for name, query in (("totals", refresh.windowed_totals(stream, "ts", ["event_type"], "value")), ("sessions", refresh.sessions(stream, "ts", "user_id"))):
        q = query.writeStream.format("memory").queryName(name).outputMode("complete" if name == "totals" else "append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / name)).start()
        q.awaitTermination(120)
    assert spark.sql("SELECT sum(n) FROM totals").first()[0] == events.count()
    assert spark.sql("SELECT count(*) FROM sessions").first()[0] > 0


def test_titles_of_a_page_of_one_block(spark, small):
    """Links of a long block don't each carry the text before them, which only lines of coaches need."""
    html = "<h2>S</h2>" + "".join(f"<a href='/wiki/T_{i}'>text {i % 3000}</a> and more, " for i in range(4000))
    found = tables.anchor_titles(readers.html_links(spark.createDataFrame([(1, html)], "id long, html string"), "id", "html", place=True), "id")
    assert {(r["anchor"], r["title"]) for r in found.collect()} == {(f"text {i}", f"T {i + 3000 if i < 1000 else i}") for i in range(3000)}
    plan = files.anchor_titles(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"HtmlLinks\(.*?, false\)", plan) and not re.search(r"HtmlLinks\(.*?, true\)", plan)
