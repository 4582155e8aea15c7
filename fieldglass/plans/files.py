"""Files in each form that the readers know: made from the tables by the sinks, and read back."""

from __future__ import annotations

import io
import json
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.functions.numbers import none_if_zero, scaled_currency
from fieldglass.functions.text import id_list, joined_ids, link_of_title, strip_code
from fieldglass.operators import gates, ratings
from fieldglass.operators import relational as R
from fieldglass.operators.documents import DOCUMENTS, LANGUAGES
from fieldglass.session import table
from fieldglass.sources import readers, service, sinks, tables, versions
from fieldglass.staging import carry, numbered, scratch

#: Years of the sheets and wide files made here, and the nations of a summary.
YEARS = tuple(range(2000, 2012))
SUMMARY = ("NATION_3", "NATION_4", "NATION_11")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, name, region and number of customers of each nation: a table of fixed size, that one file can hold."""
    customers = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("key")).agg(F.count("*").alias("n"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    return nation.join(customers, "key", "left").na.fill(0, ["n"])


def _lines(rows: DataFrame, value, order: list[str]) -> str:
    """The path of one text file with a line a row, in order: of nations, or of one log."""
    path = f"{scratch(rows.sparkSession)}/lines.txt"
    rows.orderBy(*order).select(value.alias("value")).coalesce(1).write.text(path)
    return path


def json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One indented document, with the fields left out that have no value."""
    entry = F.struct("key", "name", none_if_zero(F.col("region")).alias("region"))
    path = f"{scratch(spark)}/nations.json"
    sinks.write_json_document(_nations(spark, sf_dir).agg(F.array_sort(F.collect_list(entry)).alias("nations")), path, pretty=True)
    return readers.read_json(spark, path, "nations array<struct<key:int,name:string,region:int>>").select(F.inline("nations"))


def json_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object whose keys become a column."""
    entry = F.struct(F.col("key").cast("string"), F.struct("name", "region"))
    text = _nations(spark, sf_dir).agg(F.to_json(F.map_from_entries(F.collect_list(entry)))).first()[0]
    path = f"{scratch(spark)}/by_key.json"
    sinks.write_text(spark, path, text)
    return readers.read_json_map(spark, path, "name string, region int")


def json_map_of_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An object of objects, as services give values by country and year: here by nation and segment."""
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    inner = counts.groupBy("c_nationkey").agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n"))).alias("by_segment"))
    text = inner.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("c_nationkey").cast("string"), "by_segment"))))).first()[0]
    path = f"{scratch(spark)}/nested.json"
    sinks.write_text(spark, path, text)
    return readers.read_nested_map(spark, path, "nation", "segment", "n")


def csv_with_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with quotes, separators and nulls through a CSV whose first name has a byte-order mark before it."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("key"), F.when(k % 7 != 0, F.concat(F.lit('"'), F.col("c_name"), F.lit('", '), F.col("c_mktsegment"))).alias("title"), F.col("c_acctbal").alias("balance"))
    path = f"{scratch(spark)}/customers"
    sinks.write_csv(rows, path, bom=True)
    found = readers.read_csv(spark, path)
    return found.select(F.col("key").cast("long").alias("key"), "title", F.col("balance").cast("double").alias("balance"))


def csv_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select((k * 37 % 120 - 60).cast("double").alias("lat"), (k * 101 % 360 - 179.5).cast("double").alias("lon"), k.alias("population"))
    path = f"{scratch(spark)}/points"
    sinks.write_csv(rows, path)
    return readers.read_csv(spark, path, "lat double, lon double, population long")


def positional_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated text without a header, of which three columns matter; places without people are left out."""
    k, none = F.col("c_custkey"), F.lit("")
    fields = [k.cast("string"), F.col("c_name"), none, none, (k * 37 % 120 - 60).cast("string"), (k * 101 % 360 - 179.5).cast("string"), *[none] * 8, F.floor("c_acctbal").cast("string")]
    path = f"{scratch(spark)}/points.tsv"
    table(spark, sf_dir, "customer").select(F.concat_ws("\t", *fields)).write.text(path)
    return readers.read_population_points(spark, path)


def code_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by code, without those that say where a place is."""
    both = F.explode(F.array(F.concat_ws("\t", F.concat(F.lit("N"), F.col("key").cast("string")), "name"), F.concat(F.lit("N"), F.col("key").cast("string"), F.lit("_loc\tin "), F.col("name"))))
    path = f"{scratch(spark)}/names.tsv"
    _nations(spark, sf_dir).select(both).write.text(path)
    return readers.read_names(spark, path)


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text's lines by number, once its first line looks as it must."""
    lines = readers.read_lines(spark, _lines(_nations(spark, sf_dir), F.concat_ws("\t", F.col("key").cast("string"), "name"), ["key"]))
    if not readers.looks_like(lines, r"^\d+\t"):
        raise ValueError("not a list of nations")
    return lines.where("value <> ''")


def ranking_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations ranked by customers, as lines of a rating service: some without points, special ones, codes written otherwise and
    unknown ones; in order of rank, ties in that of the file."""
    ranked = R.competition_rank(_nations(spark, sf_dir), "n")
    code = F.concat(F.lit("N"), F.col("key").cast("string"))
    line = F.concat_ws("\t", F.col("rank").cast("string"), F.lit("-"), code, F.when(F.col("key") % 5 == 4, "n/a").otherwise(F.col("n").cast("string")))
    lines = readers.read_lines(spark, _lines(ranked, F.when(F.col("key") == 2, "a line of other text").otherwise(line), ["rank", "key"]))
    nation = table(spark, sf_dir, "nation").where("n_nationkey < 20")
    iso = F.when(F.col("n_nationkey") == 3, "x3").otherwise(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")))
    codes = nation.select(iso.alias("iso2"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    special, overrides = spark.createDataFrame([("N7", "Special Seven")], "code string, name string"), spark.createDataFrame([("N3", "x3")], "code string, iso2 string")
    out = ratings.parse_rankings(lines, special, overrides, codes, codes.where("id % 2 = 0").select("iso2"))
    return out.orderBy("rank", "line_no")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the lines of one log: each line's date is as much of it as the line before doesn't tell."""
    code = lambda c: F.concat(F.chr(F.lit(65) + F.pmod(c, F.lit(20))), F.chr(F.lit(65) + F.pmod(F.floor(c / 20), F.lit(20))))
    points = F.floor(F.abs(F.coalesce("value", F.lit(0.0)))).cast("long") % 40
    token = F.when(F.col("event_id") % 5 == 0, F.concat(code(F.col("user_id")), points.cast("string"))).otherwise(F.concat(code(F.col("user_id")), code(F.col("user_id") + 7), (points - 20).cast("string")))
    rows = table(spark, sf_dir, "events").select("event_id", F.add_months(F.to_date("ts"), (F.col("event_id") % 400).cast("int")).alias("day"), token.alias("token"))
    rows = numbered(carry(rows, [], ["day", "event_id"], {"day before": "day"}, own=False), ["day", "event_id"], "line_no", 1)
    before = F.col("day before")
    short = F.when(before.isNull() | (F.year("day") != F.year(before)), "yyyyMMdd").when(F.month("day") != F.month(before), "MMdd").when(F.col("day") != before, "dd").otherwise("")
    rows = rows.select("token", F.col("line_no").cast("int").alias("line_no"), "day", short.alias("short"))
    stamp = F.when(F.col("short") == "yyyyMMdd", F.date_format("day", "yyyyMMdd")).when(F.col("short") == "MMdd", F.date_format("day", "MMdd")).when(F.col("short") == "dd", F.date_format("day", "dd")).otherwise("")
    return rows.select("line_no", F.concat(stamp, F.col("token"), F.when(F.col("line_no") % 3 == 0, F.concat(F.lit("ZZ5"), F.lit(" ZZ9"))).otherwise("")).alias("value"))


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a log whose dates inherit what they leave out; on every third line a token more, and one that can't be."""
    found = ratings.parse_log(_log(spark, sf_dir))
    return found.select(F.col("seq.line").alias("line"), F.col("seq.place").alias("place"), F.col("month").cast("string").alias("month"), "kind", "a", "b", "points")


def rating_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings at the end of each month of that log, carried on to its last."""
    return ratings.rating_history(_log(spark, sf_dir)).select("code", F.col("month").cast("string").alias("month"), "rating")


def _page(rows: DataFrame, by: list[str], order: str, row, head: str, tail: str = "</table>") -> DataFrame:
    """A page for each nation: a heading, a table's head and a row for each supplier."""
    return rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(order, row.alias("row")))).alias("list")).select(
        *by, F.concat(F.format_string("<h2>%s (%s)</h2>" + head, "name", F.concat(F.lit("N"), F.chr(F.col("key") % 26 + 65), F.chr(F.floor(F.col("key") / 26) + 65))), F.array_join(F.transform("list", lambda x: x.row), ""), F.lit(tail)).alias("html")
    )


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    return table(spark, sf_dir, "supplier").withColumn("key", F.col("s_nationkey")).join(F.broadcast(nation), "key")


SQUAD = "<table><tr><th colspan=6>Squad</th></tr><tr><th>No.</th><th>Pos.</th><th>Player</th><th>Date of birth</th><th>Caps</th><th>Club</th></tr>"


def squad_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers out of tables of people; positions are links too, and a table of figures is none of people."""
    row = F.format_string(
        "<tr><td>%d</td><td><a href='/wiki/Goal'>GK</a></td><td><a href='/wiki/%s'>%s</a>[1]</td><td>1 May %d</td><td>%d</td><td>Club %d (captain)</td></tr>",
        "s_suppkey", link_of_title(F.col("s_name")), "s_name", F.col("s_suppkey") % 30 + 1970, F.col("s_suppkey") % 100, F.col("s_suppkey") % 7,
    )
    figures = "</table><h2>By league</h2><table><tr><th>Club</th><th>Players</th><th>Share</th></tr><tr><td>X</td><td>12</td><td>3</td></tr></table>"
    pages = _page(_suppliers(spark, sf_dir), ["key", "name"], "s_suppkey", row, SQUAD, figures)
    found = tables.table_records(readers.html_rows(pages, "key", "html", links=True), "key")
    return found.select("key", strip_code(F.col("section")).alias("section"), F.col("number").cast("long").alias("number"), "position", "name", "born", F.col("caps").cast("int").alias("caps"), "club", "href")


def infobox_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and country from the row of a page's box that tells where somebody was born; the note after it goes."""
    html = F.format_string("<table><tr><th>Full name<td>%s<tr><th>Place of birth<td>City %d, Region, <a href='/wiki/N'>%s</a><sup>[2]</sup></table>", "s_name", F.col("s_suppkey") % 9, "name")
    pages = _suppliers(spark, sf_dir).select("s_suppkey", html.alias("html"))
    return tables.infobox_place(readers.html_rows(pages, "s_suppkey", "html"), "s_suppkey")


def member_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list in several tables, up to a heading."""
    row = F.format_string("<tr><td>%d</td><td>%s</td></tr>", "s_suppkey", "s_name")
    tail = "</table><h3>Others</h3><table><tr><th>h</th></tr><tr><td>-1</td><td>more</td></tr></table><h3>Non-member codes</h3><table><tr><td>h</td></tr><tr><td>-2</td><td>no</td></tr></table>"
    pages = _page(_suppliers(spark, sf_dir), ["key", "name"], "s_suppkey", row, "<table><tr><th>No</th></tr>", tail)
    found = tables.rows_before(readers.html_rows(pages, "key", "html"), "key", "(?i)non.*member")
    return found.select("key", F.get("cells", F.lit(0)).cast("long").alias("ident"), F.get("cells", F.lit(1)).alias("title"))


def anchor_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles by nation and linked text: pages of other kinds are left out, and of several links with one text the last counts."""
    row = F.format_string(
        "<a href='//h.example/wiki/Old_%s'>%s</a> <a href='/wiki/Category:%s'>%s</a> <a href='/wiki/%s#top'>%s</a> <a href='/w/x'>elsewhere</a>",
        *[link_of_title(F.col("s_name"))] + [F.col("s_name")] * 3 + [link_of_title(F.col("s_name")), F.col("s_name")],
    )
    pages = _page(_suppliers(spark, sf_dir), ["key", "name"], "s_suppkey", row, "", "")
    return tables.anchor_titles(readers.html_links(pages, "key", "html", place=True), "key").select("key", strip_code(F.col("section")).alias("section"), "anchor", "title")


def coach_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last name on each nation's line of coaches; a flag before it tells another nationality."""
    nation = _nations(spark, sf_dir)
    flag = F.when(F.col("key") % 3 == 0, F.format_string("<a href='/wiki/N%d'><img alt='NATION_%d'></a>", F.col("key") + 1, F.col("key") + 1)).otherwise("")
    html = F.format_string("<h3>%s</h3><p>Coach: %s<a href='/wiki/A_%d'>A %d</a> (first match) / <a href='/wiki/B_%d'>B %d</a></p>", "name", flag, "key", "key", "key", "key")
    return tables.coaches(readers.html_links(nation.select("key", html.alias("html")), "key", "html", context=True), "key").select("key", "section", "coach", "title", "nationality")


def text_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a text layout under the headings of their nations."""
    rows = _nations(spark, sf_dir).select("key", F.posexplode(F.array(F.format_string("%s (N%02d)", "name", "key"), F.format_string("%d  MF   %s  9", "key", "name"), F.format_string("Page %d", "key"), F.lit("short"))).alias("place", "line"))
    lines = readers.read_lines(spark, _lines(rows, F.col("line"), ["key", "place"]))
    found = readers.sections(lines, r"^(\S+) \([A-Z0-9]{3}\)$", skip="^Page ", least_fields=4)
    return found.select("section", F.get("fields", F.lit(0)).cast("int").alias("key"), F.get("fields", F.lit(1)).alias("position"), F.get("fields", F.lit(2)).alias("name"))


def squad_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players and coaches out of the layout of a squad list: suppliers under their nations, and what isn't a row between them."""
    k = F.col("s_suppkey")
    digit = lambda c: F.translate(c.cast("string"), "0123456789", "ABCDEFGHIJ")
    player = F.format_string(
        "%d  GK  NAME%d  Ana Maria  O'%s DE-%s  SHIRT  %s  Club %d  %s  %d  %d  more", k % 99 + 1, k, digit(k), digit(F.col("s_nationkey")),
        F.when(k % 11 == 0, "unknown").otherwise(F.format_string("%02d/%02d/%d", k % 28 + 1, k % 12 + 1, k % 30 + 1970)), k % 7, F.when(k % 5 == 0, "-").otherwise((k % 40 + 160).cast("string")), k % 100, k % 13,
    )
    rows = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("key"), F.lit(1).alias("place"), k.alias("ident"), player.alias("value"))
    head = F.format_string("  %s (N%sX)", "name", F.chr(F.col("key") % 26 + 65))
    coach = F.format_string("Head coach  NAME  Bo Li  VAN %s  NATION_%d  x", digit(F.col("key")), (F.col("key") + 1) % 25)
    listed = [(0, head), (2, coach), (3, F.lit("12  GK  too short")), (4, F.lit("")), (5, F.lit("# ROLE  and so on"))]
    others = _nations(spark, sf_dir).select("key", F.explode(F.array(*(F.struct(F.lit(i).alias("place"), c.alias("value")) for i, c in listed))).alias("s"))
    lines = rows.unionByName(others.select("key", "s.place", F.lit(0).cast("long").alias("ident"), "s.value"))
    found = readers.sections(numbered(lines, ["key", "place", "ident"], "line_no"), r"^(\S+) \([A-Z]{3}\)$", skip="^#")
    players, coaches = readers.roster_rows(found)
    both = players.withColumn("born", F.col("born").cast("string")).unionByName(coaches, allowMissingColumns=True)
    return both.select("section", "name", "number", "position", "born", "club", "height", "caps", "goals", "nationality")


def _workbook(sheets: dict[str, list[list]]) -> bytes:
    """A small workbook: text as shared strings, numbers as they are, empty cells left out."""
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared: dict[str, int] = {}
    column = lambda i: (chr(64 + i // 26) if i >= 26 else "") + chr(65 + i % 26)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for n, grid in enumerate(sheets.values(), 1):
            rows = []
            for r, row in enumerate(grid, 1):
                cells = []
                for c, v in enumerate(row):
                    if isinstance(v, str) and v:
                        cells.append(f'<c r="{column(c)}{r}" t="s"><v>{shared.setdefault(v, len(shared))}</v></c>')
                    elif v is not None and v != "":
                        cells.append(f'<c r="{column(c)}{r}"><v>{v}</v></c>')
                rows.append(f'<row r="{r}">{"".join(cells)}</row>')
            book.writestr(f"xl/worksheets/sheet{n}.xml", f'<worksheet xmlns="{main}"><sheetData>{"".join(rows)}</sheetData></worksheet>')
        names = "".join(f'<sheet name="{escape(s)}" sheetId="{n}" r:id="r{n}"/>' for n, s in enumerate(sheets, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{n}" Target="worksheets/sheet{n}.xml"/>' for n in range(1, len(sheets) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f"<Relationships>{links}</Relationships>")
        strings = "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">{strings}</sst>')
    return out.getvalue()


def _cells(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The cells of a workbook of nations, in the shape of one kind of publication."""
    nations = [(r["key"], r["name"], r["n"]) for r in _nations(spark, sf_dir).orderBy("key").collect()]
    value = lambda key, n, year: f"{n * 1000 + year:,}" if key % 2 else n * 1000 + year
    if kind == "codes":
        grid = [["Source: made here"], ["Country", "Code", *YEARS], *([name, chr(65 + key) * 3, *(".." if (key + y) % 5 == 0 else value(key, n, y) for y in YEARS)] for key, name, n in nations)]
    elif kind == "nations":
        grid = [["Title"], ["", "Area", *YEARS], *(["", name, *(value(key, n, y) for y in YEARS)] for key, name, n in nations)]
    elif kind == "sections":
        grid = [["t", *YEARS]]
        for key, name, n in nations:
            grid += [[name], ["GDHI total", *[5] * len(YEARS)], ["GDHI per head", *(n + y if y % 3 else 50 for y in YEARS)]]
    else:
        grid = [["Summary"], *([name, "GBP", 12, n * 1000 + key + 1001, 5_000_000] for key, name, n in nations)]
    path = f"{scratch(spark)}/{kind}.xlsx"
    sinks.write_bytes(spark, path, _workbook({"Notes": [["nothing"]], "Data & more": grid}))
    return readers.read_xlsx(spark, path)


def workbook_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cells(spark, sf_dir, "nations").select("sheet", "row_no", "col_no", "value")


def sheet_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values by code and year of a sheet in which years and codes are found by what they look like."""
    cells = _cells(spark, sf_dir, "codes")
    return tables.coded_years(cells, tables.header_years(cells)).select("sheet", "code", "year", "value")


def sheet_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values by name and year, in another currency as well."""
    found = readers.sheet_years(_cells(spark, sf_dir, "nations")).where("sheet <> 'Notes'")
    return found.select("label", "year", "value", scaled_currency(F.col("value"), F.lit(1.25)).alias("scaled"))


def sheet_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir, "sections")
    names = [f"NATION_{i}" for i in range(25)]
    return tables.section_rows(cells, tables.header_years(cells), names).select("section", "year", "value")


def sheet_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.sheet_summary(_cells(spark, sf_dir, "totals"), SUMMARY).select("label", "value")


def wide_years_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years as columns of an old encoding: numbers with commas, and marks for what isn't known."""
    head = "\t".join(["ISO", "Name", *map(str, YEARS), "Estimates Start After"])
    body = ["\t".join([f"N{r['key']}", f"Natión € {r['key']}", *("n/a" if (r["key"] + y) % 4 == 0 else f"{r['n'] * 1000 + y:,}" for y in YEARS), "2009"]) for r in _nations(spark, sf_dir).collect()]
    path = f"{scratch(spark)}/wide.tsv"
    sinks.write_bytes(spark, path, "\n".join([head, *body]).encode("cp1252"))
    return readers.wide_years(readers.read_csv(spark, path, separator="\t", encoding="windows-1252"), ["ISO", "Name"]).select(F.col("ISO").alias("iso"), F.col("Name").alias("name"), "year", "value")


def wide_or_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same values from a file that has years as columns and from one that has a column of years."""
    nation = _nations(spark, sf_dir)
    value = lambda y: F.when((F.col("key") + y) % 4 == 0, "..").otherwise((F.col("n") + y).cast("string"))
    wide = nation.select(F.col("key").alias("iso"), *(value(F.lit(y)).alias(f"hdi_{y}") for y in YEARS))
    long = nation.select(F.col("key").alias("iso"), F.explode(F.array(*map(F.lit, YEARS))).alias("year"), "n", "key").select("iso", "year", value(F.col("year")).alias("value"))
    out = []
    for form, rows in (("wide", wide), ("long", long)):
        path = f"{scratch(spark)}/{form}"
        sinks.write_csv(rows, path)
        out.append(readers.wide_or_long(readers.read_csv(spark, path), ["iso"]).select(F.lit(form).alias("form"), F.col("iso").cast("int").alias("iso"), "year", "value"))
    return out[0].unionByName(out[1])


def indicator_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One indicator under two names; the second stands in for another."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("value"))
    return readers.with_proxy(rows, "gdp_total", "gdp_per_head").select("s_suppkey", "value", "indicator", "is_proxy")


def life_expectancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Life expectancy at birth from a life table: by the middle year of a period, averaged where several fall in one."""
    k = F.col("c_custkey")
    period = F.when(k % 2 == 0, F.concat((k % 6 + 2000).cast("string"), F.lit(" to "), (k % 6 + 2003).cast("string"))).otherwise((k % 6 + 2001).cast("string"))
    age = F.when(k % 3 == 0, "x").otherwise((k % 3 - 1).cast("string"))
    rows = table(spark, sf_dir, "customer").select("c_nationkey", period.alias("period"), age.alias("age"), (F.floor("c_acctbal") % 50 + 50).cast("string").alias("ex"))
    return readers.life_table(rows, ["c_nationkey"], "period", "age", "ex")


def jsonstat_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cube of customers by nation and segment as a statistics office gives it: sizes, categories and flat values."""
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    segments = [r[0] for r in counts.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]
    places = F.array_position(F.array(*map(F.lit, segments)), F.col("c_mktsegment")) - 1
    flat = F.struct((F.col("c_nationkey") * len(segments) + places).cast("string"), "n")
    index = lambda names: {"category": {"index": {n: i for i, n in enumerate(names)}}}
    cube = {"id": ["geo", "segment"], "size": [25, len(segments)], "dimension": {"geo": index([f"N{i}" for i in range(25)]), "segment": index(segments)}}
    values = json.loads(counts.agg(F.to_json(F.map_from_entries(F.collect_list(flat)))).first()[0] or "{}")
    path = f"{scratch(spark)}/cube.json"
    sinks.write_text(spark, path, json.dumps(cube | {"value": values}))
    found = readers.read_jsonstat(spark, path)
    return found.select(F.col("at")["geo"].alias("geo"), F.col("at")["segment"].alias("segment"), "value")


def query_bindings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bindings of a query service: a label that is only an item's id is none."""
    label = F.when(F.col("key") % 4 == 0, F.concat(F.lit("Q"), F.col("key").cast("string"))).otherwise(F.col("name"))
    binding = F.struct(F.struct(F.concat(F.lit("http://e/Q"), F.col("key").cast("string")).alias("value")).alias("item"), F.when(F.col("key") % 7 != 0, F.struct(label.alias("value"))).alias("label"))
    document = _nations(spark, sf_dir).agg(F.struct(F.collect_list(binding).alias("bindings")).alias("results"))
    path = f"{scratch(spark)}/bindings.json"
    sinks.write_json_document(document, path)
    return readers.read_bindings(spark, path, ["item", "label"])


def paged_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A service's pages, each a document with their number; read on until the last."""
    folder = scratch(spark)
    pages = _nations(spark, sf_dir).groupBy("region").agg(F.collect_list(F.struct("key", "name")).alias("rows"))
    numbered = pages.select((F.col("region") + 1).alias("page"), F.struct((F.col("region") + 1).alias("page"), F.lit(5).alias("pages"), "rows").alias("d"))
    for r in numbered.select("page", F.to_json("d").alias("text")).collect():
        sinks.write_text(spark, f"{folder}/page-{r['page']}.json", r["text"])
    return readers.read_service(spark, folder + "/page-{page}.json", "key int, name string", "rows")


def _games_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as games in answers of a hundred each."""
    key, home, away = F.col("o_orderkey"), F.col("o_custkey") % 25, (F.col("o_custkey") + 1 + F.col("o_orderkey") % 7) % 25
    side = lambda n, won: F.struct(n.alias("id"), F.concat(F.lit("NATION_"), n.cast("string")).alias("name"), F.when(key % 5 != 0, won).alias("winner"))
    game = F.struct(
        F.struct(key.alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.struct(F.col("o_orderstatus").alias("short")).alias("status")).alias("fixture"),
        F.struct(F.when(key % 3 == 0, "Group Stage - 1").otherwise("Final").alias("round")).alias("league"), F.struct(side(home, key % 2 == 0).alias("home"), side(away, key % 2 == 1).alias("away")).alias("teams"),
        F.struct((key % 4).alias("home"), (key % 6).alias("away")).alias("goals"), F.struct(F.struct(F.when(key % 11 == 0, 4).alias("home"), F.when(key % 11 == 0, 3).alias("away")).alias("penalty")).alias("score"),
    )
    return table(spark, sf_dir, "orders").groupBy(F.floor(key / 400).alias("page")).agg(F.to_json(F.struct(F.collect_list(game).alias("response"))).alias("text"))


def _standings_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the teams of their regions, and once more in a table of no group."""
    n, k = _nations(spark, sf_dir), F.col("key")
    goals = F.struct((k % 9).alias("for"), (k % 4).alias("against"))
    line = lambda group: F.struct(k.alias("rank"), F.struct(k.alias("id"), F.col("name").alias("name")).alias("team"), F.col("n").alias("points"), (k % 9 - k % 4).alias("goalsDiff"), group.alias("group"), F.struct((k % 3 + 2).alias("played"), (k % 3).alias("win"), F.lit(1).alias("draw"), F.lit(1).alias("lose"), goals.alias("goals")).alias("all"))
    groups = n.groupBy("region").agg(F.collect_list(line(F.concat(F.lit("Group "), F.chr(F.col("region") + 65)))).alias("lines"))
    losers = n.where("key % 2 = 0").agg(F.collect_list(line(F.lit("Group Stage"))).alias("lines"))
    return groups.select("lines").unionByName(losers).agg(F.to_json(F.struct(F.array(F.struct(F.struct(F.collect_list("lines").alias("standings")).alias("league"))).alias("response"))).alias("text"))


def service_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games out of a service's answers, with the groups of its tables."""
    return service.with_groups(service.games(_games_answers(spark, sf_dir)), service.standings(_standings_answer(spark, sf_dir))).withColumnRenamed("group", "letter")


def service_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return service.standings(_standings_answer(spark, sf_dir)).withColumnRenamed("group", "letter")


def service_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of both sides of games, out of answers on a game each."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).alias("q"), F.count("*").alias("n"))
    kind = lambda name, value: F.struct(F.lit(name).alias("type"), value.cast("string").alias("value"))
    team = lambda name, *kinds: F.struct(F.struct(F.lit(1).alias("id"), F.lit(name).alias("name")).alias("team"), F.array(*kinds).alias("statistics"))
    home = team("home", kind("Fouls", F.col("q")), kind("Yellow Cards", F.when(F.col("n") % 2 == 0, F.col("n"))), kind("Ball Possession", F.lit("55%")))
    away = team("away", kind("Fouls", F.col("n")), kind("Red Cards", F.lit(1)))
    answers = lines.select(F.concat(F.lit("https://service/statistics?fixture="), F.col("l_orderkey").cast("string")).alias("request"), F.to_json(F.struct(F.array(home, away).alias("response"))).alias("text"))
    return service.game_statistics(answers, F.regexp_extract("request", "fixture=([0-9]+)", 1).cast("long"), {"fouls": "Fouls", "yellow": "Yellow Cards", "red": "Red Cards"})


def country_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with population and capitals: names by language go before those at hand, which fill what lacks."""
    nation = _nations(spark, sf_dir).withColumn("iso2", F.concat(F.lit("n"), F.col("key").cast("string")))
    base = nation.select("iso2", F.create_map(F.lit("en"), F.concat(F.lit("Base "), F.col("name")), F.lit("it"), F.lit("Citta")).alias("capital"))
    people = nation.where("key % 3 <> 0").select("iso2", F.col("n").alias("population"), F.lit("2020").alias("pop_year"))
    capitals = nation.where("key % 2 = 0").select("iso2", F.create_map(F.lit("en"), F.col("name"), F.lit("fr"), F.lit("Ville")).alias("names"))
    out = readers.country_metadata(base, people, capitals)
    return out.select("iso2", "population", "pop_year", *(F.col("capital")[x].alias(x) for x in ("en", "fr", "it")))


def cache_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of a cache that are thirty days old at most."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("fetched"))
    return readers.cached_within(rows, "fetched", F.lit("1997-06-30").cast("date")).where("fetched <= DATE '1997-06-30'").select("o_orderkey", F.col("fetched").cast("string").alias("fetched"))


def stored_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model of several tables put in place twice, and read from there."""
    folder = f"{scratch(spark)}/model"
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    sinks.write_model({"nation": nation.limit(0), "customer": customer.limit(0)}, folder)
    sinks.write_model({"nation": nation, "customer": customer}, folder)
    stored = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return stored.select("c_custkey", "c_name", "n_name")


def _model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A tournament's model out of customers as people of their nations."""
    k, nation, customer = F.col("c_custkey"), table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    code = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    person = customer.select(
        k.alias("pid"), F.col("c_name").alias("name"), F.concat(F.lit("S"), (k % 10).cast("string")).alias("surname"), F.when(k % 4 != 0, k % 99).alias("shirt_number"), F.when(k % 3 != 0, "GK").alias("position"),
        F.when(k % 50 == 0, "coach").otherwise("player").alias("role"), (F.floor(F.abs("c_acctbal")) % 100).alias("caps"), F.col("c_nationkey").cast("int").alias("nation"), ((F.col("c_nationkey") + F.when(k % 3 == 0, k % 5).otherwise(0)) % 25).cast("int").alias("birth"),
    )
    measures = [F.count("*").alias("matches_played"), F.sum(k % 7).alias("fouls_committed"), F.sum(k % 5).alias("fouls_suffered"), (F.floor(F.avg(k % 7)) + 0.5).alias("avg_fouls_committed"), (F.floor(F.avg(k % 5)) + 0.5).alias("avg_fouls_suffered"), F.count_if(k % 9 == 0).alias("yellow_cards"), F.count_if(k % 90 == 0).alias("red_cards")]
    discipline = customer.where("c_nationkey % 6 <> 5").groupBy(F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("iso2"), F.col("c_mktsegment").alias("stage"), F.ascii("c_mktsegment").alias("ord")).agg(*measures)
    return {
        "person": person,
        "country": nation.select(F.col("n_nationkey").cast("int").alias("id"), F.col("n_name").alias("name"), code.alias("iso2"), F.when(F.col("n_nationkey") % 4 != 0, F.col("n_nationkey") * 1_000_000 + 250_000).alias("population")),
        "capital_name": nation.select(F.col("n_nationkey").cast("int").alias("country"), F.explode(F.array(F.lit("en"), F.lit("fr"))).alias("lang"), F.concat(F.lit("City of "), "n_name").alias("name")).where("country % 3 <> 0 or lang = 'en'"),
        "provenance": nation.limit(1).select(F.lit("population").alias("dataset"), F.lit("tables").alias("source"), F.lit("2024-01-01").alias("updated")),
        "af_person": person.where("pid % 2 = 0").select((F.col("pid") + 100_000).alias("af_id"), "pid"),
        "af_team": nation.select((F.col("n_nationkey") + 900).alias("af_team_id"), F.col("n_nationkey").cast("int").alias("country")),
        "eliminated": nation.where("n_nationkey % 2 = 0").select(
            code.alias("iso2"), F.lit("Round of 16").alias("round"), F.when(F.col("n_nationkey") % 3 != 0, "2026-07-01").alias("date"), F.when(F.col("n_nationkey") % 4 != 0, "n1").alias("lost_to"),
            F.when(F.col("n_nationkey") == 6, "won").alias("third_result"), F.lit("2026-07-18").alias("third_date"), F.lit("n8").alias("third_opponent")),
        "discipline": discipline.withColumn("fouls_per_card", F.when(F.col("red_cards") > 0, F.floor(F.col("fouls_committed") / F.col("red_cards")) + 0.5)),
        "team_stage": nation.select(code.alias("iso2"), F.lit("Final").alias("stage"), (F.col("n_nationkey") % 2).cast("int").alias("eliminated")),
        "birthplace": customer.where(k % 5 == 0).select(k.alias("pid"), F.concat(F.lit("City "), (k % 7).cast("string")).alias("city"), (k + 0.5).cast("double").alias("lat"), (-k - 0.25).cast("double").alias("lon"), F.when(k % 10 == 0, k * 10).alias("population"), F.when(k % 15 == 0, "Other").alias("actual_city")),
        "wiki_title": customer.select(k.alias("pid"), F.posexplode(F.array(*map(F.lit, LANGUAGES))).alias("i", "lang"), F.col("c_name").alias("title")).where("pid % (i + 2) <> 0").drop("i"),
    }


def model_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaves of the ten documents of a model, which was published after an empty one."""
    folder, model = f"{scratch(spark)}/model", _model(spark, sf_dir)
    versions.publish(spark, folder, {name: df.limit(0) for name, df in model.items()})
    published = versions.publish(spark, folder, model, DOCUMENTS)
    return gates.json_leaves(published.documents_as_rows(), "document", "text")


def version_diff(spark: SparkSession, folder_of: str) -> DataFrame:
    """What changed in a table of totals between the first and the last of three versions, and the leaves that changed in a
    document of them."""
    customer = table(spark, folder_of, "customer")
    folder, document = f"{scratch(spark)}/totals", {"totals": ((lambda t: t["totals"].agg(F.map_from_entries(F.collect_list(F.struct(F.col("nation").cast("string"), "points"))).alias("document"))), False)}
    for i in range(3):
        sums = customer.where(F.col("c_custkey") % 4 <= i).groupBy(F.col("c_nationkey").alias("nation")).agg(F.sum(F.floor("c_acctbal").cast("long")).alias("points")).where(f"nation % 5 <> {i}")
        versions.publish(spark, folder, {"totals": R.min_rank(sums, "points", "place", falling=True)}, document, name=f"v{i}")
    found = versions.table_diff(spark, folder, "totals", "nation", "points", "place", old="v0")
    leaves = versions.document_diff(spark, folder, old="v0").withColumn("nation", F.regexp_extract("path", "([0-9]+)$", 1).cast("int"))
    return found.join(leaves.select("nation", F.col("old").alias("old_leaf"), F.col("new").alias("new_leaf")), "nation", "left")


def registry_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of suppliers with their joined ids, rewritten twice: keys stay, ids are added, new suppliers get the next keys."""
    s, folder = F.col("s_suppkey"), f"{scratch(spark)}/registry"
    supplier = table(spark, sf_dir, "supplier").select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("nation"), F.col("s_name").alias("name"), s.alias("ident"))

    def assign(rows: DataFrame):
        def of(before: DataFrame | None) -> DataFrame:
            known = before if before is not None else spark.createDataFrame([], "pid long, nation string, name string, ids string")
            keyed, _ = R.assign_keys(known.select("pid", "nation", "name", F.lit(None).cast("long").alias("outer_id")), rows.select("nation", "name", F.lit(None).cast("long").alias("outer_id")), ["outer_id"], ["nation", "name"], "pid", ["nation", "name"])
            ids = rows.select("nation", "name", F.array(F.col("ident").cast("string")).alias("more"))
            both = keyed.select("pid", "nation", "name").join(ids, ["nation", "name"]).join(known.select("pid", F.col("ids").alias("old")), "pid", "left")
            fresh = both.select("pid", "nation", "name", joined_ids(F.concat("more", F.coalesce(id_list(F.col("old")), F.array().cast("array<string>")))).alias("ids"))
            return R.append_missing(fresh, known, ["pid"])
        return of

    versions.rewrite_registry(spark, folder, assign(supplier.where("ident % 3 = 0")))
    versions.rewrite_registry(spark, folder, assign(supplier.withColumn("ident", F.col("ident") + 10_000).where("ident % 3 <> 1")))
    return versions.open_version(spark, folder).table("registry").select("pid", "nation", "name", "ids")


def write_if_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each of four writes of a table was done: the first, the same again, one with a change, that again."""
    path, nation = f"{scratch(spark)}/nation", table(spark, sf_dir, "nation")
    other = nation.withColumn("n_name", F.when(F.col("n_nationkey") == 3, "other").otherwise(F.col("n_name")))
    done = [sinks.write_if_changed(df, path) for df in (nation, nation, other, other)]
    return spark.createDataFrame(list(enumerate(done)), "step int, written boolean")


def grid_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid as one flat list of values, null where masked, and its cells again."""
    k = F.col("c_custkey")
    cells = table(spark, sf_dir, "customer").groupBy((k % 9).cast("int").alias("i"), (k % 7).cast("int").alias("j")).agg((F.sum(F.floor("c_acctbal").cast("long")) / 1000).alias("v"))
    path = f"{scratch(spark)}/grid.json"
    sinks.write_grid(cells.where("i <> j"), path, 9, 7, "v")
    found = readers.read_json(spark, path, "ny int, nx int, values array<double>").select("nx", F.posexplode("values").alias("at", "v"))
    return found.select(F.floor(F.col("at") / F.col("nx")).cast("int").alias("i"), (F.col("at") % F.col("nx")).alias("j"), "v")


def profile_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of a profile and each one's latest as a pair of files, and both again."""
    wide = table(spark, sf_dir, "orders").select("o_custkey", F.date_format("o_orderdate", "yyyy").alias("year"), "o_orderkey").groupBy("o_custkey", "year").agg(F.max("o_orderkey").alias("last_order"))
    folder = scratch(spark)
    sinks.write_profile(wide, R.latest_by(wide, "o_custkey", ["year"]), folder)
    read = lambda name: readers.read_csv(spark, f"{folder}/{name}", "o_custkey long, year int, last_order long").withColumn("file", F.lit(name))
    return read("wide").unionByName(read("latest"))


def csv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV file with a byte-order mark, written twice, and its rows again."""
    path = f"{scratch(spark)}/nations.csv"
    for rows in (_nations(spark, sf_dir).limit(2), _nations(spark, sf_dir)):
        sinks.write_csv_file(rows.select("key", "name", "n"), path, bom=True)
    return readers.read_csv(spark, path).select(F.col("key").cast("int").alias("key"), "name", F.col("n").cast("long").alias("n"))


def title_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, fifty to a request."""
    return readers.lookup_batches(table(spark, sf_dir, "customer"), "c_name")


QUERIES = {
    f.__name__: f
    for f in (
        json_document, json_map, json_map_of_maps, csv_with_mark, csv_points, positional_points, code_names, text_lines, ranking_file, log_events, rating_months, squad_tables,
        infobox_places, member_list, anchor_titles, coach_lines, text_sections, squad_list, workbook_cells, sheet_codes, sheet_nations, sheet_sections, sheet_totals, wide_years_file,
        wide_or_long, indicator_proxy, life_expectancy, jsonstat_cube, query_bindings, paged_service, service_games, service_standings, service_statistics, country_metadata, cache_age, stored_model, model_documents, version_diff, registry_file, write_if_changed, grid_document,
        profile_files, csv_file, title_batches,
    )
}

_N = "WITH n AS (SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL), y AS (SELECT range::INTEGER AS year FROM range(2000, 2012))"
_LOG = """
    WITH e AS (SELECT event_id, (ts::DATE + to_months((event_id % 400)::INTEGER))::DATE AS day, floor(abs(coalesce(value, 0)))::BIGINT % 40 AS p,
                      chr((65 + user_id % 20)::INTEGER) || chr((65 + user_id // 20 % 20)::INTEGER) AS a, chr((65 + (user_id + 7) % 20)::INTEGER) || chr((65 + (user_id + 7) // 20 % 20)::INTEGER) AS b FROM events),
    l AS (SELECT *, row_number() OVER (ORDER BY day, event_id)::INTEGER AS line, date_trunc('month', day)::DATE AS month FROM e),
    t AS (SELECT line, 0 AS place, month, CASE WHEN event_id % 5 = 0 THEN 'adjust' ELSE 'match' END AS kind, a, CASE WHEN event_id % 5 <> 0 THEN b END AS b, CASE WHEN event_id % 5 = 0 THEN p ELSE p - 20 END AS points FROM l
          UNION ALL SELECT line, 1, month, 'adjust', 'ZZ', NULL, 5 FROM l WHERE line % 3 = 0)"""

_MODEL = """
    WITH person AS (
        SELECT c_custkey AS pid, c_name AS name, 'S' || (c_custkey % 10) AS surname, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 99 END AS shirt, CASE WHEN c_custkey % 3 <> 0 THEN 'GK' END AS position,
               c_custkey % 50 = 0 AS coach, floor(abs(c_acctbal))::BIGINT % 100 AS caps, c_nationkey AS nation, ((c_nationkey + CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 5 ELSE 0 END) % 25)::INTEGER AS birth FROM customer),
    p AS (SELECT person.*, n.n_name AS nation_name, b.n_name AS birth_name FROM person JOIN nation n ON nation = n.n_nationkey JOIN nation b ON birth = b.n_nationkey),
    g AS (SELECT birth, birth_name, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, min(pid)) - 1 AS i FROM p WHERE birth <> nation GROUP BY ALL),
    placed AS (
        SELECT '$.data[' || i || '].players[' || (row_number() OVER w - 1) || ']' AS base, row_number() OVER w - 1 AS j, i, p.*, true AS abroad FROM p JOIN g USING (birth) WHERE p.birth <> p.nation WINDOW w AS (PARTITION BY birth ORDER BY coach, caps DESC, pid)
        UNION ALL SELECT '$.natives.' || nation_name || '[' || (row_number() OVER (PARTITION BY nation ORDER BY caps DESC, pid) - 1) || ']', NULL, NULL, p.*, false FROM p WHERE birth = nation),
    fields AS (
        SELECT base, unnest([{'f': 'name', 'v': '"' || name || '"'}, {'f': 'nation', 'v': CASE WHEN abroad THEN '"' || nation_name || '"' END}, {'f': 'caps', 'v': caps::VARCHAR}, {'f': 'role', 'v': CASE WHEN coach THEN '"coach"' END},
               {'f': 'surname', 'v': '"' || surname || '"'}, {'f': 'shirtNumber', 'v': shirt::VARCHAR}, {'f': 'position', 'v': '"' || position || '"'}, {'f': 'pid', 'v': pid::VARCHAR}]) AS s FROM (
            SELECT base, name, nation_name, caps, coach, surname, shirt, position, pid, abroad FROM placed UNION ALL SELECT '$.data[' || i || '].top[' || j || ']', name, nation_name, caps, coach, surname, shirt, position, NULL, abroad FROM placed WHERE j < 5)),
    pairs AS (SELECT i, nation_name, c, row_number() OVER (PARTITION BY i ORDER BY c DESC, nation_name) - 1 AS j FROM (SELECT i, nation_name, count(*) AS c FROM placed WHERE abroad GROUP BY ALL)),
    d AS (
        SELECT n_nationkey AS key, c_mktsegment AS stage, ascii(c_mktsegment) AS ord, count(*) AS mp, sum(c_custkey % 7)::BIGINT AS fc, sum(c_custkey % 5)::BIGINT AS fs, floor(avg(c_custkey % 7)) + 0.5 AS afc, floor(avg(c_custkey % 5)) + 0.5 AS afs,
               count(*) FILTER (c_custkey % 9 = 0) AS yc, count(*) FILTER (c_custkey % 90 = 0) AS rc FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey % 6 <> 5 GROUP BY ALL),
    measures AS (
        SELECT base, unnest([{'f': 'matchesPlayed', 'v': m.mp::VARCHAR}, {'f': 'foulsCommitted', 'v': m.fc::VARCHAR}, {'f': 'foulsSuffered', 'v': m.fs::VARCHAR}, {'f': 'avgFoulsCommitted', 'v': m.afc::VARCHAR}, {'f': 'avgFoulsSuffered', 'v': m.afs::VARCHAR},
               {'f': 'yellowCards', 'v': m.yc::VARCHAR}, {'f': 'redCards', 'v': m.rc::VARCHAR}, {'f': 'foulsPerCard', 'v': CASE WHEN m.rc > 0 THEN (floor(m.fc / m.rc) + 0.5)::VARCHAR ELSE 'null' END}]) AS s
        FROM (SELECT '$.n' || key || '.byStage.' || stage AS base, d AS m FROM d UNION ALL SELECT '$.n' || key, arg_max(d, ord) FROM d GROUP BY key)),
    leaves AS (
        SELECT 'map' AS document, base || '.' || s.f AS path, s.v AS leaf FROM fields WHERE s.v IS NOT NULL
        UNION ALL SELECT 'map', '$.data[' || i || '].' || f, v FROM (SELECT i, unnest(['country', 'id', 'iso2', 'count']) AS f, unnest(['"' || birth_name || '"', birth::VARCHAR, '"n' || birth || '"', n::VARCHAR]) AS v FROM g)
        UNION ALL SELECT 'map', '$.data[' || i || '].nations[' || j || '][' || x || ']', CASE x WHEN 0 THEN '"' || nation_name || '"' ELSE c::VARCHAR END FROM pairs, (VALUES (0), (1)) v(x)
        UNION ALL SELECT 'map', '$.pop.n' || n_nationkey, n_nationkey || '.25' FROM nation WHERE n_nationkey % 4 <> 0
        UNION ALL SELECT 'map', '$.capital.n' || n_nationkey || '.' || lang, '"City of ' || n_name || '"' FROM nation, (VALUES ('en'), ('fr')) v(lang) WHERE n_nationkey % 3 <> 0 OR lang = 'en'
        UNION ALL SELECT 'map', * FROM (VALUES ('$.popSource', '"tables"'), ('$.popUpdated', '"2024-01-01"')) v
        UNION ALL SELECT 'live', '$.n' || nation || '.' || (pid + 100000) || '.' || f, v FROM (SELECT nation, pid, unnest(['pid', 'birthCountry']) AS f, unnest([pid::VARCHAR, '"' || birth_name || '"']) AS v FROM p WHERE pid % 2 = 0)
        UNION ALL SELECT 'live', '$.teams.' || (n_nationkey + 900), '"n' || n_nationkey || '"' FROM nation
        UNION ALL SELECT 'status', '$.n' || k || '.' || f, v FROM (SELECT n_nationkey AS k, unnest(['round', 'date', 'lostTo', 'thirdPlace.result', 'thirdPlace.date', 'thirdPlace.opponent']) AS f, unnest(['"Round of 16"', CASE WHEN n_nationkey % 3 <> 0 THEN '"2026-07-01"' END,
                  CASE WHEN n_nationkey % 4 <> 0 THEN '"n1"' END, CASE WHEN n_nationkey = 6 THEN '"won"' END, CASE WHEN n_nationkey = 6 THEN '"2026-07-18"' END, CASE WHEN n_nationkey = 6 THEN '"n8"' END]) AS v FROM nation WHERE n_nationkey % 2 = 0) WHERE v IS NOT NULL
        UNION ALL SELECT 'discipline', base || '.' || s.f, s.v FROM measures
        UNION ALL SELECT 'discipline', '$.n' || n_nationkey || '.' || f, v FROM (SELECT n_nationkey, unnest(['stage', 'eliminated']) AS f, unnest(['"Final"', (n_nationkey % 2 = 1)::VARCHAR]) AS v FROM nation)
        UNION ALL SELECT 'discipline', '$.n' || n_nationkey || '.' || f, v FROM nation, (VALUES ('matchesPlayed', '0'), ('foulsCommitted', '0'), ('foulsSuffered', '0'), ('avgFoulsCommitted', '0'), ('avgFoulsSuffered', '0'), ('yellowCards', '0'), ('redCards', '0'), ('foulsPerCard', 'null'), ('byStage', '{}')) v(f, v)
                  WHERE n_nationkey NOT IN (SELECT key FROM d)
        UNION ALL SELECT 'birthplace', '$.' || k || '.' || f, v FROM (SELECT c_custkey AS k, unnest(['city', 'lat', 'lon', 'population', 'actualCityName']) AS f, unnest(['"City ' || (c_custkey % 7) || '"', c_custkey || '.5', '-' || c_custkey || '.25',
                  CASE WHEN c_custkey % 10 = 0 THEN (c_custkey * 10)::VARCHAR END, CASE WHEN c_custkey % 15 = 0 THEN '"Other"' END]) AS v FROM customer WHERE c_custkey % 5 = 0) WHERE v IS NOT NULL
        UNION ALL SELECT 'wiki_' || lang, '$.urlTemplate', '"https://' || lang || '.wikipedia.org/wiki/{title}"' FROM (VALUES ('en'), ('fr'), ('de'), ('it'), ('es')) v(lang)
        UNION ALL SELECT 'wiki_' || lang, '$.titles[' || pid || ']', coalesce('"' || c_name || '"', 'null') FROM (SELECT range AS pid, lang, i FROM range((SELECT max(c_custkey) + 1 FROM customer)), (VALUES ('en', 2), ('fr', 3), ('de', 4), ('it', 5), ('es', 6)) v(lang, i))
                  LEFT JOIN customer ON c_custkey = pid AND pid % i <> 0)
    SELECT document, path, leaf FROM leaves"""

ORACLE_SQL = {
    "json_document": "SELECT n_nationkey AS key, n_name AS name, nullif(n_regionkey, 0) AS region FROM nation",
    "json_map": "SELECT n_nationkey::VARCHAR AS key, n_name AS name, n_regionkey AS region FROM nation",
    "json_map_of_maps": "SELECT c_nationkey::VARCHAR AS nation, c_mktsegment AS segment, count(*)::DOUBLE AS n FROM customer GROUP BY ALL",
    "csv_with_mark": """SELECT c_custkey AS key, CASE WHEN c_custkey % 7 <> 0 THEN '"' || c_name || '", ' || c_mktsegment END AS title, c_acctbal AS balance FROM customer""",
    "csv_points": "SELECT (c_custkey * 37 % 120 - 60)::DOUBLE AS lat, (c_custkey * 101 % 360 - 179.5)::DOUBLE AS lon, c_custkey AS population FROM customer",
    "positional_points": "SELECT (c_custkey * 37 % 120 - 60)::DOUBLE AS lat, (c_custkey * 101 % 360 - 179.5)::DOUBLE AS lon, floor(c_acctbal)::BIGINT AS population FROM customer WHERE floor(c_acctbal) > 0",
    "code_names": "SELECT 'N' || n_nationkey AS code, n_name AS name FROM nation",
    "text_lines": "SELECT (row_number() OVER (ORDER BY n_nationkey) - 1)::INTEGER AS line_no, n_nationkey || chr(9) || n_name AS value FROM nation",
    "ranking_file": _N + """
        , r AS (SELECT *, rank() OVER (ORDER BY n DESC) AS rank FROM n), l AS (SELECT *, row_number() OVER (ORDER BY rank, key) - 1 AS line_no FROM r)
        SELECT rank::INTEGER AS rank, CASE WHEN key < 20 AND key <> 7 THEN key END AS id, CASE key WHEN 7 THEN NULL WHEN 3 THEN 'x3' ELSE 'n' || key END AS iso2,
               CASE WHEN key = 7 THEN 'Special Seven' WHEN key < 20 THEN name ELSE 'N' || key END AS name, n::INTEGER AS points, key < 20 AND key % 2 = 0 AS member, key >= 20 OR key = 7 AS flagged, line_no::INTEGER AS line_no
        FROM l WHERE key % 5 <> 4 AND key <> 2""",
    "log_events": _LOG + " SELECT line, place, month::VARCHAR AS month, kind, a, b, points FROM t",
    "rating_months": _LOG + """
        , m AS (SELECT a AS code, month, points AS d FROM t UNION ALL SELECT b, month, -points FROM t WHERE b IS NOT NULL),
        s AS (SELECT code, month, sum(sum(d)) OVER (PARTITION BY code ORDER BY month) AS rating FROM m GROUP BY code, month),
        g AS (SELECT code, unnest(generate_series(min(month)::TIMESTAMP, (SELECT max(month) FROM s)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM s GROUP BY code)
        SELECT code, month::VARCHAR AS month, last_value(rating IGNORE NULLS) OVER (PARTITION BY code ORDER BY month ROWS UNBOUNDED PRECEDING)::BIGINT AS rating FROM g LEFT JOIN s USING (code, month)""",
    "squad_tables": """
        SELECT s_nationkey AS key, n_name AS section, s_suppkey AS number, 'GK' AS position, s_name AS name, '1 May ' || (s_suppkey % 30 + 1970) AS born, (s_suppkey % 100)::INTEGER AS caps,
               'Club ' || (s_suppkey % 7) AS club, '/wiki/' || replace(s_name, '#', '%23') AS href FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "infobox_places": "SELECT s_suppkey, 'City ' || (s_suppkey % 9) AS city, n_name AS country FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "member_list": """
        SELECT s_nationkey AS key, s_suppkey AS ident, s_name AS title FROM supplier JOIN nation ON s_nationkey = n_nationkey
        UNION ALL SELECT DISTINCT s_nationkey, -1::BIGINT, 'more' FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "anchor_titles": "SELECT s_nationkey AS key, n_name AS section, s_name AS anchor, s_name AS title FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "coach_lines": "SELECT n_nationkey AS key, n_name AS section, 'B ' || n_nationkey AS coach, 'B ' || n_nationkey AS title, CASE WHEN n_nationkey % 3 = 0 THEN 'NATION_' || (n_nationkey + 1) ELSE n_name END AS nationality FROM nation",
    "text_sections": "SELECT n_name AS section, n_nationkey AS key, 'MF' AS position, n_name AS name FROM nation",
    "squad_list": """
        WITH s AS (SELECT s_suppkey AS k, s_nationkey AS key, n_name AS section, translate(s_suppkey::VARCHAR, '0123456789', 'abcdefghij') AS x, translate(s_nationkey::VARCHAR, '0123456789', 'abcdefghij') AS y FROM supplier JOIN nation ON s_nationkey = n_nationkey)
        SELECT section, 'Ana O''' || upper(x[1]) || x[2:] || ' De-' || upper(y[1]) || y[2:] AS name, (k % 99 + 1)::INTEGER AS number, 'GK' AS position,
               CASE WHEN k % 11 <> 0 THEN make_date(k % 30 + 1970, k % 12 + 1, k % 28 + 1)::VARCHAR END AS born, 'Club ' || (k % 7) AS club, CASE WHEN k % 5 <> 0 THEN (k % 40 + 160)::INTEGER END AS height,
               (k % 100)::INTEGER AS caps, (k % 13)::INTEGER AS goals, NULL AS nationality FROM s
        UNION ALL SELECT n_name, 'Bo Van ' || upper(y[1]) || y[2:], NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'NATION_' || ((n_nationkey + 1) % 25)
        FROM (SELECT *, translate(n_nationkey::VARCHAR, '0123456789', 'abcdefghij') AS y FROM nation)""",
    "workbook_cells": _N + """
        SELECT 'Data & more' AS sheet, (key + 2)::INTEGER AS row_no, (year - 1998)::INTEGER AS col_no, CASE WHEN key % 2 = 1 THEN format('{:,}', n * 1000 + year) ELSE (n * 1000 + year)::VARCHAR END AS value FROM n, y
        UNION ALL SELECT 'Data & more', (key + 2)::INTEGER, 1, name FROM n
        UNION ALL SELECT 'Data & more', 1, (year - 1998)::INTEGER, year::VARCHAR FROM y
        UNION ALL SELECT * FROM (VALUES ('Data & more', 0, 0, 'Title'), ('Data & more', 1, 1, 'Area'), ('Notes', 0, 0, 'nothing'))""",
    "sheet_codes": _N + " SELECT 'Data & more' AS sheet, repeat(chr(65 + key), 3) AS code, year, (n * 1000 + year)::DOUBLE AS value FROM n, y WHERE (key + year) % 5 <> 0",
    "sheet_nations": _N + " SELECT name AS label, year, (n * 1000 + year)::DOUBLE AS value, round((n * 1000 + year) * 1.25::DOUBLE / 1000, 2) AS scaled FROM n, y",
    "sheet_sections": _N + " SELECT name AS section, year, (n + year)::DOUBLE AS value FROM n, y WHERE year % 3 <> 0",
    "sheet_totals": _N + " SELECT name AS label, (n * 1000 + key + 1001)::DOUBLE AS value FROM n WHERE key IN (3, 4, 11)",
    "wide_years_file": _N + " SELECT 'N' || key AS iso, 'Natión € ' || key AS name, year, (n * 1000 + year)::DOUBLE AS value FROM n, y WHERE (key + year) % 4 <> 0",
    "wide_or_long": _N + " SELECT form, key AS iso, year, (n + year)::DOUBLE AS value FROM n, y, (VALUES ('wide'), ('long')) f(form) WHERE (key + year) % 4 <> 0",
    "indicator_proxy": "SELECT s_suppkey, s_acctbal AS value, indicator, is_proxy FROM supplier, (VALUES ('gdp_total', false), ('gdp_per_head', true)) i(indicator, is_proxy)",
    "life_expectancy": """
        SELECT c_nationkey, (c_custkey % 6 + 2001)::INTEGER AS year, avg(ex)::DOUBLE AS value, count(*) > 1 AS is_proxy FROM (SELECT *, floor(c_acctbal)::BIGINT % 50 + 50 AS ex FROM customer)
        WHERE c_custkey % 3 = 1 AND ex BETWEEN 60 AND 95 GROUP BY ALL""",
    "jsonstat_cube": "SELECT 'N' || c_nationkey AS geo, c_mktsegment AS segment, count(*)::DOUBLE AS value FROM customer GROUP BY ALL",
    "query_bindings": "SELECT 'http://e/Q' || n_nationkey AS item, CASE WHEN n_nationkey % 7 = 0 THEN NULL WHEN n_nationkey % 4 = 0 THEN '' ELSE n_name END AS label FROM nation",
    "paged_service": "SELECT n_nationkey AS key, n_name AS name FROM nation",
    "country_metadata": _N + """
        SELECT 'n' || key AS iso2, CASE WHEN key % 3 <> 0 THEN n END AS population, CASE WHEN key % 3 <> 0 THEN '2020' END AS pop_year, CASE WHEN key % 2 = 0 THEN name ELSE 'Base ' || name END AS en,
               CASE WHEN key % 2 = 0 THEN 'Ville' END AS fr, 'Citta' AS it FROM n""",
    "cache_age": "SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS fetched FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1997-05-31' AND DATE '1997-06-30'",
    "stored_model": "SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "service_games": """
        WITH g AS (SELECT *, o_custkey % 25 AS h, (o_custkey + 1 + o_orderkey % 7) % 25 AS a, o_orderkey AS k FROM orders)
        SELECT k AS id, strftime(o_orderdate, '%Y-%m-%d') AS date, CASE WHEN k % 3 = 0 THEN 'Group Stage - 1' ELSE 'Final' END AS round, o_orderstatus AS status, 'NATION_' || h AS home, 'NATION_' || a AS away,
               (k % 4)::INTEGER AS home_goals, (k % 6)::INTEGER AS away_goals, CASE WHEN k % 5 <> 0 THEN CASE WHEN k % 2 = 0 THEN 'home' ELSE 'away' END END AS winner,
               CASE WHEN k % 11 = 0 THEN 4 END AS home_penalty, CASE WHEN k % 11 = 0 THEN 3 END AS away_penalty, CASE WHEN k % 3 = 0 AND x.n_regionkey = y.n_regionkey THEN chr((65 + x.n_regionkey)::INTEGER) END AS letter
        FROM g LEFT JOIN nation x ON x.n_name = 'NATION_' || h LEFT JOIN nation y ON y.n_name = 'NATION_' || a""",
    "service_standings": _N + """
        SELECT chr((65 + region)::INTEGER) AS letter, key::INTEGER AS rank, name AS team, n::INTEGER AS points, (key % 3 + 2)::INTEGER AS played, (key % 3)::INTEGER AS win, 1 AS draw, 1 AS lose, (key % 9)::INTEGER AS goals_for,
               (key % 4)::INTEGER AS goals_against, (key % 9 - key % 4)::INTEGER AS goals_diff FROM n""",
    "service_statistics": """
        WITH l AS (SELECT l_orderkey AS game, sum(l_quantity::BIGINT)::INTEGER AS q, count(*)::INTEGER AS n FROM lineitem GROUP BY ALL)
        SELECT game, 'home' AS team, q AS fouls, CASE WHEN n % 2 = 0 THEN n ELSE 0 END AS yellow, 0 AS red FROM l UNION ALL SELECT game, 'away', n, 0, 1 FROM l""",
    "model_documents": _MODEL,
    "version_diff": """
        WITH v AS (SELECT i, c_nationkey AS nation, sum(floor(c_acctbal)::BIGINT)::BIGINT AS points FROM customer, (VALUES (0), (2)) v(i) WHERE c_custkey % 4 <= i AND c_nationkey % 5 <> i GROUP BY ALL),
        r AS (SELECT *, rank() OVER (PARTITION BY i ORDER BY points DESC) AS place FROM v),
        a AS (SELECT nation, points AS p0, place AS r0 FROM r WHERE i = 0), b AS (SELECT nation, points AS p2, place AS r2 FROM r WHERE i = 2)
        SELECT nation, CASE WHEN r0 IS NULL THEN 'added' WHEN r2 IS NULL THEN 'removed' ELSE 'changed' END AS kind, p0 AS old_value, p2 AS new_value, p2 - p0 AS value_delta, r0 - r2 AS rank_delta, r0 AS old_rank, r2 AS new_rank, p0::VARCHAR AS old_leaf, p2::VARCHAR AS new_leaf
        FROM a FULL JOIN b USING (nation) WHERE p0 IS DISTINCT FROM p2""",
    "registry_file": """
        WITH s AS (SELECT 'n' || s_nationkey AS nation, s_name AS name, s_suppkey AS i FROM supplier),
        a AS (SELECT nation, name, i::VARCHAR AS ids, row_number() OVER (ORDER BY nation, name) AS pid FROM s WHERE i % 3 = 0),
        b AS (SELECT nation, name, (i + 10000)::VARCHAR AS ids FROM s WHERE (i + 10000) % 3 <> 1),
        f AS (SELECT nation, name, ids, (SELECT max(pid) FROM a) + row_number() OVER (ORDER BY nation, name) AS pid FROM b WHERE (nation, name) NOT IN (SELECT (nation, name) FROM a))
        SELECT coalesce(a.pid, f.pid) AS pid, nation, name, array_to_string(list_sort(list_filter([a.ids, b.ids], lambda x: x IS NOT NULL)), ';') AS ids FROM a FULL JOIN b USING (nation, name) LEFT JOIN f USING (nation, name)""",
    "write_if_changed": "SELECT * FROM (VALUES (0, true), (1, false), (2, true), (3, false)) v(step, written)",
    "grid_document": """
        WITH g AS (SELECT (c_custkey % 9)::INTEGER AS i, (c_custkey % 7)::INTEGER AS j, sum(floor(c_acctbal)::BIGINT) / 1000 AS v FROM customer GROUP BY ALL)
        SELECT a.range::INTEGER AS i, b.range::INTEGER AS j, round(v, 3)::DOUBLE AS v FROM range(9) a CROSS JOIN range(7) b LEFT JOIN g ON i = a.range AND j = b.range AND i <> j""",
    "csv_file": _N + " SELECT key, name, n FROM n",
    "title_batches": "SELECT batch, string_agg(c_name, '|' ORDER BY c_name) AS request FROM (SELECT c_name, (row_number() OVER (ORDER BY c_name) - 1) // 50 AS batch FROM (SELECT DISTINCT c_name FROM customer)) GROUP BY batch",
    "profile_files": """
        WITH w AS (SELECT o_custkey, year(o_orderdate)::INTEGER AS year, max(o_orderkey) AS last_order FROM orders GROUP BY ALL)
        SELECT *, 'wide' AS file FROM w UNION ALL SELECT *, 'latest' FROM (SELECT o_custkey, max(year) AS year, arg_max(last_order, year) AS last_order FROM w GROUP BY ALL)""",
}
