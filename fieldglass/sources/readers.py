"""Readers: files as frames. Schemas are given, not inferred, wherever the caller knows them."""

from __future__ import annotations

import io
import json
import re
import time
import zipfile
from array import array
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from itertools import islice
from urllib.request import urlopen
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from fieldglass.functions.numbers import parse_number
from fieldglass.staging import carry, running_total, shuffle_partitions, stage


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file that is one JSON document, or an array of them."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_map(spark: SparkSession, path: str, value_schema: str, key: str = "key") -> DataFrame:
    """A file that is one JSON object: a row for each of its keys, with the value's fields."""
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", f"map<string, struct<{value_schema}>>")
    return text.select(F.explode(entries).alias(key, "entry")).select(key, "entry.*")


def read_nested_map(spark: SparkSession, path: str, outer: str, inner: str, value: str, value_type: str = "double") -> DataFrame:
    """A JSON object of objects: a row for each pair of keys."""
    text = spark.read.text(path, wholetext=True)
    first = text.select(F.explode(F.from_json("value", f"map<string, map<string, {value_type}>>")).alias(outer, "inner map"))
    return first.select(outer, F.explode("inner map").alias(inner, value))


def read_csv(spark: SparkSession, path: str, schema: str | None = None, separator: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """A file with a header; a byte-order mark before the first name is dropped. Without a schema all columns are text.

    Encodings are those that Spark reads, and windows-1252: as Latin-1, whose controls stand for its further characters.
    """
    windows = encoding.lower() in ("cp1252", "windows-1252")
    encoding = "ISO-8859-1" if windows else encoding
    reader = spark.read.option("header", True).option("sep", separator).option("encoding", encoding).option("quote", '"').option("escape", '"').option("multiLine", True)
    df = (reader.schema(schema) if schema else reader).option("enforceSchema", True).csv(path)
    df = df.toDF(*(c.lstrip("﻿") for c in df.columns))
    if windows:
        pairs = [(chr(i), bytes([i]).decode("cp1252", "replace")) for i in range(0x80, 0xA0)]
        df = df.withColumns({c: F.translate(c, "".join(a for a, _ in pairs), "".join(b for _, b in pairs)) for c, kind in df.dtypes if kind == "string"})
    return df


def read_positions(spark: SparkSession, path: str, columns: dict[int, tuple[str, str]], separator: str = "\t") -> DataFrame:
    """Columns by position (from 0) of a file without header: {4: ("lat", "double")}; what doesn't parse is null."""
    fields = F.split("value", separator, -1)
    return spark.read.text(path).select(*(F.get(fields, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in columns.items()))


def read_population_points(spark: SparkSession, path: str) -> DataFrame:
    """lat, lon, population of places from a positional file; those without people are left out."""
    return read_positions(spark, path, {4: ("lat", "double"), 5: ("lon", "double"), 14: ("population", "long")}).where("population > 0")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a text with their numbers from 0, in the order of the file: (line_no, value)."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.split("value", "\r\n|\r|\n")).alias("line_no", "value"))


def looks_like(lines: DataFrame, pattern: str) -> bool:
    """Whether the first line matches: a check before a download is put in place."""
    first = lines.orderBy("line_no").first()
    return bool(first and re.search(pattern, first["value"]))


def read_names(spark: SparkSession, path: str, drop_suffix: str = "_loc") -> DataFrame:
    """(code, name) of a tab-separated file, without the codes that end in `drop_suffix`."""
    return read_positions(spark, path, {0: ("code", "string"), 1: ("name", "string")}).where(~F.col("code").endswith(drop_suffix))


def wide_years(rows: DataFrame, keys: Sequence[str], pattern: str = r"^(?:\w+_)?((?:19|20)\d\d)$") -> DataFrame:
    """Year columns as rows (keys, year, value); values with commas or sentinels are parsed, and nulls left out."""
    years = {c: int(m[1]) for c in rows.columns if (m := re.match(pattern, c))}
    long = rows.select(*keys, F.explode(F.array(*(F.struct(F.lit(y).alias("year"), parse_number(F.col(f"`{c}`").cast("string")).alias("value")) for c, y in years.items()))).alias("v"))
    return long.select(*keys, "v.*").where("value is not null")


def wide_or_long(rows: DataFrame, keys: Sequence[str], pattern: str = r"^\w+_((?:19|20)\d\d)$") -> DataFrame:
    """Rows as (keys, year, value) whether the years are columns or a column."""
    if any(re.match(pattern, c) for c in rows.columns):
        return wide_years(rows, keys, pattern)
    return rows.select(*keys, F.col("year").cast("int").alias("year"), parse_number(F.col("value").cast("string")).alias("value")).where("value is not null")


def with_proxy(rows: DataFrame, indicator: str, proxy_for: str) -> DataFrame:
    """Each row of an indicator twice: as itself, and as a proxy for another."""
    copies = F.array(F.struct(F.lit(indicator).alias("indicator"), F.lit(False).alias("is_proxy")), F.struct(F.lit(proxy_for).alias("indicator"), F.lit(True).alias("is_proxy")))
    return rows.select(*(c for c in rows.columns if c not in ("indicator", "is_proxy")), F.explode(copies).alias("c")).select("*", "c.*").drop("c")


def read_jsonstat(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-stat cube: a row for each value with `at`, a map from dimension to category code, and value. A value's flat
    index is taken apart by the sizes of the dimensions; zeros are values too."""
    text = spark.read.text(path, wholetext=True)
    schema = "id array<string>, size array<int>, dimension map<string, struct<category: struct<index: map<string, int>>>>, value map<string, double>"
    cube = text.select(F.from_json("value", schema).alias("c")).select("c.*")
    cells = cube.select("id", "size", "dimension", F.explode("value").alias("flat", "value")).where("value is not null")
    stride = lambda i: F.aggregate(F.slice("size", i + 2, F.greatest(F.size("size") - i - 1, F.lit(0))), F.lit(1), lambda a, s: a * s)

    def code(name: Column, i: Column) -> Column:
        place = F.pmod(F.floor(F.col("flat").cast("long") / stride(i)).cast("int"), F.get("size", i))
        index = F.map_entries(F.element_at("dimension", name)["category"]["index"])
        return F.struct(name.alias("k"), F.coalesce(F.get(F.filter(index, lambda e: e["value"] == place), F.lit(0))["key"], place.cast("string")).alias("v"))

    return cells.select(F.map_from_entries(F.transform("id", code)).alias("at"), "value")


def read_bindings(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """The bindings of a SPARQL result as columns; a label that is only an item's id is blank."""
    schema = "results struct<bindings: array<map<string, struct<value: string>>>>"
    rows = read_json(spark, path, schema).select(F.explode("results.bindings").alias("b"))
    value = lambda n: F.col("b")[n]["value"]
    return rows.select(*(F.when(value(n).rlike("^Q[0-9]+$"), "").otherwise(value(n)).alias(n) for n in names))


def read_pages(spark: SparkSession, folder: str, schema: str, items: str) -> DataFrame:
    """A REST service's pages, captured as one JSON file each: the rows of all their `items`."""
    return spark.read.schema(f"{items} array<struct<{schema}>>").option("multiLine", True).json(folder).select(F.inline(items))


class ServiceReader(DataSourceReader):
    """Reads a service's pages: `address` with `{page}` in it, from 1 on. The first page tells how many there are (`pages`);
    each is a partition of its own, read by an executor, up to `tries` times. Rows are (page, text)."""

    def __init__(self, options: dict[str, str]):
        self.address, self.tries = options["address"], int(options.get("tries", 3))

    def _text(self, page: int) -> str:
        address = self.address.replace("{page}", str(page))
        for left in range(self.tries - 1, -1, -1):
            try:
                with urlopen(address, timeout=30) as answer:
                    return answer.read().decode("utf-8")
            except OSError:
                if not left:
                    raise
                time.sleep(1)
        raise ValueError("tries must be at least 1")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(1, int(json.loads(self._text(1)).get("pages", 1)) + 1)]

    def read(self, partition: InputPartition) -> Iterator[tuple[int, str]]:
        yield partition.value, self._text(partition.value)


class ServiceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_service"

    def schema(self) -> str:
        return "page int, text string"

    def reader(self, schema) -> ServiceReader:
        return ServiceReader(self.options)


def read_service(spark: SparkSession, address: str, schema: str, items: str, tries: int = 3) -> DataFrame:
    """The rows of all pages of a service (or of captured ones in a store that Spark reads): `address` has `{page}` where the
    number goes, and pages are read until the number that each tells in `pages`."""
    kind = f"pages int, {items} array<struct<{schema}>>"
    if re.match("https?://", address):
        spark.dataSource.register(ServiceSource)
        texts = spark.read.format("paged_service").option("address", address).option("tries", str(tries)).load().select("text")
    else:
        read = lambda page: spark.read.text(address.replace("{page}", str(page)), wholetext=True).select(F.col("value").alias("text"))
        pages = read(1).select(F.from_json("text", kind)["pages"]).first()[0] or 1
        texts = read(1) if pages == 1 else spark.read.text([address.replace("{page}", str(i)) for i in range(1, pages + 1)], wholetext=True).select(F.col("value").alias("text"))
    return texts.select(F.inline(F.from_json("text", kind)[items]))


def lookup_batches(rows: DataFrame, column: str, size: int = 50, separator: str = "|") -> DataFrame:
    """(batch, request): the different values of a column, joined `size` at a time in their order, as services take them."""
    different = stage(rows.where(F.col(column).isNotNull()).select(column).distinct().withColumn("one", F.lit(1).cast("long")))
    numbered = running_total(different, [], [column], {"before": "one"}).withColumn("batch", F.floor(F.col("before") / size))
    return numbered.groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list(column)), separator).alias("request"))


def cached_within(rows: DataFrame, fetched_at: str, now: Column, days: int = 30) -> DataFrame:
    """Rows of a cache that are not too old."""
    return rows.where(F.datediff(now, F.col(fetched_at)) <= days)


def country_metadata(base: DataFrame, population: DataFrame, capitals: DataFrame) -> DataFrame:
    """`base` (iso2, ..., capital map) with population (iso2, population, pop_year) and capitals by language (iso2, names map),
    which go before the base's; other languages without a name take the English one."""
    out = base.join(population, "iso2", "left").join(capitals, "iso2", "left")
    none = F.create_map().cast("map<string,string>")
    merged = F.map_concat(F.map_filter(F.coalesce("capital", none), lambda k, _: ~F.array_contains(F.map_keys(F.coalesce("names", none)), k)), F.coalesce("names", none))
    return out.withColumn("capital", merged).drop("names")


def sections(lines: DataFrame, header: str, skip: str | None = None, least_fields: int = 1) -> DataFrame:
    """Rows of a text layout: each line split at two or more spaces, with the section header above it: (line_no, section,
    fields). `header` is a pattern with the section in its first group. Sections are carried from task to task; line numbers tell
    lines apart, and blank lines are no rows."""
    line = F.trim(F.regexp_replace("value", r"^\s+|\s+$", ""))
    rows = lines.select("line_no", line.alias("line")).where("line <> ''")
    rows = rows.withColumn("own section", F.when(F.col("line").rlike(header), F.regexp_extract("line", header, 1)))
    rows = carry(rows, [], ["line_no"], {"section": "own section"}).where(F.col("own section").isNull() & F.col("section").isNotNull())
    if skip:
        rows = rows.where(~F.col("line").rlike(skip))
    return rows.select("line_no", "section", F.split("line", r"\s{2,}").alias("fields")).where(F.size("fields") >= least_fields)


#: The fields of a player's row and of a coach's, and what tells them.
PLAYER_FIELDS = ("number", "position", "shown", "first", "last", "shirt", "born", "club", "height", "caps", "goals")
COACH_FIELDS = ("role", "shown", "first", "last", "nationality")
COACH_ROLE = "Head coach"


def roster_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Players and coaches out of `sections` of a squad list.

    A player's row begins with a number of one or two digits and has the eleven PLAYER_FIELDS: line_no, section, number,
    position, name, born (date of DD/MM/YYYY, else null), club, height, caps, goals (null where no whole number). A coach's
    begins with COACH_ROLE and has the five COACH_FIELDS: line_no, section, name, nationality. Further fields are left
    out, and so are all other rows. A name is the first of the first names and the last names, each word with a capital.
    """
    field = lambda names, n: F.get("fields", F.lit(names.index(n)))
    whole = lambda n: F.when(field(PLAYER_FIELDS, n).rlike("^[0-9]+$"), field(PLAYER_FIELDS, n).try_cast("int"))
    #: Letters after a sign begin a word too.
    titled = lambda c: F.replace(F.initcap(F.regexp_replace(F.lower(c), r"([^\p{L}\s])(?=\p{L})", "$1\u0001 ")), F.lit("\u0001 "), F.lit(""))

    def name(names: Sequence[str]) -> Column:
        return F.trim(F.concat(F.regexp_extract(field(names, "first"), r"^\s*(\S*)", 1), F.lit(" "), titled(field(names, "last")))).alias("name")

    players = rows.where(F.get("fields", F.lit(0)).rlike("^[0-9]{1,2}$") & (F.size("fields") >= len(PLAYER_FIELDS)))
    born = F.when(field(PLAYER_FIELDS, "born").rlike("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_timestamp(field(PLAYER_FIELDS, "born"), F.lit("d/M/yyyy")).cast("date"))
    players = players.select("line_no", "section", field(PLAYER_FIELDS, "number").cast("int").alias("number"), field(PLAYER_FIELDS, "position").alias("position"), name(PLAYER_FIELDS), born.alias("born"), field(PLAYER_FIELDS, "club").alias("club"), *(whole(n).alias(n) for n in ("height", "caps", "goals")))
    coaches = rows.where((F.get("fields", F.lit(0)) == COACH_ROLE) & (F.size("fields") >= len(COACH_FIELDS)))
    return players, coaches.select("line_no", "section", name(COACH_FIELDS), field(COACH_FIELDS, "nationality").alias("nationality"))


# Documents that need a parser ----------------------------------------------------------------------------------------


#: Elements that begin a text of their own.
BLOCKS = frozenset(("p", "div", "li", "dd", "dt", "td", "th", "tr", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6"))


class _Rows(HTMLParser):
    """Table rows with the heading above them, and links with their text, place, first image's text and, with `context`, the text
    before them in their block."""

    def __init__(self, context: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self._context = context
        self.rows: list[tuple[str, int, int, list[str], list[str], list[str | None]]] = []
        self.links: list[tuple[str, str, str, int, str | None, str]] = []
        self.section, self.table = "", -1
        self._heading: list[str] | None = None
        self._cells: list[str] | None = None
        self._hrefs: list[str] = []
        self._firsts: list[str | None] = []
        self._cell = False
        self._link: tuple[str, list[str], str] | None = None
        self._image: str | None = None
        self._block: list[str] = []
        self._row, self._quiet = 0, 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._block = []
        if tag in ("script", "style", "sup"):
            self._quiet += 1
        elif re.fullmatch("h[1-6]", tag):
            self._heading = []
        elif tag == "table":
            self.table, self._row = self.table + 1, 0
        elif tag == "tr":
            self._close_row()
            self._cells, self._hrefs, self._firsts = [], [], []
        elif tag in ("td", "th") and self._cells is not None:
            self._cells.append("")
            self._firsts.append(None)
            self._cell = True
        elif tag == "a":
            href = dict(attrs).get("href") or ""
            self._link, self._image = (href, [], " ".join("".join(self._block).split()) if self._context else ""), None
            if self._cell:
                self._hrefs.append(href)
                if self._firsts[-1] is None:
                    self._firsts[-1] = href
        elif tag == "img" and self._link and self._image is None:
            self._image = dict(attrs).get("alt") or ""

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "sup"):
            self._quiet = max(0, self._quiet - 1)
        elif re.fullmatch("h[1-6]", tag) and self._heading is not None:
            self.section, self._heading = " ".join("".join(self._heading).split()), None
        elif tag in ("td", "th"):
            self._cell = False
        elif tag in ("tr", "table"):
            self._close_row()
        elif tag == "a" and self._link:
            self.links.append((self.section, " ".join("".join(self._link[1]).split()), self._link[0], len(self.links), self._image, self._link[2]))
            self._link = None

    def handle_data(self, data: str) -> None:
        if self._quiet:
            return
        if self._context:
            self._block.append(data)
        if self._heading is not None:
            self._heading.append(data)
        if self._cell and self._cells:
            self._cells[-1] += data
        if self._link:
            self._link[1].append(data)

    def _close_row(self) -> None:
        if self._cells:
            self.rows.append((self.section, max(self.table, 0), self._row, [" ".join(c.split()) for c in self._cells], self._hrefs, self._firsts))
            self._row += 1
        self._cells, self._cell = None, False


@F.udtf(returnType="section string, table_no int, row_no int, cells array<string>, hrefs array<string>, links array<string>", useArrow=True)
class HtmlRows:
    """The table rows of a page, with all addresses of the row and the first of each cell."""

    def eval(self, html: str):
        parser = _Rows()
        parser.feed(html or "")
        parser.close()
        parser._close_row()
        yield from parser.rows


@F.udtf(returnType="section string, anchor string, href string, place int, image string, before string", useArrow=True)
class HtmlLinks:
    """The links of a page, with the heading above them, their text, their number on the page, the text of their first image and
    the text before them in their block, if wanted."""

    def eval(self, html: str, context: bool):
        parser = _Rows(context)
        parser.feed(html or "")
        parser.close()
        yield from parser.links


def html_rows(pages: DataFrame, key: str, html: str, links: bool = False) -> DataFrame:
    """The rows of all tables; with `links`, also the first address of each cell."""
    return pages.lateralJoin(HtmlRows(F.col(html).outer())).select(key, "section", "table_no", "row_no", "cells", "hrefs", *(["links"] if links else []))


def html_links(pages: DataFrame, key: str, html: str, context: bool = False, place: bool = False) -> DataFrame:
    """All links; with `place`, also their number on the page; with `context`, also place, image and before. Each link of a block
    holds all of the block's text before it there, which grows with the square of a block; the others grow with the page."""
    more = ["place", "image", "before"] if context else ["place"] if place else []
    return pages.lateralJoin(HtmlLinks(F.col(html).outer(), F.lit(context))).select(key, "section", "anchor", "href", *more)


def last_link(links: DataFrame, key: str, pattern: str) -> DataFrame:
    """Each page's section's last link whose address matches: links are taken in the order in which they stand."""
    numbered = links.withColumn("at", F.monotonically_increasing_id()).where(F.col("href").rlike(pattern))
    return numbered.groupBy(key, "section").agg(F.max_by(F.struct("anchor", "href"), "at").alias("l")).select(key, "section", "l.*")


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _column(ref: str) -> int:
    out = 0
    for c in re.match("[A-Z]*", ref)[0]:
        out = out * 26 + ord(c) - 64
    return out - 1


class _Strings:
    """The shared strings of a workbook, laid end to end: as little memory as the text itself takes."""

    def __init__(self, book: zipfile.ZipFile):
        self._ends, parts = array("q", [0]), bytearray()
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as stream:
                for _, element in _closed(stream, f"{_MAIN}si"):
                    parts += "".join(t.text or "" for t in element.iter(f"{_MAIN}t")).encode("utf-8")
                    self._ends.append(len(parts))
        self._text = bytes(parts)

    def __getitem__(self, i: int) -> str:
        return self._text[self._ends[i] : self._ends[i + 1]].decode("utf-8")


def _closed(stream, tag: str) -> Iterator[tuple[int, ElementTree.Element]]:
    """The elements of a tag, numbered, as they end; each is gone from memory, with all before it, when the next comes."""
    open_, n = [], 0
    for event, element in ElementTree.iterparse(stream, ("start", "end")):
        if event == "start":
            open_.append(element)
            continue
        open_.pop()
        if element.tag == tag:
            yield n, element
            n += 1
            for above in open_:
                above.clear()


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """Names of a workbook's sheets, and where they are in it."""
    tree = lambda name: ElementTree.fromstring(book.read(name))  # noqa: E731  # lists of sheets
    targets = {r.get("Id"): r.get("Target").lstrip("/") for r in tree("xl/_rels/workbook.xml.rels")}
    found = [(sheet.get("name"), targets[sheet.get(f"{_REL}id")]) for sheet in tree("xl/workbook.xml").iter(f"{_MAIN}sheet")]
    return [(name, t if t.startswith("xl/") else f"xl/{t}") for name, t in found]


def sheet_cells(book: zipfile.ZipFile, target: str, shared: _Strings) -> Iterator[tuple[int, int, str]]:
    """(row, column, text) of the cells of a sheet that hold something, counted from 0, as the sheet is read."""
    with book.open(target) as stream:
        for r, row in _closed(stream, f"{_MAIN}row"):
            row_no = int(row.get("r") or r + 1) - 1
            for c, cell in enumerate(row.iter(f"{_MAIN}c")):
                kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
                text = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t")) if kind == "inlineStr" else value.text if value is not None else None
                if kind == "s" and text is not None:
                    text = shared[int(text)]
                if text not in (None, ""):
                    yield row_no, _column(cell.get("r")) if cell.get("r") else c, text


#: Cells that are handed on at a time.
CELLS_AT_ONCE = 10_000


def read_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet, row_no, col_no, value) of the cells that hold something in the workbooks in `path`, counted from 0.

    Each sheet is a row of its own, dealt to the tasks with its workbook (packed, as the file is), and read as a stream: a task
    holds a workbook, its shared strings, a row and CELLS_AT_ONCE cells, however many rows a sheet has. An empty file has no
    sheets.
    """

    @F.udf("array<struct<sheet: string, target: string>>")
    def sheets(content: bytes):
        return _sheets(zipfile.ZipFile(io.BytesIO(bytes(content)))) if content else []

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, sheet, target, content = (batch.column(j)[i].as_py() for j in range(4))
                book = zipfile.ZipFile(io.BytesIO(content))
                cells = sheet_cells(book, target, _Strings(book))
                while some := list(islice(cells, CELLS_AT_ONCE)):
                    rows, columns, values = zip(*some, strict=True)
                    n = len(some)
                    yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array([sheet] * n), pa.array(rows, pa.int32()), pa.array(columns, pa.int32()), pa.array(values)], ["path", "sheet", "row_no", "col_no", "value"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    each = files.select("path", "content", F.explode(sheets("content")).alias("s")).select("path", "s.sheet", "s.target", "content")
    return each.repartition(shuffle_partitions(spark), "path", "sheet").mapInArrow(task, "path string, sheet string, row_no int, col_no int, value string")


def sheet_years(cells: DataFrame, least_years: int = 10, first: int = 1990, last: int = 2030) -> DataFrame:
    """(path, sheet, label, year, value) of sheets whose header row holds years: the first row with at least `least_years`
    whole numbers in that span. A row's label is its first cell with letters, left of the years."""
    number = F.col("value").try_cast("double")
    year = F.when((number == F.floor(number)) & number.between(first, last), number.cast("int"))
    header = cells.withColumn("year", year).groupBy("path", "sheet", "row_no").agg(F.count("year").alias("n")).where(F.col("n") >= least_years)
    header = header.groupBy("path", "sheet").agg(F.min("row_no").alias("header"))
    placed = cells.join(header, ["path", "sheet"])
    years = placed.where("row_no = header").select("path", "sheet", "col_no", year.alias("year")).where("year is not null")
    body = placed.where("row_no > header")
    labels = body.where(F.col("value").rlike(r"\p{L}")).groupBy("path", "sheet", "row_no").agg(F.min_by("value", "col_no").alias("label"))
    values = body.join(years, ["path", "sheet", "col_no"]).select("path", "sheet", "row_no", "year", parse_number(F.col("value")).alias("value")).where("value is not null")
    return values.join(labels, ["path", "sheet", "row_no"]).select("path", "sheet", "label", "year", "value")


def sheet_summary(cells: DataFrame, names: Sequence[str], least: float = 1000.0) -> DataFrame:
    """(path, sheet, label, value): for each row whose first text is one of `names`, its first number above `least`."""
    labels = cells.where(F.col("value").isin(*names)).groupBy("path", "sheet", "row_no").agg(F.min_by("value", "col_no").alias("label"))
    numbers = cells.withColumn("number", parse_number(F.col("value"))).where(F.col("number") > least)
    first = numbers.groupBy("path", "sheet", "row_no").agg(F.min_by("number", "col_no").alias("value"))
    return labels.join(first, ["path", "sheet", "row_no"]).select("path", "sheet", "label", "value")


def life_table(rows: DataFrame, keys: Sequence[str], period: str, age: str, value: str, low: float = 60, high: float = 95) -> DataFrame:
    """Life expectancy at birth by year: the values at age 0 within a plausible span, averaged over what falls in a year;
    is_proxy tells where more than one did."""
    from fieldglass.functions.numbers import period_midpoint

    rows = rows.where(F.col(age).try_cast("int") == 0).withColumn("year", F.coalesce(period_midpoint(F.col(period)), F.col(period).try_cast("int")))
    rows = rows.withColumn("number", F.col(value).try_cast("double")).where(F.col("number").between(low, high))
    return rows.groupBy(*keys, "year").agg(F.avg("number").alias("value"), (F.count("*") > 1).alias("is_proxy"))
