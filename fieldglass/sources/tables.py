"""Records out of the rows of pages and sheets: which row is the header, which columns are meant, where a list ends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.functions.numbers import parse_number
from fieldglass.functions.text import split_place, strip_code, strip_notes, title_of_link
from fieldglass.staging import carry

#: What the headers of people's tables hold, by field, in order of preference.
PEOPLE = {
    "number": ("no.", "no"), "position": ("pos",), "name": ("player", "name"), "born": ("date of birth", "born"),
    "place": ("place of birth", "birthplace", "birth place", "birth city"), "caps": ("caps", "cap"), "club": ("club",),
}
SUPPORT = ("position", "born", "caps", "club")
#: Words by which a header row is told.
HEADER_WORDS = ("pos", "player", "name", "birth", "place", "club", "cap", "goal")


def _any_in(label: Column, words: Sequence[str]) -> Column:
    return reduce(Column.__or__, (F.contains(label, F.lit(w)) for w in words))


def _column_of(labels: Column, words: Sequence[str]) -> Column:
    """The place (from 0) of the first label with the first of the words that any label has, else null."""
    numbered = F.transform(labels, lambda x, i: F.struct(x.alias("label"), i.alias("at")))
    holding = lambda word: F.filter(numbered, lambda s: F.contains(s["label"], F.lit(word)))
    return F.coalesce(*(F.get(holding(w), F.lit(0))["at"] for w in words))


def table_records(rows: DataFrame, page: str, fields: Mapping[str, Sequence[str]] = PEOPLE, name: str = "name", support: Sequence[str] = SUPPORT, least_support: int = 2, header_rows: int = 3, least_cells: int = 3, header_words: Sequence[str] = HEADER_WORDS) -> DataFrame:
    """Records of tables that list people, from rows (page, section, table_no, row_no, cells, hrefs and, if there, links): page,
    section, a column for each field, and href: the first link of the name's cell, or without links that of the row.

    A table's header is, of its first rows, the one in which most labels hold one of `header_words`; of equals the first. A table counts if it has the name's column and `least_support` of the supporting ones, which tells lists of
    people from tables of figures. Rows without a name or with few cells are left out; a null page is left out.
    """
    labels = F.transform("cells", lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))))
    score = F.size(F.filter(labels, lambda label: _any_in(label, header_words)))
    heads = rows.where(F.col("row_no") < header_rows).select(page, "table_no", "row_no", labels.alias("labels"), score.alias("score")).where("score > 0")
    heads = heads.groupBy(page, "table_no").agg(F.max_by(F.struct("labels", F.col("row_no").alias("header")), F.struct("score", -F.col("row_no"))).alias("h")).select(page, "table_no", "h.*")
    heads = heads.select(page, "table_no", "header", *(_column_of(F.col("labels"), w).alias(f"at {f}") for f, w in fields.items()))
    supports = reduce(Column.__add__, (F.col(f"at {f}").isNotNull().cast("int") for f in support))
    heads = heads.where(F.col(f"at {name}").isNotNull() & (supports >= least_support))
    body = rows.join(heads, [page, "table_no"]).where((F.col("row_no") > F.col("header")) & (F.size("cells") >= least_cells))
    value = lambda f: F.when(F.col(f"at {f}").isNotNull(), strip_notes(F.get("cells", F.col(f"at {f}")))).alias(f)
    href = F.get("links", F.col(f"at {name}")) if "links" in rows.columns else F.get("hrefs", F.lit(0))
    out = body.select(page, "section", "table_no", "row_no", *map(value, fields), href.alias("href"))
    return out.where((F.col(name) != "") & (F.lower(name) != "nan"))


def rows_before(rows: DataFrame, page: str, stop: str) -> DataFrame:
    """Rows of the tables before the first whose section matches `stop`: a list that goes on in several tables, up to a
    heading. The first row of each table is its header."""
    end = rows.where(F.col("section").rlike(stop)).groupBy(page).agg(F.min("table_no").alias("end"))
    kept = rows.join(end, page, "left").where(F.col("end").isNull() | (F.col("table_no") < F.col("end")))
    return kept.where("row_no > 0").drop("end")


def infobox_place(rows: DataFrame, page: str, label: str = r"(?i)^(?:place of birth|born|birth\s*place)\b") -> DataFrame:
    """(page, city, country) from the row of an infobox whose first cell is the label: the first and last comma part."""
    found = rows.where(F.get("cells", F.lit(0)).rlike(label) & (F.size("cells") > 1))
    first = found.groupBy(page).agg(F.min_by(F.get("cells", F.lit(1)), F.struct("table_no", "row_no")).alias("text"))
    place = split_place(F.col("text"))
    return first.select(page, place["first"].alias("city"), place["last"].alias("country"))


def anchor_titles(links: DataFrame, page: str) -> DataFrame:
    """(page, section, anchor, title) of links with their place to pages of the plain kind, whose title has no colon: of several links
    of a section with one text the last counts. Links without a text are left out."""
    titled = links.withColumn("title", title_of_link(F.col("href"))).where(~F.contains("title", F.lit(":")) & (F.col("title") != "") & (F.col("anchor") != ""))
    return titled.groupBy(page, "section", "anchor").agg(F.max_by("title", "place").alias("title"))


def coaches(links: DataFrame, page: str, label: str = r"(?i)\b(?:head coach|coach|manager)\b") -> DataFrame:
    """(page, section, coach, title, nationality) from links with context, after a label in their block: the last name under a
    heading is the coach in office; a link with an image is a flag, whose text is the nationality, else the heading's."""
    rows = links.where(F.col("before").rlike(label)).withColumn("title", title_of_link(F.col("href"))).where("title is not null")
    is_name = F.col("image").isNull() & (F.length("anchor") > 1) & ~F.col("anchor").rlike(r"(?i)^(coach|manager|head coach)$")
    names = F.max_by(F.when(is_name, F.struct("anchor", "title")), F.when(is_name, F.col("place")))
    flag = F.max_by(F.when(F.col("image") != "", F.col("image")), F.when(F.col("image") != "", F.col("place")))
    found = rows.groupBy(page, "section").agg(names.alias("name"), flag.alias("flag")).where("name is not null")
    return found.select(page, "section", strip_notes(F.col("name.anchor")).alias("coach"), F.col("name.title").alias("title"), F.coalesce("flag", strip_code(F.col("section"))).alias("nationality"))


def code_column(cells: DataFrame, pattern: str = "^[A-Z]{3}$", least: int = 21) -> DataFrame:
    """(path, sheet, col_no) of the first column of each sheet in which at least `least` cells are codes."""
    n = cells.where(F.trim("value").rlike(pattern)).groupBy("path", "sheet", "col_no").count().where(F.col("count") >= least)
    return n.groupBy("path", "sheet").agg(F.min("col_no").alias("col_no"))


def coded_years(cells: DataFrame, years: DataFrame, pattern: str = "^[A-Z]{3}$", least: int = 21) -> DataFrame:
    """(path, sheet, code, year, value) of the rows with a code in the column of codes; `years` is (path, sheet, col_no, year).
    Values that are no positive number are left out."""
    at = code_column(cells, pattern, least)
    codes = cells.join(at, ["path", "sheet", "col_no"]).where(F.trim("value").rlike(pattern)).select("path", "sheet", "row_no", F.trim("value").alias("code"))
    values = cells.join(years, ["path", "sheet", "col_no"]).select("path", "sheet", "row_no", "year", parse_number(F.col("value")).alias("value")).where("value > 0")
    return codes.join(values, ["path", "sheet", "row_no"]).select("path", "sheet", "code", "year", "value")


def section_rows(cells: DataFrame, years: DataFrame, names: Sequence[str], wanted: str = r"(?i)per head|per capita", least: float = 100.0) -> DataFrame:
    """(path, sheet, section, year, value) of the rows whose first cell matches `wanted`, under the last row above whose first
    cell is one of `names`; values up to `least` are left out. Of several rows for a year the last counts."""
    first = cells.where("col_no = 0").select("path", "sheet", "row_no", F.trim("value").alias("label"))
    first = first.withColumn("own section", F.when(F.col("label").isin(*names), F.col("label")))
    rows = carry(first, ["path", "sheet"], ["row_no"], {"section": "own section"}).where(F.col("section").isNotNull() & F.col("label").rlike(wanted)).drop("own section")
    values = cells.join(years, ["path", "sheet", "col_no"]).select("path", "sheet", "row_no", "year", parse_number(F.col("value")).alias("value")).where(F.col("value") > least)
    found = rows.join(values, ["path", "sheet", "row_no"])
    return found.groupBy("path", "sheet", "section", "year").agg(F.max_by("value", "row_no").alias("value"))


def header_years(cells: DataFrame, least_years: int = 10, first: int = 1990, last: int = 2030) -> DataFrame:
    """(path, sheet, col_no, year) of the first row of each sheet that holds at least `least_years` years."""
    number = F.col("value").try_cast("double")
    years = cells.withColumn("year", F.when((number == F.floor(number)) & number.between(first, last), number.cast("int"))).where("year is not null")
    rows = years.groupBy("path", "sheet", "row_no").count().where(F.col("count") >= least_years).groupBy("path", "sheet").agg(F.min("row_no").alias("row_no"))
    return years.join(rows, ["path", "sheet", "row_no"]).select("path", "sheet", "col_no", "year")
