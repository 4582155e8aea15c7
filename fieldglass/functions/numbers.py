"""Numeric, date and code functions on columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column, digits: int = 2) -> Column:
    """a / b, rounded; null where b is 0."""
    return F.round(a / F.nullif(b, F.lit(0)), digits)


def none_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def none_if_zero(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def millions(c: Column) -> Column:
    return F.round(c / 1e6, 2)


def parse_number(c: Column, sentinels: Sequence[str] = ("", "..", "n/a", "--", "-", ":")) -> Column:
    """A number with thousands commas; sentinels and anything else are null."""
    text = F.trim(F.replace(c, F.lit(","), F.lit("")))
    return F.when(~F.lower(text).isin(*sentinels), text.try_cast("double"))


def scaled_currency(amount: Column, rate: Column) -> Column:
    """Millions in one currency as thousands of millions in another."""
    return F.round(amount * rate / 1000, 2)


def is_sovereign(code: Column, prefixes: Sequence[str] = ("GB-", "ES5", "BE1", "BE2")) -> Column:
    """Whether a code is none of a part of a country, by its prefix."""
    return ~code.rlike("^(" + "|".join(prefixes) + ")")


def period_midpoint(c: Column) -> Column:
    """The middle year, rounded down, of a period like `2018 to 2020`."""
    year = lambda i: F.regexp_extract(c, r"(\d{4})\D+(\d{4})", i).try_cast("int")
    return F.floor((year(1) + year(2)) / 2).cast("int")


def month_index(year: Column, month: Column) -> Column:
    return year * 12 + month - 1


def point_of_wkt(c: Column) -> Column:
    """A struct (lat, lon) from `Point(lon lat)`, else null."""
    number = r"(-?\d+(?:\.\d+)?)"
    part = lambda i: F.regexp_extract(c, rf"(?i)^\s*point\s*\(\s*{number}\s+{number}\s*\)", i).try_cast("double")
    return F.when(part(1).isNotNull(), F.struct(part(2).alias("lat"), part(1).alias("lon")))


def statistic(stats: Column, kind: str) -> Column:
    """The value of one kind in an array of (type, value); 0 where it is missing or null."""
    return F.coalesce(F.get(F.filter(stats, lambda s: s["type"] == kind), F.lit(0))["value"].try_cast("int"), F.lit(0))


def latest_value(columns: Sequence[Column], null_marker: str = "..") -> Column:
    """The first of `columns` (latest first) that isn't null, blank or the null marker, as a number; a value that is no
    number ends the search with null."""
    return F.coalesce(*(F.when(F.trim(c) == null_marker, None).otherwise(none_if_blank(F.trim(c))) for c in columns)).try_cast("double")
