"""Compositions: coordinates that agree, people out of nested documents, and a report on two lists of people."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.functions.text import latin_letters, strip_qualifier
from fieldglass.operators.relational import count_mismatches, mutual_unique_match, residual_match


def converge_coordinates(people: DataFrame, claims: DataFrame, ident: str, city: str, country: str, seq: str) -> DataFrame:
    """`people` with lat, lon and how: where everyone shown under one city gets one point.

    `claims` (ident, label, lat, lon) are places claimed for people. A city's plain name is the one without its
    administrative qualifier. A claim whose label is the plain name is taken (`claim`); the first of them, in order of
    `seq`, is the city's. A person whose city has a qualifier takes the city's point (`sibling`), if there is one; another
    claim is only told (`diverges`). Without a claim, or with an incomplete one, nothing is taken.
    """
    plain = F.lower(F.trim(F.coalesce(strip_qualifier(F.col(city)), F.col(city))))
    rows = people.withColumn("plain", plain).withColumn("qualified", strip_qualifier(F.col(city)).isNotNull())
    good = claims.where("label is not null and lat is not null and lon is not null").select(ident, F.lower(F.trim("label")).alias("claimed"), F.struct("lat", "lon").alias("at"))
    rows = rows.join(good, ident, "left").withColumn("own", F.coalesce(F.col("claimed") == F.col("plain"), F.lit(False)))
    known = rows.where("own").groupBy("plain", country).agg(F.min_by("at", seq).alias("city at"))
    rows = rows.join(known, ["plain", country], "left")
    how = F.when(F.col("own"), "claim").when(F.col("claimed").isNotNull() & F.col("qualified") & F.col("city at").isNotNull(), "sibling").when(F.col("claimed").isNotNull() & ~F.col("qualified"), "diverges")
    at = F.when(how == "claim", F.col("at")).when(how == "sibling", F.col("city at"))
    return rows.select(*people.columns, at["lat"].alias("lat"), at["lon"].alias("lon"), how.alias("how"))


def flatten_people(documents: DataFrame, country: str, groups: Sequence[str]) -> DataFrame:
    """(country, group, place, person...) of the people in arrays of structs, in their order: all arrays have the same fields."""
    parts = [documents.select(F.col(country).alias("country"), F.lit(g).alias("group"), F.posexplode(g).alias("place", "person")) for g in groups]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("country", "group", "place", "person.*")


def consistency_report(left: DataFrame, right: DataFrame, nation: str, ident: str, born: str, name: str, fields: Sequence[str]) -> DataFrame:
    """How two lists of people differ: (kind, nation, left_id, right_id, detail).

    People are matched by birth date where it occurs once in the nation on either side, then by the letters of their name,
    where that is alone on the right among those left over. kind: `field` for a matched pair that differs in one, `left only`,
    `right only`, `count` for a nation whose numbers differ, `nation` for a nation on one side only.
    """
    key = lambda df, side: df.select(F.col(ident).alias(f"{side}_id"), nation, F.col(born).alias("born key"), latin_letters(F.col(name)).alias("name key"))
    a, b = key(left, "left"), key(right, "right")
    dated = lambda df: df.where(F.col("born key").isNotNull())
    first = mutual_unique_match(dated(a), dated(b), [nation, "born key"], "left_id", "right_id").select("left_id", "right_id")
    second = residual_match(a, b, [nation, "name key"], "left_id", "right_id", first).select("left_id", "right_id")
    pairs = first.unionByName(second)
    told = lambda df, kind, detail: df.select(F.lit(kind).alias("kind"), nation, "left_id", "right_id", detail.cast("string").alias("detail"))
    no = lambda df, side: df.withColumn(f"{side}_id", F.lit(None).cast(a.schema["left_id"].dataType))
    both = pairs.join(left.select(F.col(ident).alias("left_id"), nation, F.struct(*fields).alias("l")), "left_id").join(right.select(F.col(ident).alias("right_id"), F.struct(*fields).alias("r")), "right_id")
    differ = F.array(*(F.when(~F.col(f"l.{f}").eqNullSafe(F.col(f"r.{f}")), F.concat_ws("", F.lit(f"{f}: "), F.coalesce(F.col(f"l.{f}").cast("string"), F.lit("-")), F.lit(" / "), F.coalesce(F.col(f"r.{f}").cast("string"), F.lit("-")))) for f in fields))
    out = told(both.withColumn("d", F.explode(F.filter(differ, lambda d: d.isNotNull()))), "field", F.col("d"))
    out = out.unionByName(told(no(a.join(pairs, "left_id", "left_anti"), "right"), "left only", F.col("name key")))
    out = out.unionByName(told(no(b.join(pairs, "right_id", "left_anti"), "left"), "right only", F.col("name key")))
    numbers = count_mismatches(left, right, nation)
    kind = F.when((F.col("n_left") == 0) | (F.col("n_right") == 0), "nation").otherwise("count")
    detail = F.concat_ws(" / ", F.col("n_left").cast("string"), F.col("n_right").cast("string"))
    numbers = numbers.select(kind.alias("kind"), nation, F.lit(None).cast(a.schema["left_id"].dataType).alias("left_id"), F.lit(None).cast(a.schema["left_id"].dataType).alias("right_id"), detail.alias("detail"))
    return out.unionByName(numbers)


def union_ids(rows: DataFrame, key: Sequence[str], ids: str) -> DataFrame:
    """Each key's ids of all its rows: one sorted array without repeats."""
    return rows.select(*key, F.explode(ids).alias("one id")).groupBy(*key).agg(F.array_sort(F.collect_set("one id")).alias(ids))


def conditional_counts(rows: DataFrame, conditions: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """The number of rows, and of those that meet each named condition."""
    return rows.groupBy(*by).agg(F.count("*").alias("n_rows"), *(F.count_if(F.expr(c)).alias(name) for name, c in conditions.items()))


def distinct_counts(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The number of different values of each column, null aside."""
    return rows.groupBy(*by).agg(*(F.countDistinct(c).alias(f"n_{c}") for c in columns))


def latest_year(rows: DataFrame, key: Sequence[str], year: str) -> DataFrame:
    """The latest year of each key, years as text; blanks don't count."""
    return rows.where(F.col(year).rlike(r"^\d{4}$")).groupBy(*key).agg(F.max(year).alias(year))


def first_in_order(rows: DataFrame, key: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One row a key: the first in order."""
    w = Window.partitionBy(*key).orderBy(*seq)
    return rows.withColumn("place in key", F.row_number().over(w)).where(F.col("place in key") == 1).drop("place in key")
