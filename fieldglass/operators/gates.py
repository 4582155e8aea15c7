"""Data-quality gates: constraints, anomalies, coverage and structural differences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.staging import stage


class GateFailed(ValueError):
    """Rows that a gate does not let pass."""


@dataclass(frozen=True)
class Rule:
    """What a table must hold: `check` is true or null for a good row."""

    name: str
    check: Column
    detail: str


def violations(table: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(kind, detail) for each row and rule that it breaks; the table is read once."""
    broken = F.filter(F.array(*(F.when(~r.check, F.struct(F.lit(r.name).alias("kind"), F.col(r.detail).cast("string").alias("detail"))) for r in rules)), lambda b: b.isNotNull())
    return table.select(F.inline(broken))


def duplicates(table: DataFrame, keys: Sequence[str], kind: str) -> DataFrame:
    """(kind, detail) for each key without nulls that several rows hold."""
    full = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    detail = F.concat_ws(" / ", *(F.col(k).cast("string") for k in keys))
    return table.where(full).groupBy(*keys).count().where("count > 1").select(F.lit(kind).alias("kind"), detail.alias("detail"))


def orphans(table: DataFrame, keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str], kind: str) -> DataFrame:
    """(kind, detail) for each different key without nulls that the parent lacks."""
    full = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    parents = parent.select(*(F.col(p).alias(k) for p, k in zip(parent_keys, keys, strict=True)))
    detail = F.concat_ws(" / ", *(F.col(k).cast("string") for k in keys))
    return table.where(full).select(*keys).distinct().join(parents, list(keys), "left_anti").select(F.lit(kind).alias("kind"), detail.alias("detail"))


def lacking(table: DataFrame, key: str, other: DataFrame, other_key: str, detail: str, kind: str) -> DataFrame:
    """(kind, detail) for each row without a partner in `other`."""
    partners = other.select(F.col(other_key).alias(key)).where(F.col(key).isNotNull())
    return table.join(partners, key, "left_anti").select(F.lit(kind).alias("kind"), F.col(detail).cast("string").alias("detail"))


def shared_ids(rows: DataFrame, group: str, ident: str, owner: str, kind: str) -> DataFrame:
    """(kind, detail) for each id that several owners of one group hold."""
    found = rows.groupBy(group, ident).agg(F.countDistinct(owner).alias("n")).where("n > 1")
    return found.select(F.lit(kind).alias("kind"), F.concat_ws(" / ", F.col(group).cast("string"), F.col(ident).cast("string")).alias("detail"))


def anomalies(*parts: DataFrame) -> DataFrame:
    """All findings together."""
    return reduce(DataFrame.unionByName, parts)


def require_empty(found: DataFrame, tolerated: Sequence[str] = ()) -> None:
    """Fails with up to ten of the findings, unless all are of a tolerated kind."""
    rows = (found.where(~F.col("kind").isin(*tolerated)) if tolerated else found).limit(10).collect()
    if rows:
        raise GateFailed("; ".join(f"{r['kind']}: {r['detail']}" for r in rows))


def coverage_failures(rows: DataFrame, column: str, resolved: str, stored: str | None = None) -> DataFrame:
    """(value, reason) for each different name that resolves to nothing, or to another code than the one stored."""
    unknown = rows.where(F.col(column).isNotNull() & F.col(resolved).isNull()).select(F.col(column).alias("value"), F.lit("unknown").alias("reason"))
    if stored:
        other = rows.where(F.col(resolved) != F.col(stored)).select(F.col(column).alias("value"), F.lit("other code stored").alias("reason"))
        unknown = unknown.unionByName(other)
    return unknown.distinct()


#: Levels of a document that are taken apart before what is left is written.
LEVELS = 6


def json_leaves(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, path, leaf) of each row's JSON text: its leaves and empty containers, each as JSON with its path. A text that is no JSON
    (or nested a thousand levels deep and more, which the parser refuses) is one leaf, a string; a null text has none.

    Some levels at a time: containers are exploded in place, and what still isn't a leaf goes on in another round.
    """
    spark = rows.sparkSession
    is_open = F.col("leaf").rlike(r"^(\[.|\{.)") & ~F.col("leaf").isin("[]", "{}")
    rest = rows.where(F.col(text).isNotNull()).select(F.col(key).alias("doc"), F.lit("$").alias("path"), F.coalesce(F.try_parse_json(text), F.col(text).cast("variant")).alias("v"))
    found: list[DataFrame] = []
    while True:
        for _ in range(LEVELS):
            rest = rest.lateralJoin(spark.tvf.variant_explode_outer(F.col("v").outer()))
            step = F.when(F.col("pos").isNull(), "").when(F.col("key").isNull(), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat(F.lit("."), F.col("key")))
            rest = rest.select("doc", F.concat("path", step).alias("path"), F.when(F.col("pos").isNull(), F.col("v")).otherwise(F.col("value")).alias("v"))
        done = stage(rest.select("doc", "path", F.to_json("v").alias("leaf")))
        found.append(done.where(~is_open))
        rest = done.where(is_open)
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, found).withColumnRenamed("doc", key)
        rest = rest.select("doc", "path", F.parse_json("leaf").alias("v"))


def json_diff(old: DataFrame, new: DataFrame, key: str, text: str) -> DataFrame:
    """(key, path, old, new) of the leaves in which two sets of JSON texts differ. Only texts whose digests differ are parsed."""
    digest = lambda df, name: df.groupBy(key).agg(F.array_sort(F.collect_list(F.sha2(F.col(text).cast("binary"), 256))).alias(name))
    differ = digest(old, "a").join(digest(new, "b"), key, "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(key)
    differ = stage(differ)
    a = json_leaves(old.join(differ, key, "left_semi"), key, text).withColumnRenamed("leaf", "old")
    b = json_leaves(new.join(differ, key, "left_semi"), key, text).withColumnRenamed("leaf", "new")
    return a.join(b, [key, "path"], "full_outer").where(~F.col("old").eqNullSafe(F.col("new")))


def constraint_report(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Rule]]) -> DataFrame:
    """Violations of all tables' rules, with the table's name before the kind."""
    return anomalies(*(violations(tables[t], r).withColumn("kind", F.concat(F.lit(f"{t}: "), "kind")) for t, r in rules.items()))
