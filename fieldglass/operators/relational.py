"""Relational operators, generic over their columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.functions.numbers import ratio
from fieldglass.staging import fresh, numbered, running_total, stage


# Flows ---------------------------------------------------------------------------------------------------------------


def flow_counts(rows: DataFrame, origin: str, destination: str, out: str = "n") -> DataFrame:
    """Rows by (origin, destination), without those that stay; a null end drops out."""
    return rows.where(F.col(origin) != F.col(destination)).groupBy(origin, destination).agg(F.count("*").alias(out))


def stay_counts(rows: DataFrame, origin: str, destination: str, out: str = "n") -> DataFrame:
    """Rows by origin of those that stay."""
    return rows.where(F.col(origin) == F.col(destination)).groupBy(origin).agg(F.count("*").alias(out))


def net_flow(flows: DataFrame, origin: str, destination: str, n: str) -> DataFrame:
    """For each place exports, imports and their difference; 0 where there are none."""
    exports = flows.groupBy(F.col(origin).alias("place")).agg(F.sum(n).alias("exports"))
    imports = flows.groupBy(F.col(destination).alias("place")).agg(F.sum(n).alias("imports"))
    out = exports.join(imports, "place", "full_outer").na.fill(0, ["exports", "imports"])
    return out.withColumn("net", F.col("exports") - F.col("imports"))


def nested_counts(flows: DataFrame, by: str, name: str, n: str, out: str = "pairs") -> DataFrame:
    """For each `by` its total and an array of (name, n), the largest first, ties by name."""
    pairs = F.array_sort(F.collect_list(F.struct((-F.col(n)).alias("less"), F.col(name).alias("name"))))
    return flows.groupBy(by).agg(F.sum(n).alias("count"), F.transform(pairs, lambda p: F.struct(p["name"].alias("name"), (-p["less"]).alias("n"))).alias(out))


def per_million(counts: DataFrame, population: DataFrame, key: str, n: str, population_col: str, least: float, limit: int) -> DataFrame:
    """The `limit` keys with the most `n` per million people, of those with any and at least `least`."""
    out = counts.join(population, key).where((F.col(n) > 0) & (F.col(population_col) > 0))
    out = out.withColumn("per_million", F.round(F.col(n) / (F.col(population_col) / 1e6), 4))
    return out.where(F.col("per_million") >= least).orderBy(F.desc("per_million"), key).limit(limit)


# Ordered state -------------------------------------------------------------------------------------------------------


def cumulative(rows: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Sequence[str], ratios: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Running sums through each row of its key, in place, and named ratios of them."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumns({c: F.sum(c).over(w) for c in sums})
    return out.withColumns({name: ratio(F.col(a), F.col(b)) for name, (a, b) in (ratios or {}).items()})


def latest_by(rows: DataFrame, key: str, order: Sequence[str], any_of: Sequence[str] = ()) -> DataFrame:
    """Each key's last row in `order`, of those in which any of `any_of` is there."""
    if any_of:
        rows = rows.where(reduce(Column.__or__, (F.col(c).isNotNull() for c in any_of)))
    packed = F.struct(*order, *(c for c in rows.columns if c not in (*order, key)))
    return rows.groupBy(key).agg(F.max(packed).alias("last row")).select(key, "last row.*").select(*rows.columns)


def top_n(rows: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first `n` rows of each group."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)


def min_rank(rows: DataFrame, value: str, out: str, falling: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """`rows` with `out`, the rank of `value` with ties (1, 1, 3), among all rows or those of `by`; null for a null value, which
    takes no rank.

    Different values are counted first; a prefix sum over the counts, dealt out by ranges of the value, gives each value's
    rank, and rows look theirs up. So neither many rows nor many ties meet in one task. `rows` is read twice. A group that
    is null is a group like others.
    """
    n, before, order, *keys = fresh(rows, "n", "before", "order", *(f"{k} group" for k in by))
    group = [F.struct(F.col(k).isNull().alias("none"), F.col(k).alias("group")).alias(g) for k, g in zip(by, keys, strict=True)]  # no key is null
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias(order)).agg(F.count("*").alias(n))
    if falling:
        counts = counts.withColumn(order, -F.col(order))
    ranks = running_total(stage(counts), keys, [order], {before: n}).select(*keys, (-F.col(order) if falling else F.col(order)).alias(order), (F.col(before) + 1).alias(out))
    same = reduce(Column.__and__, (F.col(f"{g}.group").eqNullSafe(F.col(f"r.{k}")) for k, g in zip(by, keys, strict=True)), F.col(f"r.{value}") == F.col(order))
    return rows.alias("r").join(ranks, same, "left").select("r.*", out)


def competition_rank(rows: DataFrame, n: str) -> DataFrame:
    """Ranks with ties (1, 1, 3) by falling `n`, and its share of the most in percent."""
    rows = stage(rows)
    most = rows.agg(F.max(n)).first()[0]
    return min_rank(rows, n, "rank", falling=True).withColumn("percent_of_most", F.round(100 * F.col(n) / F.lit(most), 2))


def densify(rows: DataFrame, key: str, at: str, value: str, step: str = "interval 1 month") -> DataFrame:
    """A row for each key and step from the key's first to the last of all keys, with the value carried on."""
    last = rows.agg(F.max(at)).first()[0]
    if last is None:
        return rows.select(key, at, value)
    grid = rows.groupBy(key).agg(F.min(at).alias("first")).select(key, F.explode(F.sequence("first", F.lit(last), F.expr(step))).alias(at))
    w = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return grid.join(rows.select(key, at, value), [key, at], "left").withColumn(value, F.last(value, ignorenulls=True).over(w))


# Merging sources -----------------------------------------------------------------------------------------------------


def priority_dedup(rows: DataFrame, keys: Sequence[str], source: str, priority: Mapping[str, int], seq: Sequence[str], unknown: int = 99) -> DataFrame:
    """One row a key: of the source of the lowest number, then the first in `seq`."""
    known = F.create_map(*(F.lit(x) for pair in priority.items() for x in pair))
    first = Window.partitionBy(*keys).orderBy(F.coalesce(known[F.col(source)], F.lit(unknown)), *seq)
    return rows.withColumn("place in key", F.row_number().over(first)).where(F.col("place in key") == 1).drop("place in key")


def pivot_first(rows: DataFrame, keys: Sequence[str], pivot: str, value: str, values: Sequence[str], seq: str) -> DataFrame:
    """A column for each of `values`, there or not, with the first value in order of `seq`."""
    return rows.groupBy(*keys).agg(*(F.min_by(F.when(F.col(pivot) == v, F.col(value)), F.when((F.col(pivot) == v) & F.col(value).isNotNull(), F.col(seq))).alias(v) for v in values))


def coverage(rows: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One row: how many rows have each measure, all, any, or only the first of them."""
    has = [F.col(m).isNotNull() for m in measures]
    every, some = reduce(Column.__and__, has), reduce(Column.__or__, has)
    only = reduce(Column.__and__, (~h for h in has[1:]), has[0])
    return rows.agg(F.count("*").alias("n_rows"), *(F.count_if(h).alias(f"has_{m}") for m, h in zip(measures, has, strict=True)), F.count_if(every).alias("has_all"), F.count_if(some).alias("has_any"), F.count_if(only).alias("only_first"))


def append_missing(rows: DataFrame, more: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`rows`, and those of `more` whose key they don't have; their other columns may be missing."""
    return rows.unionByName(more.join(rows, list(keys), "left_anti"), allowMissingColumns=True)


def missing_from(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of `rows` that `others` lacks: what is still to do, or what isn't covered."""
    return rows.select(*keys).distinct().join(others.select(*keys), list(keys), "left_anti")


def two_way_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of one side only, with the side."""
    only_left = left.select(key).subtract(right.select(key)).withColumn("side", F.lit("left"))
    return only_left.unionByName(right.select(key).subtract(left.select(key)).withColumn("side", F.lit("right")))


def presence_report(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on keys with where each was found: both, left or right."""
    joined = left.withColumn("in left", F.lit(True)).join(right.withColumn("in right", F.lit(True)), list(keys), "full_outer")
    found = F.when(F.col("in right").isNull(), "left").when(F.col("in left").isNull(), "right").otherwise("both")
    return joined.withColumn("found", found).drop("in left", "in right")


def count_mismatches(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys whose number of rows differs, with both numbers."""
    a, b = left.groupBy(key).agg(F.count("*").alias("n_left")), right.groupBy(key).agg(F.count("*").alias("n_right"))
    return a.join(b, key, "full_outer").na.fill(0, ["n_left", "n_right"]).where("n_left <> n_right")


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, value: str, rank: str, keep_ranks: bool = False) -> DataFrame:
    """Keys that were added, removed or changed in value: kind, old and new value, value_delta, rank_delta (up is
    positive). Null values and ranks count as 0."""
    a = old.select(key, F.coalesce(value, F.lit(0)).alias("old_value"), F.coalesce(rank, F.lit(0)).alias("old_rank"), F.lit(True).alias("was"))
    b = new.select(key, F.coalesce(value, F.lit(0)).alias("new_value"), F.coalesce(rank, F.lit(0)).alias("new_rank"), F.lit(True).alias("is"))
    kind = F.when(F.col("was").isNull(), "added").when(F.col("is").isNull(), "removed").when(F.col("old_value") != F.col("new_value"), "changed")
    out = a.join(b, key, "full_outer").withColumn("kind", kind).where("kind is not null")
    ranks = ["old_rank", "new_rank"] if keep_ranks else []
    return out.select(key, "kind", "old_value", "new_value", (F.col("new_value") - F.col("old_value")).alias("value_delta"), (F.col("old_rank") - F.col("new_rank")).alias("rank_delta"), *ranks)


def change_report(diff: DataFrame, names: DataFrame, key: str, name: str) -> DataFrame:
    """What a message on new values tells, from snapshot_diff with old_rank and new_rank: place (from 1), kind, name and line.
    Changes come first, the largest by value, then by rank, ties by key; then what was added and removed, by key."""
    rows = stage(diff.join(names.select(key, F.col(name).alias("name")), key))
    arrow = F.when(F.col("rank_delta") > 0, "↑").when(F.col("rank_delta") < 0, "↓").otherwise("=")
    rank = F.when(F.col("rank_delta") != 0, F.format_string("#%d→#%d (%s%d)", "old_rank", "new_rank", arrow, F.abs("rank_delta"))).otherwise(F.format_string("#%d", "new_rank"))
    width = F.lit(rows.where("kind = 'changed'").agg(F.max(F.length("name"))).first()[0])
    pad = lambda c, n: F.concat(c, F.repeat(F.lit(" "), F.greatest(n - F.length(c), F.lit(0))))
    points = F.concat(F.when(F.col("value_delta") > 0, "+").otherwise(""), F.col("value_delta").cast("string"), F.lit(" pts"))
    line = F.when(F.col("kind") == "changed", F.concat(F.lit("  "), pad(F.col("name"), width), F.lit("  "), pad(rank, F.lit(22)), F.lit("  "), points)).otherwise(F.concat(F.initcap("kind"), F.lit(": "), F.col("name")))
    group = F.when(F.col("kind") == "changed", 0).when(F.col("kind") == "added", 1).otherwise(2)
    order = [group.alias("group"), *(F.coalesce(F.when(group == 0, -F.abs(c)), F.lit(0)).alias(f"less {c}") for c in ("value_delta", "rank_delta"))]
    lines = rows.select(*order, key, "kind", "name", line.alias("line"))
    placed = numbered(lines, ["group", "less value_delta", "less rank_delta", key], "place", 1)
    return placed.select(F.col("place").cast("int").alias("place"), "kind", "name", "line")


def changed(old: DataFrame, new: DataFrame) -> bool:
    """Whether two frames of the same columns differ as sets of rows with repeats."""
    return not (old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty())


# Games ---------------------------------------------------------------------------------------------------------------


def two_sides(games: DataFrame, game: str, home: str, away: str, keep: Sequence[str] = ()) -> DataFrame:
    """Two rows a game: team and opponent, once each way."""
    return games.select(game, *keep, F.explode(F.array(F.struct(F.col(home).alias("team"), F.col(away).alias("opponent")), F.struct(F.col(away).alias("team"), F.col(home).alias("opponent")))).alias("side")).select(game, *keep, "side.*")


def mirrored_totals(games: DataFrame, stats: DataFrame, game: str, home: str, away: str, stage_col: str, committed: str, others: Sequence[str] = ()) -> DataFrame:
    """By team and stage: games, the measure committed, what the opponents committed (`suffered`) and the sums of others.
    `stats` has a row for each game and team; games without both sides' are left out."""
    sides = two_sides(games, game, home, away, [stage_col])
    own = stats.select(game, "team", F.col(committed).alias("own value"), *others)
    other = stats.select(game, F.col("team").alias("opponent"), F.col(committed).alias("other value"))
    both = sides.join(own, [game, "team"]).join(other, [game, "opponent"])
    return both.groupBy("team", stage_col).agg(F.count("*").alias("matches"), F.sum("own value").alias("committed"), F.sum("other value").alias("suffered"), *(F.sum(c).alias(c) for c in others))


# Keys and lookups ----------------------------------------------------------------------------------------------------


def resolve(rows: DataFrame, column: str, names: DataFrame, aliases: DataFrame, out: str = "code", strict: bool = False) -> DataFrame:
    """The code of each free-text name: `names` (name, code) before `aliases` (name, code), without regard to case and
    outer space. With `strict`, an unknown name fails the query."""
    key = lambda c: F.lower(F.trim(c))
    by_name = names.select(key(F.col("name")).alias("name key"), F.col("code").alias("by name")).dropDuplicates(["name key"])
    by_alias = aliases.select(key(F.col("name")).alias("name key"), F.col("code").alias("by alias")).dropDuplicates(["name key"])
    found = rows.withColumn("name key", key(F.col(column))).join(by_name, "name key", "left").join(by_alias, "name key", "left")
    code = F.coalesce("by name", "by alias")
    if strict:
        code = F.coalesce(code, F.when(F.col(column).isNotNull(), F.raise_error(F.concat(F.lit("unknown name: "), F.col(column)))))
    return found.withColumn(out, code).drop("name key", "by name", "by alias")


def lookup(rows: DataFrame, values: DataFrame, keys: Sequence[str], columns: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """`rows` with `columns` from the first of `values`, in order of `seq`, that has all their keys; null where none has."""
    first = values.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(*seq)).alias("found here"))
    return rows.join(first, list(keys), "left").select(*rows.columns, *(F.col(f"found here.{c}").alias(c) for c in columns))


def bridge(rows: DataFrame, start: str, steps: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """`rows` with the ids that lead from `start` through several tables: each step is (table, key, out), looks up what the step
    before gave (the first, `start`) in the table's key, and adds `out`; of several rows of a key the least `out` counts. Where a
    step finds nothing, it and those after it are null; `reached` tells how many steps found something."""
    found, at, done = rows.drop("reached"), start, F.lit(0)
    for table_, key, out in steps:
        name, = fresh(found, "bridge key")
        one = table_.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(name)).agg(F.min(out).alias(f"{name} out"))
        kept = [c for c in found.columns if c != out]
        found = found.join(one, F.col(at) == F.col(name), "left").select(*kept, F.col(f"{name} out").alias(out))
        at, done = out, done + F.col(out).isNotNull().cast("int")
    return found.withColumn("reached", done)


def resolve_places(rows: DataFrame, name: str, city: str, country: str, former: Mapping[str, str], invalid: Sequence[str], corrections: DataFrame, coarse: str, cities: DataFrame, clear: Sequence[str] = ()) -> DataFrame:
    """Cities and countries as they are today, with `unresolved`, which a gate must find nowhere true.

    Countries of old go by `former`, and `invalid` ones become blank. A person in `corrections` (name, city, country) gets
    that city and country, and loses the columns `clear`, which belong to the old ones. Others of the country `coarse` take
    the country that `cities` (city, country) has for their city; without one they are unresolved.
    """
    old = F.create_map(*(F.lit(x) for pair in former.items() for x in pair)) if former else F.create_map().cast("map<string,string>")
    now = F.coalesce(old[F.col(country)], F.col(country))
    fixed = corrections.select(F.col("name").alias(name), F.col("city").alias("right city"), F.col("country").alias("right country"), F.lit(True).alias("is right"))
    parts = cities.select(F.col("city").alias("part city"), F.col("country").alias("part country")).dropDuplicates(["part city"])
    joined = rows.withColumn("now", F.when(now.isin(*invalid), "").otherwise(now)).join(F.broadcast(fixed), name, "left")  # by hand, so small
    joined = joined.join(parts, F.col(city) == F.col("part city"), "left")
    right, is_coarse = F.coalesce("is right", F.lit(False)), F.col("now") == coarse
    out = {city: F.when(right, F.col("right city")).otherwise(F.col(city)), country: F.when(right, F.col("right country")).when(is_coarse & F.col("part country").isNotNull(), F.col("part country")).otherwise(F.col("now"))}
    out |= {c: F.when(~right, F.col(c)) for c in clear}
    return joined.select(*(out.get(c, F.col(c)).alias(c) for c in rows.columns), F.coalesce(~right & is_coarse & F.col("part country").isNull(), F.lit(False)).alias("unresolved"))


def still_coarse(rows: DataFrame, source: str, column: str, coarse: str) -> DataFrame:
    """(kind, detail): one finding for a source in which anything is still placed in the `coarse` country."""
    found = rows.where(F.col(column) == coarse).groupBy().count().where("count > 0")
    return found.select(F.lit("country too coarse").alias("kind"), F.lit(f"{source}: {coarse}").alias("detail"))


def concat(*frames: DataFrame | None) -> DataFrame:
    """All rows of the frames that are there, by column name."""
    return reduce(DataFrame.unionByName, (f for f in frames if f is not None))


def drill_down(rows: DataFrame, column: str, trigger: str, key: str, lookup: Mapping[str, str]) -> DataFrame:
    """Where `column` has the value `trigger`, the finer value that `lookup` has for `key`, or null if none."""
    finer = F.create_map(*(F.lit(x) for pair in lookup.items() for x in pair)) if lookup else F.lit(None).cast("map<string,string>")
    return rows.withColumn(column, F.when(F.col(column) == trigger, finer[F.col(key)]).otherwise(F.col(column)))


def override(rows: DataFrame, values: DataFrame, keys: Sequence[str], column: str, wins: bool) -> DataFrame:
    """Values by key from a hand-kept table: they win, or only fill gaps; `diverges` tells where both are there and differ."""
    joined = rows.join(values.select(*keys, F.col(column).alias("by hand")), list(keys), "left")
    order = ("by hand", column) if wins else (column, "by hand")
    diverges = F.coalesce(F.col("by hand") != F.col(column), F.lit(False))
    return joined.withColumn("diverges", diverges).withColumn(column, F.coalesce(*order)).drop("by hand")


def mutual_unique_match(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, right_id: str) -> DataFrame:
    """Pairs of ids whose key occurs once on either side. Keys with a null match nothing."""
    once = lambda df, i: df.groupBy(*keys).agg(F.count("*").alias("n"), F.first(i).alias(i)).where("n = 1").drop("n")
    return once(left, left_id).join(once(right, right_id), list(keys)).select(left_id, right_id, *keys)


def residual_match(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, right_id: str, matched: DataFrame) -> DataFrame:
    """A second pass over what `matched` leaves: keys that occur once on the right; of several on the left the first id."""
    rest_left, rest_right = left.join(matched, left_id, "left_anti"), right.join(matched, right_id, "left_anti")
    single = rest_right.groupBy(*keys).agg(F.count("*").alias("n"), F.first(right_id).alias(right_id)).where("n = 1").drop("n")
    return rest_left.groupBy(*keys).agg(F.min(left_id).alias(left_id)).join(single, list(keys)).select(left_id, right_id, *keys)


def first_title_wins(rows: DataFrame, keys: Sequence[str], ident: str) -> DataFrame:
    """Rows with `kept`: whether they have the smallest id among those of their key."""
    return rows.withColumn("kept", F.row_number().over(Window.partitionBy(*keys).orderBy(ident)) == 1)


def adopt_from_sibling(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], seq: str) -> DataFrame:
    """Rows where all `columns` are null take those of the first sibling of the same key that has them."""
    full = reduce(Column.__and__, (F.col(c).isNotNull() for c in columns))
    first = rows.where(full).groupBy(*keys).agg(F.min_by(F.struct(*columns), seq).alias("from sibling"))
    empty = reduce(Column.__and__, (F.col(c).isNull() for c in columns))
    joined = rows.join(first, list(keys), "left").withColumn("adopted", empty & F.col("from sibling").isNotNull())
    return joined.withColumns({c: F.when(F.col("adopted"), F.col(f"from sibling.{c}")).otherwise(F.col(c)) for c in columns}).drop("from sibling")


def dimension_ids(rows: DataFrame, keys: Sequence[str], out: str) -> tuple[DataFrame, DataFrame]:
    """A dimension of the different keys (nulls equal) with ids from 1 in their order, and the rows with their id."""
    different = stage(rows.select(*keys).distinct().withColumn("one", F.lit(1).cast("long")))
    dimension = stage(running_total(different, [], list(keys), {out: "one"}).withColumn(out, F.col(out) + 1).drop("one"))
    on = reduce(Column.__and__, (F.col(f"r.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys))
    fact = rows.alias("r").join(dimension.alias("d"), on).select("r.*", f"d.{out}")
    return dimension, fact


def assign_keys(registry: DataFrame, rows: DataFrame, external: Sequence[str], natural: Sequence[str], key: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Stable surrogate keys. `registry` has key, external and natural columns; `rows` the same but for the key.

    A row takes the key of its external id, else of its natural key, else the next one after the largest, in `order`; a key
    that no row takes stays in the registry. Two rows that would take one key, or new rows with the same id, fail the query.
    Returns the rows with their keys, and the new registry.
    """
    by_external = registry.where(reduce(Column.__and__, (F.col(c).isNotNull() for c in external))).select(*external, F.col(key).alias("by external"))
    by_natural = registry.groupBy(*natural).agg(F.min(key).alias("by natural"))
    found = rows.join(by_external, list(external), "left").join(by_natural, list(natural), "left").withColumn(key, F.coalesce("by external", "by natural")).drop("by external", "by natural")
    found = stage(found)
    highest = registry.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    fresh_rows = stage(found.where(F.col(key).isNull()).withColumn("one", F.lit(1).cast("long")))
    numbered = running_total(fresh_rows, [], [*order, *natural], {"before": "one"}).withColumn(key, F.col("before") + highest + 1).drop("before", "one")
    assigned = stage(found.where(F.col(key).isNotNull()).unionByName(numbered))
    twice = assigned.groupBy(key).count().where("count > 1").limit(1).collect()
    again = numbered.groupBy(*natural).count().where("count > 1").limit(1).collect()
    if twice or again:
        raise ValueError(f"rows share a key: {(twice or again)[0]}")
    return assigned, append_missing(assigned.select(*registry.columns), registry, [key])


# Nested outputs ------------------------------------------------------------------------------------------------------


def array_by_key(rows: DataFrame, key: str, value: str) -> DataFrame:
    """One array whose element i is the value of key i, null where there is none. For small tables."""
    top = rows.agg(F.max(key)).first()[0]
    if top is None:
        return rows.sparkSession.sql(f"SELECT array() AS {value}")
    slots = rows.sparkSession.range(top + 1).withColumnRenamed("id", "slot")
    filled = slots.join(rows.select(F.col(key).cast("long").alias("slot"), value), "slot", "left")
    return filled.agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", value))), lambda s: s[value]).alias(value))


def people_in_order(rows: DataFrame, by: str, role: str, caps: str, ident: str, last: str = "coach") -> DataFrame:
    """Rows with their place (from 0) in their group's list: those of the role `last` at the end, then by falling caps, then by id."""
    order = Window.partitionBy(by).orderBy(F.col(role) == last, F.desc_nulls_last(caps), ident)
    return rows.withColumn("place", F.row_number().over(order) - 1)


def ranked_lists(rows: DataFrame, group: str, order: Sequence[str], item: str, out: str = "items") -> DataFrame:
    """For each group its items as one array, in order; for groups of bounded size."""
    return rows.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(item).alias("the item")))), lambda s: s["the item"]).alias(out))


def nested_map(rows: DataFrame, outer: str, inner: str, fields: Sequence[str]) -> DataFrame:
    """For each `outer` a map of `inner` to a struct of fields, in order of `inner`."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(inner).cast("string").alias("k"), F.struct(*fields).alias("v"))))
    return rows.groupBy(outer).agg(F.map_from_entries(entries).alias("entries"))
