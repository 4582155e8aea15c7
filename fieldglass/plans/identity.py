"""Resolving names, places and keys: over nations, parts, customers, suppliers, pages and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldglass.functions import numbers, text
from fieldglass.operators import gates, names, reports, spatial
from fieldglass.operators import relational as R
from fieldglass.session import table
from fieldglass.sources.readers import html_links, html_rows

ALIASES = (("Nation Three", 3), ("the fifth", 5), ("NATION_7", 99))
STEP, BANDWIDTH = 5.0, 400.0


def resolve_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    known = nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code"))
    aliases = spark.createDataFrame(list(ALIASES), "name string, code int")
    written = F.when(F.col("c_nationkey") == 3, " nation THREE").when(F.col("c_nationkey") == 5, "The Fifth ").when(F.col("c_nationkey") == 9, "Atlantis").otherwise(F.lower(F.concat(F.lit("Nation_"), F.col("c_nationkey").cast("string"))))
    rows = table(spark, sf_dir, "customer").select("c_custkey", written.alias("written"))
    return R.resolve(rows, "written", known, aliases).select("c_custkey", "code")


def coverage_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve_alias(spark, sf_dir).join(table(spark, sf_dir, "customer"), "c_custkey")
    return gates.coverage_failures(found.withColumn("segment", F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string"))), "segment", "code", "c_nationkey")


def _by_hand(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).alias("brand"))
    return part, part.where("p_partkey % 4 = 0").select("p_partkey", F.lit("BY HAND").alias("brand"))


def override_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.override(*_by_hand(spark, sf_dir), ["p_partkey"], "brand", wins=False)


def override_win(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.override(*_by_hand(spark, sf_dir), ["p_partkey"], "brand", wins=True)


def strip_qualifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("p_partkey") % 5, F.col("p_name")
    written = F.when(k == 0, F.concat(F.lit("12th Arrondissement of "), name)).when(k == 1, F.concat(name, F.lit(" City District"))).when(k == 2, F.concat(name, F.lit(" Municipality"))).when(k == 3, F.concat(name, F.lit(" district"))).otherwise(F.concat(name, F.lit(" municipality")))
    return table(spark, sf_dir, "part").select("p_partkey", text.strip_qualifier(written).alias("plain"))


def place_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes stripped and places split at commas."""
    written = F.concat(F.col("p_name"), F.lit("[1] (old), "), F.col("p_type"), F.when(F.col("p_size") % 2 == 0, F.lit(", Country [a b]")).otherwise(""))
    place = text.split_place(written)
    return table(spark, sf_dir, "part").select("p_partkey", place["first"].alias("city"), place["last"].alias("country"))


def url_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.title_of_link(F.col("url"), "/en/").alias("title"))


def number_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.when(F.col("c_custkey") % 9 == 0, "..").when(F.col("c_custkey") % 9 == 1, "n/a").otherwise(F.format_number("c_acctbal", 2))
    wkt = F.concat(F.lit("Point("), F.col("c_nationkey").cast("string"), F.lit(" -"), F.col("c_custkey").cast("string"), F.lit(".5)"))
    point = numbers.point_of_wkt(wkt)
    return table(spark, sf_dir, "customer").select("c_custkey", numbers.parse_number(written).alias("amount"), point["lat"].alias("lat"), point["lon"].alias("lon"))


def json_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.from_json("props", "k long")["k"]
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(F.coalesce(k, F.lit(0))).alias("total"), F.count_if(k.isNull()).alias("n_missing"))


def mutual_unique_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers whose rounded balance no other has, and then, of the rest, those alone by its tens."""
    left = table(spark, sf_dir, "customer").select("c_custkey", F.round("c_acctbal").cast("long").alias("units"), F.round(F.col("c_acctbal") / 10).cast("long").alias("tens"))
    right = table(spark, sf_dir, "supplier").select("s_suppkey", F.round("s_acctbal").cast("long").alias("units"), F.round(F.col("s_acctbal") / 10).cast("long").alias("tens"))
    first = R.mutual_unique_match(left, right, ["units"], "c_custkey", "s_suppkey").select("c_custkey", "s_suppkey")
    second = R.residual_match(left, right, ["tens"], "c_custkey", "s_suppkey", first).select("c_custkey", "s_suppkey")
    return first.withColumn("pass", F.lit(1)).unionByName(second.withColumn("pass", F.lit(2)))


def todo_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return R.missing_from(events.where("event_type <> 'purchase'"), events.where("event_type = 'purchase' AND value > 50"), ["user_id"])


def two_way_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    key = lambda c: F.round(F.col(c) / 100).cast("long").alias("hundreds")
    return R.two_way_difference(customer.select(key("c_acctbal")), supplier.select(key("s_acctbal")), "hundreds")


def presence_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 9900").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n_customers"))
    many = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("n_suppliers"))
    return R.presence_report(rich, many, ["nation"])


def count_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against fifteen times the suppliers, which is how many there should be."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.explode(F.sequence(F.lit(1), F.lit(15))).alias("copy"))
    return R.count_mismatches(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")), suppliers, "nation")


def append_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.count("*").alias("points")).select(F.col("s_nationkey").alias("nation"), "points")
    return R.append_missing(rated, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation")), ["nation"])


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of the customers of even nations, by a key of their own; all customers come again, some without their old
    external id."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ext_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"))
    registry = customer.where("nation % 2 = 0").withColumn("pid", F.col("ext_id") + 10000)
    rows = customer.withColumn("ext_id", F.when(F.col("ext_id") % 10 != 0, F.col("ext_id")))
    return R.assign_keys(registry, rows, ["ext_id"], ["nation", "name"], "pid", ["name"])[0].select("name", "pid")


def dimension_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") > 5, F.col("p_type")).alias("kind"))
    return R.dimension_ids(part, ["p_brand", "kind"], "dim_id")[1].select("p_partkey", "dim_id")


def title_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.first_title_wins(table(spark, sf_dir, "part").select("p_name", "p_partkey"), ["p_name"], "p_partkey")


def sibling_adopt(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.when(F.col("p_partkey") % 3 == 0, F.col("p_size")).alias("size"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_retailprice")).alias("price"))
    return R.adopt_from_sibling(part, ["p_name"], ["size", "price"], "p_partkey")


def drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("nation"), "c_mktsegment")
    return R.drill_down(rows, "nation", "N4", "c_mktsegment", {"BUILDING": "N4-B", "MACHINERY": "N4-M"})


def _points(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    return table(spark, sf_dir, name).select(((F.col(key) * 37) % 120 - 60).cast("double").alias("lat"), ((F.col(key) * 101) % 360 - 179.5).cast("double").alias("lon"), F.lit(1.0).alias("weight"), F.col(key).alias("key"))


def _risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers, customers = _points(spark, sf_dir, "supplier", "s_suppkey"), _points(spark, sf_dir, "customer", "c_custkey")
    return spatial.relative_risk(suppliers, customers, ("lat", "lon", "weight"), step=STEP, bandwidth_km=BANDWIDTH, least_base=1e-6, smoothing=1e-6)


def kde_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _risk(spark, sf_dir).select("i", "j", F.round(F.col("part") * 1e6, 6).alias("part"), F.round(F.col("base") * 1e6, 6).alias("base"), F.round("log2_risk", 6).alias("log2_risk"))


def hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _risk(spark, sf_dir).withColumn("log2_risk", F.round("log2_risk", 9))
    places = _points(spark, sf_dir, "supplier", "s_suppkey").select("key", "lat", "lon")
    return spatial.hotspots(cells, places, step=STEP, bandwidth_km=BANDWIDTH, top=10, order=["key"])


def nearest_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _points(spark, sf_dir, "nation", "n_nationkey").select(F.col("key").alias("nation"), F.col("lat").alias("nlat"), F.col("lon").alias("nlon"))
    out = spatial.nearest(nations, _points(spark, sf_dir, "supplier", "s_suppkey").select("key", "lat", "lon"), "nlat", "nlon", "lat", "lon", ["key"])
    return out.select("nation", F.col("nearest.key").alias("s_suppkey"), F.round("km", 6).alias("km"))


def bbox_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"), "c_custkey")
    lat, lon = (F.col("c_custkey") * 37 % 120 - 60).cast("double"), (F.col("c_custkey") * 101 % 360 - 179.5).cast("double")
    rows = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.row_number().over(order).alias("rank"), (F.col("c_custkey") % 3 < 2).alias("is_region"), lat.alias("lat"), lon.alias("lon"))
    rows = rows.withColumns({"south": F.col("lat") - 20, "north": F.col("lat") + 20, "west": F.col("lon") - 40, "east": F.col("lon") + 40})
    return spatial.prefer_nested(rows, "c_nationkey", "rank", "is_region", ["south", "north", "west", "east"], "lat", "lon").select("c_nationkey", "c_custkey")


def html_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of nations, a heading and table for each region, and their rows again."""
    nation = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    row = F.format_string("<tr><td>%d</td><td><a href='/wiki/%s'>%s</a><sup>1</sup></td></tr>", "n_nationkey", "n_name", "n_name")
    page = nation.groupBy("r_regionkey", "r_name").agg(F.array_join(F.array_sort(F.collect_list(row)), "").alias("rows"))
    page = page.select("r_regionkey", F.format_string("<html><h2>%s</h2><table>%s</table></html>", "r_name", "rows").alias("html"))
    rows = html_rows(page, "r_regionkey", "html")
    return rows.select("section", F.get("cells", F.lit(0)).cast("int").alias("n_nationkey"), F.get("cells", F.lit(1)).alias("name"), F.get("hrefs", F.lit(0)).alias("href"))


def html_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of every page."""
    return html_links(table(spark, sf_dir, "pages"), "page_id", "html")


def name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' names, made of two parts, against the same written otherwise: as they are, with an initial, in capitals, with
    the last part only, and with a last part that sounds the same or nearly so."""
    k = F.col("c_custkey")
    letter = lambda letters, step: F.substring(F.lit(letters), (F.floor(k / step) % len(letters)).cast("int") + 1, 1)
    first = F.element_at(F.array(*map(F.lit, ("Ana María", "Björn", "Chloé", "Derek", "Émile"))), (k % 5 + 1).cast("int"))
    last = F.concat(F.lit("Köhler"), letter("bfklmnpt", 5), letter("aeiou", 40), letter("bfklmnpt", 200))
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.concat(first, F.lit(" "), last).alias("name"), first.alias("first"), last.alias("last"))
    same = F.concat("first", F.lit(" "), F.translate("last", "aiu", "eoa"))
    near = F.concat("first", F.lit(" "), F.substring("last", 1, 6), F.translate(F.substring("last", 7, 1), "bfkmn", "pblnm"), F.substring("last", 8, 2))
    written = F.element_at(F.array("name", F.concat(F.substring("first", 1, 1), F.lit(". "), F.col("last")), F.upper("name"), F.col("last"), same, near), (k % 6 + 1).cast("int"))
    others = people.select("c_nationkey", k.cast("string").alias("id"), written.alias("other"))
    return names.match_names(people, others, "c_nationkey", "name", "id", "other")[0].withColumnRenamed("block", "c_nationkey")


def nested_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names by key as one array with holes, and a map by region."""
    nation = table(spark, sf_dir, "nation").withColumn("n_nationkey", F.col("n_nationkey") * 2)
    array = R.array_by_key(nation, "n_nationkey", "n_name").select(F.lit(-1).alias("region"), F.to_json("n_name").alias("document"))
    maps = R.nested_map(nation, "n_regionkey", "n_nationkey", ["n_name"]).select(F.col("n_regionkey").alias("region"), F.to_json("entries").alias("document"))
    return array.unionByName(maps)


def converge_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of a city of their nation, some of one of its districts, and places claimed for two thirds of them."""
    customer, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    city = F.concat(F.lit("City"), F.col("c_nationkey").cast("string"))
    people = customer.select(k.alias("pid"), F.when(k % 4 == 0, F.concat(city, F.lit(" District"))).otherwise(city).alias("city"), F.col("c_mktsegment").alias("country"))
    claims = customer.where(k % 3 != 0).select(k.alias("pid"), F.when(k % 5 == 0, "Elsewhere").otherwise(F.upper(city)).alias("label"), k.cast("double").alias("lat"), (-k).cast("double").alias("lon"))
    return reports.converge_coordinates(people, claims, "pid", "city", "country", "pid")


def consistency_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers against a copy that lacks some, renames some and changes balances of others."""
    k = F.col("c_custkey")
    left = table(spark, sf_dir, "customer").select(k.alias("pid"), F.col("c_nationkey").alias("nation"), F.when(k % 6 != 0, F.date_add(F.lit("1990-01-01").cast("date"), (k % 500).cast("int")).cast("string")).alias("born"), F.translate(F.concat(F.lit("p"), k.cast("string")), "0123456789", "abcdefghij").alias("name"), F.floor("c_acctbal").alias("balance"))
    right = left.where("pid % 17 <> 0").withColumn("name", F.when(F.col("pid") % 19 == 0, "other").otherwise(F.upper("name"))).withColumn("balance", F.col("balance") + F.when(F.col("pid") % 23 == 0, 1).otherwise(0))
    return reports.consistency_report(left, right, "nation", "pid", "born", "name", ["balance"])


def conditional_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.conditional_counts(table(spark, sf_dir, "customer"), {"rich": "c_acctbal > 5000", "in_debt": "c_acctbal < 0"}, ["c_nationkey"])


def union_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select("s_nationkey", F.array((k % 7).cast("string"), (k % 5).cast("string")).alias("ids"))
    return reports.union_ids(rows, ["s_nationkey"], "ids").select("s_nationkey", text.joined_ids(F.col("ids")).alias("ids"))


QUERIES = {
    f.__name__: f
    for f in (
        resolve_alias, coverage_failures, override_fill, override_win, strip_qualifier, place_parts, url_title, number_parse, json_stat, mutual_unique_join, todo_anti,
        two_way_difference, presence_report, count_mismatches, append_missing, surrogate_keys, dimension_ids, title_conflict, sibling_adopt, drill_down, kde_risk,
        hotspots, nearest_city, bbox_nested, converge_coordinates, consistency_report, conditional_counts, union_ids, html_table_rows, html_anchors, name_match, nested_titles,
    )
}

_RESOLVED = """
    WITH w AS (SELECT *, CASE c_nationkey WHEN 3 THEN ' nation THREE' WHEN 5 THEN 'The Fifth ' WHEN 9 THEN 'Atlantis' ELSE 'nation_' || c_nationkey END AS written FROM customer),
    k AS (SELECT lower(trim(n_name)) AS name, n_nationkey AS code, 1 AS p FROM nation UNION ALL SELECT lower(trim(n)), c, 2 FROM (VALUES ('Nation Three', 3), ('the fifth', 5), ('NATION_7', 99)) v(n, c)),
    f AS (SELECT name, arg_min(code, p) AS code FROM k GROUP BY name),
    r AS (SELECT c_custkey, c_nationkey, c_mktsegment, code FROM w LEFT JOIN f ON lower(trim(written)) = name)"""
_RISK = f"""
    WITH s AS (SELECT (s_suppkey * 37 % 120 - 60)::DOUBLE AS lat, (s_suppkey * 101 % 360 - 179.5)::DOUBLE AS lon, s_suppkey AS key FROM supplier),
    c AS (SELECT (c_custkey * 37 % 120 - 60)::DOUBLE AS lat, (c_custkey * 101 % 360 - 179.5)::DOUBLE AS lon FROM customer),
    cells AS (SELECT a.range::INTEGER AS i, b.range::INTEGER AS j, a.range * {STEP} - {90 - STEP / 2} AS y, b.range * {STEP} - {180 - STEP / 2} AS x FROM range({round(180 / STEP)}) a, range({round(360 / STEP)}) b),
    p AS (SELECT 1 AS kind, lat, lon, count(*) AS w FROM s GROUP BY ALL UNION ALL SELECT 2, lat, lon, count(*) FROM c GROUP BY ALL),
    d AS (SELECT kind, i, j, w, 2 * 6371.0 * asin(sqrt(least(1.0, sin(radians(y - lat) / 2) ** 2 + cos(radians(lat)) * cos(radians(y)) * sin(radians(x - lon) / 2) ** 2))) AS km FROM p, cells),
    k AS (SELECT kind, i, j, sum(w / (2 * pi() * {BANDWIDTH} ** 2) * exp(-km * km / (2 * {BANDWIDTH} ** 2))) AS density FROM d WHERE km <= 4 * {BANDWIDTH} GROUP BY ALL),
    g AS (SELECT (SELECT count(*) FROM s) / (SELECT count(*) FROM c) AS rate),
    r AS (SELECT b.i, b.j, coalesce(a.density, 0) AS part, b.density AS base, log2((coalesce(a.density, 0) / rate + 1e-6) / (b.density + 1e-6)) AS log2_risk
          FROM g, (SELECT * FROM k WHERE kind = 2 AND density >= 1e-6) b LEFT JOIN (SELECT * FROM k WHERE kind = 1) a ON a.i = b.i AND a.j = b.j)"""

#: The likeness of two strings a and b: the longest run that both have, found by trying all places, and in turn what is to its
#: left and right. Needs pairs(e, a, b); gives likeness(e, likeness).
LIKENESS_SQL = """
    spans AS (
        SELECT e, a, b, 0 AS size FROM pairs
        UNION ALL
        SELECT e, unnest([a[:i - 1], a[i + size:]]), unnest([b[:j - 1], b[j + size:]]), unnest([size, 0]) FROM (
            SELECT e, a, b, best // 10000 AS size, 99 - best // 100 % 100 AS i, 99 - best % 100 AS j FROM (
                SELECT e, a, b, list_max(flatten(list_transform(range(1, length(a) + 1), lambda i: list_transform(list_filter(range(1, length(b) + 1), lambda j: a[i] = b[j]), lambda j:
                    list_max(list_filter(range(1, least(length(a) - i, length(b) - j) + 2), lambda n: a[i:i + n - 1] = b[j:j + n - 1])) * 10000 + (99 - i) * 100 + 99 - j)))) AS best
                FROM spans WHERE a <> '' AND b <> '') WHERE best IS NOT NULL)),
    likeness AS (SELECT e, CASE WHEN length(p.a) + length(p.b) = 0 THEN 1 ELSE 2 * sum(size) / (length(p.a) + length(p.b)) END AS likeness FROM spans JOIN pairs p USING (e) GROUP BY e, p.a, p.b)"""

_AGREE = "({0} = {1} OR (least(length({0}), length({1})) = 1 AND {0}[1] = {1}[1]))"
_ENDS = "len(s) > 1 AND " + _AGREE.format("s[1]", "l[1]") + " AND (len(s) < 3 OR len(list_filter(l[2:-2], lambda x: " + _AGREE.format("x", "s[2]") + ")) > 0)"
#: Names are of three parts at most, and all last parts are made of `kohler` and three letters, the second a vowel, so that their
#: sounds are known: KLR and the consonants, K46 and the first letter's class.
_NAME_MATCH = f"""
    WITH RECURSIVE n AS (
        SELECT c_custkey AS k, c_nationkey, ['Ana María', 'Björn', 'Chloé', 'Derek', 'Émile'][c_custkey % 5 + 1] AS first,
               'Köhler' || substr('bfklmnpt', c_custkey // 5 % 8 + 1, 1) || substr('aeiou', c_custkey // 40 % 5 + 1, 1) || substr('bfklmnpt', c_custkey // 200 % 8 + 1, 1) AS last FROM customer),
    r AS (
        SELECT c_nationkey, k::VARCHAR AS id, [first || ' ' || last, first[1] || '. ' || last, upper(first || ' ' || last), last, first || ' ' || translate(last, 'aiu', 'eoa'),
               first || ' ' || last[:6] || translate(last[7], 'bfkmn', 'pblnm') || last[8:]][k % 6 + 1] AS right_name FROM n),
    names AS (SELECT DISTINCT c_nationkey, first || ' ' || last AS left_name FROM n),
    single AS (SELECT * FROM r QUALIFY count(*) OVER (PARTITION BY c_nationkey, right_name) = 1),
    equal AS (SELECT c_nationkey, id, left_name, right_name, 'equal' AS kind FROM single JOIN names USING (c_nationkey) WHERE left_name = right_name),
    x AS (
        SELECT c_nationkey, id, left_name, right_name, replace(strip_accents(lower(left_name)), '.', '') AS a, replace(strip_accents(lower(right_name)), '.', '') AS b,
               strip_accents(lower(left_name)) = strip_accents(lower(right_name)) AS same
        FROM names JOIN single USING (c_nationkey) WHERE id NOT IN (SELECT id FROM equal) AND (c_nationkey, left_name) NOT IN (SELECT (c_nationkey, left_name) FROM equal)),
    y AS (SELECT *, string_split(a, ' ') AS pa, string_split(b, ' ') AS pb FROM x),
    z AS (SELECT *, CASE WHEN len(pa) <= len(pb) THEN pa ELSE pb END AS s, CASE WHEN len(pa) <= len(pb) THEN pb ELSE pa END AS l FROM y),
    m AS (
        SELECT *, CASE WHEN same THEN {{'kind': 'norm', 'rank': 5}}
            WHEN len(s) > 1 AND s = l[-len(s):] THEN {{'kind': 'initials+tail', 'rank': 4}}
            WHEN len(s) > 1 AND len(list_filter(range(1, len(s) + 1), lambda i: NOT {_AGREE.format("s[i]", "l[len(l) - len(s) + i]")})) = 0 THEN {{'kind': 'initials+tail', 'rank': 3}}
            WHEN len(s) > 1 AND len(list_filter(range(1, len(s) + 1), lambda i: NOT {_AGREE.format("s[i]", "l[i]")})) = 0 THEN {{'kind': 'prefix', 'rank': 3}}
            WHEN {_ENDS} AND s[-1] = l[-1] THEN {{'kind': 'middle-optional', 'rank': 3}}
            WHEN {_ENDS} AND s[-1][7] = l[-1][7] AND s[-1][9] = l[-1][9] THEN {{'kind': 'phonetic', 'rank': 2}}
            WHEN len(s) = 1 AND list_contains(l, s[1]) THEN {{'kind': 'mononym', 'rank': 1}}
            WHEN {_ENDS} AND translate(s[-1][7], 'bfpkmntl', '11125534') = translate(l[-1][7], 'bfpkmntl', '11125534') THEN {{'kind': 'soundex', 'rank': 0}} END AS m FROM z),
    edges AS (SELECT *, row_number() OVER () AS e FROM m WHERE m IS NOT NULL),
    pairs AS (SELECT e, a, b FROM edges),{LIKENESS_SQL},
    ordered AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY m.rank DESC, likeness DESC, left_name, id) AS n FROM edges JOIN likeness USING (e)),
    taken AS (
        SELECT DISTINCT c_nationkey, 0::BIGINT AS n, NULL::BIGINT AS e, []::VARCHAR[] AS lefts, []::VARCHAR[] AS rights FROM ordered
        UNION ALL
        SELECT c_nationkey, o.n, CASE WHEN free THEN o.e END, CASE WHEN free THEN list_append(lefts, left_name) ELSE lefts END, CASE WHEN free THEN list_append(rights, id) ELSE rights END
        FROM (SELECT t.*, o.*, NOT list_contains(t.lefts, o.left_name) AND NOT list_contains(t.rights, o.id) AS free FROM (SELECT c_nationkey, n AS before, lefts, rights FROM taken) t
              JOIN (SELECT c_nationkey AS nation, n, e, left_name, id FROM ordered) o ON t.c_nationkey = o.nation AND o.n = t.before + 1) o)
    SELECT * FROM equal UNION ALL SELECT c_nationkey, id, left_name, right_name, m.kind FROM edges WHERE e IN (SELECT e FROM taken)"""

#: Headings and links in the order in which they stand, without comments and what is not shown; a link is under the last heading.
_ANCHORS = r"""
    WITH p AS (SELECT page_id, regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<!--.*?-->', '', 'g'), '(?is)<(script|style|sup)\b[^>]*>.*?</(script|style|sup)\s*>', '', 'g') AS html FROM pages),
    t AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<h[1-6]\b[^>]*>.*?</h[1-6]\s*>|<a\b[^>]*>.*?</a\s*>')) AS part, generate_subscripts(regexp_extract_all(html, '(?is)<h[1-6]\b[^>]*>.*?</h[1-6]\s*>|<a\b[^>]*>.*?</a\s*>'), 1) AS i FROM p),
    w AS (SELECT page_id, i, lower(part[2]) = 'a' AS link, regexp_extract(part, '(?is)^<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>]+))', 1) AS href,
            trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(part, '(?s)<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&'), '[\s ]+', ' ', 'g'), ' ') AS words FROM t),
    s AS (SELECT *, last_value(CASE WHEN NOT link THEN words END IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS section FROM w)
    SELECT page_id, coalesce(section, '') AS section, words AS anchor, href FROM s WHERE link"""

ORACLE_SQL = {
    "html_anchors": _ANCHORS,
    "name_match": _NAME_MATCH,
    "nested_titles": """
        SELECT -1 AS region, '[' || string_agg(coalesce('"' || n_name || '"', 'null'), ',' ORDER BY k.range) || ']' AS document
        FROM range((SELECT 2 * max(n_nationkey) + 1 FROM nation)) k LEFT JOIN nation ON 2 * n_nationkey = k.range
        UNION ALL SELECT n_regionkey, '{' || string_agg('"' || 2 * n_nationkey || '":{"n_name":"' || n_name || '"}', ',' ORDER BY (2 * n_nationkey)::VARCHAR) || '}' FROM nation GROUP BY n_regionkey""",
    "consistency_report": """
        WITH l AS (SELECT c_custkey AS pid, c_nationkey AS nation, CASE WHEN c_custkey % 6 <> 0 THEN c_custkey % 500 END AS born, 'p' || translate(c_custkey::VARCHAR, '0123456789', 'abcdefghij') AS name, floor(c_acctbal)::BIGINT AS balance FROM customer),
        r AS (SELECT pid, nation, born, CASE WHEN pid % 19 = 0 THEN 'other' ELSE name END AS name, balance + CASE WHEN pid % 23 = 0 THEN 1 ELSE 0 END AS balance FROM l WHERE pid % 17 <> 0),
        one AS (SELECT a.pid AS left_id, b.pid AS right_id
                FROM (SELECT nation, born, min(pid) AS pid FROM l WHERE born IS NOT NULL GROUP BY ALL HAVING count(*) = 1) a
                JOIN (SELECT nation, born, min(pid) AS pid FROM r WHERE born IS NOT NULL GROUP BY ALL HAVING count(*) = 1) b USING (nation, born)),
        two AS (SELECT a.pid AS left_id, b.pid AS right_id
                FROM (SELECT nation, name, min(pid) AS pid FROM l WHERE pid NOT IN (SELECT left_id FROM one) GROUP BY ALL) a
                JOIN (SELECT nation, name, min(pid) AS pid FROM r WHERE pid NOT IN (SELECT right_id FROM one) GROUP BY ALL HAVING count(*) = 1) b USING (nation, name)),
        pairs AS (SELECT * FROM one UNION ALL SELECT * FROM two),
        n AS (SELECT nation, coalesce(a.n, 0) AS a, coalesce(b.n, 0) AS b FROM (SELECT nation, count(*) AS n FROM l GROUP BY ALL) a FULL JOIN (SELECT nation, count(*) AS n FROM r GROUP BY ALL) b USING (nation))
        SELECT 'field' AS kind, l.nation, left_id, right_id, 'balance: ' || l.balance || ' / ' || r.balance AS detail FROM pairs JOIN l ON l.pid = left_id JOIN r ON r.pid = right_id WHERE l.balance <> r.balance
        UNION ALL SELECT 'left only', nation, pid, NULL, name FROM l WHERE pid NOT IN (SELECT left_id FROM pairs)
        UNION ALL SELECT 'right only', nation, NULL, pid, name FROM r WHERE pid NOT IN (SELECT right_id FROM pairs)
        UNION ALL SELECT CASE WHEN a = 0 OR b = 0 THEN 'nation' ELSE 'count' END, nation, NULL, NULL, a || ' / ' || b FROM n WHERE a <> b""",
    "converge_coordinates": """
        WITH p AS (SELECT c_custkey AS pid, CASE WHEN c_custkey % 4 = 0 THEN 'City' || c_nationkey || ' District' ELSE 'City' || c_nationkey END AS city, c_mktsegment AS country,
                          'city' || c_nationkey AS plain, c_custkey % 4 = 0 AS qualified, c_custkey % 3 <> 0 AS claims, c_custkey % 3 <> 0 AND c_custkey % 5 <> 0 AS own FROM customer),
        k AS (SELECT plain, country, min(pid) AS first FROM p WHERE own GROUP BY ALL),
        h AS (SELECT *, CASE WHEN own THEN 'claim' WHEN claims AND qualified AND first IS NOT NULL THEN 'sibling' WHEN claims AND NOT qualified THEN 'diverges' END AS how FROM p LEFT JOIN k USING (plain, country))
        SELECT pid, city, country, CASE how WHEN 'claim' THEN pid WHEN 'sibling' THEN first END::DOUBLE AS lat, -CASE how WHEN 'claim' THEN pid WHEN 'sibling' THEN first END::DOUBLE AS lon, how FROM h""",
    "conditional_counts": "SELECT c_nationkey, count(*) AS n_rows, count(*) FILTER (c_acctbal > 5000) AS rich, count(*) FILTER (c_acctbal < 0) AS in_debt FROM customer GROUP BY ALL",
    "union_ids": """
        SELECT s_nationkey, array_to_string(list_sort(list_distinct(flatten(list([(s_suppkey % 7)::VARCHAR, (s_suppkey % 5)::VARCHAR])))), ';') AS ids FROM supplier GROUP BY ALL""",
    "html_table_rows": "SELECT r_name AS section, n_nationkey, n_name AS name, '/wiki/' || n_name AS href FROM nation JOIN region ON n_regionkey = r_regionkey",
    "resolve_alias": _RESOLVED + " SELECT c_custkey, code FROM r",
    "coverage_failures": _RESOLVED + """
        SELECT DISTINCT c_mktsegment || '/' || c_nationkey AS value, 'unknown' AS reason FROM r WHERE code IS NULL
        UNION SELECT DISTINCT c_mktsegment || '/' || c_nationkey, 'other code stored' FROM r WHERE code <> c_nationkey""",
    "override_fill": """
        SELECT p_partkey, coalesce(b, h) AS brand, coalesce(b <> h, false) AS diverges
        FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS b, CASE WHEN p_partkey % 4 = 0 THEN 'BY HAND' END AS h FROM part)""",
    "override_win": """
        SELECT p_partkey, coalesce(h, b) AS brand, coalesce(b <> h, false) AS diverges
        FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS b, CASE WHEN p_partkey % 4 = 0 THEN 'BY HAND' END AS h FROM part)""",
    "strip_qualifier": "SELECT p_partkey, CASE WHEN p_partkey % 5 < 4 THEN p_name END AS plain FROM part",
    "place_parts": "SELECT p_partkey, p_name AS city, CASE WHEN p_size % 2 = 0 THEN 'Country' ELSE p_type END AS country FROM part",
    "url_title": """
        SELECT page_id, CASE WHEN path LIKE '/en/%' THEN replace(url_decode(path[5:]), '_', ' ') END AS title
        FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)""",
    "number_parse": """
        SELECT c_custkey, CASE WHEN c_custkey % 9 > 1 THEN round(c_acctbal, 2) END AS amount, -(c_custkey + 0.5)::DOUBLE AS lat, c_nationkey::DOUBLE AS lon FROM customer""",
    "json_stat": """
        SELECT event_type, sum(coalesce((props->>'k')::BIGINT, 0))::BIGINT AS total, count(*) FILTER (props->>'k' IS NULL) AS n_missing FROM events GROUP BY ALL""",
    "mutual_unique_join": """
        WITH l AS (SELECT c_custkey, round(c_acctbal)::BIGINT AS u, round(c_acctbal / 10)::BIGINT AS t FROM customer),
        r AS (SELECT s_suppkey, round(s_acctbal)::BIGINT AS u, round(s_acctbal / 10)::BIGINT AS t FROM supplier),
        a AS (SELECT c_custkey, s_suppkey FROM (SELECT u, min(c_custkey) AS c_custkey FROM l GROUP BY u HAVING count(*) = 1)
              JOIN (SELECT u, min(s_suppkey) AS s_suppkey FROM r GROUP BY u HAVING count(*) = 1) USING (u)),
        b AS (SELECT c_custkey, s_suppkey FROM (SELECT t, min(c_custkey) AS c_custkey FROM l WHERE c_custkey NOT IN (SELECT c_custkey FROM a) GROUP BY t)
              JOIN (SELECT t, min(s_suppkey) AS s_suppkey FROM r WHERE s_suppkey NOT IN (SELECT s_suppkey FROM a) GROUP BY t HAVING count(*) = 1) USING (t))
        SELECT *, 1 AS pass FROM a UNION ALL SELECT *, 2 FROM b""",
    "todo_anti": """
        SELECT DISTINCT user_id FROM events e WHERE event_type <> 'purchase'
        AND NOT EXISTS (SELECT 1 FROM events p WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.value > 50)""",
    "two_way_difference": """
        WITH a AS (SELECT round(c_acctbal / 100)::BIGINT AS hundreds FROM customer), b AS (SELECT round(s_acctbal / 100)::BIGINT AS hundreds FROM supplier)
        (SELECT hundreds, 'left' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) UNION ALL (SELECT hundreds, 'right' FROM (SELECT * FROM b EXCEPT SELECT * FROM a))""",
    "presence_report": """
        WITH a AS (SELECT c_nationkey AS nation, count(*) AS n_customers FROM customer WHERE c_acctbal > 9900 GROUP BY ALL),
        b AS (SELECT s_nationkey AS nation, count(*) AS n_suppliers FROM supplier WHERE s_acctbal > 5000 GROUP BY ALL)
        SELECT nation, n_customers, n_suppliers, CASE WHEN n_suppliers IS NULL THEN 'left' WHEN n_customers IS NULL THEN 'right' ELSE 'both' END AS found FROM a FULL JOIN b USING (nation)""",
    "count_mismatches": """
        WITH a AS (SELECT c_nationkey AS nation, count(*) AS n FROM customer GROUP BY ALL), b AS (SELECT s_nationkey AS nation, count(*) * 15 AS n FROM supplier GROUP BY ALL)
        SELECT nation, coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right FROM a FULL JOIN b USING (nation) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""",
    "append_missing": """
        SELECT s_nationkey AS nation, count(*) AS points FROM supplier GROUP BY ALL
        UNION ALL SELECT n_nationkey, NULL FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)""",
    "surrogate_keys": """
        WITH n AS (SELECT c_custkey, c_name, c_nationkey, row_number() OVER (ORDER BY c_name, c_nationkey) AS k FROM customer WHERE c_nationkey % 2 <> 0),
        top AS (SELECT max(c_custkey) + 10000 AS m FROM customer WHERE c_nationkey % 2 = 0)
        SELECT c_name AS name, c_custkey + 10000 AS pid FROM customer WHERE c_nationkey % 2 = 0 UNION ALL SELECT c_name, m + k FROM n, top""",
    "dimension_ids": """
        WITH p AS (SELECT p_partkey, p_brand, CASE WHEN p_size > 5 THEN p_type END AS kind FROM part)
        SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand, kind NULLS FIRST) AS dim_id FROM p""",
    "title_conflict": "SELECT p_name, p_partkey, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) = 1 AS kept FROM part",
    "sibling_adopt": """
        WITH p AS (SELECT p_partkey, p_name, CASE WHEN p_partkey % 3 = 0 THEN p_size END AS size, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice END AS price FROM part),
        f AS (SELECT p_name, arg_min(size, p_partkey) AS s, arg_min(price, p_partkey) AS r FROM p WHERE size IS NOT NULL AND price IS NOT NULL GROUP BY p_name)
        SELECT p_partkey, p_name, coalesce(size, CASE WHEN price IS NULL THEN s END) AS size, coalesce(price, CASE WHEN size IS NULL THEN r END) AS price,
               size IS NULL AND price IS NULL AND s IS NOT NULL AS adopted FROM p LEFT JOIN f USING (p_name)""",
    "drill_down": """
        SELECT c_custkey, CASE WHEN c_nationkey <> 4 THEN 'N' || c_nationkey WHEN c_mktsegment = 'BUILDING' THEN 'N4-B' WHEN c_mktsegment = 'MACHINERY' THEN 'N4-M' END AS nation, c_mktsegment FROM customer""",
    "kde_risk": _RISK + " SELECT i, j, round(part * 1e6, 6) AS part, round(base * 1e6, 6) AS base, round(log2_risk, 6) AS log2_risk FROM r",
    "hotspots": _RISK + f"""
        , v AS (SELECT i, j, round(log2_risk, 9) AS log2_risk FROM r),
        peak AS (SELECT a.* FROM v a WHERE a.log2_risk >= (SELECT max(b.log2_risk) FROM v b WHERE abs(a.i - b.i) <= {max(round(2 * BANDWIDTH / 111.32 / STEP), 1)} AND abs(a.j - b.j) <= {max(round(2 * BANDWIDTH / 111.32 / STEP), 1)})),
        near AS (SELECT peak.*, s.key, s.lat, s.lon, row_number() OVER (PARTITION BY peak.i, peak.j ORDER BY asin(sqrt(least(1.0, sin(radians(lat - y) / 2) ** 2 + cos(radians(y)) * cos(radians(lat)) * sin(radians(lon - x) / 2) ** 2))), key) AS n
                 FROM peak JOIN cells USING (i, j), s),
        one AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY log2_risk DESC, i, j) AS k FROM near WHERE n = 1)
        SELECT key, lat, lon, round(log2_risk, 4) AS log2_risk, i, j FROM one WHERE k = 1 ORDER BY one.log2_risk DESC, i, j LIMIT 10""",
    "nearest_city": """
        WITH n AS (SELECT n_nationkey AS nation, n_nationkey * 37 % 120 - 60 AS y, n_nationkey * 101 % 360 - 179.5 AS x FROM nation),
        s AS (SELECT s_suppkey, s_suppkey * 37 % 120 - 60 AS lat, s_suppkey * 101 % 360 - 179.5 AS lon FROM supplier),
        d AS (SELECT nation, s_suppkey, 2 * 6371.0 * asin(sqrt(least(1.0, sin(radians(lat - y) / 2) ** 2 + cos(radians(y)) * cos(radians(lat)) * sin(radians(lon - x) / 2) ** 2))) AS km FROM n, s)
        SELECT nation, s_suppkey, round(km, 6) AS km FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY km, s_suppkey) AS k FROM d) WHERE k = 1""",
    "bbox_nested": """
        WITH c AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rank, c_custkey % 3 < 2 AS is_region,
                          c_custkey * 37 % 120 - 60 AS lat, c_custkey * 101 % 360 - 179.5 AS lon FROM customer),
        t AS (SELECT * FROM c WHERE rank = 1),
        n AS (SELECT c.c_nationkey, arg_min(c.c_custkey, c.rank) AS key FROM c JOIN t ON c.c_nationkey = t.c_nationkey AND t.is_region AND NOT c.is_region
              AND c.lat BETWEEN t.lat - 20 AND t.lat + 20 AND c.lon BETWEEN t.lon - 40 AND t.lon + 40 GROUP BY ALL)
        SELECT t.c_nationkey, coalesce(n.key, t.c_custkey) AS c_custkey FROM t LEFT JOIN n USING (c_nationkey)""",
}
