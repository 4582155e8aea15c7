"""Functions and small operators that other plans don't use, over the tables and over lists of names, links and codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.functions import numbers, text
from fieldglass.operators import bracket, gates, names, reports
from fieldglass.operators import relational as R
from fieldglass.plans.identity import LIKENESS_SQL
from fieldglass.plans.tournament import FIXTURES_SQL, fixtures
from fieldglass.session import table


def _variants(spark: SparkSession, sf_dir: str, values: list[tuple], schema: str) -> DataFrame:
    """Customers, each with one of a list of values in turn."""
    listed = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], f"variant int, {schema}")
    return table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % len(values)).cast("int").alias("variant")).join(F.broadcast(listed), "variant")


NAMES = [("José-María  Núñez",), ("O'Neill J.R.",), ("Straße Işık",), ("ÅNGSTRÖM Émile",), (" A.B-C ",)]


def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as they are compared: without accents, as tokens, and with letters only."""
    rows, c = _variants(spark, sf_dir, NAMES, "name string"), F.col("name")
    return rows.select("c_custkey", text.fold_accents(c).alias("folded"), text.normal_name(c).alias("normal"), F.size(text.name_tokens(c)).alias("n_tokens"), text.latin_letters(c).alias("letters"))


PEOPLE = [
    ("Anis Ben Slimane", "DE SILVA Ana Maria", "France (FRA)", "1 GK"), ("Ben Foster", "MBAPPE Kylian", "Korea Republic (KOR) ", "10 FW"), ("Pelé", "VAN DIJK Virgil", "Spain", "DF"),
    ("Virgil van Dijk", "SON Heung Min", "Group (A)", "2  MF"), ("Moayad Abu Bani Ata", "O'NEIL Sam", "(FRA)", " 3 GK "),
]


def person_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _variants(spark, sf_dir, PEOPLE, "name string, listed string, nation string, position string")
    return rows.select("c_custkey", text.surname(F.col("name")).alias("surname"), text.given_and_surname(F.col("listed")).alias("spoken"), text.strip_code(F.col("nation")).alias("nation"), text.last_token(F.col("position")).alias("position"))


TITLES = [("C++",), ("100% Wolf",), ("A b (c)/é",), ('"Q"; x?#[1]',), ("a~b-c.d_e",), ("São Paulo, SP!*'",)]


def title_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles as addresses and back; a percent sign that encodes nothing stays."""
    rows, c = _variants(spark, sf_dir, TITLES, "title string"), F.col("title")
    link, raw = text.link_of_title(c), F.concat(F.lit("/wiki/"), F.replace(F.replace(F.replace(c, F.lit(" "), F.lit("_")), F.lit("?")), F.lit("#")))
    back = lambda x: text.title_of_link(F.concat(F.lit("//en.example.org/wiki/"), x, F.lit("?a=1#b")))
    return rows.select("c_custkey", link.alias("link"), back(link).alias("title"), text.title_of_link(raw).alias("from_raw"), text.page_address(F.lit("fr"), c).alias("address"))


SOUNDS = [
    ("Robert", "R163", "RBRT"), ("Rupert", "R163", "RPRT"), ("Honeyman", "H555", "HNMN"), ("Fisher", "F260", "FXR"), ("Philip", "P410", "FLP"), ("Xavier", "X160", "SFR"),
    ("Martin", "M635", "MRTN"), ("Duncan", "D525", "TNKN"), ("Miller", "M460", "MLR"), ("Nation", "N350", "NXN"), ("Church", "C620", "XRX"),
]


def sound_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _variants(spark, sf_dir, [s[:1] for s in SOUNDS], "name string")
    return rows.select("c_custkey", F.soundex("name").alias("soundex"), text.metaphone(F.col("name")).alias("metaphone"))


ALIKE = [("abcd", "bcde", 0.75), ("", "", 1.0), ("kitten", "sitting", 8 / 13), ("same", "same", 1.0), ("ab", "cd", 0.0), ("john paul jones", "paul jones", 0.8)]


def likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _variants(spark, sf_dir, [a[:2] for a in ALIKE], "a string, b string")
    return rows.select("c_custkey", text.similarity(F.col("a"), F.col("b")).alias("ratio"))


PAIRS = [
    ("José Díaz", "jose diaz", "norm"), ("J Smith", "John Smith", "initials+tail"), ("John Paul Jones", "Paul Jones", "initials+tail"), ("John Paul", "John Paul Jones", "prefix"),
    ("Ana Luz Diaz", "Ana Maria Luz Diaz", "middle-optional"), ("John Smith", "Smith", "initials+tail"), ("Ann Robert", "Ann Rupert", "soundex"), ("X Y", "A B", None), ("Same", "Same", "equal"),
    ("Pedro Pele Silva", "Pele", "mononym"), ("Jon Philips", "Jon Filips", "phonetic"),
]
PAIRS[5] = ("Smith John", "Smith", "mononym")


def match_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How one pair of names a nation matches, if it does."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("block"), (F.col("n_nationkey") % len(PAIRS)).cast("int").alias("variant"))
    listed = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(PAIRS)], "variant int, a string, b string")
    rows = nation.join(listed, "variant")
    found = names.match_names(rows.select("block", F.col("a").alias("name")), rows.select("block", F.col("block").cast("string").alias("id"), F.col("b").alias("other")), "block", "name", "id", "other")[0]
    return found.select("block", "kind")


def match_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winners from what both sides tell, and the group of a match if both sides share it."""
    price = F.floor("o_totalprice").cast("long")
    group = lambda k: F.when(price % k == 0, None).otherwise(F.chr(65 + price % 4))
    return table(spark, sf_dir, "orders").select("o_orderkey", bracket.winner(price % 3 == 0, price % 3 == 1).alias("winner"), bracket.group_letter(group(5), F.when(price % 2 == 0, group(7)).otherwise("B")).alias("group_name"))


CODES = [("FRA", "2018 to 2020", "1,5", None, "3", ".."), ("GB-ENG", "2001-2004", "..", "", "x", "2.5"), ("ES51", "2000", None, "7", "8", "9"), ("BE1", None, "0.5", "..", "", "4"), ("BE3", "in 1999/2000", "", None, None, None)]


def code_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of countries and parts of them, middle years of periods, month numbers, and the latest value that is known."""
    rows = _variants(spark, sf_dir, CODES, "code string, period string, a string, b string, c string, d string")
    latest = numbers.latest_value([F.col(x) for x in "abcd"])
    return rows.select("c_custkey", numbers.is_sovereign(F.col("code")).alias("sovereign"), numbers.period_midpoint(F.col("period")).alias("year"), numbers.month_index(F.lit(2024), (F.col("c_custkey") % 12 + 1).cast("int")).alias("month_no"), latest.alias("latest"))


def population_millions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Populations in millions; nations without one are left out."""
    people = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.sum(F.when(F.col("c_nationkey") % 6 != 0, F.floor(F.col("c_acctbal") * 1000).cast("long"))).alias("population"))
    return people.where("population is not null").select("c_nationkey", numbers.millions(F.col("population")).alias("millions"))


def blank_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blanks and zeros as nulls; rows left blank are dropped."""
    name = F.when(F.col("p_partkey") % 4 == 0, "").otherwise(F.col("p_brand"))
    rows = table(spark, sf_dir, "part").select("p_partkey", numbers.none_if_blank(name).alias("brand"), numbers.none_if_zero(F.col("p_size") % 3).alias("size"))
    return rows.where("brand is not null")


def event_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures by name out of lists of figures; 0 where one is missing or null."""
    k = F.from_json("props", "k int")["k"].cast("string")
    stats = F.array(F.struct(F.lit("Fouls").alias("type"), k.alias("value")), F.when(F.col("event_id") % 3 == 0, F.struct(F.lit("Cards").alias("type"), F.lit("2").alias("value"))).otherwise(F.struct(F.lit("Other").alias("type"), F.lit(None).cast("string").alias("value"))))
    return table(spark, sf_dir, "events").select("event_id", numbers.statistic(stats, "Fouls").alias("fouls"), numbers.statistic(stats, "Cards").alias("cards"), numbers.statistic(stats, "Other").alias("other"))


def structural_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves in which two sets of documents differ."""
    k = F.col("event_id").cast("string")
    rows = table(spark, sf_dir, "events")
    old = rows.select("event_id", F.concat(F.lit('{"id": '), k, F.lit(', "list": [1, {"a": "x"}], "same": {}}')).alias("document"))
    new = rows.select("event_id", F.concat(F.lit('{"same": {}, "id": '), k, F.when(F.col("event_id") % 3 == 0, ', "list": [1, {"a": "é"}, 2]}').otherwise(', "list": [1, {"a": "x"}]}')).alias("document"))
    return gates.json_diff(old, new, "event_id", "document")


def first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.first_in_order(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return reports.distinct_counts(rows, ["event_type"], ["user_id", "day"])


def latest_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.when(F.col("o_orderkey") % 5 == 0, "").when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.date_format("o_orderdate", "yyyy"))
    return reports.latest_year(table(spark, sf_dir, "orders").select("o_custkey", year.alias("year")), ["o_custkey"], "year")


def player_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places in nations' lists: coaches at the end, others by falling caps."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select("c_nationkey", k, F.when(k % 20 == 0, "coach").otherwise("player").alias("role"), F.when(k % 9 != 0, F.floor(F.col("c_acctbal") / 500).cast("int")).alias("caps"))
    return R.people_in_order(rows, "c_nationkey", "role", "caps", "c_custkey").select("c_nationkey", "c_custkey", "place")


def standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each region's nations in the order of their rank, ties by name."""
    customers = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    rows = table(spark, sf_dir, "nation").join(customers, "n_nationkey", "left").select("n_regionkey", "n_name", F.coalesce(-F.col("n"), F.lit(0)).alias("less"))
    return R.ranked_lists(rows, "n_regionkey", ["less", "n_name"], "n_name").select("n_regionkey", F.array_join("items", ",").alias("teams"))


def title_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Something kept by two keys, of which the first written counts."""
    kept = table(spark, sf_dir, "part").select("p_brand", "p_size", F.col("p_name").alias("title"), F.col("p_partkey").alias("seq")).where("seq % 2 = 0")
    return R.lookup(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size"), kept, ["p_brand", "p_size"], ["title"], ["seq"])


def change_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a message on new totals of suppliers' nations tells, line by line; later ones count lines shipped from mid-1997 on."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_shipdate") >= "1997-07-01", F.col("l_quantity").cast("long").alias("q")).toDF("s_suppkey", "late", "q")
    rows = lines.join(table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")), "s_suppkey")

    def snapshot(late: bool) -> DataFrame:
        sums = rows.where(F.col("late") if late else ~F.col("late")).groupBy("n_nationkey").agg((F.sum("q") / 10).cast("long").alias("points"))
        return R.min_rank(sums, "points", "place", falling=True).where("place <= 12" if late else "place <= 14")

    diff = R.snapshot_diff(snapshot(False), snapshot(True), "n_nationkey", "points", "place", keep_ranks=True)
    return R.change_report(diff, table(spark, sf_dir, "nation"), "n_nationkey", "n_name")


def joined_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as one list of parties; a source that gave nothing is left out."""
    customers = table(spark, sf_dir, "customer").select(F.lit("customer").alias("role"), F.col("c_custkey").alias("ident"), F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("role"), F.col("s_suppkey").alias("ident"))
    return R.concat(customers, None, suppliers)


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    country = F.when(k % 5 == 0, "Old Land").when(k % 5 == 1, "]").when(k % 5 < 4, "United Parts").otherwise(F.concat(F.lit("Land "), F.col("c_nationkey").cast("string")))
    return table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.concat(F.lit("City "), (k % 8).cast("string")).alias("city"), country.alias("country"), k.cast("double").alias("lat"))


def birth_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities and countries as they are today: countries of old, ones that can't be, corrections by hand, and parts of a country
    by city."""
    by_hand = spark.createDataFrame([("Customer#000000007", "Right", "North Part"), ("Customer#000000010", "Right", "Land X")], "name string, city string, country string")
    cities = spark.createDataFrame([(f"City {i}", "North Part" if i % 2 else "South Part") for i in range(6)], "city string, country string")
    return R.resolve_places(_people(spark, sf_dir), "name", "city", "country", {"Old Land": "New Land"}, ["]"], by_hand, "United Parts", cities, ["lat"])


def coarse_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a gate finds where a country is left that should have been told apart, in a source that has it and one that hasn't."""
    people = _people(spark, sf_dir)
    return gates.anomalies(R.still_coarse(people, "customers", "country", "United Parts"), R.still_coarse(people.where("country <> 'United Parts'"), "others", "country", "United Parts"))


def bracket_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches that a bracket can't place: of unknown rounds, or without a name for the loser."""
    odd = fixtures(spark, sf_dir).withColumn("round", F.when(F.col("id") % 17 == 0, "Play-off").otherwise(F.col("round"))).withColumn("away", F.when(F.col("id") % 101 != 0, F.col("away")))
    teams = spark.range(60).select(F.concat(F.lit("N"), F.col("id").cast("string")).alias("team"))
    return bracket.eliminations(odd, teams)[1]


def role_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a role and an id that no person has."""
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pid"), F.when(F.col("c_custkey") % 10 == 0, "coach").otherwise("player").alias("role"))
    claims = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("pid"), F.when(F.col("o_orderkey") % 40 == 0, "coach").otherwise("player").alias("role"))
    return gates.orphans(claims, ["role", "pid"], people, ["role", "pid"], "role unknown")


def part_likeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How like each part's name is to that of the next part."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("a"))
    after = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("a").alias("b"))
    return part.join(after, "p_partkey").select("p_partkey", F.round(text.similarity(F.col("a"), F.col("b")), 12).alias("ratio"))


def part_sounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phonetic code of each word of the parts' names."""
    words = table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("place", "word"))
    return words.select("p_partkey", "place", F.soundex("word").alias("soundex"))


def text_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as names are compared: without accents, with letters only, and as parts."""
    rows, c = table(spark, sf_dir, "documents"), F.coalesce("text", F.lit(""))
    digest = lambda x: F.md5(x.cast("binary"))
    return rows.select("doc_id", digest(text.fold_accents(c)).alias("folded"), digest(text.latin_letters(c)).alias("letters"), digest(text.normal_name(c)).alias("normal"), F.size(text.name_tokens(c)).alias("n_tokens"))


def address_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages' addresses as titles: their links, and the titles out of these."""
    rows, c = table(spark, sf_dir, "pages"), F.col("url")
    link = text.link_of_title(c)
    back = text.title_of_link(F.concat(F.lit("https://en.example.org/wiki/"), link, F.lit("?a=1#b")))
    return rows.select("page_id", link.alias("link"), back.alias("title"), text.page_address(F.lit("fr"), c).alias("address"))


def people_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One list of people out of documents of regions: of those born there who play for others, and of its own."""
    k = F.col("c_custkey")
    person = F.struct(k.alias("ident"), F.col("c_name").alias("name"), (k % 100).alias("caps"))
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    listed = lambda own: F.array_sort(F.collect_list(F.when((k % 3 == 0) == own, person)))
    documents = rows.groupBy(F.col("n_name").alias("nation")).agg(listed(F.lit(False)).alias("players"), listed(F.lit(True)).alias("natives"))
    return reports.flatten_people(documents, "nation", ["players", "natives"]).withColumnRenamed("group", "list")


def id_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' regions and their regions' suppliers, through ids of three tables; some names lead nowhere."""
    nation, region, supplier = (table(spark, sf_dir, t) for t in ("nation", "region", "supplier"))
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k, F.when(k % 9 != 0, F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))).otherwise("Nowhere").alias("written"))
    counts = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey").agg(F.count("*").alias("suppliers"))
    steps = [(nation.select("n_name", "n_regionkey"), "n_name", "n_regionkey"), (region.where("r_regionkey <> 2").select("r_regionkey", "r_name"), "r_regionkey", "r_name")]
    found = R.bridge(rows, "written", steps)
    return R.bridge(found, "n_regionkey", [(counts, "n_regionkey", "suppliers")]).select("c_custkey", "n_regionkey", "r_name", "suppliers", "reached")


QUERIES = {
    f.__name__: f
    for f in (
        name_forms, person_forms, title_links, sound_keys, likeness, part_likeness, part_sounds, text_forms, address_links, people_list, id_bridge, match_kinds, match_results, code_forms, population_millions, blank_values, event_statistics, structural_diff,
        first_events, distinct_counts, latest_years, player_order, standings, title_lookup, change_message, joined_sources, birth_places, coarse_places, bracket_issues, role_orphans,
    )
}


def _sql(value) -> str:
    return "NULL" if value is None else repr(value) if isinstance(value, int | float) else "'" + str(value).replace("'", "''") + "'"


def _variants_sql(columns: str, rows: list[tuple]) -> str:
    """Customers with what is expected of each variant."""
    listed = ", ".join(f"({i}, {', '.join(map(_sql, r))})" for i, r in enumerate(rows))
    return f"SELECT c_custkey, {columns} FROM customer JOIN (VALUES {listed}) v(i, {columns}) ON c_custkey % {len(rows)} = i"


ORACLE_SQL = {
    "name_forms": _variants_sql("folded, normal, n_tokens, letters", [
        ("jose-maria  nunez", "jose maria nunez", 3, "josemaria  nunez"), ("o'neill j.r.", "o'neill j r", 3, "oneill jr"), ("straße isık", "strasse isik", 2, "strae isk"),
        ("angstrom emile", "angstrom emile", 2, "angstrom emile"), ("a.b-c", "a b c", 3, "abc"),
    ]),
    "person_forms": _variants_sql("surname, spoken, nation, position", [
        ("Ben Slimane", "Ana De Silva", "France", "GK"), ("Foster", "Kylian Mbappe", "Korea Republic", "FW"), ("Pelé", "Virgil Van Dijk", "Spain", "DF"),
        ("van Dijk", "Heung Son", "Group (A)", "MF"), ("Abu Bani Ata", "Sam O'Neil", "", "GK"),
    ]),
    "title_links": _variants_sql("link, title, from_raw, address", [
        ("C++", "C++", "C++", "https://fr.wikipedia.org/wiki/C++"), ("100%25_Wolf", "100% Wolf", "100% Wolf", "https://fr.wikipedia.org/wiki/100%25_Wolf"),
        ("A_b_(c)/%C3%A9", "A b (c)/é", "A b (c)/é", "https://fr.wikipedia.org/wiki/A_b_(c)/%C3%A9"), ("%22Q%22;_x%3F%23%5B1%5D", '"Q"; x?#[1]', '"Q"; x[1]', "https://fr.wikipedia.org/wiki/%22Q%22;_x%3F%23%5B1%5D"),
        ("a~b-c.d_e", "a~b-c.d e", "a~b-c.d e", "https://fr.wikipedia.org/wiki/a~b-c.d_e"), ("S%C3%A3o_Paulo,_SP!*'", "São Paulo, SP!*'", "São Paulo, SP!*'", "https://fr.wikipedia.org/wiki/S%C3%A3o_Paulo,_SP!*'"),
    ]),
    "sound_keys": _variants_sql("soundex, metaphone", [s[1:] for s in SOUNDS]),
    "likeness": "SELECT c_custkey, ratio::DOUBLE AS ratio FROM (" + _variants_sql("ratio", [(a[2],) for a in ALIKE]) + ")",
    "match_kinds": "SELECT n_nationkey AS block, kind FROM nation JOIN (VALUES " + ", ".join(f"({i}, {_sql(k)})" for i, (_, _, k) in enumerate(PAIRS) if k) + f") v(i, kind) ON n_nationkey % {len(PAIRS)} = i",
    "match_results": """
        WITH o AS (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS p FROM orders),
        g AS (SELECT *, CASE WHEN p % 5 <> 0 THEN chr((65 + p % 4)::INTEGER) END AS h, CASE WHEN p % 2 = 1 THEN 'B' WHEN p % 7 <> 0 THEN chr((65 + p % 4)::INTEGER) END AS a FROM o)
        SELECT o_orderkey, CASE p % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'away' END AS winner, CASE WHEN h = a THEN h END AS group_name FROM g""",
    "code_forms": "SELECT c_custkey, sovereign, year::INTEGER AS year, (2024 * 12 + c_custkey % 12)::INTEGER AS month_no, latest::DOUBLE AS latest FROM ("
    + _variants_sql("sovereign, year, latest", [(True, 2019, None), (False, 2002, None), (False, None, 7), (False, None, 0.5), (True, 1999, None)]) + ")",
    "population_millions": "SELECT c_nationkey, round(sum(floor(c_acctbal * 1000)::BIGINT) / 1e6, 2)::DOUBLE AS millions FROM customer WHERE c_nationkey % 6 <> 0 GROUP BY ALL",
    "blank_values": "SELECT p_partkey, p_brand AS brand, nullif(p_size % 3, 0) AS size FROM part WHERE p_partkey % 4 <> 0",
    "event_statistics": "SELECT event_id, coalesce((props->>'k')::INTEGER, 0) AS fouls, CASE WHEN event_id % 3 = 0 THEN 2 ELSE 0 END AS cards, 0 AS other FROM events",
    "part_likeness": f"""
        WITH RECURSIVE n AS (SELECT a.p_partkey, a.p_name AS a, b.p_name AS b FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1),
        pairs AS (SELECT row_number() OVER () AS e, a, b FROM (SELECT DISTINCT a, b FROM n)),{LIKENESS_SQL}
        SELECT p_partkey, round(likeness, 12) AS ratio FROM n JOIN pairs USING (a, b) JOIN likeness USING (e)""",
    "part_sounds": """
        WITH w AS (SELECT p_partkey, unnest(range(len(string_split(p_name, ' '))))::INTEGER AS place, upper(unnest(string_split(p_name, ' '))) AS w FROM part),
        c AS (SELECT *, string_split(w[1] || translate(w[2:], 'HW', ''), '') AS letters FROM w),
        d AS (SELECT *, list_transform(letters, lambda x: translate(x, 'BFPVCGJKQSXZDTLMNRAEIOUYHW', '11112222222233455600000000')) AS codes FROM c)
        SELECT p_partkey, place, rpad(w[1] || array_to_string(list_filter(codes, lambda x, i: i > 1 AND x <> '0' AND x <> codes[i - 1]), ''), 20, '0')[:4] AS soundex FROM d""",
    "text_forms": r"""
        WITH t AS (SELECT doc_id, strip_accents(lower(coalesce(text, ''))) AS raw FROM documents),
        f AS (SELECT doc_id, trim(raw, ' ') AS folded FROM t),
        n AS (SELECT *, trim(regexp_replace(replace(regexp_replace(replace(replace(folded, 'ß', 'ss'), '-', ' '), '\.(\S)', ' \1', 'g'), '.', ''), '\s+', ' ', 'g'), ' ') AS normal FROM f)
        SELECT doc_id, md5(folded) AS folded, md5(trim(regexp_replace(folded, '[^a-z ]', '', 'g'), ' ')) AS letters, md5(normal) AS normal, len(list_filter(string_split(normal, ' '), lambda x: x <> ''))::INTEGER AS n_tokens FROM n""",
    "address_links": """
        SELECT page_id, replace(replace(url, '?', '%3F'), '#', '%23') AS link, replace(url, '_', ' ') AS title, 'https://fr.wikipedia.org/wiki/' || replace(replace(url, '?', '%3F'), '#', '%23') AS address FROM pages""",
    "people_list": """
        SELECT n_name AS country, CASE WHEN c_custkey % 3 = 0 THEN 'natives' ELSE 'players' END AS list, (row_number() OVER (PARTITION BY n_name, c_custkey % 3 = 0 ORDER BY c_custkey) - 1)::INTEGER AS place,
               c_custkey AS ident, c_name AS name, c_custkey % 100 AS caps FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "id_bridge": """
        WITH s AS (SELECT n_regionkey, count(*) AS suppliers FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)
        SELECT c_custkey, n.n_regionkey, r_name, suppliers, CASE WHEN suppliers IS NULL THEN 0 ELSE 1 END AS reached
        FROM customer LEFT JOIN nation n ON c_custkey % 9 <> 0 AND c_nationkey = n_nationkey LEFT JOIN region ON r_regionkey = n.n_regionkey AND r_regionkey <> 2 LEFT JOIN s ON s.n_regionkey = n.n_regionkey""",
    "structural_diff": """
        SELECT event_id, path, old, new FROM events, (VALUES ('$.list[1].a', '"x"', '"é"'), ('$.list[2]', NULL, '2')) v(path, old, new) WHERE event_id % 3 = 0""",
    "first_events": "SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL",
    "distinct_counts": "SELECT event_type, count(DISTINCT user_id) AS n_user_id, count(DISTINCT ts::DATE) AS n_day FROM events GROUP BY ALL",
    "latest_years": "SELECT o_custkey, max(year(o_orderdate))::VARCHAR AS year FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 GROUP BY ALL",
    "player_order": """
        SELECT c_nationkey, c_custkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey % 20 = 0, CASE WHEN c_custkey % 9 <> 0 THEN floor(c_acctbal / 500) END DESC NULLS LAST, c_custkey) - 1)::INTEGER AS place FROM customer""",
    "standings": """
        SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n DESC, n_name) AS teams
        FROM (SELECT n_regionkey, n_name, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL) GROUP BY ALL""",
    "title_lookup": """
        SELECT p_partkey, p_brand, p_size, title FROM part LEFT JOIN (SELECT p_brand, p_size, arg_min(p_name, p_partkey) AS title FROM part WHERE p_partkey % 2 = 0 GROUP BY ALL) USING (p_brand, p_size)""",
    "change_message": """
        WITH s AS (SELECT s_nationkey AS k, l_shipdate >= TIMESTAMP '1997-07-01' AS late, floor(sum(l_quantity::BIGINT) / 10)::BIGINT AS p FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
        r AS (SELECT *, rank() OVER (PARTITION BY late ORDER BY p DESC) AS r FROM s),
        a AS (SELECT * FROM r WHERE NOT late AND r <= 14), b AS (SELECT * FROM r WHERE late AND r <= 12),
        d AS (SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS kind, b.p - a.p AS dp, a.r AS r0, b.r AS r1, a.r - b.r AS dr
              FROM a FULL JOIN b ON a.k = b.k WHERE a.p IS DISTINCT FROM b.p),
        n AS (SELECT d.*, n_name AS name, max(CASE WHEN kind = 'changed' THEN length(n_name) END) OVER () AS w FROM d JOIN nation ON k = n_nationkey),
        t AS (SELECT *, CASE WHEN dr <> 0 THEN '#' || r0 || '→#' || r1 || ' (' || CASE WHEN dr > 0 THEN '↑' ELSE '↓' END || abs(dr) || ')' ELSE '#' || r1 END AS rank FROM n)
        SELECT row_number() OVER (ORDER BY CASE kind WHEN 'changed' THEN 0 WHEN 'added' THEN 1 ELSE 2 END, CASE WHEN kind = 'changed' THEN -abs(dp) END, CASE WHEN kind = 'changed' THEN -abs(dr) END, k)::INTEGER AS place, kind, name,
               CASE kind WHEN 'changed' THEN '  ' || rpad(name, w::INTEGER, ' ') || '  ' || rpad(rank, greatest(22, length(rank))::INTEGER, ' ') || '  ' || CASE WHEN dp > 0 THEN '+' ELSE '' END || dp || ' pts'
                         WHEN 'added' THEN 'Added: ' || name ELSE 'Removed: ' || name END AS line FROM t""",
    "joined_sources": "SELECT 'customer' AS role, c_custkey AS ident, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier",
    "birth_places": """
        WITH p AS (SELECT c_name AS name, c_custkey AS k, 'City ' || (c_custkey % 8) AS city, CASE WHEN c_custkey % 5 = 0 THEN 'New Land' WHEN c_custkey % 5 = 1 THEN '' WHEN c_custkey % 5 < 4 THEN 'United Parts' ELSE 'Land ' || c_nationkey END AS country FROM customer)
        SELECT name, CASE WHEN k IN (7, 10) THEN 'Right' ELSE city END AS city,
               CASE WHEN k = 7 THEN 'North Part' WHEN k = 10 THEN 'Land X' WHEN country = 'United Parts' AND k % 8 < 6 THEN CASE WHEN k % 2 = 1 THEN 'North Part' ELSE 'South Part' END ELSE country END AS country,
               CASE WHEN k NOT IN (7, 10) THEN k::DOUBLE END AS lat, k NOT IN (7, 10) AND country = 'United Parts' AND k % 8 >= 6 AS unresolved FROM p""",
    "coarse_places": "SELECT DISTINCT 'country too coarse' AS kind, 'customers: United Parts' AS detail FROM customer WHERE c_custkey % 5 IN (2, 3)",
    "bracket_issues": FIXTURES_SQL + """
        SELECT DISTINCT CASE WHEN status = 'FT' THEN 'fatal' ELSE 'warning' END AS kind, 'unknown round: Play-off' AS detail FROM fixtures WHERE id % 17 = 0
        UNION ALL SELECT 'warning', 'no team for the loser of match ' || id FROM fixtures WHERE id % 17 <> 0 AND id % 101 = 0 AND status = 'FT' AND winner = 'home'""",
    "role_orphans": """
        SELECT DISTINCT 'role unknown' AS kind, role || ' / ' || pid AS detail FROM (SELECT o_custkey AS pid, CASE WHEN o_orderkey % 40 = 0 THEN 'coach' ELSE 'player' END AS role FROM orders)
        WHERE (role, pid) NOT IN (SELECT (CASE WHEN c_custkey % 10 = 0 THEN 'coach' ELSE 'player' END, c_custkey) FROM customer)""",
}
