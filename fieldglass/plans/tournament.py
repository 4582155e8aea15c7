"""Brackets and per-stage totals, with orders as matches and order priorities as stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.operators import bracket, gates
from fieldglass.operators import relational as R
from fieldglass.session import table

_ROUNDS = ", ".join(f"'{r}'" for r in (*bracket.ROUNDS, bracket.THIRD_PLACE))


def _stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, value and cards (orders of over 100,000) by nation and priority."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderpriority").alias("stage"), "o_totalprice")
    return orders.join(customer, "o_custkey").groupBy("nation", "stage").agg(
        F.count("*").alias("matches"), F.sum(F.floor("o_totalprice").cast("long")).alias("fouls"), F.count_if(F.col("o_totalprice") > 100000).alias("cards")
    )


def discipline_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cumulative(_stages(spark, sf_dir), ["nation"], ["stage"], ["matches", "fouls", "cards"], {"per_match": ("fouls", "matches"), "per_card": ("fouls", "cards")})


def discipline_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.latest_by(discipline_cumulative(spark, sf_dir), "nation", ["stage"])


def _games(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Each (order, line) that has both a customer's and a supplier's nation is a match; both sides' measures are its quantity
    and size."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("game"), "o_custkey", F.col("o_orderpriority").alias("stage"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("game")).agg(F.min("l_suppkey").alias("s_suppkey"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.count("*").alias("n_lines"))
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("home"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("away"))
    games = orders.join(lines, "game").join(customer, "o_custkey").join(supplier, "s_suppkey").where("home <> away")
    stats = games.select("game", F.explode(F.array(F.struct(F.col("home").alias("team"), F.col("quantity").alias("fouls"), F.col("n_lines").alias("cards")), F.struct(F.col("away").alias("team"), F.col("n_lines").alias("fouls"), F.lit(1).cast("long").alias("cards")))).alias("s")).select("game", "s.*")
    return games.select("game", "stage", "home", "away"), stats


def opponent_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    games, stats = _games(spark, sf_dir)
    return R.mirrored_totals(games, stats, "game", "home", "away", "stage", "fouls", ["cards"])


def fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as matches: the round comes from the key, the sides are nations, even prices win at home; open orders are not
    over, and every seventh pair of sides is undecided."""
    key = F.col("o_orderkey")
    rounds = F.array(F.lit("Group Stage - 1"), *map(F.lit, (*bracket.ROUNDS, bracket.THIRD_PLACE)))
    nation = lambda x: F.concat(F.lit("N"), F.pmod(x, F.lit(48)).cast("string"))
    return table(spark, sf_dir, "orders").select(
        key.alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.get(rounds, F.pmod(F.floor(key / 50), F.lit(7)).cast("int")).alias("round"),
        F.when((F.col("o_orderstatus") == "O") & (F.pmod(F.floor(key / 50), F.lit(7)) != 0), "NS").otherwise("FT").alias("status"),
        nation(key * 7 + F.col("o_custkey")).alias("home"), nation(key * 7 + F.col("o_custkey") + 1 + key % 11).alias("away"),
        F.when(key % 7 == 5, None).when(F.floor("o_totalprice") % 2 == 0, "home").otherwise("away").alias("winner"),
    )


def _status(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    teams = spark.range(60).select(F.concat(F.lit("N"), F.col("id").cast("string")).alias("team"))
    return bracket.eliminations(fixtures(spark, sf_dir), teams)


def elimination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status(spark, sf_dir)[0].select("team", "status", "eliminated_round", "eliminated_date", "eliminated_by", "third_place_result")


def current_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bracket.team_stage(_status(spark, sf_dir)[0])


def round_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = F.when(F.col("id") % 13 == 0, F.upper("round")).when(F.col("id") % 17 == 0, F.lit("Play-off")).otherwise(F.col("round"))
    rows = fixtures(spark, sf_dir).select(odd.alias("round"), F.col("status").isin(*bracket.FINISHED).alias("over"))
    return rows.groupBy(bracket.classify_stage(F.col("round")).alias("stage")).agg(F.count("*").alias("n"), F.count_if("over").alias("n_over"))


def squad_size_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    by_hand = spark.createDataFrame([(1, 26), (3, 23), (7, 0)], "n_nationkey int, squad_override long")
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    return nation.join(F.broadcast(by_hand), "n_nationkey", "left").join(counts, "n_nationkey", "left").select("n_name", F.coalesce("squad_override", "n", F.lit(0)).alias("squad_size"))


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, customer, supplier = (table(spark, sf_dir, t) for t in ("nation", "customer", "supplier"))
    orders = table(spark, sf_dir, "orders").select("o_custkey")
    rich = customer.where("c_acctbal > 9000")
    ids = customer.select(F.col("c_nationkey").alias("nation"), (F.col("c_custkey") % 40).alias("ident"), F.col("c_custkey").alias("owner"))
    bad = [gates.Rule("customer in debt", F.col("c_acctbal") >= 0, "c_name"), gates.Rule("segment unknown", F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"), "c_name")]
    return gates.anomalies(
        gates.lacking(nation, "n_nationkey", supplier, "s_nationkey", "n_name", "nation without supplier"),
        gates.lacking(nation, "n_nationkey", rich, "c_nationkey", "n_name", "nation without rich customer"),
        gates.lacking(customer, "c_custkey", orders, "o_custkey", "c_name", "customer without order"),
        gates.shared_ids(ids, "nation", "ident", "owner", "id shared within nation"),
        gates.violations(customer, bad),
        gates.orphans(customer, ["c_nationkey"], nation.where("n_nationkey < 20"), ["n_nationkey"], "nation unknown"),
        gates.duplicates(supplier, ["s_nationkey"], "nation with several suppliers"),
    )


def live_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region").where("r_regionkey < 3")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")).join(nation, "n_nationkey")
    return rows.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("c_custkey", "n_name", "r_name")


_GAMES = """
    WITH l AS (SELECT l_orderkey AS game, min(l_suppkey) AS s_suppkey, sum(l_quantity::BIGINT)::BIGINT AS quantity, count(*) AS n_lines FROM lineitem GROUP BY ALL),
    g AS (SELECT game, o_orderpriority AS stage, c_nationkey AS home, s_nationkey AS away, quantity, n_lines
          FROM l JOIN orders ON game = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier USING (s_suppkey) WHERE c_nationkey <> s_nationkey)"""
FIXTURES_SQL = """
    WITH fixtures AS (
        SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS date,
               ['Group Stage - 1', 'Round of 32', 'Round of 16', 'Quarter-finals', 'Semi-finals', 'Final', '3rd Place Final'][(o_orderkey // 50) % 7 + 1] AS round,
               CASE WHEN o_orderstatus = 'O' AND (o_orderkey // 50) % 7 <> 0 THEN 'NS' ELSE 'FT' END AS status,
               'N' || ((o_orderkey * 7 + o_custkey) % 48) AS home, 'N' || ((o_orderkey * 7 + o_custkey + 1 + o_orderkey % 11) % 48) AS away,
               CASE WHEN o_orderkey % 7 = 5 THEN NULL WHEN floor(o_totalprice)::BIGINT % 2 = 0 THEN 'home' ELSE 'away' END AS winner
        FROM orders),
    field AS (SELECT 'N' || range AS team FROM range(60)),
    done AS (SELECT *, CASE winner WHEN 'home' THEN away ELSE home END AS loser, CASE winner WHEN 'home' THEN home ELSE away END AS victor,
                    CASE round WHEN 'Round of 32' THEN 1 WHEN 'Round of 16' THEN 2 WHEN 'Quarter-finals' THEN 3 WHEN 'Semi-finals' THEN 4 WHEN 'Final' THEN 5 END AS ord
             FROM fixtures WHERE status IN ('FT', 'AET', 'PEN') AND winner IS NOT NULL),
    lost AS (SELECT * FROM (SELECT loser AS team, round, date, victor, row_number() OVER (PARTITION BY loser ORDER BY ord DESC, date DESC, victor DESC) AS n FROM done WHERE ord IS NOT NULL) WHERE n = 1),
    r32 AS (SELECT home AS team FROM fixtures WHERE round = 'Round of 32' UNION SELECT away FROM fixtures WHERE round = 'Round of 32'),
    ready AS (SELECT (SELECT coalesce(bool_and(status IN ('FT', 'AET', 'PEN')), false) FROM fixtures WHERE round LIKE 'Group Stage%') AND (SELECT count(*) FROM r32) > 0 AS ok),
    bronze AS (SELECT team, max(result) AS result FROM (SELECT loser AS team, 'lost' AS result FROM done WHERE round = '3rd Place Final' UNION ALL SELECT victor, 'won' FROM done WHERE round = '3rd Place Final') GROUP BY ALL),
    status AS (
        SELECT team, CASE WHEN lost.team IS NOT NULL OR grp THEN 'eliminated' ELSE 'alive' END AS status,
               coalesce(round, CASE WHEN grp THEN 'Group Stage' END) AS eliminated_round, date AS eliminated_date, victor AS eliminated_by, result AS third_place_result
        FROM (SELECT field.team, field.team NOT IN (SELECT team FROM r32) AND (SELECT ok FROM ready) AS grp FROM field)
        LEFT JOIN lost USING (team) LEFT JOIN bronze USING (team))"""

QUERIES = {f.__name__: f for f in (discipline_cumulative, discipline_latest, opponent_mirror, elimination, current_round, round_classes, squad_size_override, anomalies, live_lookup)}

_STAGES = """
    WITH s AS (SELECT c_nationkey AS nation, o_orderpriority AS stage, count(*) AS matches, sum(floor(o_totalprice)::BIGINT)::BIGINT AS fouls,
                      count(*) FILTER (o_totalprice > 100000) AS cards FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
    c AS (SELECT nation, stage, (sum(matches) OVER w)::BIGINT AS matches, (sum(fouls) OVER w)::BIGINT AS fouls, (sum(cards) OVER w)::BIGINT AS cards
          FROM s WINDOW w AS (PARTITION BY nation ORDER BY stage ROWS UNBOUNDED PRECEDING)),
    d AS (SELECT *, round(fouls / matches, 2) AS per_match, round(fouls / nullif(cards, 0), 2) AS per_card FROM c)"""

ORACLE_SQL = {
    "discipline_cumulative": _STAGES + " SELECT * FROM d",
    "discipline_latest": _STAGES + " SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY stage DESC) AS n FROM d) WHERE n = 1",
    "opponent_mirror": _GAMES + """
        , sides AS (SELECT stage, home AS team, quantity AS committed, n_lines AS suffered, n_lines AS cards FROM g
                    UNION ALL SELECT stage, away, n_lines, quantity, 1 FROM g)
        SELECT team, stage, count(*) AS matches, sum(committed)::BIGINT AS committed, sum(suffered)::BIGINT AS suffered, sum(cards)::BIGINT AS cards FROM sides GROUP BY ALL""",
    "elimination": FIXTURES_SQL + " SELECT * FROM status",
    "current_round": FIXTURES_SQL + """
        , won AS (SELECT eliminated_by AS team, max(list_position(['Round of 32', 'Round of 16', 'Quarter-finals', 'Semi-finals', 'Final'], eliminated_round)) AS w
                  FROM status WHERE eliminated_by IS NOT NULL GROUP BY ALL)
        SELECT team, CASE WHEN status = 'eliminated' THEN eliminated_round
                          WHEN NOT EXISTS (SELECT 1 FROM status WHERE eliminated_round = 'Group Stage') THEN 'Group Stage'
                          WHEN coalesce(w, 0) = 0 THEN 'Round of 32' WHEN w = 5 THEN 'Champion'
                          ELSE ['Round of 32', 'Round of 16', 'Quarter-finals', 'Semi-finals', 'Final'][w + 1] END AS stage,
               status = 'eliminated' AS eliminated FROM status LEFT JOIN won USING (team)""",
    "round_classes": FIXTURES_SQL + f"""
        , r AS (SELECT CASE WHEN id % 13 = 0 THEN upper(round) WHEN id % 17 = 0 THEN 'Play-off' ELSE round END AS round, status IN ('FT', 'AET', 'PEN') AS over FROM fixtures),
        k AS (SELECT CASE WHEN lower(round) LIKE 'group stage%' THEN 'Group Stage' ELSE list_filter([{_ROUNDS}], lambda x: lower(x) = lower(round))[1] END AS stage, over FROM r)
        SELECT stage, count(*) AS n, count(*) FILTER (over) AS n_over FROM k GROUP BY ALL""",
    "squad_size_override": """
        SELECT n_name, coalesce(v.o, count(c_custkey))::BIGINT AS squad_size FROM nation
        LEFT JOIN (VALUES (1, 26), (3, 23), (7, 0)) v(k, o) ON k = n_nationkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name, v.o""",
    "anomalies": """
        SELECT 'nation without supplier' AS kind, n_name AS detail FROM nation WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey)
        UNION ALL SELECT 'nation without rich customer', n_name FROM nation WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 9000)
        UNION ALL SELECT 'customer without order', c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
        UNION ALL SELECT 'id shared within nation', c_nationkey || ' / ' || (c_custkey % 40) FROM customer GROUP BY c_nationkey, c_custkey % 40 HAVING count(DISTINCT c_custkey) > 1
        UNION ALL SELECT 'customer in debt', c_name FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT 'segment unknown', c_name FROM customer WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
        UNION ALL SELECT 'nation unknown', c_nationkey::VARCHAR FROM (SELECT DISTINCT c_nationkey FROM customer) WHERE c_nationkey >= 20
        UNION ALL SELECT 'nation with several suppliers', s_nationkey::VARCHAR FROM supplier GROUP BY s_nationkey HAVING count(*) > 1""",
    "live_lookup": """
        SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) ON n_regionkey = r_regionkey""",
}
