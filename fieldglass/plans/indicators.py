"""Indicators merged from several sources, rating histories, rank statistics: over events, customers and suppliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.operators import ratings, stats
from fieldglass.operators import relational as R
from fieldglass.session import table
from fieldglass.staging import numbered

#: Event types as sources, the lower the better; other types count as 99.
PRIORITY = {"purchase": 1, "view": 2, "click": 2}
TYPES = ("click", "error", "purchase", "signup", "view", "absent")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


def _iso(rows: DataFrame, day: str = "day") -> DataFrame:
    """Days as text, as in all outputs."""
    return rows.withColumn(day, F.col(day).cast("string"))


def priority_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.priority_dedup(_events(spark, sf_dir), ["user_id", "day"], "event_type", PRIORITY, ["event_id"])
    return _iso(rows.select("user_id", "day", "event_id", "event_type", "value"))


def pivot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).where(F.dayofmonth("day").between(2, 23))
    return _iso(R.pivot_first(rows, ["user_id", "day"], "event_type", "value", TYPES, "event_id"))


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = pivot_wide(spark, sf_dir)
    return R.latest_by(wide, "user_id", ["day"], ["purchase", "signup"]).select("user_id", "day", "purchase", "signup", "view")


def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.coverage(pivot_wide(spark, sf_dir), ["purchase", "signup", "view"])


def rating_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select("event_id", "user_id", "ts", (F.floor("value") % 50).cast("long").alias("delta"))
    return ratings.running_rating(rows, "user_id", ["ts", "event_id"], "delta", 1000).select("event_id", F.col("rating").cast("long").alias("rating"))


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).groupBy("user_id", "day").agg(F.max_by("value", F.struct("ts", "event_id")).alias("rating"))
    return R.densify(rows, "user_id", "day", "rating", "interval 1 day")


def rating_monthly_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _iso(_daily(spark, sf_dir))


def rating_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.top_n(_daily(spark, sf_dir), ["day"], [F.desc("rating"), F.col("user_id")], 3)
    return _iso(out.withColumn("rank", F.col("rank").cast("long")))


def rating_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compact log made of events, parsed and folded again: matches by code, adjustments, renames and a dissolution."""
    code = lambda c: F.concat(F.chr(F.lit(65) + F.pmod(c, F.lit(20))), F.chr(F.lit(65) + F.pmod(F.floor(c / 20), F.lit(20))))
    points = F.floor(F.abs("value")).cast("long") % 40
    match = F.concat(code(F.col("user_id")), code(F.col("user_id") + 7), (points - 20).cast("string"))
    token = F.when(F.col("event_id") % 997 == 5, "ABXX").when(F.col("event_id") % 499 == 3, F.lit("CADA")).when(F.col("event_id") % 5 == 0, F.concat(code(F.col("user_id")), points.cast("string"))).otherwise(match)
    rows = _events(spark, sf_dir).select("event_id", F.concat(F.date_format(F.add_months("day", (F.col("event_id") % 400).cast("int")), "yyyyMM"), F.lit("01")).alias("stamp"), token.alias("token"))
    lines = numbered(rows, ["stamp", "event_id"], "line_no", 1).select("line_no", F.concat("stamp", "token").alias("value"))
    return _iso(ratings.rating_history(lines), "month")


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    def half(first: int, last: int) -> DataFrame:
        rows = _events(spark, sf_dir).where(F.dayofmonth("day").between(first, last))
        sums = rows.groupBy("user_id").agg(F.sum(F.floor("value").cast("long")).alias("points"))
        return R.min_rank(sums, "points", "place", falling=True)

    return R.snapshot_diff(half(1, 15), half(16, 31), "user_id", "points", "place")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("exports"), F.sum(F.round("c_acctbal").cast("long")).alias("wealth"))
    supplier = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("imports"), F.sum(F.round("s_acctbal").cast("long")).alias("stock"))
    return customer.join(supplier, "nation").withColumn("net", F.col("exports") - F.col("imports"))


def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.spearman_min_rank(_nations(spark, sf_dir), "imports", "wealth").withColumn("rho", F.round("rho", 6))


def ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.ols(_nations(spark, sf_dir), "wealth", "exports", log_x=True)
    return out.select("n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _nations(spark, sf_dir).withColumn("exports", F.col("exports") - 50)
    out = stats.best_threshold(rows, "wealth", ["net", "exports", "imports"], "exports", "imports")
    return out.select("target", F.round("rho", 6).alias("rho"), "e", "i", "n")


_WIDE = """
    WITH e AS (SELECT *, ts::DATE::VARCHAR AS day FROM events WHERE day(ts) BETWEEN 2 AND 23),
    wide AS (SELECT user_id, day, """ + ", ".join(f"arg_min(value, event_id) FILTER (event_type = '{t}' AND value IS NOT NULL) AS {t}" for t in TYPES) + " FROM e GROUP BY user_id, day)"
_DAILY = """
    WITH d AS (SELECT user_id, ts::DATE AS day, arg_max(value, (ts, event_id)) AS rating FROM events GROUP BY ALL),
    g AS (SELECT user_id, unnest(generate_series(min(day)::TIMESTAMP, (SELECT max(day) FROM d)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM d GROUP BY user_id),
    f AS (SELECT user_id, day, last_value(rating IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day ROWS UNBOUNDED PRECEDING) AS rating FROM g LEFT JOIN d USING (user_id, day))"""
_NATIONS = """
    WITH c AS (SELECT c_nationkey AS nation, count(*) AS exports, sum(round(c_acctbal)::BIGINT)::BIGINT AS wealth FROM customer GROUP BY ALL),
    s AS (SELECT s_nationkey AS nation, count(*) AS imports FROM supplier GROUP BY ALL),
    n AS (SELECT *, exports - imports AS net FROM c JOIN s USING (nation))"""

QUERIES = {f.__name__: f for f in (priority_dedup, pivot_wide, latest_snapshot, coverage, rating_running, rating_monthly_ffill, rating_top_n, rating_log, snapshot_diff, spearman, ols, best_threshold)}

#: Renames cut the log into epochs, in which ratings are sums. Each epoch begins with what the rename before it made of the
#: ratings at the end of the last; a code without a rating (`""`) keeps an epoch of none going.
_RATING_LOG = """
    WITH RECURSIVE e AS (
        SELECT event_id, (date_trunc('month', ts::DATE) + to_months((event_id % 400)::INTEGER))::DATE AS month, floor(abs(value))::BIGINT % 40 AS p,
               chr((65 + user_id % 20)::INTEGER) || chr((65 + user_id // 20 % 20)::INTEGER) AS a, chr((65 + (user_id + 7) % 20)::INTEGER) || chr((65 + (user_id + 7) // 20 % 20)::INTEGER) AS b FROM events),
    t AS (
        SELECT row_number() OVER (ORDER BY month, event_id) AS line, month,
               CASE WHEN event_id % 997 = 5 OR event_id % 499 = 3 THEN 'rename' WHEN event_id % 5 = 0 THEN 'adjust' WHEN p IS NULL THEN 'none' ELSE 'match' END AS kind,
               CASE WHEN event_id % 997 = 5 THEN 'AB' WHEN event_id % 499 = 3 THEN 'CA' ELSE a END AS a, CASE WHEN event_id % 997 = 5 THEN 'XX' WHEN event_id % 499 = 3 THEN 'DA' ELSE b END AS b, p FROM e),
    k AS (SELECT *, count(*) FILTER (kind = 'rename') OVER (ORDER BY line) AS k FROM t),
    renames AS (SELECT k, a, b, month FROM k WHERE kind = 'rename'),
    moves AS (
        SELECT k, month, a AS code, p AS d FROM k WHERE kind = 'adjust' AND p IS NOT NULL UNION ALL SELECT k, month, a, p - 20 FROM k WHERE kind = 'match' UNION ALL SELECT k, month, b, 20 - p FROM k WHERE kind = 'match'),
    sums AS (SELECT k, code, sum(d)::BIGINT AS d FROM moves GROUP BY ALL),
    begins AS (
        SELECT 0::BIGINT AS k, '' AS code, 0::BIGINT AS rating
        UNION ALL
        SELECT k + 1, CASE WHEN held AND code = r.a THEN r.b ELSE code END, rating
        FROM (SELECT x.k, code, rating, r.a, r.b, bool_or(code = r.a) OVER () AS held FROM
                (SELECT k, code, sum(rating)::BIGINT AS rating FROM (SELECT * FROM begins UNION ALL SELECT s.k, s.code, s.d FROM sums s WHERE s.k = (SELECT max(k) FROM begins)) GROUP BY k, code) x
              JOIN renames r ON r.k = x.k + 1) r
        WHERE NOT (held AND ((code = r.a AND r.b = 'XX') OR code = r.b))),
    months AS (SELECT unnest(generate_series((SELECT min(month) FROM t WHERE kind <> 'none')::TIMESTAMP, (SELECT max(month) FROM t WHERE kind <> 'none')::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month),
    placed AS (SELECT month, (SELECT count(*) FROM renames r WHERE r.month <= m.month) AS k FROM months m),
    ends AS (SELECT max(month) AS month FROM (SELECT month FROM moves UNION ALL SELECT month FROM renames)),
    held AS (SELECT p.month, code, rating FROM placed p JOIN begins USING (k) WHERE code <> '' UNION ALL SELECT p.month, code, d FROM placed p JOIN moves ON moves.k = p.k AND moves.month <= p.month)
    SELECT code, month::VARCHAR AS month, sum(rating)::BIGINT AS rating FROM held WHERE month <= (SELECT month FROM ends) GROUP BY code, month"""

ORACLE_SQL = {
    "rating_log": _RATING_LOG,
    "priority_dedup": """
        SELECT user_id, day::VARCHAR AS day, event_id, event_type, value FROM (
            SELECT *, ts::DATE AS day, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY
                CASE event_type WHEN 'purchase' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 2 ELSE 99 END, event_id) AS n FROM events) WHERE n = 1""",
    "pivot_wide": _WIDE + " SELECT * FROM wide",
    "latest_snapshot": _WIDE + """
        SELECT user_id, day, purchase, signup, view FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC) AS n FROM wide WHERE purchase IS NOT NULL OR signup IS NOT NULL) WHERE n = 1""",
    "coverage": _WIDE + """
        SELECT count(*) AS n_rows, count(purchase) AS has_purchase, count(signup) AS has_signup, count(view) AS has_view,
               count(*) FILTER (purchase IS NOT NULL AND signup IS NOT NULL AND view IS NOT NULL) AS has_all,
               count(*) FILTER (coalesce(purchase, signup, view) IS NOT NULL) AS has_any,
               count(*) FILTER (purchase IS NOT NULL AND signup IS NULL AND view IS NULL) AS only_first FROM wide""",
    "rating_running": """
        SELECT event_id, (1000 + sum(floor(value)::BIGINT % 50) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS rating FROM events""",
    "rating_monthly_ffill": _DAILY + " SELECT user_id, day::VARCHAR AS day, rating FROM f",
    "rating_top_n": _DAILY + " SELECT user_id, day::VARCHAR AS day, rating, rank FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY rating DESC, user_id) AS rank FROM f) WHERE rank <= 3",
    "snapshot_diff": """
        WITH a AS (SELECT user_id, sum(floor(value)::BIGINT)::BIGINT AS p FROM events WHERE day(ts) <= 15 GROUP BY ALL),
        b AS (SELECT user_id, sum(floor(value)::BIGINT)::BIGINT AS p FROM events WHERE day(ts) >= 16 GROUP BY ALL),
        a1 AS (SELECT *, rank() OVER (ORDER BY p DESC) AS r FROM a), b1 AS (SELECT *, rank() OVER (ORDER BY p DESC) AS r FROM b)
        SELECT user_id, CASE WHEN a1.p IS NULL THEN 'added' WHEN b1.p IS NULL THEN 'removed' ELSE 'changed' END AS kind, a1.p AS old_value, b1.p AS new_value,
               b1.p - a1.p AS value_delta, a1.r - b1.r AS rank_delta
        FROM a1 FULL JOIN b1 USING (user_id) WHERE a1.p IS DISTINCT FROM b1.p""",
    "spearman": _NATIONS + """
        , r AS (SELECT count(*) OVER () AS n, rank() OVER (ORDER BY imports) AS rx, rank() OVER (ORDER BY wealth) AS ry FROM n),
        m AS (SELECT n, rx - (n + 1) / 2 AS dx, ry - (n + 1) / 2 AS dy FROM r)
        SELECT count(*) AS n, CASE WHEN count(*) >= 3 AND sum(dx * dx) * sum(dy * dy) > 0 THEN round(sum(dx * dy) / sqrt(sum(dx * dx) * sum(dy * dy)), 6) END AS rho FROM m""",
    "ols": _NATIONS + """
        SELECT regr_count(exports, log10(wealth))::BIGINT AS n, round(regr_slope(exports, log10(wealth)), 6) AS slope,
               round(regr_intercept(exports, log10(wealth)), 6) AS intercept FROM n WHERE wealth > 0""",
    "best_threshold": _NATIONS + """
        , v AS (SELECT wealth, exports - 50 AS exports, imports, net FROM n),
        t AS (SELECT e.range::INTEGER AS e, i.range::INTEGER AS i, target, wealth AS x, CASE target WHEN 'net' THEN net WHEN 'exports' THEN exports ELSE imports END AS y
              FROM v, range(11) e, range(11) i, (VALUES ('net'), ('exports'), ('imports')) k(target) WHERE exports >= e.range AND imports >= i.range),
        r AS (SELECT target, e, i, count(*) OVER g AS n, rank() OVER (PARTITION BY target, e, i ORDER BY x) AS rx, rank() OVER (PARTITION BY target, e, i ORDER BY y) AS ry
              FROM t WINDOW g AS (PARTITION BY target, e, i)),
        m AS (SELECT *, rx - (n + 1) / 2 AS dx, ry - (n + 1) / 2 AS dy FROM r),
        k AS (SELECT target, e, i, count(*) AS n, sum(dx * dy) / sqrt(sum(dx * dx) * sum(dy * dy)) AS rho FROM m GROUP BY ALL HAVING count(*) >= 15 AND sum(dx * dx) * sum(dy * dy) > 0)
        SELECT target, round(rho, 6) AS rho, e, i, n FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY round(abs(rho), 12) DESC, e, i) AS p FROM k) WHERE p = 1""",
}
