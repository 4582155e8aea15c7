"""Flows between nations: customers' nations are origins, suppliers' nations destinations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.operators import relational as R
from fieldglass.session import table


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row an item: origin and destination nation keys, and their names. Only keys go through the large joins."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
        .join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
        .join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("origin_key")), "o_custkey")
        .join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("destination_key")), "l_suppkey")
        .groupBy("origin_key", "destination_key").agg(F.count("*").alias("n"))
        .join(nation.select(F.col("n_nationkey").alias("origin_key"), F.col("n_name").alias("origin")), "origin_key")
        .join(nation.select(F.col("n_nationkey").alias("destination_key"), F.col("n_name").alias("destination")), "destination_key")
    )


def _flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).where("origin_key <> destination_key").select("origin", "destination", F.col("n").alias("n_items"))


def flow_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flows(spark, sf_dir)


def native_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).where("origin_key = destination_key").select(F.col("origin").alias("nation"), F.col("n").alias("n_items"))


def net_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.net_flow(_flows(spark, sf_dir), "origin", "destination", "n_items")


def flow_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.top_n(_flows(spark, sf_dir), ["origin"], [F.desc("n_items"), F.col("destination")], 5)
    return out.withColumn("rank", F.col("rank").cast("long"))


def importer_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.competition_rank(_flows(spark, sf_dir).groupBy("destination").agg(F.countDistinct("origin").alias("n_origins")), "n_origins")


def export_ratio_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("origin"))
    people = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg((F.count("*") * 1000).alias("people")).join(nation, "c_nationkey").select("origin", "people")
    exports = _flows(spark, sf_dir).groupBy("origin").agg(F.sum("n_items").alias("n_items"))
    return R.per_million(exports, people, "origin", "n_items", "people", 0.05, 20)


def nested_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each origin's document: its count, destinations by falling count, and the five first."""
    out = R.nested_counts(_flows(spark, sf_dir), "origin", "destination", "n_items")
    return out.select("origin", "count", F.to_json("pairs").alias("nations"), F.to_json(F.slice("pairs", 1, 5)).alias("top"))


_TRIPS = """
    WITH trips AS (
        SELECT c_nationkey AS ok, s_nationkey AS dk, a.n_name AS origin, b.n_name AS destination
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN nation a ON c_nationkey = a.n_nationkey
        JOIN nation b ON s_nationkey = b.n_nationkey
    ), flows AS (SELECT origin, destination, count(*) AS n_items FROM trips WHERE ok <> dk GROUP BY ALL)"""

QUERIES = {f.__name__: f for f in (flow_counts, native_counts, net_flow, flow_top5, importer_rank, export_ratio_topk, nested_export)}

ORACLE_SQL = {
    "flow_counts": _TRIPS + " SELECT * FROM flows",
    "native_counts": _TRIPS + " SELECT origin AS nation, count(*) AS n_items FROM trips WHERE ok = dk GROUP BY ALL",
    "net_flow": _TRIPS + """
        , e AS (SELECT origin AS place, sum(n_items)::BIGINT AS exports FROM flows GROUP BY ALL),
        i AS (SELECT destination AS place, sum(n_items)::BIGINT AS imports FROM flows GROUP BY ALL)
        SELECT place, coalesce(exports, 0) AS exports, coalesce(imports, 0) AS imports,
               coalesce(exports, 0) - coalesce(imports, 0) AS net FROM e FULL JOIN i USING (place)""",
    "flow_top5": _TRIPS + """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY origin ORDER BY n_items DESC, destination) AS rank FROM flows)
        WHERE rank <= 5""",
    "importer_rank": _TRIPS + """
        , t AS (SELECT destination, count(DISTINCT origin) AS n_origins FROM flows GROUP BY ALL)
        SELECT destination, n_origins, rank() OVER (ORDER BY n_origins DESC) AS rank,
               round(100 * n_origins / max(n_origins) OVER (), 2) AS percent_of_most FROM t""",
    "export_ratio_topk": _TRIPS + """
        , p AS (SELECT n_name AS origin, count(*) * 1000 AS people FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
        e AS (SELECT origin, sum(n_items)::BIGINT AS n_items FROM flows GROUP BY ALL)
        SELECT origin, n_items, people, round(n_items / (people / 1e6), 4) AS per_million FROM e JOIN p USING (origin)
        WHERE round(n_items / (people / 1e6), 4) >= 0.05 ORDER BY per_million DESC, origin LIMIT 20""",
    "nested_export": _TRIPS + """
        , o AS (SELECT origin, sum(n_items)::BIGINT AS count,
                list({'name': destination, 'n': n_items} ORDER BY n_items DESC, destination) AS pairs FROM flows GROUP BY ALL)
        SELECT origin, count, to_json(pairs)::VARCHAR AS nations, to_json(pairs[1:5])::VARCHAR AS top FROM o""",
}
