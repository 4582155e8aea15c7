"""Rank correlation, regression and the search for the best thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.operators.relational import min_rank
from fieldglass.staging import stage


def spearman_min_rank(rows: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """n and rho for each group: correlation of lowest ranks around (n + 1) / 2, null for n < 3 and for a constant side.

    Under ties this is not the usual coefficient: tied values all get the lowest of their ranks, and the middle of the ranks
    stays fixed. Rows with a null side don't count. Ranks over all rows are found across tasks; those within groups in the
    group's task.
    """
    keys = list(by)
    rows = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if keys:
        rank = lambda c: F.rank().over(Window.partitionBy(*keys).orderBy(c)).cast("double")
        n = F.count("*").over(Window.partitionBy(*keys))
        ranked = rows.select(*keys, (rank(x) - (n + 1) / 2).alias("dx"), (rank(y) - (n + 1) / 2).alias("dy"))
    else:
        rows = stage(rows.select(F.col(x).alias("x"), F.col(y).alias("y")))
        middle = F.lit((rows.count() + 1) / 2)
        ranked = min_rank(min_rank(rows, "x", "rx"), "y", "ry").select((F.col("rx") - middle).alias("dx"), (F.col("ry") - middle).alias("dy"))
    sums = ranked.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col("dx") * F.col("dy")).alias("xy"), F.sum(F.col("dx") * F.col("dx")).alias("xx"), F.sum(F.col("dy") * F.col("dy")).alias("yy"))
    rho = F.when((F.col("n") >= 3) & (F.col("xx") * F.col("yy") > 0), F.col("xy") / F.sqrt(F.col("xx") * F.col("yy")))
    return sums.select(*keys, "n", rho.alias("rho"))


def ols(rows: DataFrame, x: str, y: str, by: Sequence[str] = (), log_x: bool = False) -> DataFrame:
    """Least-squares slope and intercept for each group, on log10 of x if asked (where x > 0)."""
    rows = rows.where(F.col(x) > 0) if log_x else rows
    cx = F.log10(x) if log_x else F.col(x)
    return rows.groupBy(*by).agg(F.regr_count(F.col(y), cx).alias("n"), F.regr_slope(F.col(y), cx).alias("slope"), F.regr_intercept(F.col(y), cx).alias("intercept"))


def best_threshold(rows: DataFrame, x: str, ys: Sequence[str], first: str, second: str, most: int = 10, least_n: int = 15) -> DataFrame:
    """For each y the thresholds (`first` >= e, `second` >= i, each 0 to `most`) under which its rank correlation with x is
    strongest, of those that leave `least_n` rows; of equals the first in order of (e, i). Rows are dealt out by threshold."""
    steps = F.sequence(F.lit(0), F.lit(most))
    grid = rows.where(F.col(x).isNotNull()).select("*", F.explode(steps).alias("e")).where(F.col(first) >= F.col("e"))
    grid = grid.select("*", F.explode(steps).alias("i")).where(F.col(second) >= F.col("i"))
    long = grid.select("e", "i", F.col(x).alias("x"), F.explode(F.array(*(F.struct(F.lit(y).alias("target"), F.col(y).cast("double").alias("y")) for y in ys))).alias("t")).select("e", "i", "x", "t.*")
    found = spearman_min_rank(long, "x", "y", ["target", "e", "i"]).where((F.col("n") >= least_n) & F.col("rho").isNotNull())
    best = F.max_by(F.struct("rho", "e", "i", "n"), F.struct(F.round(F.abs("rho"), 12), -F.col("e"), -F.col("i")))
    return found.groupBy("target").agg(best.alias("b")).select("target", "b.*")
