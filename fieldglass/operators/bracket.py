"""Tournament brackets: who is out, since when, and where the others stand."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The knockout rounds in order, the match for third place, the group stage and finished states.
ROUNDS = ("Round of 32", "Round of 16", "Quarter-finals", "Semi-finals", "Final")
THIRD_PLACE = "3rd Place Final"
GROUP = "Group Stage"
FINISHED = ("FT", "AET", "PEN")


def classify_stage(round_: Column, rounds: Sequence[str] = (*ROUNDS, THIRD_PLACE), group: str = GROUP) -> Column:
    """The stage of a round's name without regard to case: the group stage by prefix, others by name, else null."""
    out = F.when(F.lower(round_).startswith(group.lower()), group)
    for name in rounds:
        out = out.when(F.lower(round_) == name.lower(), name)
    return out


def winner(home_won: Column, away_won: Column) -> Column:
    return F.when(home_won, "home").when(away_won, "away")


def group_letter(home: Column, away: Column) -> Column:
    """The group of a match: the teams' group if they share it."""
    return F.when(home == away, home)


def eliminations(fixtures: DataFrame, field: DataFrame, rounds: Sequence[str] = ROUNDS, third: str = THIRD_PLACE, group: str = GROUP) -> tuple[DataFrame, DataFrame]:
    """From fixtures (id, date, round, status, home, away, winner: home, away or null) and the field (team): each team's
    status, and issues.

    status: team, status (alive or eliminated), eliminated_round, eliminated_date, eliminated_by, third_place_result. The
    loser of a finished knockout match is out; a later round counts over an earlier one. Teams of the field that the first
    knockout round lacks are out in the group stage, once all its matches are finished and that round is known. The match
    for third place eliminates nobody.
    issues: kind and detail; kind `fatal` for finished matches of unknown rounds, `warning` for others of them and for
    losers without a name.
    """
    known = fixtures.withColumn("stage", classify_stage(F.col("round"), (*rounds, third), group)).withColumn("over", F.col("status").isin(*FINISHED))
    decided = known.where(F.col("over") & F.col("winner").isNotNull()).select(
        "id", "stage", F.substring(F.col("date").cast("string"), 1, 10).alias("day"),
        F.when(F.col("winner") == "home", F.col("away")).otherwise(F.col("home")).alias("loser"),
        F.when(F.col("winner") == "home", F.col("home")).otherwise(F.col("away")).alias("victor"),
    )
    at = F.array_position(F.array(*map(F.lit, rounds)), F.col("stage"))
    out = decided.where(F.col("stage").isin(*rounds) & F.col("loser").isNotNull()).withColumn("at", at)
    out = out.groupBy(F.col("loser").alias("team")).agg(F.max(F.struct("at", "day", "stage", "victor")).alias("last"))
    groups = known.where(F.col("stage") == group).agg(F.count("*").alias("n"), F.coalesce(F.every("over"), F.lit(False)).alias("done"))
    first_round = known.where(F.col("stage") == rounds[0]).select(F.explode(F.array("home", "away")).alias("team")).where("team is not null").distinct()
    gone = field.select("team").distinct().join(first_round, "team", "left_anti")
    ready = groups.crossJoin(first_round.agg(F.count("*").alias("n_first"))).where("done and n_first > 0")  # one row at most
    gone = gone.join(F.broadcast(ready.select(F.lit(True).alias("in_group"))), how="cross")
    bronze = decided.where(F.col("stage") == third)
    bronze = bronze.select(F.col("loser").alias("team"), F.lit("lost").alias("result")).union(bronze.select("victor", F.lit("won"))).groupBy("team").agg(F.max("result").alias("third_place_result"))
    status = field.select("team").distinct().join(out, "team", "left").join(gone, "team", "left").join(bronze, "team", "left")
    status = status.select(
        "team", F.when(F.col("last").isNotNull() | F.col("in_group"), "eliminated").otherwise("alive").alias("status"),
        F.coalesce("last.stage", F.when(F.col("in_group"), group)).alias("eliminated_round"), F.col("last.day").alias("eliminated_date"),
        F.col("last.victor").alias("eliminated_by"), "third_place_result",
    )
    unknown = known.where("stage is null").groupBy("round", F.when(F.col("over"), "fatal").otherwise("warning").alias("kind")).count()
    unnamed = decided.where("stage is not null and loser is null").select(F.lit("warning").alias("kind"), F.concat(F.lit("no team for the loser of match "), F.col("id").cast("string")).alias("detail"))
    issues = unknown.select("kind", F.concat(F.lit("unknown round: "), F.coalesce("round", F.lit("null"))).alias("detail")).unionByName(unnamed)
    return status, issues


def current_round(status: DataFrame, rounds: Sequence[str] = ROUNDS, group: str = GROUP) -> DataFrame:
    """For each team alive the round that it plays next: the group stage while nobody is out of it, else the one after
    the furthest round in which it put a team out; `Champion` after the last."""
    order = F.array(*map(F.lit, rounds))
    won = status.where("eliminated_by is not null").groupBy(F.col("eliminated_by").alias("team")).agg(F.max(F.array_position(order, F.col("eliminated_round"))).alias("won"))
    over = status.agg(F.coalesce(F.bool_or(F.col("eliminated_round") == group), F.lit(False)).alias("over"))
    alive = status.where("status = 'alive'").select("team").join(won, "team", "left").crossJoin(F.broadcast(over))  # one row
    next_ = F.when(~F.col("over"), group).when(F.coalesce("won", F.lit(0)) == 0, rounds[0]).when(F.col("won") == len(rounds), "Champion").otherwise(F.get(order, F.col("won").cast("int")))
    return alive.select("team", next_.alias("current_round"))


def team_stage(status: DataFrame, rounds: Sequence[str] = ROUNDS, group: str = GROUP) -> DataFrame:
    """Each team's stage: where it went out, or where it stands."""
    now = current_round(status, rounds, group)
    return status.join(now, "team", "left").select("team", F.when(F.col("status") == "eliminated", F.col("eliminated_round")).otherwise(F.col("current_round")).alias("stage"), (F.col("status") == "eliminated").alias("eliminated"))
