"""A service over the network, read at its pace and never twice, and the shapes of what it answers."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from urllib.error import HTTPError
from urllib.request import Request, urlopen

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.functions.numbers import statistic
from fieldglass.sources.readers import cached_within
from fieldglass.sources.sinks import _fs
from fieldglass.staging import drop, numbered, stage

#: Seconds between two requests, from one's start to the next's; the longest wait before another try.
PACE, LONGEST_WAIT = 1.0, 60.0
CACHE = "request string, fetched_at timestamp, text string"


def _fetch(address: str, headers: Mapping[str, str], tries: int, wait: float, timeout: float) -> tuple[str | None, str | None]:
    """An answer's text, or why there is none. Another try comes after `wait` seconds, and twice as many each time, or when the
    service says; what a service refuses for good (4xx but 408 and 429) isn't tried again."""
    for left in range(tries - 1, -1, -1):
        after = None
        try:
            with urlopen(Request(address, headers=dict(headers)), timeout=timeout) as answer:
                return answer.read().decode("utf-8"), None
        except HTTPError as e:
            why, after = f"HTTP {e.code}", e.headers.get("Retry-After")
            if 400 <= e.code < 500 and e.code not in (408, 429):
                return None, why
        except (OSError, UnicodeDecodeError) as e:
            why = f"{type(e).__name__}: {e}"
        if left:
            time.sleep(min(LONGEST_WAIT, max(wait, float(after) if after and after.isdigit() else 0.0)))
            wait *= 2
    return None, why


def fetch(requests: DataFrame, *, pace: float = PACE, lanes: int = 1, tries: int = 5, wait: float = 1.0, timeout: float = 30.0, headers: Mapping[str, str] | None = None) -> DataFrame:
    """(request, text, error) for the different `requests` (request: an address). Lanes are tasks that fetch side by side: each
    begins a request `lanes * pace` seconds after its last at the earliest, and they start `pace` apart, so that all
    together keep the pace; a service that allows none but one at a time has one lane. Null requests are left out."""
    if tries < 1 or lanes < 1:
        raise ValueError("at least one try and one lane")
    headers = dict(headers or {})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free = None
        for batch in batches:
            for lane, request in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if free is None:
                    free = time.monotonic() + lane * pace
                time.sleep(max(0.0, free - time.monotonic()))
                free = time.monotonic() + lanes * pace
                text, why = _fetch(request, headers, tries, wait, timeout)
                free = max(free, time.monotonic()) if why else free
                yield pa.RecordBatch.from_arrays([pa.array([request]), pa.array([text], pa.string()), pa.array([why], pa.string())], ["request", "text", "error"])

    different = requests.where("request is not null").select("request").distinct()
    dealt = different.select(F.pmod(F.xxhash64("request"), F.lit(lanes)).cast("int").alias("lane"), "request").repartitionById(lanes, "lane")
    return dealt.mapInArrow(task, "request string, text string, error string")


def read_cache(spark: SparkSession, folder: str, days: int | None = None) -> DataFrame:
    """(request, fetched_at, text): the last answer to each request in a cache, if none is older than `days` (any, if not given)."""
    fs, target = _fs(spark, folder)
    if not fs.exists(target):
        return spark.createDataFrame([], CACHE)
    kept = spark.read.schema(CACHE).parquet(folder)
    kept = kept if days is None else cached_within(kept, "fetched_at", F.current_timestamp(), days)
    return kept.groupBy("request").agg(F.max_by(F.struct("fetched_at", "text"), "fetched_at").alias("last")).select("request", "last.*")


def fetch_cached(requests: DataFrame, folder: str, *, days: int | None = None, at_once: int = 500, **options) -> DataFrame:
    """(request, text, error) for the different `requests`, from the cache in `folder` where it has them, else from the service,
    whose answers are added to the cache some `at_once` at a time: what was fetched before a crash isn't fetched again. What
    had an error isn't kept. Options are those of `fetch`."""
    spark = requests.sparkSession
    wanted = stage(requests.where("request is not null").select("request").distinct())
    todo = stage(numbered(wanted.join(read_cache(spark, folder, days).select("request"), "request", "left_anti"), ["request"], "n"))
    failed: DataFrame | None = None
    for i in range(-(-todo.count() // at_once)):
        got = stage(fetch(todo.where(F.floor(F.col("n") / at_once) == i), **options))
        got.where("text is not null").select("request", F.current_timestamp().alias("fetched_at"), "text").write.mode("append").parquet(folder)
        wrong = got.where("text is null").select("request", "text", "error")
        failed = wrong if failed is None else failed.unionByName(wrong)
    drop(todo)
    known = wanted.join(read_cache(spark, folder, days).select("request", "text"), "request").withColumn("error", F.lit(None).cast("string"))
    if failed is None:
        return known
    return known.unionByName(failed.join(known.select("request"), "request", "left_anti"))


def read_paged(spark: SparkSession, address: str, folder: str, schema: str, items: str, pages: str = "pages", **options) -> DataFrame:
    """The rows of all pages of a service, by way of a cache: `address` has `{page}` in it, the first page tells in `pages` how many
    there are. A page that can't be had fails the reading; what came before stays in the cache."""
    first = spark.createDataFrame([(address.replace("{page}", "1"),)], "request string")
    one = _whole(fetch_cached(first, folder, **options))
    count = one.select(F.get_json_object("text", f"$.{pages}").try_cast("int")).first()[0] or 1
    every = spark.range(1, count + 1).select(F.replace(F.lit(address), F.lit("{page}"), F.col("id").cast("string")).alias("request"))
    texts = _whole(fetch_cached(every, folder, **options))
    return texts.select(F.inline(F.from_json("text", f"{items} array<struct<{schema}>>")[items]))


def _whole(answers: DataFrame) -> DataFrame:
    answers = stage(answers)
    wrong = answers.where("error is not null").limit(5).collect()
    if wrong:
        raise OSError("; ".join(f"{r['request']}: {r['error']}" for r in wrong))
    return answers


# What it answers -----------------------------------------------------------------------------------------------------

#: The fields of a game, of a line of a table, and of a team's statistics in a game.
GAME = "fixture struct<id: long, date: string, status: struct<short: string>>, league struct<round: string>, teams struct<home: struct<id: long, name: string, winner: boolean>, away: struct<id: long, name: string, winner: boolean>>, goals struct<home: int, away: int>, score struct<penalty: struct<home: int, away: int>>"
LINE = "rank: int, team: struct<id: long, name: string>, points: int, goalsDiff: int, group: string, all: struct<played: int, win: int, draw: int, lose: int, goals: struct<`for`: int, against: int>>"
STATISTICS = "team: struct<id: long, name: string>, statistics: array<struct<type: string, value: string>>"
GROUP, NO_GROUP = "Group ", "Stage"


def games(answers: DataFrame) -> DataFrame:
    """(id, date, round, status, home, away, home_goals, away_goals, winner, home_penalty, away_penalty) of answers (text); the
    winner is `home`, `away` or null, penalties are null where none were shot."""
    rows = answers.select(F.inline(F.from_json("text", f"response array<struct<{GAME}>>")["response"]))
    winner = F.when(F.col("teams.home.winner"), "home").when(F.col("teams.away.winner"), "away")
    names = {"id": "fixture.id", "date": "fixture.date", "round": "league.round", "status": "fixture.status.short", "home": "teams.home.name", "away": "teams.away.name", "home_goals": "goals.home", "away_goals": "goals.away"}
    shot = F.col("score.penalty.home").isNotNull()
    return rows.select(*(F.col(c).alias(n) for n, c in names.items()), winner.alias("winner"), *(F.when(shot, F.col(f"score.penalty.{s}")).alias(f"{s}_penalty") for s in ("home", "away")))


def standings(answers: DataFrame) -> DataFrame:
    """(group, rank, team, points, played, win, draw, lose, goals_for, goals_against, goals_diff) of answers (text): a line for each
    team of a group, in the service's own rank; the group of all groups' losers is none."""
    tables = answers.select(F.inline(F.from_json("text", f"response array<struct<league: struct<standings: array<array<struct<{LINE}>>>>>>")["response"]))
    lines = tables.select(F.inline(F.flatten("league.standings"))).withColumn("letter", F.regexp_replace("group", f"^{GROUP}", "")).where(F.col("letter") != NO_GROUP)
    counts = {"played": "all.played", "win": "all.win", "draw": "all.draw", "lose": "all.lose", "goals_for": "all.goals.for", "goals_against": "all.goals.against", "goals_diff": "goalsDiff"}
    return lines.select(F.col("letter").alias("group"), "rank", F.col("team.name").alias("team"), "points", *(F.col(c).alias(n) for n, c in counts.items()))


def with_groups(rows: DataFrame, lines: DataFrame, stage_name: str = "Group Stage") -> DataFrame:
    """Games with the group that both teams are in, if the round is one of groups; else null."""
    letter = lambda side: lines.select(F.col("team").alias(side), F.col("group").alias(f"{side} group"))
    both = rows.join(letter("home"), "home", "left").join(letter("away"), "away", "left")
    same = F.col("round").startswith(stage_name) & (F.col("home group") == F.col("away group"))
    return both.withColumn("group", F.when(same, F.col("home group"))).select(*rows.columns, "group")


def game_statistics(answers: DataFrame, ident: Column, kinds: Mapping[str, str]) -> DataFrame:
    """(game, team, a column for each of `kinds`: its name and the service's) of answers (text) on one game each; `ident` tells the
    game from the request. What a team lacks, or is null, is 0."""
    rows = answers.select(ident.alias("game"), F.inline(F.from_json("text", f"response array<struct<{STATISTICS}>>")["response"]))
    return rows.select("game", F.col("team.name").alias("team"), *(statistic(F.col("statistics"), kind).alias(name) for name, kind in kinds.items()))


