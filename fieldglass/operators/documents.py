"""The documents of a tournament's model, each one row made from its tables: its columns are the document's fields, or its one
column `document`, a map, is the document.

Tables: person (pid, name, surname, shirt_number, position, role, caps, nation, birth), country (id, name, iso2, population),
capital_name (country, lang, name), provenance (dataset, source, updated), af_person (af_id, pid), af_team (af_team_id, country),
eliminated (iso2, round, date, lost_to, third_result, third_date, third_opponent), discipline (iso2, stage, ord and MEASURES),
team_stage (iso2, stage, eliminated), birthplace (pid, city, lat, lon, population, actual_city), wiki_title (pid, lang, title).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.operators.relational import array_by_key

Tables = Mapping[str, DataFrame]
#: The languages of titles; a team's measures, as columns and as fields, with what they are before its first game.
LANGUAGES = ("en", "fr", "de", "it", "es")
MEASURES = {
    "matches_played": ("matchesPlayed", 0), "fouls_committed": ("foulsCommitted", 0), "fouls_suffered": ("foulsSuffered", 0), "avg_fouls_committed": ("avgFoulsCommitted", 0.0),
    "avg_fouls_suffered": ("avgFoulsSuffered", 0.0), "yellow_cards": ("yellowCards", 0), "red_cards": ("redCards", 0), "fouls_per_card": ("foulsPerCard", None),
}
COACH, TOP = "coach", 5


def _one_row(*frames: DataFrame) -> DataFrame:
    """Frames of one row each, side by side."""
    side = lambda a, b: a.join(F.broadcast(b), F.lit(True))  # noqa: E731  # one row each
    return reduce(side, frames)


def _object(rows: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """One row with a map of all rows; empty without any."""
    return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.col(value).alias("v"))), lambda a, b: F.when(a["k"] < b["k"], -1).otherwise(1))).alias(out))


def _player(nation: Column | None, pid: bool = True) -> Column:
    role = F.when(F.col("role") == COACH, F.col("role")).alias("role")
    first = ["name", *([nation.alias("nation")] if nation is not None else []), "caps", role, "surname", F.col("shirt_number").alias("shirtNumber"), "position"]
    return F.struct(*first, *(["pid"] if pid else []))


def export_map(t: Tables) -> DataFrame:
    """People born elsewhere by the country of their birth: the most first, then that of the smallest pid; people without a role of
    coach before coaches, by falling caps, then by pid. Others by nation. With populations in millions and capitals' names."""
    nation = t["country"].select(F.col("id").alias("nation"), F.col("name").alias("nation name"))
    birth = t["country"].select(F.col("id").alias("birth"), F.col("name").alias("birth name"), F.col("iso2").alias("birth iso2"))
    people = t["person"].join(nation, "nation").join(birth, "birth")
    abroad = people.where("birth <> nation")
    order = [(F.col("role") == COACH).alias("last"), (-F.col("caps")).alias("less"), F.col("pid").alias("at")]
    listed = F.array_sort(F.collect_list(F.struct(*order, _player(F.col("nation name")).alias("player"), _player(F.col("nation name"), False).alias("shown"))), lambda a, b: _before(a, b, ["last", "less", "at"]))
    groups = abroad.groupBy("birth", "birth name", "birth iso2").agg(F.count("*").alias("count"), F.min("pid").alias("first"), listed.alias("listed"))
    counts = abroad.groupBy("birth", "nation name").agg((-F.count("*")).alias("less"))
    pair = lambda p: F.array(p["nation name"].cast("variant"), (-p["less"]).cast("variant"))
    counts = counts.groupBy("birth").agg(F.transform(F.array_sort(F.collect_list(F.struct("less", "nation name"))), pair).alias("nations"))
    record = F.struct(
        F.col("birth name").alias("country"), F.col("birth").alias("id"), F.col("birth iso2").alias("iso2"), "count", "nations",
        F.transform(F.slice("listed", 1, TOP), lambda p: p["shown"]).alias("top"), F.transform("listed", lambda p: p["player"]).alias("players"),
    )
    records = groups.join(counts, "birth").select((-F.col("count")).alias("less"), F.col("first").alias("at"), record.alias("record"))
    data = records.agg(F.transform(F.array_sort(F.collect_list(F.struct("less", "at", "record")), lambda a, b: _before(a, b, ["less", "at"])), lambda r: r["record"]).alias("data"))
    own = people.where("birth = nation").groupBy("nation name").agg(F.array_sort(F.collect_list(F.struct((-F.col("caps")).alias("less"), F.col("pid").alias("at"), _player(None).alias("player"))), lambda a, b: _before(a, b, ["less", "at"])).alias("listed"))
    natives = _object(own.select("nation name", F.transform("listed", lambda p: p["player"]).alias("players")), "nation name", "players", "natives")
    pop = _object(t["country"].where("population is not null").select("iso2", F.round(F.col("population") / 1e6, 2).alias("millions")), "iso2", "millions", "pop")
    names = t["capital_name"].join(t["country"].select(F.col("id").alias("country"), "iso2"), "country")
    names = names.groupBy("iso2").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "name")))).alias("names"))
    source = t["provenance"].where("dataset = 'population'").agg(F.first("source").alias("popSource"), F.first("updated").alias("popUpdated"))
    return _one_row(data, pop, _object(names, "iso2", "names", "capital"), natives, source)


def _before(a: Column, b: Column, fields: list[str]) -> Column:
    """How two structs compare by some fields, the first first."""
    return reduce(lambda later, f: F.when(a[f] < b[f], -1).when(a[f] > b[f], 1).otherwise(later), reversed(fields), F.lit(0))


def export_live(t: Tables) -> DataFrame:
    """People by their nation's code and the service's id, with their pid and country of birth; and the service's teams."""
    nation = t["country"].select(F.col("id").alias("nation"), "iso2")
    birth = t["country"].select(F.col("id").alias("birth"), F.col("name").alias("birthCountry"))
    people = t["af_person"].join(t["person"].select("pid", "nation", "birth"), "pid").join(nation, "nation").join(birth, "birth", "left")
    entry = F.parse_json(F.to_json(F.struct("pid", "birthCountry")))
    by_nation = people.groupBy("iso2").agg(F.map_from_entries(F.collect_list(F.struct(F.col("af_id").cast("string"), entry))).alias("people"))
    teams = t["af_team"].join(nation.withColumnRenamed("nation", "country"), "country").agg(F.map_from_entries(F.collect_list(F.struct(F.col("af_team_id").cast("string"), F.col("iso2").cast("variant")))).alias("people"))
    return _object(by_nation.unionByName(teams.select(F.lit("teams").alias("iso2"), "people")), "iso2", "people", "document")


def export_status(t: Tables) -> DataFrame:
    """Eliminated teams only, with the game for third place where it was played."""
    third = F.when(F.col("third_result").isNotNull(), F.struct(F.col("third_result").alias("result"), F.col("third_date").alias("date"), F.col("third_opponent").alias("opponent")))
    return _object(t["eliminated"].select("iso2", F.struct("round", "date", F.col("lost_to").alias("lostTo"), third.alias("thirdPlace")).alias("entry")), "iso2", "entry", "document")


def export_discipline(t: Tables) -> DataFrame:
    """Each team's totals after its last stage so far (by ord, then name), or none, its stage, whether it is out, and its totals after each
    stage."""
    entry = F.struct(*(F.col(c).alias(f) for c, (f, _) in MEASURES.items()))
    staged = t["discipline"].groupBy("iso2").agg(F.array_sort(F.collect_list(F.struct("ord", "stage", entry.alias("entry"))), lambda a, b: _before(a, b, ["ord", "stage"])).alias("stages"))
    rows = t["team_stage"].join(staged, "iso2", "left")
    last = F.element_at("stages", -1)["entry"]
    fields = [F.coalesce(last[f], F.lit(none)).alias(f) if none is not None else last[f].alias(f) for f, none in MEASURES.values()]
    by_stage = F.coalesce(F.map_from_entries(F.transform("stages", lambda s: F.struct(s["stage"], s["entry"]))), F.map_from_entries(F.array().cast(f"array<struct<k: string, v: {_kind(t)}>>")))
    return _object(rows.select("iso2", F.struct(*fields, "stage", F.col("eliminated").cast("boolean").alias("eliminated"), by_stage.alias("byStage")).alias("entry")), "iso2", "entry", "document")


def _kind(t: Tables) -> str:
    return t["discipline"].select(F.struct(*(F.col(c).alias(f) for c, (f, _) in MEASURES.items())).alias("e")).schema["e"].dataType.simpleString()


def export_birthplace(t: Tables) -> DataFrame:
    """Places of birth by pid."""
    entry = F.struct("city", "lat", "lon", "population", F.col("actual_city").alias("actualCityName"))
    return _object(t["birthplace"].select("pid", entry.alias("entry")), "pid", "entry", "document")


def export_wiki(t: Tables, language: str) -> DataFrame:
    """The titles in a language, by pid: one array up to the largest pid, with null where there is none."""
    titles = t["person"].select("pid").join(t["wiki_title"].where(F.col("lang") == language).select("pid", "title"), "pid", "left")
    return array_by_key(titles, "pid", "title").select(F.lit(f"https://{language}.wikipedia.org/wiki/{{title}}").alias("urlTemplate"), F.col("title").alias("titles"))


#: The ten documents: their names, what makes them, and whether fields without a value stay.
DOCUMENTS = {"map": (export_map, False), "live": (export_live, False), "status": (export_status, False), "discipline": (export_discipline, True), "birthplace": (export_birthplace, False)}
DOCUMENTS |= {f"wiki_{lang}": ((lambda t, lang=lang: export_wiki(t, lang)), False) for lang in LANGUAGES}
