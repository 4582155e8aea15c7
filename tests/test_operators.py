import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldglass.operators import bracket, gates, names, ratings, spatial, stats
from fieldglass.operators import relational as R


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_keys_are_stable(spark):
    registry = spark.createDataFrame([(7, "player", 1, "fr", "Ann"), (9, "player", 2, "fr", "Bo"), (12, "coach", 1, "de", "Gone")], "pid int, role string, af_id int, nation string, name string")
    people = spark.createDataFrame([("player", 1, "fr", "Ann Lee"), ("player", None, "fr", "Bo"), ("player", 5, "es", "Cy"), ("coach", 8, "es", "Di")], "role string, af_id int, nation string, name string")
    assigned, again = R.assign_keys(registry, people, ["role", "af_id"], ["nation", "name"], "pid", ["name"])
    assert rows(assigned, "name", "pid") == [("Ann Lee", 7), ("Bo", 9), ("Cy", 13), ("Di", 14)]
    assert {r[0] for r in rows(again, "pid")} == {7, 9, 12, 13, 14}
    once_more = R.assign_keys(again, people, ["role", "af_id"], ["nation", "name"], "pid", ["name"])[0]
    assert rows(once_more, "name", "pid") == rows(assigned, "name", "pid")
    with pytest.raises(ValueError, match="share a key"):
        R.assign_keys(registry, people.union(people), ["role", "af_id"], ["nation", "name"], "pid", ["name"])


def test_dimension_ids_take_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, "a", 1.0), (4, None, None)], "i int, name string, lat double")
    dimension, fact = R.dimension_ids(df, ["name", "lat"], "city")
    ids = {r["i"]: r["city"] for r in fact.collect()}
    assert ids[1] == ids[2] and len(set(ids.values())) == 3 and dimension.count() == 3


def test_strict_resolution(spark):
    known = spark.createDataFrame([("France", "fr"), ("Turkey", "tr")], "name string, code string")
    alias = spark.createDataFrame([("Türkiye", "tr"), ("france", "xx")], "name string, code string")
    df = spark.createDataFrame([(" FRANCE ",), ("türkiye",), (None,)], "n string")
    assert {r["code"] for r in R.resolve(df, "n", known, alias, strict=True).collect()} == {"fr", "tr", None}
    with pytest.raises(Exception, match="unknown name"):
        R.resolve(df.union(spark.createDataFrame([("Atlantis",)], "n string")), "n", known, alias, strict=True).collect()


def fixtures(spark, rows_):
    return spark.createDataFrame(rows_, "id int, date string, round string, status string, home string, away string, winner string")


def test_eliminations(spark):
    field = spark.createDataFrame([(c,) for c in "ABCDEF"], "team string")
    games = [
        (1, "2026-06-11T18:00", "Group Stage - 1", "FT", "A", "B", None), (2, "2026-06-12T18:00", "group stage - 2", "FT", "E", "F", "home"),
        (3, "2026-06-28T18:00", "Round of 32", "PEN", "A", "B", "away"), (4, "2026-06-29T18:00", "Semi-finals", "FT", "B", "C", "home"), (5, "2026-06-29T20:00", "Semi-finals", "AET", "D", "A", "home"),
        (6, "2026-07-01T18:00", "3rd Place Final", "FT", "C", "A", "away"), (7, "2026-07-02T18:00", "Final", "NS", "B", "D", None), (8, "2026-07-02", "Play-off", "NS", "A", "B", None),
    ]
    status, issues = bracket.eliminations(fixtures(spark, games), field)
    by = {r["team"]: r for r in status.collect()}
    assert (by["A"]["eliminated_round"], by["A"]["eliminated_date"], by["A"]["eliminated_by"], by["A"]["third_place_result"]) == ("Semi-finals", "2026-06-29", "D", "won")
    assert by["C"]["eliminated_round"] == "Semi-finals" and by["C"]["third_place_result"] == "lost"
    assert {t for t, r in by.items() if r["eliminated_round"] == "Group Stage"} == {"D", "E", "F"}
    assert by["B"]["status"] == "alive"
    assert rows(issues) == [("warning", "unknown round: Play-off")]
    fatal = bracket.eliminations(fixtures(spark, [*games, (9, "2026-07-03", "Play-off", "FT", "A", "B", "home")]), field)[1]
    assert ("fatal", "unknown round: Play-off") in rows(fatal)
    stages = {r["team"]: r["stage"] for r in bracket.team_stage(status).collect()}
    assert stages["B"] == "Final" and stages["E"] == "Group Stage"


def test_groups_stay_open_while_a_match_is_left(spark):
    field = spark.createDataFrame([("A",), ("B",)], "team string")
    games = [(1, "d", "Group Stage - 1", "FT", "A", "B", "home"), (2, "d", "Group Stage - 2", "NS", "A", "B", None), (3, "d", "Round of 32", "NS", "A", None, None)]
    status = bracket.eliminations(fixtures(spark, games), field)[0]
    assert {r["status"] for r in status.collect()} == {"alive"}
    assert {r["current_round"] for r in bracket.current_round(status).collect()} == {"Group Stage"}


def fold_log(text):
    """The log read line by line, in plain Python: {(code, (year, month)): rating} for every month."""
    import re

    state, snaps, year, month = {}, {}, None, None
    for line in filter(None, map(str.strip, text.split("\n"))):
        digits = re.match(r"\d*", line)[0]
        if len(digits) == 8:
            year, month = int(digits[:4]), int(digits[4:6])
        elif len(digits) > 2:
            month = int(digits[:-2])
        rest = line[len(digits) :]
        for m in re.finditer(r"([A-Z]{2})([A-Z]{2})(-?\d+)|([A-Z]{2})([A-Z]{2})|([A-Z]{2})(-?\d+)", rest):
            a, b, n, old, new, code, points = m.groups()
            if a:
                state[a] = state.get(a, 0) + int(n)
                state[b] = state.get(b, 0) - int(n)
            elif code:
                state[code] = state.get(code, 0) + int(points)
            elif old in state:
                value = state.pop(old)
                if new != "XX":
                    state[new] = value
        snaps[year, month] = dict(state)
    out, held = {}, {}
    first, last = min(snaps), max(snaps)
    at = first
    while at <= last:
        held = snaps.get(at, held)
        out |= {(c, at): v for c, v in held.items()}
        at = (at[0] + (at[1] == 12), at[1] % 12 + 1)
    return out


LOG = "20240105AA100BB50\n07AABB-5CC10\n\n0310BBAA7\n12AADD\n1201DDBB3CCXX\n20250210CC4AA1\n15BBCC-2"


def test_rating_history(spark):
    lines = spark.createDataFrame(list(enumerate(LOG.split("\n"))), "line_no int, value string")
    got = {(r["code"], (r["month"].year, r["month"].month)): r["rating"] for r in ratings.rating_history(lines).collect()}
    assert got == fold_log(LOG)


def test_rankings(spark):
    text = "1\tx\tFR\t2000\n2\tx\tEN\t1990\n3\tx\tZZ\t1500\nbad\n4\tx\tFR\t1400\n5\tx\tXX\tnone\n6\tx\tKO\t1300"
    lines = spark.createDataFrame(list(enumerate(text.split("\n"))), "line_no int, value string")
    make = spark.createDataFrame
    got = ratings.parse_rankings(lines, make([("EN", "England")], "code string, name string"), make([("KO", "kr")], "code string, iso2 string"), make([("fr", 250, "France"), ("kr", 410, "Korea")], "iso2 string, id int, name string"), make([("fr",)], "iso2 string"))
    assert [(r["rank"], r["id"], r["name"], r["member"], r["flagged"]) for r in got.orderBy("rank").collect()] == [(1, 250, "France", True, False), (2, None, "England", False, True), (3, None, "ZZ", False, True), (6, 410, "Korea", False, False)]


def slow_kde(points, step, h):
    lat, lon = np.arange(-90 + step / 2, 90, step), np.arange(-180 + step / 2, 180, step)
    y, x = np.meshgrid(np.radians(lat), np.radians(lon), indexing="ij")
    out = np.zeros(y.shape)
    for a, b, w in points:
        a, b = np.radians(a), np.radians(b)
        d = 2 * 6371 * np.arcsin(np.sqrt(np.clip(np.sin((y - a) / 2) ** 2 + np.cos(a) * np.cos(y) * np.sin((x - b) / 2) ** 2, 0, 1)))
        out += np.where(d <= 4 * h, w / (2 * np.pi * h**2) * np.exp(-(d**2) / (2 * h**2)), 0)
    return out


def test_kde_is_that_of_all_cells(spark):
    points = [(48.0, 2.0, 3.0), (48.0, 2.0, 1.0), (-10.0, 179.9, 2.0), (0.3, -179.9, 1.0), (None, 1.0, 9.0)]
    df = spark.createDataFrame(points, "lat double, lon double, w double")
    want = slow_kde(points[:4], 2.5, 300)
    got = np.zeros(want.shape)
    for r in spatial.kde(df, "lat", "lon", "w", 2.5, 300).collect():
        got[r["i"], r["j"]] = r["density"]
    assert got == pytest.approx(want)
    area = 111.32**2 * 2.5**2 * np.cos(np.radians(np.arange(-90 + 1.25, 90, 2.5)))[:, None]
    assert (got * area).sum() == pytest.approx(7, rel=0.02)


def test_proportional_points_have_no_risk(spark):
    base = spark.createDataFrame([(10.0 * i, 20.0 * i, 1000.0) for i in range(5)], "lat double, lon double, w double")
    part = base.withColumn("w", F.col("w") / 100)
    out = spatial.relative_risk(part, base, ("lat", "lon", "w"), step=2.5, bandwidth_km=300, least_base=1e-9, smoothing=0.0)
    assert all(abs(r["log2_risk"]) < 1e-9 for r in out.collect())
    assert spatial.relative_risk(part.where("false"), base, ("lat", "lon", "w"), step=2.5, bandwidth_km=300).count() == 0


def test_local_maxima(spark):
    rng = np.random.default_rng(0)
    grid = rng.integers(0, 30, (12, 15)).astype(float)
    cells = [(i, j, float(grid[i, j])) for i in range(12) for j in range(15) if rng.random() < 0.7]
    have = {(i, j): v for i, j, v in cells}
    got = {(r["i"], r["j"]) for r in spatial.local_maxima(spark.createDataFrame(cells, "i int, j int, v double"), "v", 2).collect()}
    want = {(i, j) for (i, j), v in have.items() if v >= max(have.get((a, b), -1) for a in range(i - 2, i + 3) for b in range(j - 2, j + 3))}
    assert got == want


def slow_spearman(x, y):
    n = len(x)
    if n < 3:
        return None
    rank = lambda v: [sorted(v).index(a) + 1 for a in v]
    dx, dy = ([r - (n + 1) / 2 for r in rank(v)] for v in (x, y))
    return sum(a * b for a, b in zip(dx, dy)) / (sum(a * a for a in dx) * sum(b * b for b in dy)) ** 0.5


def test_spearman_with_ties(spark):
    data = [(1, 5.0), (2, 5.0), (2, 1.0), (9, 7.0), (4, None)]
    got = stats.spearman_min_rank(spark.createDataFrame(data, "x int, y double"), "x", "y").first()
    assert got["n"] == 4 and got["rho"] == pytest.approx(slow_spearman([1, 2, 2, 9], [5, 5, 1, 7]))


def test_names(spark):
    left = spark.createDataFrame([("fr", n) for n in ("Ana María Díaz", "Kylian Mbappé", "Jon Smith", "Pelé", "Ann Lee", "Bob Stone")], "nation string, name string")
    right = spark.createDataFrame([("fr", str(i), n) for i, n in enumerate(("A. Díaz", "Kylian Mbappé", "Jon Smyth", "Edson Pele", "L. Same", "L. Same", "B. Other", "Zed"))], "nation string, id string, name string")
    confirmed = spark.createDataFrame([("6", "Bob Stone")], "id string, left_name string")
    matched, ids, rest = names.match_names(left, right, "nation", "name", "id", "name", confirmed)
    got = {r["id"]: (r["left_name"], r["kind"]) for r in matched.collect()}
    assert got == {"0": ("Ana María Díaz", "middle-optional"), "1": ("Kylian Mbappé", "equal"), "2": ("Jon Smith", "phonetic"), "3": ("Pelé", "mononym"), "6": ("Bob Stone", "confirmed")}
    assert {r["id"] for r in ids.collect()} == {"4", "5", "7"} and [r["left_name"] for r in rest.collect()] == ["Ann Lee"]


@pytest.mark.parametrize(("a", "b", "want"), [("john smith", "smith", ("mononym", 1)), ("j smith", "john smith", ("initials+tail", 3)), ("john paul jones", "paul jones", ("tail", 4)), ("john paul", "john paul jones", ("prefix", 3)), ("ana luz diaz", "ana maria luz diaz", ("middle-optional", 3)), ("ann robert", "ann rupert", ("soundex", 0)), ("x y", "a b", None)])
def test_kinds_of_match(a, b, want):
    assert names.match_kind(a.split(), b.split()) == want


def test_gates(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, -1), (2, "b", 99)], "id int, name string, shirt int")
    found = gates.violations(df, [gates.Rule("shirt out of range", F.col("shirt").between(1, 98), "id"), gates.Rule("no name", F.col("name").isNotNull(), "id")])
    assert rows(found) == [("no name", "2"), ("shirt out of range", "2"), ("shirt out of range", "2")]
    assert rows(gates.duplicates(df, ["id"], "twice")) == [("twice", "2")]
    gates.require_empty(found, ["no name", "shirt out of range"])
    with pytest.raises(gates.GateFailed, match="no name"):
        gates.require_empty(found, ["shirt out of range"])


def test_json_diff(spark):
    old = spark.createDataFrame([(1, '{"a": [1, {"b": 2}], "c": {}}')], "k int, doc string")
    new = spark.createDataFrame([(1, '{"c": {}, "a": [1, {"b": 3}, 4]}')], "k int, doc string")
    assert rows(gates.json_diff(old, new, "k", "doc")) == [(1, "$.a[1].b", "2", "3"), (1, "$.a[2]", None, "4")]
    assert gates.json_diff(old, old, "k", "doc").isEmpty()


def test_json_of_any_depth(spark):
    """Deep documents end in leaves, deeper than the parser goes are leaves; what is no JSON is a string; values keep their kinds."""
    deep = lambda n, x: "[" * n + x + "]" * n
    many = '{"a": {"b": {"c": {"d": {"e": {"f": {"g": [1, {"h": "x\\"y", "i": null, "j": true, "k": [], "l": 2.5}]}}}}}}}}'
    texts = [(1, many), (2, deep(40, "7")), (3, deep(200_000, "")), (4, "[" * 200_000), (5, "no json"), (6, '"é"'), (7, None), (8, "{}"), (9, '{"a.b": 1, "": 2}')]
    df = spark.createDataFrame(texts, "k int, doc string")
    got = {(r["k"], r["path"]): r["leaf"] for r in gates.json_leaves(df, "k", "doc").collect()}
    at = "$.a.b.c.d.e.f.g"
    want = {(1, f"{at}[0]"): "1", (1, f"{at}[1].h"): '"x\\"y"', (1, f"{at}[1].i"): "null", (1, f"{at}[1].j"): "true", (1, f"{at}[1].k"): "[]", (1, f"{at}[1].l"): "2.5", (2, "$" + "[0]" * 40): "7"}
    want |= {(3, "$"): f'"{texts[2][1]}"', (4, "$"): f'"{texts[3][1]}"', (5, "$"): '"no json"', (6, "$"): '"é"', (8, "$"): "{}", (9, "$.a.b"): "1", (9, "$."): "2"}
    assert got == want
    assert gates.json_leaves(df.where("false"), "k", "doc").collect() == []
    changed = df.withColumn("doc", F.when(F.col("k") == 2, F.lit(deep(40, "8"))).otherwise(F.col("doc"))).where("k <> 8")
    assert rows(gates.json_diff(df, changed, "k", "doc"), "k", "old", "new") == [(2, "7", "8"), (8, "{}", None)]


def test_densify_and_latest(spark):
    d = datetime.date
    df = spark.createDataFrame([("a", d(2024, 1, 1), 1), ("a", d(2024, 3, 1), 2), ("b", d(2024, 2, 1), 7)], "k string, m date, v int")
    assert rows(R.densify(df, "k", "m", "v")) == [("a", d(2024, 1, 1), 1), ("a", d(2024, 2, 1), 1), ("a", d(2024, 3, 1), 2), ("b", d(2024, 2, 1), 7), ("b", d(2024, 3, 1), 7)]
    assert R.densify(df.where("false"), "k", "m", "v").count() == 0
    assert rows(R.latest_by(df, "k", ["m"])) == [("a", d(2024, 3, 1), 2), ("b", d(2024, 2, 1), 7)]


def test_nested(spark):
    df = spark.createDataFrame([(0, "fr", "x"), (2, "fr", None), (3, "de", "z")], "pid int, nation string, title string")
    assert R.array_by_key(df, "pid", "title").first()[0] == ["x", None, None, "z"]
    assert R.array_by_key(df.where("false"), "pid", "title").first()[0] == []
    by = {r["nation"]: r["entries"] for r in R.nested_map(df, "nation", "pid", ["title"]).collect()}
    assert by["fr"]["0"]["title"] == "x" and by["fr"]["2"]["title"] is None


def test_index_misses_no_match():
    import itertools

    pool = ["ana", "a", "maria", "m", "diaz", "d", "dias", "smith", "smyth", "jon", "robert", "rupert"]
    every = [list(p) for n in (1, 2, 3) for p in itertools.permutations(pool, n)][::7]
    index = names._Index([(" ".join(p), p) for p in every])
    for p in every[::11]:
        found = set(index.candidates(" ".join(p), p))
        assert {j for j, q in enumerate(every) if names.match_kind(p, q)} <= found


def test_staged_files_go(spark):
    import os

    from fieldglass import staging

    folder = staging.shared_folder(spark)
    before = set(os.listdir(folder))
    first = staging.stage(spark.range(3))
    out = staging.stage_only(lambda: staging.stage(spark.range(5)).union(staging.stage(spark.range(2))))
    assert out.count() == 7 and first.count() == 3 and len(set(os.listdir(folder)) - before) == 2
    staging.drop(first)
    staging.drop(spark.range(1))
    staging.drop(out)
    assert set(os.listdir(folder)) == before
