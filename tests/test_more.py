"""Long lines, crashes, services, far and many points, folders: what the queries don't reach."""

import json
import threading
import time
from functools import partial
from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from fieldglass import staging
from fieldglass.functions import text
from fieldglass.operators import names, ratings, spatial
from fieldglass.sources import readers, sinks


def test_log_line_of_very_many_tokens(spark):
    began = time.monotonic()
    line = "20240101" + "ABCD5" * 50_000 + "AB-1" + "?" + "EF2" * 10
    got = ratings.parse_log(spark.createDataFrame([(1, line), (2, "x ABCD5"), (3, "0203ABXX")], "line_no int, value string"))
    assert got.groupBy("kind").count().orderBy("kind").collect() == [("adjust", 1), ("match", 50_000), ("rename", 1)] and time.monotonic() - began < 20


def test_titles(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(text.title_of_link(F.lit("/wiki/100%_Wolf"))) == "100% Wolf" and one(text.title_of_link(F.lit("/wiki/50%25_%zz%2"))) == "50% %zz%2"
    assert one(text.link_of_title(F.lit("C++"))) == "C++" and one(text.surname(F.lit("Anis Ben Slimane"))) == "Ben Slimane" and one(text.surname(F.lit("Ben Foster"))) == "Foster"


def test_kinds_of_matches_in_results(spark):
    left = spark.createDataFrame([("b", "John Paul Jones"), ("b", "José X"), ("b", "Ann Robert"), ("b", "Ann Robart")], "block string, name string")
    right = spark.createDataFrame([("b", "1", "Paul Jones"), ("b", "2", "jose x"), ("b", "3", "Ann Rupert")], "block string, id string, other string")
    found, no_id, no_name = names.match_names(left, right, "block", "name", "id", "other")
    assert sorted((r["id"], r["left_name"], r["kind"]) for r in found.collect()) == [("1", "John Paul Jones", "initials+tail"), ("2", "José X", "norm"), ("3", "Ann Robert", "soundex")]
    assert no_id.count() == 0 and no_name.count() == 1


def test_nearest_by_cells_as_by_pairs(spark, monkeypatch):
    """Everywhere on the globe, with ties, at the poles and across the date line; with very few points too."""
    import random

    rng = random.Random(2)
    at = lambda: (rng.choice((-90.0, 90.0, rng.uniform(-90, 90))), rng.choice((-180.0, 180.0, rng.uniform(-180, 180))))
    rows = spark.createDataFrame([(i, *at()) for i in range(60)] + [(99, None, 1.0)], "id int, lat double, lon double")
    for n in (0, 1, 3, 400):
        points = spark.createDataFrame([(f"p{i}", *at()) for i in range(n)] + [("tie", 10.0, 10.0), ("tie2", 10.0, 10.0), ("none", None, 0.0)][: 3 if n else 0], "name string, y double, x double")
        near = lambda: sorted((r["id"], r["nearest"]["name"], round(r["km"], 6)) for r in spatial.nearest(rows, points, "lat", "lon", "y", "x", ["name"]).collect())  # noqa: B023, E731
        monkeypatch.setattr(spatial, "MAX_BROADCAST_POINTS", 200_000)
        want = near()
        monkeypatch.setattr(spatial, "MAX_BROADCAST_POINTS", 0)
        assert near() == want and len(want) == (60 if n else 0)


def test_a_crash_keeps_the_old(spark, tmp_path, monkeypatch):
    """Where the new can't be put in place, the old stays whole."""
    path = tmp_path / "t"
    sinks.write_atomic(spark.range(3), str(path))

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            return ".new" not in a.toString().rpartition("/")[2] or a.toString().endswith(".old") if a.toString().endswith(".new") else self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    real = sinks._fs
    monkeypatch.setattr(sinks, "_fs", lambda spark, p: (Broken(real(spark, p)[0]), real(spark, p)[1]))
    with pytest.raises(OSError, match="could not move"):
        sinks.write_atomic(spark.range(9), str(path))
    assert spark.read.parquet(str(path)).count() == 3


def test_service_over_http(spark, tmp_path):
    """Pages are read until the last, each by a task of its own; a page that is missing fails the query."""
    for i in (1, 2, 3):
        (tmp_path / f"page-{i}.json").write_text(json.dumps({"page": i, "pages": 3, "rows": [{"a": i}, {"a": 10 * i}]}))
    server = ThreadingHTTPServer(("127.0.0.1", 0), partial(SimpleHTTPRequestHandler, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        address = f"http://127.0.0.1:{server.server_port}/page-{{page}}.json"
        found = readers.read_service(spark, address, "a int", "rows")
        assert sorted(r["a"] for r in found.collect()) == [1, 2, 3, 10, 20, 30]
        (tmp_path / "page-2.json").unlink()
        with pytest.raises(Exception, match="404"):
            readers.read_service(spark, address, "a int", "rows", tries=1).collect()
    finally:
        server.shutdown()
    (tmp_path / "page-2.json").write_text(json.dumps({"page": 2, "pages": 3, "rows": []}))
    files = readers.read_service(spark, f"{tmp_path}/page-{{page}}.json", "a int", "rows")
    assert sorted(r["a"] for r in files.collect()) == [1, 3, 10, 30]


def test_folder_for_stages(spark, monkeypatch):
    """The session's setting; without it a folder among temporary files on one machine, and in the warehouse on a cluster."""

    class Conf(dict):
        set = dict.__setitem__

    class Session:
        def __init__(self, master, **conf):
            self.conf, self.sparkContext = Conf(conf), type("C", (), {"master": master})

    assert staging.shared_folder(Session("local[4]", **{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    on_cluster = Session("spark://host:7077", **{"spark.sql.warehouse.dir": "hdfs://x/warehouse/"})
    assert staging.shared_folder(on_cluster) == "hdfs://x/warehouse/fieldglass-staged" == on_cluster.conf["spark.checkpoint.dir"]
    assert "fieldglass-" in staging.shared_folder(Session("local[*]"))


def test_lookup_batches(spark):
    rows = spark.createDataFrame([(f"t{i:03}",) for i in range(120)] * 2 + [(None,)], "t string")
    got = {r["batch"]: r["request"].split("|") for r in readers.lookup_batches(rows, "t").collect()}
    assert {k: len(v) for k, v in got.items()} == {0: 50, 1: 50, 2: 20} and got[1][0] == "t050"
