"""Published versions: whole or not at all, whatever goes wrong on the way, and readable by name."""

import json

import pytest
from pyspark.sql import functions as F

from fieldglass.operators.documents import DOCUMENTS
from fieldglass.operators.gates import GateFailed
from fieldglass.sources import versions

DOCS = {"total": ((lambda t: t["a"].agg(F.sum("v").alias("sum"))), False), "by": ((lambda t: t["a"].agg(F.map_from_entries(F.collect_list(F.struct(F.col("k"), "v"))).alias("document"))), True)}


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def seen(spark, folder):
    now = versions.open_version(spark, folder)
    return now.name, sorted(tuple(r) for r in now.table("a").collect()), sorted(tuple(r) for r in now.table("b").collect()), json.loads(now.document("total")), json.loads(now.document("by"))


class Crash(Exception):
    pass


def test_a_crash_at_any_step_leaves_the_version_before(spark, tmp_path):
    folder = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        versions.open_version(spark, folder)
    one = {"a": frame(spark, [("x", 1), ("y", 2)]), "b": frame(spark, [("z", 3)])}
    versions.publish(spark, folder, one, DOCS, name="one")
    whole = ("one", [("x", 1), ("y", 2)], [("z", 3)], {"sum": 3}, {"x": 1, "y": 2})
    assert seen(spark, folder) == whole
    steps = []
    two = {"a": frame(spark, [("x", 5)]), "b": frame(spark, [])}
    versions.publish(spark, str(tmp_path / "other"), two, DOCS, findings=lambda t: spark.createDataFrame([], "kind string, detail string"), step=steps.append)
    assert steps == ["table a", "table b", "findings", "document total", "document by", "manifest", "pointer"]
    for stop in steps:
        held = versions.open_version(spark, folder)

        def crash(what, stop=stop):
            assert seen(spark, folder) == whole  # a reader between any two steps
            if what == stop:
                raise Crash(what)

        with pytest.raises(Crash):
            versions.publish(spark, folder, two, DOCS, findings=lambda t: spark.createDataFrame([], "kind string, detail string"), step=crash)
        assert seen(spark, folder) == whole and versions.versions(spark, folder) == ["one"]
    versions.publish(spark, folder, two, DOCS, name="two", step=lambda what: None)
    assert seen(spark, folder) == ("two", [("x", 5)], [], {"sum": 5}, {"x": 5})
    assert versions.versions(spark, folder) == ["one", "two"]
    assert held.name == "one" and held.table("a").count() == 2  # who opened the old one goes on with it
    assert versions.open_version(spark, folder, "one").document("total") == '{"sum":3}'


def test_what_is_refused(spark, tmp_path):
    folder = str(tmp_path / "model")
    versions.publish(spark, folder, {"a": frame(spark, [("x", 1)])}, name="one")
    with pytest.raises(FileExistsError):
        versions.publish(spark, folder, {"a": frame(spark, [])}, name="one")
    with pytest.raises(GateFailed):
        versions.publish(spark, folder, {"a": frame(spark, [])}, findings=lambda t: spark.createDataFrame([("bad", "row")], "kind string, detail string"))
    with pytest.raises(ValueError, match="one row"):
        versions.publish(spark, folder, {"a": frame(spark, [("x", 1), ("y", 2)])}, {"d": (lambda t: t["a"], False)})
    assert versions.versions(spark, folder) == ["one"]
    now = versions.open_version(spark, folder)
    for missing in (lambda: now.table("b"), lambda: now.document("d"), lambda: versions.open_version(spark, folder, "none"), lambda: versions.table_diff(spark, folder, "a", "k", "v", "v")):
        with pytest.raises(KeyError):
            missing()


def test_differences_by_name(spark, tmp_path):
    folder = str(tmp_path / "model")
    for name, rows in (("one", [("x", 1), ("y", 2)]), ("two", [("x", 1), ("y", 3)]), ("three", [("y", 3), ("z", 4)])):
        versions.publish(spark, folder, {"a": frame(spark, rows)}, DOCS, name=name)
    kinds = lambda **o: sorted((r["k"], r["kind"]) for r in versions.table_diff(spark, folder, "a", "k", "v", "v", **o).collect())
    assert kinds() == [("x", "removed"), ("z", "added")] and kinds(old="one") == [("x", "removed"), ("y", "changed"), ("z", "added")] and kinds(old="one", new="two") == [("y", "changed")]
    leaves = sorted(tuple(r) for r in versions.document_diff(spark, folder, new="two").collect())
    assert leaves == [("by", "$.y", "2", "3"), ("total", "$.sum", "3", "4")]


def test_registry_is_rewritten_from_itself(spark, tmp_path):
    folder = str(tmp_path / "registry")
    for i in range(3):
        versions.rewrite_registry(spark, folder, lambda before, i=i: frame(spark, [(f"k{i}", i)]) if before is None else before.unionByName(frame(spark, [(f"k{i}", i)])))
    assert sorted(r["v"] for r in versions.open_version(spark, folder).table("registry").collect()) == [0, 1, 2]


def test_documents_of_an_empty_model(spark, middle):
    from fieldglass.plans.files import _model

    tables = {name: df.limit(0) for name, df in _model(spark, middle).items()}
    made = {name: make(tables) for name, (make, _) in DOCUMENTS.items()}
    assert len(made) == 10 and all(df.count() == 1 for df in made.values())
    assert made["map"].first()["data"] == [] and made["status"].first()["document"] == {} and made["wiki_fr"].first()["titles"] == []
