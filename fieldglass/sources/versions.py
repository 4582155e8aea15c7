"""A model of tables and documents under versions: written whole, published by one pointer, and readable by name ever after."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.operators.gates import json_diff, require_empty
from fieldglass.operators.relational import snapshot_diff
from fieldglass.sources.sinks import _fs, as_json, write_text

#: A document: what makes its one row from the tables (fields, or one column `document`), and whether fields without a value stay.
Document = tuple[Callable[[Mapping[str, DataFrame]], DataFrame], bool]


@dataclass(frozen=True)
class Version:
    """What was published under one name. Its files never change."""

    spark: SparkSession
    folder: str
    name: str
    tables: tuple[str, ...]
    documents: tuple[str, ...]

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"version {self.name} has no table {name}")
        return self.spark.read.parquet(f"{_at(self.folder, self.name)}/tables/{name}.parquet")

    def document(self, name: str) -> str:
        return self.documents_as_rows(name).first()["text"]

    def documents_as_rows(self, *names: str) -> DataFrame:
        """(document, text) of the documents named, or of all."""
        for n in names:
            if n not in self.documents:
                raise KeyError(f"version {self.name} has no document {n}")
        paths = [f"{_at(self.folder, self.name)}/documents/{n}.json" for n in names or self.documents]
        if not paths:
            return self.spark.createDataFrame([], "document string, text string")
        name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
        return self.spark.read.text(paths, wholetext=True).select(F.url_decode(name).alias("document"), F.col("value").alias("text"))


def _at(folder: str, version: str) -> str:
    return f"{folder.rstrip('/')}/versions/{version}"


def _pointers(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the pointers, the first published first."""
    fs, target = _fs(spark, f"{folder.rstrip('/')}/published")
    if not fs.exists(target):
        return []
    paths = [s.getPath() for s in fs.listStatus(target)]
    return sorted(p.toString() for p in paths if p.getName().isdigit())


def _read(spark: SparkSession, paths: list[str]) -> list[str]:
    if not paths:
        return []
    rows = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").collect()
    by_number = sorted((r["path"].rsplit("/", 1)[-1], r["value"]) for r in rows)
    return [value for _, value in by_number]


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Names of what was published, the first first."""
    return [json.loads(t)["version"] for t in _read(spark, _pointers(spark, folder))]


def open_version(spark: SparkSession, folder: str, name: str | None = None) -> Version:
    """The version of that name, or the one published last. What it returns stays as it is, whatever is published meanwhile."""
    if name is None:
        paths = _pointers(spark, folder)
        if not paths:
            raise FileNotFoundError(f"nothing is published in {folder}")
        name = json.loads(_read(spark, paths[-1:])[0])["version"]
    elif name not in versions(spark, folder):
        raise KeyError(f"{name} is not published in {folder}")
    known = json.loads(_read(spark, [f"{_at(folder, name)}/manifest.json"])[0])
    return Version(spark, folder, name, tuple(known["tables"]), tuple(known["documents"]))


def publish(
    spark: SparkSession, folder: str, tables: Mapping[str, DataFrame], documents: Mapping[str, Document] | None = None, *,
    name: str | None = None, findings: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None, step: Callable[[str], None] = lambda what: None,
) -> Version:
    """Write a version and publish it.

    The tables are written first and read again; what `findings` then finds in them fails the publication; the documents are
    made from the tables as written, so that all are of one state; a manifest names them; and the pointer, one small file that
    is moved into place, comes last. Until then readers see the version before, and then this one, whole. A crash at any step
    leaves files that no pointer names. Of two publications at a time each gets a pointer of its own, or fails.

    `step` is told each step before it is taken.
    """
    name = name or uuid4().hex
    place, staged = _at(folder, name), {}
    fs, target = _fs(spark, place)
    if fs.exists(target):
        raise FileExistsError(f"version {name} is there already")
    for table, df in tables.items():
        step(f"table {table}")
        df.write.parquet(f"{place}/tables/{table}.parquet")
        staged[table] = spark.read.schema(df.schema).parquet(f"{place}/tables/{table}.parquet")
    if findings:
        step("findings")
        require_empty(findings(staged))
    for document, (make, keep_nulls) in (documents or {}).items():
        step(f"document {document}")
        made = make(staged)
        whole = made.select(F.to_json("document", {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value")) if made.columns == ["document"] else as_json(made, keep_nulls)
        rows = whole.limit(2).collect()
        if len(rows) != 1:
            raise ValueError(f"document {document} is one row")
        write_text(spark, f"{place}/documents/{document}.json", rows[0]["value"])
    step("manifest")
    write_text(spark, f"{place}/manifest.json", json.dumps({"tables": list(tables), "documents": list(documents or {})}))
    step("pointer")
    _point(spark, folder, name)
    return open_version(spark, folder, name)


def _point(spark: SparkSession, folder: str, name: str) -> None:
    """Put a pointer of the next number in place; it is written elsewhere and moved, and never replaces another."""
    paths = _pointers(spark, folder)
    number = int(paths[-1].rsplit("/", 1)[-1]) + 1 if paths else 1
    ready = f"{folder.rstrip('/')}/ready/{uuid4().hex}"
    write_text(spark, ready, json.dumps({"version": name}))
    fs, target = _fs(spark, f"{folder.rstrip('/')}/published/{number:012d}")
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(_fs(spark, ready)[1], target):
        raise OSError(f"another version was published in {folder} meanwhile")


def rewrite_registry(spark: SparkSession, folder: str, assign: Callable[[DataFrame | None], DataFrame], table: str = "registry") -> Version:
    """A registry's next version: what `assign` makes of the last one (None, the first time), published whole. Readers of the old
    one, `assign` itself among them, aren't disturbed."""
    before = open_version(spark, folder).table(table) if _pointers(spark, folder) else None
    return publish(spark, folder, {table: assign(before)})


def table_diff(spark: SparkSession, folder: str, table: str, key: str, value: str, rank: str, old: str | None = None, new: str | None = None) -> DataFrame:
    """`snapshot_diff` of a table between two versions, the last two if not named."""
    a, b = _two(spark, folder, old, new)
    return snapshot_diff(a.table(table), b.table(table), key, value, rank, keep_ranks=True)


def document_diff(spark: SparkSession, folder: str, old: str | None = None, new: str | None = None) -> DataFrame:
    """(document, path, old, new) of the leaves in which the documents of two versions differ, the last two if not named."""
    a, b = _two(spark, folder, old, new)
    return json_diff(a.documents_as_rows(), b.documents_as_rows(), "document", "text")


def _two(spark: SparkSession, folder: str, old: str | None, new: str | None) -> tuple[Version, Version]:
    known = versions(spark, folder)
    new = new or (known[-1] if known else None)
    if old is None:
        before = known[: known.index(new)] if new in known else []
        if not before:
            raise KeyError(f"no version before {new}")
        old = before[-1]
    return open_version(spark, folder, old), open_version(spark, folder, new)
