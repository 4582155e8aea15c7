"""Sinks: results put in place whole, or not at all."""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.operators.relational import changed


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _put(spark: SparkSession, staged: str, path: str) -> None:
    """Move what is whole in `staged` to `path`. What was there is moved aside first and deleted last, so that a crash at any
    point leaves the old or the new whole, beside `path` at worst."""
    fs, target = _fs(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{staged}.old")
    if fs.exists(target) and not fs.rename(target, aside):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(staged), target):
        if fs.exists(aside):
            fs.rename(aside, target)
        raise OSError(f"could not move {staged} to {path}")
    fs.delete(aside, True)


def write_atomic(df: DataFrame, path: str, **options: str) -> None:
    """Parquet in `path`: written beside it first, and put in its place once whole."""
    staged = f"{path.rstrip('/')}.{uuid4().hex}.new"
    df.write.options(**options).parquet(staged)
    _put(df.sparkSession, staged, path)


def write_model(tables: dict[str, DataFrame], folder: str) -> None:
    """All tables of a model, staged before any is put in place."""
    spark, staged = next(iter(tables.values())).sparkSession, f"{folder.rstrip('/')}.{uuid4().hex}.new"
    for name, df in tables.items():
        df.write.parquet(f"{staged}/{name}.parquet")
    _put(spark, staged, folder)


def write_if_changed(df: DataFrame, path: str) -> bool:
    """Write Parquet only if the rows there differ; tells whether it did."""
    fs, target = _fs(df.sparkSession, path)
    if fs.exists(target) and not changed(df.sparkSession.read.parquet(path), df):
        return False
    write_atomic(df, path)
    return True


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """One small file."""
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode("utf-8"))


def as_json(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """Each row as minified JSON; fields without a value are left out unless kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value"))


def write_json_document(df: DataFrame, path: str, keep_nulls: bool = False, pretty: bool = False) -> None:
    """A result of one row as one JSON file, minified, or indented and with a line end."""
    rows = as_json(df, keep_nulls).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("a JSON document is one row")
    text = rows[0]["value"]
    if pretty:
        text = json.dumps(json.loads(text), ensure_ascii=False, indent=2) + "\n"
    write_text(df.sparkSession, path, text)


def write_csv(df: DataFrame, folder: str, bom: bool = False) -> None:
    """CSV with a header: a folder of part files; with `bom`, the first name has a byte-order mark before it."""
    names = [("﻿" if bom and not i else "") + c for i, c in enumerate(df.columns)]
    df.toDF(*names).write.mode("overwrite").option("header", True).option("escape", '"').csv(folder)


def write_csv_file(df: DataFrame, path: str, bom: bool = False) -> None:
    """CSV with a header in one file, put in place once whole: for results that one task can write."""
    spark, staged = df.sparkSession, f"{path}.{uuid4().hex}.parts"
    write_csv(df.coalesce(1), staged, bom)
    fs, _ = _fs(spark, path)
    parts = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{staged}/part-*"))
    _put(spark, parts[0].getPath().toString(), path)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(staged), True)


def write_profile(wide: DataFrame, latest: DataFrame, folder: str, bom: bool = False) -> None:
    """A profile as a pair of CSV folders: `wide` with all its rows, `latest` with each entity's last."""
    for name, df in (("wide", wide), ("latest", latest)):
        write_csv(df, f"{folder.rstrip('/')}/{name}", bom)


def write_grid(cells: DataFrame, path: str, rows: int, columns: int, value: str, digits: int = 3) -> None:
    """A grid as one JSON document: its size, and the values row by row from the south, null where masked. For a grid that
    one file is to hold; as Parquet it can be of any size."""
    spark = cells.sparkSession
    slots = spark.range(rows * columns).select(F.floor(F.col("id") / columns).cast("int").alias("i"), (F.col("id") % columns).cast("int").alias("j"))
    filled = slots.join(cells.select("i", "j", F.round(value, digits).alias("v")), ["i", "j"], "left")
    packed = F.transform(F.array_sort(F.collect_list(F.struct("i", "j", "v"))), lambda c: c["v"])
    write_json_document(filled.agg(F.lit(rows).alias("ny"), F.lit(columns).alias("nx"), packed.alias("values")), path, keep_nulls=True)
