"""Written intermediate results, and prefix sums over rows of any number."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Sequence
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors reach. Where that is unset, one of our own: in the warehouse, or, if
    there is one machine only, among its temporary files. On a cluster whose warehouse is a local folder there is none, and the
    call fails: each executor would write to its own disk."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            folder = tempfile.mkdtemp(prefix="fieldglass-")
        else:
            warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
            scheme = re.match("[A-Za-z][A-Za-z0-9+.-]*(?=:)", warehouse)
            if (scheme[0] if scheme else _file_system(spark, warehouse)[0].getScheme()) == "file":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors reach: the warehouse is a local one")
            folder = f"{warehouse}/fieldglass-staged"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Paths that were staged since the `stage_only` that this thread, or whoever started it, is in.
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared folder for files that go when the JVM ends."""
    path = f"{shared_folder(spark)}/files-{uuid4().hex}"
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


def stage(df: DataFrame, **options: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder, with any options of the writer, and read it back.

    This cuts the lineage: what an executor had computed survives its loss, and rows that depend on how they were
    dealt out stay as they are. The files go when the JVM ends, or before by `drop` or `stage_only`.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid4().hex}"
    df.write.options(**options).parquet(path)
    fs, target = _file_system(spark, path)
    fs.deleteOnExit(target)
    staged = _staged.get()
    if staged is not None:
        staged.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def drop(df: DataFrame) -> None:
    """Delete the files of a frame that `stage` returned, once nothing reads it any more; does nothing for other frames."""
    path = getattr(df, "staged_path", None)
    if isinstance(path, str):
        _delete(df.sparkSession, path)


def stage_only(make: Callable[[], DataFrame]) -> DataFrame:
    """Stage what `make` returns, and delete all that it staged on the way to it."""
    own: list[str] = []
    token = _staged.set(own)
    try:
        made = make()
    finally:
        _staged.reset(token)
    out = stage(made)
    for path in own:
        _delete(out.sparkSession, path)
    return out


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each name, the name itself or with underscores added until `df` has no such column (letter case aside)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Add for each (out, value) of `sums` the sum of `value` over the rows before, within `keys`, in the order `order`.

    Rows are dealt out by ranges of (keys, order), so that a key of any size lies over many tasks. Each task's total
    for each key (there are at most as many as tasks and keys together) gives the sum at which it starts; the rest
    is a window within the task. `df` should be narrow and staged, as it is read twice; keys and values hold no null.
    Rows that tie in `order` get their sums in any order; give a total order to fix them.
    """
    part, = fresh(df, "part")
    dealt = df.repartitionByRange(shuffle_partitions(df.sparkSession), *keys, *order)
    dealt = stage(dealt.withColumn(part, F.spark_partition_id()))
    totals = dealt.groupBy(part, *keys).agg(*(F.sum(v).alias(f"{out} total") for out, v in sums.items()))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, 0)
    starts = totals.select(part, *keys, *((F.sum(f"{out} total").over(before) - F.col(f"{out} total")).alias(f"{out} start") for out in sums))
    within = Window.partitionBy(part, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.select("*", *((F.sum(v).over(within) - F.col(v)).alias(f"{out} within") for out, v in sums.items()))
    return summed.join(starts, [part, *keys]).select(
        *df.columns, *((F.col(f"{out} start") + F.col(f"{out} within")).alias(out) for out in sums)
    )


def carry(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], own: bool = True) -> DataFrame:
    """Add for each (out, value) of `values` the last `value` that isn't null, within `keys`, in the order `order`, of the rows
    up to this one (before this one, if not `own`); null where there is none.

    A scan as in `running_total`: rows are dealt out by ranges of (keys, order); each task's last value (one row a task and
    key) is carried on to the tasks after it, and within a task it is a window. `df` should be narrow; keys hold no null. Rows
    that tie in `order` see each other's values in any order; give a total order to fix them.
    """
    part, = fresh(df, "part")
    dealt = df.repartitionByRange(shuffle_partitions(df.sparkSession), *keys, *order)
    dealt = stage(dealt.withColumn(part, F.spark_partition_id()))
    place = F.struct(*order)
    ends = dealt.groupBy(part, *keys).agg(*(F.max_by(v, F.when(F.col(v).isNotNull(), place)).alias(f"{out} end") for out, v in values.items()))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(part, *keys, *(F.last(f"{out} end", True).over(before).alias(f"{out} start") for out in values))
    within = Window.partitionBy(part, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    seen = dealt.select("*", *(F.last(v, True).over(within).alias(f"{out} within") for out, v in values.items()))
    return seen.join(starts, [part, *keys]).select(*df.columns, *(F.coalesce(f"{out} within", f"{out} start").alias(out) for out in values))


def numbered(df: DataFrame, order: Sequence[str], out: str, first: int = 0) -> DataFrame:
    """`df` with the number of each row in the order `order`, from `first` on. Rows that tie get their numbers in any order."""
    one, = fresh(df, "one")
    counted = running_total(df.withColumn(one, F.lit(1).cast("long")), [], order, {out: one})
    return counted.withColumn(out, F.col(out) + first).drop(one)
