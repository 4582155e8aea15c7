"""Structured Streaming over an event table: an addition, as everything else here runs as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_stream(spark: SparkSession, folder: str, schema: str, files_at_once: int = 16) -> DataFrame:
    """Parquet files that come into a folder, a bounded number at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def windowed_totals(events: DataFrame, at: str, keys: list[str], value: str, late: str = "1 day", width: str = "1 day") -> DataFrame:
    """Counts and sums by window and keys; rows later than `late` are left out, so state is bounded."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, at: str, key: str, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Sessions of each key: runs of events without a longer gap."""
    s = F.session_window(at, gap)
    return events.withWatermark(at, late).groupBy(s.alias("s"), key).agg(F.count("*").alias("n")).select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def keep_latest(updates: DataFrame, path: str, checkpoint: str, key: str, order: str) -> StreamingQuery:
    """Keep a table of each key's latest row in `path`, one version a batch: each batch is merged with the version before
    and written as the next, so a repeated batch writes the same again."""
    from fieldglass.operators.relational import latest_by

    def merge(batch: DataFrame, number: int) -> None:
        spark, target = batch.sparkSession, f"{path}/v{number}"
        if number:
            batch = batch.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/v{number - 1}"))
        latest_by(batch, key, [order]).write.mode("overwrite").parquet(target)

    return updates.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
