"""Session builder and table access."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def build(master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, adaptive execution and Arrow on; `conf` overrides any setting."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    builder = SparkSession.builder.appName("fieldglass")
    if master or "SPARK_MASTER" in os.environ:
        builder = builder.master(master or os.environ["SPARK_MASTER"])
    return builder.config(map=defaults | conf).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` in `sf_dir`, a path of any file system that Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
