"""Sharding by global byte-size prefix sums. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_total, stage


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """Deal documents to `shards` contiguous shards of near equal bytes.

    The documents lie in the order of a text hash, so that equal texts stand side by side and the order owes nothing
    to the way the input is split. A document's start is the sum of the sizes before it; it goes to the shard in whose
    equal share of all bytes its middle falls. So no shard is off its share by more than its two border documents.

    Returns id, size (UTF-8 bytes plus `overhead`), text_crc32, shard, slot (gapless from 0 in each shard), start.

    Nulls: a null text counts as an empty one; a null id is kept and returned as null. Repeated rows are rows of their
    own. Rows alike in text and id get their slots in any order. An empty table gives no rows. Other columns, whatever
    their names, are not looked at.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = stage(
        docs.select(
            F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"), F.md5(text.cast("binary")).alias("text_hash"),
        )
    )
    #: Copies without number, even of one id, can still be dealt to many tasks: the row number parts them.
    narrow = narrow.withColumn("row", F.monotonically_increasing_id()).withColumn("one", F.lit(1).cast("long"))
    placed = stage(running_total(narrow, [], ["text_hash", "doc_id", "row"], {"start": "size", "rank": "one"}))
    total = placed.agg(F.sum("size")).first()[0] or 1
    share = F.expr(f"(CAST(2 * start + size AS DECIMAL(38, 0)) * {shards}) DIV CAST({2 * total} AS DECIMAL(38, 0))")
    shard = F.least(F.lit(shards - 1), share.cast("int"))
    cut = placed.withColumn("shard", shard)
    first = cut.groupBy("shard").agg(F.min("rank").alias("first_rank"))  # one row a shard
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first_rank")).alias("slot"), "start"
    )
