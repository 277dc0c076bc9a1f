"""Contiguous shards of nearly equal bytes (operator 4).

The byte size of every row before a row decides its shard, so shards are
contiguous in key order and each cut lies within one row of its target. The
global prefix sum has three parts, none of which gathers rows in one task:
a running sum inside each key range, the totals of the ranges (one row per
range), and their prefix sum.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Saved, saved

#: Rows of one key range: a range is the unit of the running sum.
RANGE_ROWS = 100_000


def byte_shards(df: DataFrame, n_shards: int, key: str = "doc_id", size: str = "size",
                ties: list[str] | None = None) -> DataFrame:
    """Add ``shard`` (0 .. n_shards-1) and ``slot`` (gapless from 0 in a shard).

    ``df`` is a narrow table: the key, a positive size and columns that break
    ties (rows equal in all of them are interchangeable; each still gets its
    own slot). A row belongs to the shard in which the middle of its bytes
    falls. Null keys come first. An empty table gives an empty table.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    order = [F.col(c).asc_nulls_first() for c in [key, *(ties or [])]]
    rows = Saved(df, "shard-rows")
    n = rows.df.count()
    parts = max(1, math.ceil(n / RANGE_ROWS))
    ranged = Saved(rows.df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "shard-ranges")
    rows.drop()
    # one row per range: exclusive prefix of rows and bytes
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.df.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.sum(size).alias("_b"))
    before = totals.select("_range", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_n0"),
                           F.coalesce(F.sum("_b").over(upto), F.lit(0)).alias("_b0"))
    total = ranged.df.agg(F.sum(size)).first()[0] or 0
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (ranged.df.withColumn("_b1", F.sum(size).over(inside)).withColumn("_n1", F.count(F.lit(1)).over(inside))
              .join(before, "_range")
              .withColumn("_mid", 2 * (F.col("_b0") + F.col("_b1")) - F.col(size))
              .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(f"_mid * {n_shards}L div {2 * max(total, 1)}L")).cast("int"))
              .withColumn("_row", F.col("_n0") + F.col("_n1") - 1))
    out = saved(placed.select(*df.columns, "shard", "_row"), "shard-placed")
    ranged.drop()
    first = out.groupBy("shard").agg(F.min("_row").alias("_first"))  # n_shards rows
    return (out.join(F.broadcast(first), "shard")
            .select(*df.columns, "shard", (F.col("_row") - F.col("_first")).alias("slot")))


def shard_documents(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows of ``docs`` as (doc_id, size, text_crc32, shard, slot).

    Size is the UTF-8 length of the text (null: 0) plus 1.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         (F.octet_length(text).cast("long") + 1).alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
    return byte_shards(narrow, n_shards, ties=["text_crc32", "size"])
