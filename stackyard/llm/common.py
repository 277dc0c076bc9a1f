"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackyard.session import checkpoint_dir

#: Documents in one Arrow batch. A batch holds whole texts, so this bounds
#: the memory of a Python worker better than Spark's default of 10,000 rows.
BATCH_ROWS = 500

#: Words are runs of bytes other than the six ASCII white-space characters.
#: ``bytes.split()`` cuts at exactly \x20 and \x09-\x0D.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Whole texts travel in small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local master without that setting gets a folder of its own.
    """
    root = checkpoint_dir(spark)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stackyard-shared-"))
    return checkpoint_dir(spark)


class Saved:
    """A table written as Parquet in the shared folder: it cuts the lineage,
    outlives a lost executor, and can be dropped when no plan needs it."""

    def __init__(self, df: DataFrame, label: str, codec: str = "snappy"):
        self.spark = df.sparkSession
        self.path = f"{shared_root(self.spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        df.write.option("compression", codec).parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession, *tables: Saved) -> None:
    """Drop tables, and have Spark delete the shuffle files of plans that nothing
    refers to any more: it does so when their objects are collected, which on a
    driver with little to do may be long after their disk is needed."""
    for t in tables:
        t.drop()
    gc.collect()
    spark._jvm.System.gc()


def saved(df: DataFrame, label: str) -> DataFrame:
    return Saved(df, label).df


#: Keys of at most this many rows (some 50 MB) are broadcast, more are joined by shuffle.
BROADCAST_ROWS = 2_000_000


def small(df: DataFrame) -> DataFrame:
    """A saved table of keys, to be broadcast if its counted size allows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def row_hash(*cols: str):
    """XXH64 of a text (null: empty) and of other columns of its row."""
    return F.xxhash64(F.coalesce(F.col(f"`{cols[0]}`").cast("string"), F.lit("")), *[F.col(f"`{c}`") for c in cols[1:]])


def without(docs: DataFrame, gone: DataFrame, id_col: str, *hashed: str) -> DataFrame:
    """The rows of ``docs`` whose (id, row hash) is not in ``gone`` (doc_id, th)."""
    gone = small(saved(gone.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct(), "gone"))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("__id")) & (row_hash(*hashed) == F.col("__th"))
    return docs.join(gone, same, "left_anti")


def text_column(df: DataFrame, text: str = "text"):
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def stream_texts(docs: DataFrame, id_col: str, text_col: str, func, schema: str,
                 extra: list[str] | None = None) -> DataFrame:
    """``func`` over Arrow batches of (doc_id, text as bytes, extra columns).

    Only the named columns leave the scan, under fixed names, so other
    columns of the input (whatever their names) cannot clash.
    """
    small_batches(docs.sparkSession)
    cols = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_column(docs, f"`{text_col}`").alias("text")]
    cols += [F.col(f"`{c}`").alias(c) for c in extra or []]
    return docs.select(*cols).mapInArrow(func, schema)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (vectorised); equal inputs give equal outputs."""
    with np.errstate(over="ignore"):
        z = h.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def merge_intervals(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals, as maximal runs in ascending order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(start) - 1)
    return start[first], end[last]
