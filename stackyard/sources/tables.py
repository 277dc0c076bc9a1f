"""Scans (S1-S3): typed, projected reads with NaN normalised to NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN is the only missing marker in the source data model; Spark
    aggregates propagate NaN, so floating columns are normalised at scan."""
    fl = {f.name for f in df.schema.fields
          if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or df.columns) if c in fl]
    if not targets:
        return df
    return df.select(*[
        F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)).alias(c)
        if c in targets else F.col(c) for c in df.columns])


def load(spark: SparkSession, sf_dir: str, name: str,
         cols: list[str] | None = None) -> DataFrame:
    """Parquet scan of one table; a column list prunes the read schema."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if cols:
        df = df.select(*cols)
    return nan_to_null(df)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the path, which may be a pattern, names any file (any file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType | str,
                   index_col: str | None = None, missing: str = "error", extra: str = "ignore") -> DataFrame:
    """CSV with header and an explicit schema (no inference pass).

    Columns are found by their header name, whatever their order: one that the
    file lacks is null, one that the schema lacks is left out (``extra='error'``
    refuses it); files whose header differs from the first one's are refused.
    Text that does not fit a column's type is null. A path without
    files is an error, or with ``missing='empty'`` an empty table.
    ``index_col`` names the key column that the source used as its index; it
    stays an ordinary column, the first one.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not _exists(spark, path):
        if missing != "empty":
            raise FileNotFoundError(path)
        df = spark.createDataFrame([], wanted)
    else:
        raw = spark.read.option("header", True).option("enforceSchema", False).csv(path)
        unknown = [c for c in raw.columns if c not in wanted.names]
        if unknown and extra == "error":
            raise ValueError(f"columns that the schema lacks: {', '.join(unknown)}")
        df = raw.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in raw.columns
                           else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted.fields])
    df = nan_to_null(df)
    if index_col:
        df = df.select(index_col, *[c for c in df.columns if c != index_col])
    return df
