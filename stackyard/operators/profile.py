"""Column profiling (A4-A11, A20, A25-A28) and column filters.

Per-column statistics are computed in one scan: either one wide aggregate
whose single result row is unpivoted with ``stack`` (fixed-size buffers:
min, max, mean, std, null counts), or an unpivot to ``(name, value)`` that
is de-duplicated map-side (distinct counts, value counts, modes).
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackyard.operators.ordering import cumulative_before, range_bounds
from stackyard.session import shuffle_partitions

MAX_EXPRS = 240  # aggregate expressions per job, keeps codegen methods small


def _stack(row_df: DataFrame, cols: list[str], fields: list[str]) -> DataFrame:
    """Unpivot a one-row wide aggregate ``<field>__<col>`` to long form."""
    parts = ", ".join(
        f"'{c}', " + ", ".join(f"`{f}__{c}`" for f in fields) for c in cols)
    return row_df.selectExpr(f"stack({len(cols)}, {parts}) AS (name, {', '.join(fields)})")


def wide_agg(df: DataFrame, cols: list[str], aggs: dict) -> DataFrame:
    """``aggs`` maps field name → ``col -> Column``; result is long
    ``(name, field...)``, computed in batches of ``MAX_EXPRS`` expressions."""
    per = max(1, MAX_EXPRS // max(1, len(aggs)))
    out = None
    for i in range(0, len(cols), per):
        chunk = cols[i:i + per]
        row = df.agg(*[fn(c).alias(f"{f}__{c}") for c in chunk for f, fn in aggs.items()])
        part = _stack(row, chunk, list(aggs))
        out = part if out is None else out.unionByName(part)
    return out


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A4: ``(value, n)`` sorted by count desc (ties by value)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), F.asc_nulls_last(col)))


def long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.name", "kv.value")


def distinct_per_column(df: DataFrame, cols: list[str], count_null: bool = False) -> DataFrame:
    """``(name, n_distinct)``; with ``count_null`` a null adds one."""
    lv = long_values(df, cols)
    if not count_null:
        lv = lv.where(F.col("value").isNotNull())
    return (lv.groupBy("name", "value").agg(F.lit(1).alias("one"))
              .groupBy("name").agg(F.count(F.lit(1)).cast("bigint").alias("n_distinct")))


def column_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Min / max / mean / sample std per numeric column."""
    return wide_agg(df, cols, {
        "min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double"),
        "mean": lambda c: F.avg(c), "std": lambda c: F.stddev_samp(c)})


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(name, n_null)``."""
    return wide_agg(df, cols, {"n_null": lambda c: F.count_if(F.col(c).isNull()).cast("bigint")})


def describe_categorical(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count (non-null), unique, top (tie → smallest), freq."""
    lv = long_values(df, cols).where(F.col("value").isNotNull())
    vc = lv.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    key = F.struct((-F.col("n")).alias("a"), F.col("value").alias("b"))
    return vc.groupBy("name").agg(
        F.sum("n").cast("bigint").alias("count"), F.count(F.lit(1)).cast("bigint").alias("unique"),
        F.min_by("value", key).alias("top"), F.max("n").cast("bigint").alias("freq"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """A10: equal-width bins between min and max (the last bin includes
    the maximum); ``(bin, lo, hi, n)`` for every bin, empty ones included."""
    mm = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()  # scalar aggregate
    lo, hi = F.lit(mm["lo"]).cast("double"), F.lit(mm["hi"]).cast("double")
    width = (hi - lo) / bins
    b = F.least(F.floor(F.try_divide(F.col(col) - lo, width)), F.lit(bins - 1))
    b = F.when(hi == lo, F.lit(0)).otherwise(b).cast("int")
    counted = (df.where(F.col(col).isNotNull())
                 .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(F.broadcast(counted), "bin", "left")  # at most `bins` rows
                .select("bin", (lo + F.col("bin") * width).alias("lo"),
                        (lo + (F.col("bin") + 1) * width).alias("hi"),
                        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n")))


def percentiles(df: DataFrame, col: str, qs: list[float]) -> DataFrame:
    """Exact percentiles with linear interpolation, without gathering a
    column in one buffer: distinct values with counts get cumulative counts
    (range-partitioned); the wanted ranks that fall into a value's run of
    positions are found by binary search, then joined on their number."""
    vals = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("v")).agg(
        F.count(F.lit(1)).alias("cnt")).persist()
    spark = df.sparkSession
    # one job: the row count (scalar) and the split points of the value ranges
    agg = vals.agg(F.sum("cnt").alias("n"), range_bounds(F.col("v"), shuffle_partitions(spark)).alias("b")).first()
    n = agg["n"] or 0
    cum = cumulative_before(vals, "v", "cnt", name="before", cache_input=False, bounds=list(agg["b"] or []))
    # the wanted order statistics: at most 2 per quantile, built on the driver
    pos_rows = []
    for q in qs:
        h = float(q) * (n - 1)
        pos_rows += [(float(q), h, "lo", math.floor(h)), (float(q), h, "hi", math.ceil(h))]
    wanted = sorted({r[3] for r in pos_rows})
    number = {i: k for k, i in enumerate(wanted)}
    pos = spark.createDataFrame([(*r[:3], number[r[3]]) for r in pos_rows], "q double, h double, side string, at int")
    # wanted ranks below a position: the bucket of (position - 1/2) among them
    splits = [float("-inf"), *map(float, wanted), float("inf")]
    hit = cum.withColumn("__lo", F.col("before") - 0.5).withColumn("__hi", F.col("before") + F.col("cnt") - 0.5)
    for c in ("__lo", "__hi"):
        hit = Bucketizer(splits=splits, inputCol=c, outputCol=f"{c}_n").transform(hit)
    hit = (hit.where(F.col("__lo_n") < F.col("__hi_n"))
           .select("v", F.explode(F.sequence(F.col("__lo_n").cast("int"), F.col("__hi_n").cast("int") - 1)).alias("at"))
           .join(F.broadcast(pos), "at"))  # at most two rows per quantile
    piv = hit.groupBy("q", "h").agg(
        F.max(F.when(F.col("side") == "lo", F.col("v"))).alias("vlo"),
        F.max(F.when(F.col("side") == "hi", F.col("v"))).alias("vhi"))
    frac = F.col("h") - F.floor("h")
    return piv.select("q", (F.col("vlo") + (F.col("vhi") - F.col("vlo")) * frac).alias("value"))


def class_balance(df: DataFrame, target: str = "target") -> DataFrame:
    """Mean, min, max and number of labels of the (train) target."""
    return df.agg(F.avg(target).alias("mean"), F.min(target).alias("min"),
                  F.max(target).alias("max"),
                  F.count_distinct(target).cast("bigint").alias("n_labels"))


def global_min_max(df: DataFrame, col: str) -> DataFrame:
    """One-row min/max (used as scalars, like a scalar subquery)."""
    return df.agg(F.min(col).alias(f"{col}_min"), F.max(col).alias(f"{col}_max"))


# ------------------------------------------------------------ column filters

def zero_variance_columns(df: DataFrame, cols: list[str]) -> list[str]:
    """Columns whose sample std is 0 (one aggregate)."""
    prof = wide_agg(df, cols, {"std": lambda c: F.stddev_samp(c)})
    return sorted(r["name"] for r in prof.where(F.col("std") == 0).collect())


def low_variance_columns(df: DataFrame, cols: list[str], threshold: float = 0.001,
                         where: Column | None = None) -> DataFrame:
    """Population variance per column and whether it passes
    (``var > threshold``), fitted on ``where`` rows (train)."""
    src = df if where is None else df.where(where)
    prof = wide_agg(src, cols, {"var": lambda c: F.var_pop(c)})
    return prof.select("name", "var", (F.col("var") > threshold).alias("keep"))


def duplicate_columns(df: DataFrame, cols: list[str], key: str = "id") -> DataFrame:
    """Pairs of identical columns ``(keep, drop)``; per same type the
    later column is kept, as the source did. One pass computes an
    order-free fingerprint per column (``bit_xor`` of a row hash, overflow
    free); candidate pairs with equal fingerprints are verified exactly with
    a null-safe comparison in a second pass."""
    types = dict(df.dtypes)
    fp = df.agg(*[F.bit_xor(F.xxhash64(F.col(key), F.col(c))).alias(c) for c in cols]).first()
    cands = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]
             if types[a] == types[b] and fp[a] == fp[b]]
    spark = df.sparkSession
    if not cands:
        return spark.createDataFrame([], "col_drop string, col_keep string")
    row = df.agg(*[F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"{a}|{b}") for a, b in cands]).first()
    same = [(a, b) for a, b in cands if row[f"{a}|{b}"] == 0]
    return spark.createDataFrame(same, "col_drop string, col_keep string")


def drop_duplicate_columns(df: DataFrame, cols: list[str], key: str = "id") -> DataFrame:
    drops = {r["col_drop"] for r in duplicate_columns(df, cols, key).collect()}
    return df.drop(*drops)


def euclid_pairs(df: DataFrame, ref: str, cols: list[str]) -> DataFrame:
    """Euclidean distance of each column to ``ref`` (one aggregate)."""
    row = df.agg(*[F.sqrt(F.sum(F.pow(F.col(c) - F.col(ref), 2))).alias(c) for c in cols])
    parts = ", ".join(f"'{c}', `{c}`" for c in cols)
    return row.selectExpr(f"stack({len(cols)}, {parts}) AS (name, dist)")


def null_bands(df: DataFrame, cols: list[str], bands: list[tuple[str, float, float]]) -> DataFrame:
    """Null fraction per column and its band ``(name, lo, hi)``
    (exclusive bounds); unmatched columns get band null."""
    nc = wide_agg(df, cols, {"n_null": lambda c: F.count_if(F.col(c).isNull()).cast("bigint"),
                             "n": lambda c: F.count(F.lit(1)).cast("bigint")})
    frac = F.col("n_null") / F.col("n")
    band = F.lit(None).cast("string")
    for name, lo, hi in reversed(bands):
        band = F.when((frac > lo) & (frac < hi), F.lit(name)).otherwise(band)
    return nc.select("name", "n_null", band.alias("band"))


def sparse_columns(df: DataFrame, cols: list[str], min_sum: float = 10,
                   where: Column | None = None) -> DataFrame:
    """P20: train sum per (dummy) column and whether it is kept."""
    src = df if where is None else df.where(where)
    s = wide_agg(src, cols, {"total": lambda c: F.sum(c).cast("bigint")})
    return s.select("name", "total", (F.col("total") >= min_sum).alias("keep"))


def fold_summary(results: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Mean, population std and max over folds."""
    return results.groupBy(*by).agg(F.avg(value).alias("mean"),
                                    F.stddev_pop(value).alias("std"),
                                    F.max(value).alias("max"))


