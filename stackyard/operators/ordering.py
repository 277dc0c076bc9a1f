"""Order-dependent building blocks that stay distributed.

A window with an ``ORDER BY`` but no ``PARTITION BY`` runs in a single task.
The helpers here cut the ordering key into ranges, number or accumulate
rows inside each range (a window partitioned by the range), and add
per-range offsets from a table with one row per (range, group): its size is
bounded by ``ranges x groups`` and it is broadcast.

Range boundaries are approximate quantiles of the first ordering key (one
aggregate job; text keys count as the numbers of the bytes behind the prefix
that all keys share), collected once and then used as literals. The range of a row is
therefore a pure function of its key: every re-evaluation (a second branch
of the same plan, a retried task after a lost executor, the next fold
iteration) assigns the same range, so counts and offsets always agree.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stackyard.session import shuffle_partitions

_RID = "__rid"
#: Ranges for each shuffle partition: ranges meet partitions by hash, and
#: several small ones spread better than one.
RANGES_PER_PARTITION = 4
#: Bytes of a text key that make one number (exact in a double).
PREFIX_BYTES = 6


def _order_exprs(order_cols):
    return [F.col(c) if isinstance(c, str) else c for c in order_cols]


def range_bounds(col: Column, n_ranges: int) -> Column:
    """Aggregate expression for the split points of ``n_ranges`` ranges of
    a numeric key (can ride along in another aggregate job)."""
    return F.percentile_approx(col.cast("double"), [i / n_ranges for i in range(1, n_ranges)], max(10000, 20 * n_ranges))


def _with_range_id(df: DataFrame, first: Column, n_ranges: int | None = None,
                   bounds: list | None = None, second: Column | None = None) -> DataFrame:
    """Add ``__rid``: the range of ``first`` (nulls → -1, sorted first).

    With a numeric ``second`` ordering key, the rows of a value of ``first``
    that fills whole ranges (and those without a value) are cut into ranges
    of the second key, so a tied first key does not make one large range.
    """
    spark = df.sparkSession
    n_ranges = n_ranges or RANGES_PER_PARTITION * shuffle_partitions(spark)
    t = df.withColumn("__k0", first)
    dtype = t.schema["__k0"].dataType
    if second is not None and bounds is None and isinstance(dtype, T.NumericType):
        t = t.withColumn("__k1", second)
        if isinstance(t.schema["__k1"].dataType, T.NumericType):
            return _with_two_keys(t, n_ranges)
        t = t.drop("__k1")
    if bounds is not None:
        bounds = sorted(set(bounds))
    elif isinstance(dtype, (T.StringType, T.BinaryType)):
        return _with_text_key(t, n_ranges)
    else:
        if not isinstance(dtype, T.NumericType):  # dates and times by their number
            t, dtype = t.withColumn("__k0", _as_number(F.col("__k0"), dtype)), T.DoubleType()
        # one aggregate job: approximate quantiles as split points
        got = t.agg(range_bounds(F.col("__k0"), n_ranges).alias("b")).first()["b"]
        bounds = sorted(set(got or []))
    if not bounds:
        return t.withColumn(_RID, F.when(F.col("__k0").isNull(), -1).otherwise(0)).drop("__k0")
    # binary search in the JVM; Bucketizer puts x == split into the upper bucket; either
    # way it is a monotone function of the key, which is all the numbering needs
    t = _bucket(t.withColumn("__k0d", F.col("__k0").cast("double")), "__k0d", bounds, "__b")
    rid = F.when(F.col("__k0").isNull(), F.lit(-1)).otherwise(F.col("__b").cast("int"))
    return t.withColumn(_RID, rid).drop("__k0", "__k0d", "__b")


def _as_number(k: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DateType):
        return F.unix_date(k).cast("double")
    return k.cast("double")


def _with_text_key(t: DataFrame, n_ranges: int) -> DataFrame:
    """Ranges of a text key: all keys start as the least and the greatest of
    them do, so the bytes behind that prefix are the first number, the bytes
    behind these the second one (shorter keys end in zero bytes)."""
    least, most = t.agg(F.min("__k0"), F.max("__k0")).first()
    if least is None:
        return t.withColumn(_RID, F.lit(-1)).drop("__k0")
    a, b = (x.encode() if isinstance(x, str) else bytes(x) for x in (least, most))
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    def number(start: int) -> Column:
        part = F.substring(F.col("__k0").cast("binary"), start + 1, PREFIX_BYTES)
        return F.conv(F.rpad(F.hex(part), 2 * PREFIX_BYTES, "0"), 16, 10).cast("long")

    t = t.withColumn("__k1", number(same + PREFIX_BYTES)).withColumn("__k0", number(same))
    return _with_two_keys(t, n_ranges)


def _bucket(t: DataFrame, col: str, bounds: list, out: str) -> DataFrame:
    """Number of ``bounds`` at or below a double column, by binary search."""
    splits = [float("-inf"), *sorted({float(b) for b in bounds if math.isfinite(float(b))}), float("inf")]
    return Bucketizer(splits=splits, inputCol=col, outputCol=out, handleInvalid="keep").transform(t)


def _with_two_keys(t: DataFrame, n_ranges: int) -> DataFrame:
    """Ranges of ``__k0``; a value that is several of its own quantiles holds
    more than a range, and opens its bucket, so it is cut by ``__k1``."""
    t = t.withColumn("__d0", F.col("__k0").cast("double")).withColumn("__d1", F.col("__k1").cast("double"))
    got = t.agg(range_bounds(F.col("__d0"), n_ranges).alias("a"), range_bounds(F.col("__d1"), n_ranges).alias("b")).first()
    first, second = list(got["a"] or []), list(got["b"] or [])
    tied = sorted({v for i, v in enumerate(first[1:]) if v == first[i]})
    t = _bucket(_bucket(t, "__d0", first, "__r0"), "__d1", second, "__r1")
    cut = F.col("__k0").isNull()
    if tied:
        cut = cut | F.col("__d0").isin(*tied)
    inner = F.when(F.col("__k1").isNull(), F.lit(0)).otherwise(F.col("__r1").cast("long") + 1)
    outer = F.when(F.col("__k0").isNull(), F.lit(-1)).otherwise(F.col("__r0").cast("long"))
    width = n_ranges + 3
    rid = outer * width + F.when(cut, inner).otherwise(F.lit(width - 1))
    return t.withColumn(_RID, rid).drop("__k0", "__k1", "__d0", "__d1", "__r0", "__r1")


def row_index(df: DataFrame, order_cols: list, by: list[str] | None = None,
              name: str = "row_idx", cache_input: bool = False,
              total_name: str | None = None, bounds: list | None = None) -> DataFrame:
    """0-based position of each row in ``order_cols`` order (within ``by``).

    ``order_cols`` must be a total order (end with a key). ``by`` must be a
    low-cardinality grouping (classes, folds): each class is split across
    the key ranges, so a class holding most rows is still spread out.
    """
    by = list(by or [])
    keys = _order_exprs(order_cols)
    if cache_input:  # an aggregated input is read twice (split points, numbering)
        df = df.persist()
    t = _with_range_id(df, keys[0], bounds=bounds, second=keys[1] if len(keys) > 1 else None)
    w = Window.partitionBy(_RID, *by).orderBy(*keys)
    local = t.withColumn("__local", F.row_number().over(w) - 1)
    counts = t.groupBy(_RID, *by).agg(F.count(F.lit(1)).alias("__n"))
    wo = Window.partitionBy(*by).orderBy(_RID).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(_RID, *by, F.coalesce(F.sum("__n").over(wo), F.lit(0)).alias("__off"),
                         F.sum("__n").over(Window.partitionBy(*by)).alias("__tot"))
    out = local.join(F.broadcast(offs), [_RID, *by])
    extra = [F.col("__tot").alias(total_name)] if total_name else []
    return out.select(*df.columns, (F.col("__local") + F.col("__off")).cast("long").alias(name), *extra)


def cumulative_before(df: DataFrame, order_col: str, weight_col: str,
                      by: list[str] | None = None, name: str = "cum_before",
                      cache_input: bool = True, bounds: list | None = None) -> DataFrame:
    """Sum of ``weight_col`` over rows strictly before each row in
    ``order_col`` order (within ``by``). ``order_col`` must be unique within
    ``by`` (apply it to a distinct/aggregated table)."""
    by = list(by or [])
    if cache_input:  # the input is an aggregate (distinct values with counts)
        df = df.persist()
    t = _with_range_id(df, F.col(order_col), bounds=bounds)
    wl = (Window.partitionBy(_RID, *by).orderBy(order_col)
          .rowsBetween(Window.unboundedPreceding, -1))
    local = t.withColumn("__local", F.coalesce(F.sum(weight_col).over(wl), F.lit(0)))
    tot = t.groupBy(_RID, *by).agg(F.sum(weight_col).alias("__tot"))
    wo = Window.partitionBy(*by).orderBy(_RID).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(_RID, *by, F.coalesce(F.sum("__tot").over(wo), F.lit(0)).alias("__off"))
    out = local.join(F.broadcast(offs), [_RID, *by])
    return out.select(*df.columns, (F.col("__local") + F.col("__off")).alias(name))


def running(df: DataFrame, order_col: str, sums: dict[str, str], by: list[str] | None = None,
            previous: str | None = None, cache_input: bool = True) -> DataFrame:
    """Several running sums in one pass: for each ``name: column`` the sum of
    the column over the rows strictly before each row in ``order_col`` order
    (within ``by``), and with ``previous`` also the order value before it.
    ``order_col`` must be unique within ``by``."""
    by = list(by or [])
    if cache_input:
        df = df.persist()
    t = _with_range_id(df, F.col(order_col))
    ordered = Window.partitionBy(_RID, *by).orderBy(order_col)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    names = list(sums)
    local = t.select("*", *[F.coalesce(F.sum(sums[n]).over(before), F.lit(0)).alias(f"__l_{n}") for n in names],
                     F.lag(order_col).over(ordered).alias("__lag"))
    tot = t.groupBy(_RID, *by).agg(*[F.sum(sums[n]).alias(f"__t_{n}") for n in names], F.max(order_col).alias("__last"))
    ranges = Window.partitionBy(*by).orderBy(_RID)
    earlier = ranges.rowsBetween(Window.unboundedPreceding, -1)
    keys = [_RID, *by]
    offs = tot.select(*[F.col(c).alias(f"__by{i}") for i, c in enumerate(keys)],
                      *[F.coalesce(F.sum(f"__t_{n}").over(earlier), F.lit(0)).alias(f"__o_{n}") for n in names],
                      F.lag("__last").over(ranges).alias("__carry"))
    on = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__by{i}")) for i, c in enumerate(keys)])
    out = local.join(F.broadcast(offs), on)  # a row for each range and group
    last = [F.coalesce("__lag", "__carry").alias(previous)] if previous else []
    return out.select(*df.columns, *[(F.col(f"__l_{n}") + F.col(f"__o_{n}")).alias(n) for n in names], *last)


def with_previous(df: DataFrame, order_col: str, by: list[str] | None = None,
                  name: str = "prev", cache_input: bool = True) -> DataFrame:
    """Previous value of ``order_col`` in sorted order within ``by``
    (``lag`` over an ordered window), computed per key range with the
    boundary value carried from the preceding range, so one hot group never
    lands in a single task."""
    by = list(by or [])
    if cache_input:  # the input is a distinct set
        df = df.persist()
    t = _with_range_id(df, F.col(order_col))
    w = Window.partitionBy(_RID, *by).orderBy(order_col)
    local = t.withColumn("__lag", F.lag(order_col).over(w))
    last = t.groupBy(_RID, *by).agg(F.max(order_col).alias("__last"))
    wb = Window.partitionBy(*by).orderBy(_RID)
    carry = last.select(_RID, *by, F.lag("__last").over(wb).alias("__carry"))
    out = local.join(F.broadcast(carry), [_RID, *by])
    return out.select(*df.columns, F.coalesce(F.col("__lag"), F.col("__carry")).alias(name))


__all__ = ["row_index", "cumulative_before", "running", "with_previous"]
