"""Joins of per-key statistics onto rows.

Statistics tables have one row per category. Their size is measured when
they are fitted (``count`` of the aggregated table); only a table under the
row limit is broadcast. Larger tables go through a shuffle join where AQE
splits partitions of a hot key (``spark.sql.adaptive.skewJoin``).
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a statistics table that may be broadcast (a few tens of MB); text
# counts as a row for each ROW_BYTES of it.
BROADCAST_MAX_ROWS = 2_000_000
ROW_BYTES = 64


def broadcast_limit(spark) -> int:
    return int(spark.conf.get("stackyard.broadcast.maxRows", str(BROADCAST_MAX_ROWS)))


def attach(df: DataFrame, stats: DataFrame, on, how: str = "left",
           n_rows: int | None = None, rows_col: str | None = None) -> DataFrame:
    """Join ``stats`` onto ``df``; broadcast only with a measured bound.

    Beyond the bound, when ``stats`` carries ``rows_col`` (rows of ``df``
    per key, known from the fit), hot keys are split off: keys holding at
    least ``1/(4·partitions)`` of the rows — at most ``4·partitions`` of
    them, a proven bound — are joined by broadcast, the remaining keys by a
    shuffle join, so no hot key lands in one shuffle partition."""
    spark = df.sparkSession
    drop = [rows_col] if rows_col and rows_col in stats.columns else []
    if n_rows is not None and n_rows <= broadcast_limit(spark):
        return df.join(F.broadcast(stats.drop(*drop)), on, how)
    if not isinstance(on, (str, list)) or how not in ("left", "inner"):
        return df.join(stats.drop(*drop), on, how)
    keys = [on] if isinstance(on, str) else list(on)
    # rows without a key match nothing: they need no shuffle, however many they are
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    without, df = df.where(no_key), df.where(~no_key)
    if not drop:
        out = df.join(stats, on, how)
        return _with_unmatched(out, without) if how == "left" else out
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    total = stats.agg(F.sum(rows_col)).first()[0] or 0
    cut = max(1, total // (4 * parts))
    hot = stats.where(F.col(rows_col) >= cut).drop(rows_col)
    cold = stats.where(F.col(rows_col) < cut).drop(rows_col)
    hot_keys = F.broadcast(hot.select(*keys))
    hot_rows = df.join(F.broadcast(hot), keys, "inner")
    rest = df.join(hot_keys, keys, "left_anti").join(cold, keys, how)
    out = hot_rows.unionByName(rest)
    return _with_unmatched(out, without) if how == "left" else out


def _with_unmatched(joined: DataFrame, rows: DataFrame) -> DataFrame:
    """The joined table and rows that matched nothing (null statistics)."""
    return joined.unionByName(rows, allowMissingColumns=True)


def measured(stats: DataFrame) -> tuple[DataFrame, int]:
    """Persist a fitted statistics table and return it with its size in rows
    (or in ``ROW_BYTES`` of text, if that is more)."""
    stats = stats.persist()
    texts = [c for c, t in stats.dtypes if t == "string"]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0)).cast("long")
    n, held = stats.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return stats, max(n, held // ROW_BYTES)


def join_on_id(frames: list[DataFrame], key: str = "id", how: str = "inner") -> DataFrame:
    """Chain of equi-joins on the explicit row key (never position)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key, how)
    return out


def orphan_values(df: DataFrame, col: str, side: str = "is_train",
                  orphan: str = "Orphans") -> DataFrame:
    """A category seen on only one side (train vs test) becomes
    ``orphan``; null stays null. Distinct values per side are small
    (semi/anti join on the distinct set), then joined back."""
    vals = df.groupBy(col).agg(F.max(F.col(side).cast("int")).alias("__tr"),
                               F.min(F.col(side).cast("int")).alias("__te"), F.count(F.lit(1)).alias("__rows"))
    both = vals.where((F.col("__tr") == 1) & (F.col("__te") == 0)).select(col, F.lit(True).alias("__both"), "__rows")
    both, n = measured(both)
    out = attach(df, both, col, "left", n, "__rows")
    return out.select(*[F.when(F.col(col).isNull(), F.lit(None))
                         .when(F.col("__both").isNull(), F.lit(orphan))
                         .otherwise(F.col(col)).alias(col) if c == col else F.col(c)
                        for c in df.columns])
