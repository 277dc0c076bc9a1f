"""Fold assignment, holdouts and splits.

Deterministic splits hash seed and row key together (15 hexadecimal digits of
an MD5, the same in any engine) instead of ``randomSplit``, whose result
depends on partitioning. Contiguous folds use
the range-partitioned row index, so no class lands in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackyard.functions.scalar import HASH_RANGE, seeded_shuffle_key
from stackyard.operators.ordering import row_index, running


def _tile(pos: Column, n: Column, k: int) -> Column:
    """0-based ``ntile(k)`` from a 0-based position among ``n`` rows: the
    first ``n % k`` tiles get one extra row (as KFold does)."""
    q, r = F.floor(n / k), n % k
    big = r * (q + 1)
    return F.when(pos < big, F.floor(pos / (q + 1))).otherwise(r + F.floor((pos - big) / q)).cast("int")


def stratified_kfold(df: DataFrame, y: str, k: int, order: Column | str = "id",
                     name: str = "fold") -> DataFrame:
    """Per class, contiguous blocks in ``order`` (no shuffle)."""
    o = F.col(order) if isinstance(order, str) else order
    t = df.withColumn("__o", o)
    idx = row_index(t, ["__o", "id"] if "id" in df.columns else ["__o"], by=[y], name="__pos",
                    total_name="__n")
    return idx.select(*df.columns, _tile(F.col("__pos"), F.col("__n"), k).alias(name))


def shuffled_stratified_kfold(df: DataFrame, y: str, k: int, seed: int, key: str = "id",
                              name: str = "fold") -> DataFrame:
    """V3: W4 with rows ordered by a seeded hash of the key."""
    return stratified_kfold(df, y, k, seeded_shuffle_key(key, seed), name)


def positional_holdout(df: DataFrame, frac: float, order: str = "id", name: str = "is_fit") -> DataFrame:
    """The first ``floor(frac·n)`` rows in key order are the fit side."""
    idx = row_index(df, [order], name="__pos", total_name="__n")
    return idx.select(*df.columns, (F.col("__pos") < F.floor(F.col("__n") * frac)).alias(name))


def random_split(df: DataFrame, frac: float, seed: int, key: str = "id", name: str = "is_fit") -> DataFrame:
    """V1: reproducible ``frac`` / ``1-frac`` split by a seeded key hash."""
    h = seeded_shuffle_key(key, seed)
    return df.withColumn(name, h < int(round(frac * HASH_RANGE)))


def stratified_split(df: DataFrame, y: str, frac: float, seed: int, key: str = "id",
                     name: str = "is_fit") -> DataFrame:
    """V2: per class, the first ``floor(frac·n_y)`` rows in hash order."""
    t = df.withColumn("__h", seeded_shuffle_key(key, seed))
    idx = row_index(t, ["__h", key], by=[y], name="__pos", total_name="__n")
    return idx.select(*df.columns, (F.col("__pos") < F.floor(F.col("__n") * frac)).alias(name))


def ordinal_labels(y: str, n_class: int, prefix: str = "label_") -> list[Column]:
    """V4: cumulative binary labels ``y <= k+1`` for ``k = 0..n_class-2``."""
    return [(F.col(y) <= k + 1).cast("int").alias(f"{prefix}{k}") for k in range(n_class - 1)]


def ordinal_cut_folds(df: DataFrame, y: str, n_class: int, k: int, order: str = "id", name: str = "fold") -> DataFrame:
    """K1: folds ``<name>0..`` for every cut ``y <= c+1`` of an ordinal label,
    each stratified by the two sides of its cut (contiguous blocks in key
    order). One pass counts the labels before each row; a cut's position is the
    sum of those counts on the row's own side."""
    labels = range(1, n_class + 1)
    src = df.select("*", *[(F.col(y) == c).cast("long").alias(f"__is{c}") for c in labels])
    totals = df.agg(*[F.count_if(F.col(y) == c) for c in labels]).first()
    out = running(src, order, {f"__b{c}": f"__is{c}" for c in labels}, cache_input=False)
    folds = []
    for cut in range(1, n_class):
        below, above = list(labels[:cut]), list(labels[cut:])
        pos = F.when(F.col(y) <= cut, sum((F.col(f"__b{c}") for c in below), F.lit(0))).otherwise(sum((F.col(f"__b{c}") for c in above), F.lit(0)))
        n = F.when(F.col(y) <= cut, F.lit(sum(totals[c - 1] for c in below))).otherwise(F.lit(sum(totals[c - 1] for c in above)))
        folds.append(_tile(pos, n, k).alias(f"{name}{cut - 1}"))
    return out.select(*df.columns, *folds)
