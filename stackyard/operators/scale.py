"""Hidden-scale recovery and scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stackyard.operators.ordering import with_previous


def scale_units(df: DataFrame, cols: list[str], digits: int = 8, min_gap: float = 1e-6) -> DataFrame:
    """Per column the most frequent gap between neighbouring sorted
    values (values rounded to ``digits``; gaps rounded too and kept when
    above ``min_gap``; tie → smallest gap). Equal values give gap 0, so
    working on the distinct ``(column, value)`` set is lossless; neighbours
    come from a range-partitioned ``lag``, so one column with many values is
    spread over tasks."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.round(F.col(c).cast("double"), digits).alias("v"))
        for c in cols])).alias("kv")).select("kv.*").where(F.col("v").isNotNull())
    vals = long.distinct()
    nb = with_previous(vals, "v", ["name"], "prev")
    gaps = (nb.select("name", F.round(F.col("v") - F.col("prev"), digits).alias("gap"))
              .where(F.col("gap") > min_gap))
    cnt = gaps.groupBy("name", "gap").agg(F.count(F.lit(1)).alias("n"))
    key = F.struct((-F.col("n")).alias("a"), F.col("gap").alias("b"))
    return cnt.groupBy("name").agg(F.min_by("gap", key).alias("unit"))


def rescale_by_units(df: DataFrame, units: DataFrame, snap_digits: int | None = 5) -> DataFrame:
    """F8 + F9: snap near-zero values to 0, then multiply by ``1/unit``.
    The unit table has one row per column; it is applied as literals."""
    u = {r["name"]: r["unit"] for r in units.collect()}
    sel = []
    for c in df.columns:
        if c in u and u[c]:
            x = F.col(c)
            if snap_digits is not None:
                x = F.when(F.bround(x, snap_digits) == 0, F.lit(0.0)).otherwise(x)
            sel.append((x * (1.0 / u[c])).alias(c))
        else:
            sel.append(F.col(c))
    return df.select(*sel)


def standardise_fit(df: DataFrame, cols: list[str], where: Column | None = None) -> dict:
    """F13 fit: mean and population std per column (train side)."""
    src = df if where is None else df.where(where)
    row = src.agg(*[F.avg(c).alias(f"m__{c}") for c in cols],
                  *[F.stddev_pop(c).alias(f"s__{c}") for c in cols]).first()
    return {c: (row[f"m__{c}"], row[f"s__{c}"]) for c in cols}


def standardise(df: DataFrame, fit: dict, digits: int | None = None) -> DataFrame:
    sel = []
    for c in df.columns:
        if c in fit:
            m, s = fit[c]
            z = F.try_divide(F.col(c) - F.lit(m), F.lit(s))
            sel.append((F.bround(z, digits) if digits is not None else z).alias(c))
        else:
            sel.append(F.col(c))
    return df.select(*sel)


def unique_rows(df: DataFrame, cols: list[str], key: str = "id") -> DataFrame:
    """First row (smallest key) of each distinct tuple of ``cols``;
    ``min`` is combined map-side, so a hot duplicate group is cheap."""
    return df.groupBy(*cols).agg(F.min(key).alias(key))


__all__ = ["scale_units", "rescale_by_units", "standardise_fit", "standardise", "unique_rows"]
