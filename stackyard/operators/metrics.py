"""Scores (A17, A18, T7) as aggregates.

Quadratic weighted kappa needs no confusion matrix: with ``O`` the observed
and ``E`` the expected matrix, ``Σ w·O = Σ (a-b)²`` and
``Σ w·E = (n·Σa² - 2·Σa·Σb + n·Σb²)/n``; the ``(N-1)²`` weight scale
cancels. So kappa is one pass of five sums, partially aggregated per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPS = 1e-15


def clipped(p: str | Column, lo: float, hi: float) -> Column:
    """clip to ``[lo, hi]``; null stays null (``least/greatest``
    would skip it)."""
    c = F.col(p) if isinstance(p, str) else p
    return F.when(c.isNull(), F.lit(None)).otherwise(F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def log_loss(df: DataFrame, y: str, p: str, by: list[str] | None = None, eps: float = EPS,
             name: str = "logloss") -> DataFrame:
    """``-mean(y·ln p + (1-y)·ln(1-p))`` with ``p`` clipped to
    ``[eps, 1-eps]``; rows with a null label or prediction are skipped."""
    pc = clipped(p, eps, 1 - eps)
    term = F.col(y) * F.log(pc) + (1 - F.col(y)) * F.log(1 - pc)
    # the mean skips rows without a term; a filter on the prediction would be moved
    # below the model and work it out again for every row
    counted = F.count_if(F.col(y).isNotNull() & F.col(p).isNotNull())
    out = df.groupBy(*(by or [])).agg((-F.avg(term)).alias(name), counted.alias("__counted"))
    return (out.where("__counted > 0") if by else out).drop("__counted")


def rounded_rating(pred: str | Column, lo, hi) -> Column:
    """Round half to even, then clip to the label range."""
    c = F.col(pred) if isinstance(pred, str) else pred
    return F.least(F.greatest(F.bround(c, 0), F.lit(lo)), F.lit(hi)).cast("int")


def kappa(df: DataFrame, y: str, pred: str, by: list[str] | None = None,
          round_pred: bool = True, name: str = "kappa") -> DataFrame:
    """Quadratic weighted kappa of integer ratings. With
    ``round_pred`` the prediction is rounded half-even and clipped to the
    label range first (range from the data)."""
    src = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
    if round_pred:
        rng = src.agg(F.min(y).alias("lo"), F.max(y).alias("hi")).first()  # scalar aggregate
        src = src.withColumn(
            "__a", F.least(F.greatest(F.bround(F.col(pred), 0), F.lit(rng["lo"])), F.lit(rng["hi"])))
    else:
        src = src.withColumn("__a", F.col(pred).cast("double"))
    a, b = F.col("__a").cast("double"), F.col(y).cast("double")
    s = src.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("__n"), F.sum(F.pow(a - b, 2)).alias("__o"),
        F.sum(a).alias("__a1"), F.sum(a * a).alias("__a2"),
        F.sum(b).alias("__b1"), F.sum(b * b).alias("__b2"))
    exp = (F.col("__n") * (F.col("__a2") + F.col("__b2")) - 2 * F.col("__a1") * F.col("__b1")) / F.col("__n")
    k = F.when(exp == 0, F.lit(1.0)).otherwise(1 - F.col("__o") / exp)
    return s.select(*(by or []), k.alias(name))


def balanced_weights(df: DataFrame, y: str, name: str = "weight") -> DataFrame:
    """``n / (k · n_y)`` per row (sklearn's 'balanced')."""
    counts = df.where(F.col(y).isNotNull()).groupBy(y).agg(F.count(F.lit(1)).alias("__ny"))
    everything = Window.partitionBy()  # over the per-class table (k rows)
    w = counts.select(y, (F.sum("__ny").over(everything)
                          / (F.count(F.lit(1)).over(everything) * F.col("__ny"))).alias(name))
    return df.join(F.broadcast(w), y, "left")  # one row per class
