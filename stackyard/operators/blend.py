"""Blending rules and prediction-set reports.

Prediction sets are columns of one table keyed by ``id`` (gathered with a
pivot on the key, never by position). Row rules are array/``least``/
``greatest`` expressions. Offset tuning (B5) replaces a scalar optimiser by the
exact optimum between sorted break points.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stackyard.functions import rowwise as RW
from stackyard.operators.ordering import running
from stackyard.operators.profile import percentiles


def weak_blend(cols: list[str], top_k: int = 8, bottom_k: int = 2, hi: float = 0.95,
               lo: float = 0.5, floor: float = 0.15):
    """B1: mean; above ``hi`` → mean of the ``top_k`` largest; then below
    ``lo`` → mean of the ``bottom_k`` smallest; mean below ``floor`` → min."""
    avg = RW.row_mean(cols)
    e1 = F.when(avg > hi, RW.mean_of_largest(cols, top_k)).otherwise(avg)
    e2 = F.when(e1 < lo, RW.mean_of_smallest(cols, bottom_k)).otherwise(e1)
    return F.when(avg < floor, RW.row_min(cols)).otherwise(e2)


def strong_blend(cols: list[str], hi: float = 0.97, lo: float = 0.5, floor: float = 0.15):
    """B2 (three sets): mean; above ``hi`` → .4·median + .6·max; then below
    ``lo`` → .6·min + .4·median; mean below ``floor`` → min."""
    avg = RW.row_mean(cols)
    med = F.element_at(RW.row_sorted(cols), 2)
    mn, mx = RW.row_min(cols), RW.row_max(cols)
    e1 = F.when(avg > hi, 0.4 * med + 0.6 * mx).otherwise(avg)
    e2 = F.when(e1 < lo, 0.6 * mn + 0.4 * med).otherwise(e1)
    return F.when(avg < floor, mn).otherwise(e2)


def weak_blend_df(df: DataFrame, cols: list[str], name: str = "weak", top_k: int = 8, bottom_k: int = 2,
                  hi: float = 0.95, lo: float = 0.5, floor: float = 0.15) -> DataFrame:
    """B1 as staged projections: the sorted row and its mean are computed
    once and referenced by the later steps (Catalyst does not collapse a
    projection whose non-trivial result is used more than once, so the
    rule never re-evaluates the sort)."""
    s = df.select("*", RW.row_sorted(cols).alias("__s"), RW.row_mean(cols).alias("__avg"))
    top = F.slice(F.reverse(F.col("__s")), 1, top_k)
    bot = F.slice(F.col("__s"), 1, bottom_k)
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y) / F.size(a)
    s = s.select("*", F.when(F.col("__avg") > hi, mean(top)).otherwise(F.col("__avg")).alias("__e1"))
    s = s.select("*", F.when(F.col("__e1") < lo, mean(bot)).otherwise(F.col("__e1")).alias("__e2"))
    out = F.when(F.col("__avg") < floor, F.element_at(F.col("__s"), 1)).otherwise(F.col("__e2"))
    return s.select(*df.columns, out.alias(name))


def strong_blend_df(df: DataFrame, cols: list[str], name: str = "strong", hi: float = 0.97,
                    lo: float = 0.5, floor: float = 0.15) -> DataFrame:
    """B2 (three sets) as staged projections, see ``weak_blend_df``."""
    s = df.select("*", RW.row_sorted(cols).alias("__s"), RW.row_mean(cols).alias("__avg"))
    s = s.select("*", F.element_at("__s", 1).alias("__mn"), F.element_at("__s", 2).alias("__md"),
                 F.element_at("__s", -1).alias("__mx"))
    s = s.select("*", F.when(F.col("__avg") > hi, 0.4 * F.col("__md") + 0.6 * F.col("__mx"))
                 .otherwise(F.col("__avg")).alias("__e1"))
    s = s.select("*", F.when(F.col("__e1") < lo, 0.6 * F.col("__mn") + 0.4 * F.col("__md"))
                 .otherwise(F.col("__e1")).alias("__e2"))
    out = F.when(F.col("__avg") < floor, F.col("__mn")).otherwise(F.col("__e2"))
    return s.select(*df.columns, out.alias(name))


def side_by_side(df: DataFrame, cols: list[str]) -> DataFrame:
    """Avg, min, max and spread of the model columns."""
    return df.select("*", RW.row_mean(cols).alias("avg"), RW.row_min(cols).alias("min"),
                     RW.row_max(cols).alias("max"), RW.row_range(cols).alias("diff"))


def disagreement_counts(df: DataFrame, diff: str = "diff", steps: int = 10) -> DataFrame:
    """Rows whose spread exceeds ``i/steps`` for ``i = 0..steps-1``,
    one aggregate with a count per threshold (no row duplication)."""
    row = df.agg(*[F.count_if(F.col(diff) > i / steps).alias(f"t{i}") for i in range(steps)])
    parts = ", ".join(f"{i}, t{i}" for i in range(steps))
    return row.selectExpr(f"stack({steps}, {parts}) AS (step, n)")


def mean_over_sets(long: DataFrame, by: list[str], pred: str = "pred", name: str = "pred") -> DataFrame:
    """Mean of per-fold / per-seed predictions of the same row."""
    return long.groupBy(*by).agg(F.avg(pred).alias(name))


# ------------------------------------------------------------ ordinal offsets

# Percentile positions (1-based) and class centres of the
# initial offsets; class index 4 starts at 0.
OFFSET_PERCENTILES = (10, 21, 23, 25, None, 35, 54, 68)
OFFSET_CENTRES = (1.5, 2.5, 3.5, 4.5, None, 5.5, 6.5, 7.5)


def initial_offsets(test_preds: DataFrame, pred: str = "pred") -> list[float]:
    """``offset_j = centre_j - p_j`` from exact percentiles (1..99) of
    the test predictions; one small result row per percentile."""
    qs = [p / 100 for p in OFFSET_PERCENTILES if p is not None]
    vals = {round(r["q"] * 100): r["value"] for r in percentiles(test_preds, pred, qs).collect()}
    return [0.0 if p is None else -(vals[p] - c) for p, c in zip(OFFSET_PERCENTILES, OFFSET_CENTRES)]


def offsets_table(spark, offsets: list[float]) -> DataFrame:
    return spark.createDataFrame([(j, float(o)) for j, o in enumerate(offsets)], "cls int, offset double")


def apply_offsets(df: DataFrame, offsets: list[float], pred: str = "pred", lo: int = 1, hi: int = 8,
                  name: str = "label") -> DataFrame:
    """Add ``offset[int(pred)]`` (classes beyond the list unchanged),
    clip to ``[lo, hi]``, round half to even."""
    off = F.lit(0.0)
    tr = F.col(pred).cast("int")
    for j, o in enumerate(offsets):
        off = F.when(tr == j, F.lit(float(o))).otherwise(off)
    shifted = F.col(pred) + off
    return df.withColumn(name, F.bround(F.least(F.greatest(shifted, F.lit(float(lo))), F.lit(float(hi))), 0)
                         .cast("int"))


@dataclass
class _Sums:
    """The five kappa sums of some rows at their ratings."""
    n: float = 0.0
    o: float = 0.0
    a1: float = 0.0
    a2: float = 0.0
    b1: float = 0.0
    b2: float = 0.0

    def plus(self, other: "_Sums") -> "_Sums":
        return _Sums(*[getattr(self, f.name) + getattr(other, f.name) for f in fields(self)])

    def kappa(self) -> float:
        e = (self.n * (self.a2 + self.b2) - 2 * self.a1 * self.b1) / self.n if self.n else 0.0
        return 1.0 if e == 0 else 1 - self.o / e


def _kappa_sums(a, y, n) -> list:
    """Aggregates of the kappa sums for ratings ``a`` and labels ``y``."""
    s = lambda c: F.sum(c).cast("double")
    return [s(n).alias("n"), s(n * (a - y) * (a - y)).alias("o"), s(n * a).alias("a1"), s(n * a * a).alias("a2"),
            s(n * y).alias("b1"), s(n * y * y).alias("b2")]


def tune_offsets(df: DataFrame, offsets: list[float], y: str = "y", pred: str = "pred",
                 span: float = 1.0) -> list[float]:
    """One class at a time (0..len-1), the offset within ``offset +- span``
    that maximises quadratic weighted kappa of the shifted, rounded, clipped
    predictions; other classes keep their current offset.

    A prediction's rating changes only where prediction + offset passes a half,
    so kappa is constant between these break points. One pass over
    ``(class, y, pred, n)`` makes each class's break points with what the sums
    change there, running sums over the sorted points give the sums of every
    interval, and the best interval is an ordered top row. Its middle is the
    offset; ties go to the interval nearest the current offset, then to the
    lower one. An offset moves only if kappa rises.
    """
    rng = df.agg(F.min(y).alias("lo"), F.max(y).alias("hi")).first()
    if rng["lo"] is None:
        return list(offsets)
    lo, hi = int(rng["lo"]), int(rng["hi"])
    cur = list(offsets)
    base = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull()).select(
        F.col(y).cast("double").alias("y"), F.col(pred).cast("double").alias("p"))
    hist = base.groupBy("y", "p").agg(F.count(F.lit(1)).cast("double").alias("n"))
    own = F.col("p").cast("int")
    hist = hist.withColumn("cls", F.when(own.between(0, len(cur) - 1), own).otherwise(F.lit(-1)))
    offset = F.lit(0.0)
    for j, o in enumerate(cur):
        offset = F.when(F.col("cls") == j, F.lit(float(o))).otherwise(offset)
    rating = F.least(F.greatest(F.bround(F.col("p") + offset, 0), F.lit(float(lo))), F.lit(float(hi)))
    # a half is passed where offset = m + 0.5 - p, for m = lo..hi-1
    halves = F.transform(F.sequence(F.lit(lo), F.lit(hi - 1)), lambda m: F.struct(
        m.cast("double").alias("m"), (m.cast("double") + 0.5 - F.col("p")).alias("at"))) if hi > lo else F.array().cast(
        "array<struct<m:double,at:double>>")
    low, high = offset - span, offset + span
    hist = hist.select("cls", "y", "p", "n", rating.alias("a"), halves.alias("halves"), low.alias("low"), high.alias("high"))
    hist = hist.withColumn("first", F.lit(float(lo)) + F.size(F.filter("halves", lambda h: h["at"] <= F.col("low")))).persist()
    now = {r["cls"]: _Sums(*r[1:]) for r in hist.groupBy("cls").agg(*_kappa_sums(F.col("a"), F.col("y"), F.col("n"))).collect()}
    start = {r["cls"]: _Sums(*r[1:]) for r in hist.groupBy("cls").agg(*_kappa_sums(F.col("first"), F.col("y"), F.col("n"))).collect()}
    inside = F.filter("halves", lambda h: (h["at"] > F.col("low")) & (h["at"] < F.col("high")))
    moved = hist.where(F.col("cls") >= 0).select("cls", "y", "n", F.explode(inside).alias("h"))
    m, yy, n = F.col("h.m"), F.col("y"), F.col("n")
    points = moved.groupBy("cls", F.col("h.at").alias("at")).agg(
        F.sum(n * (2 * (m - yy) + 1)).alias("d_o"), F.sum(n).alias("d_a1"), F.sum(n * (2 * m + 1)).alias("d_a2"))
    ends = df.sparkSession.createDataFrame([(j, float(o) + span, 0.0, 0.0, 0.0) for j, o in enumerate(cur)],
                                           "cls int, at double, d_o double, d_a1 double, d_a2 double")
    table = running(points.unionByName(ends), "at", {"o": "d_o", "a1": "d_a1", "a2": "d_a2"}, by=["cls"], previous="prev").persist()
    for j in range(len(cur)):
        if j not in start:
            continue
        rest = reduce(_Sums.plus, [s for c, s in now.items() if c != j], _Sums())
        at = start[j].plus(rest)
        o, a1, a2 = F.col("o") + at.o, F.col("a1") + at.a1, F.col("a2") + at.a2
        e = (F.lit(at.n) * (a2 + at.b2) - 2 * a1 * at.b1) / at.n
        k = F.when(e == 0, F.lit(1.0)).otherwise(1 - o / e)
        middle = (F.coalesce(F.col("prev"), F.lit(cur[j] - span)) + F.col("at")) / 2
        best = (table.where(F.col("cls") == j).select(k.alias("k"), middle.alias("middle"), "o", "a1", "a2")
                     .orderBy(F.desc("k"), F.abs(F.col("middle") - cur[j]), "middle").first())
        if best["k"] > now[j].plus(rest).kappa():
            cur[j] = float(best["middle"])
            s = start[j]
            now[j] = _Sums(s.n, s.o + best["o"], s.a1 + best["a1"], s.a2 + best["a2"], s.b1, s.b2)
    hist.unpersist()
    table.unpersist()
    return cur
