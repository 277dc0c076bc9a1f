"""Associations between columns.

Pairwise statistics come from one scan: pair expressions inside one aggregate
for up to ``PAIR_BATCH`` pairs, the moments of all columns for more (no self-join
of rows, no per-pair job); correlations are pairwise-complete.
"""

from __future__ import annotations

import math
import operator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stackyard.operators.joins import attach, measured
from stackyard.operators.moments import pair_moments, sums_of_products
from stackyard.operators.ordering import cumulative_before, running

PAIR_BATCH = 200


def _pairs(cols, cols2=None):
    if cols2 is None:
        return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    return [(a, b) for a in cols for b in cols2 if a != b]


def _pair_agg(df: DataFrame, pairs, fn, field: str) -> DataFrame:
    out = None
    for i in range(0, len(pairs), PAIR_BATCH):
        chunk = pairs[i:i + PAIR_BATCH]
        row = df.agg(*[fn(a, b).alias(f"{a}|{b}") for a, b in chunk])
        parts = ", ".join(f"'{a}', '{b}', `{a}|{b}`" for a, b in chunk)
        part = row.selectExpr(f"stack({len(chunk)}, {parts}) AS (col_a, col_b, {field})")
        out = part if out is None else out.unionByName(part)
    return out


def _pair_table(df: DataFrame, pairs, value, field: str, kind: str) -> DataFrame:
    """A row for each pair from a matrix on the driver (columns squared, not data)."""
    rows = [(a, b, value(a, b)) for a, b in pairs]
    return df.sparkSession.createDataFrame(rows, f"col_a string, col_b string, {field} {kind}")


def column_pairs_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Every column pair a < b with the rows where both are null. Above
    ``PAIR_BATCH`` pairs from the masks' Gramian, in one scan as well."""
    pairs = _pairs(cols)
    if len(pairs) <= PAIR_BATCH:
        return _pair_agg(df, pairs, lambda a, b: F.count_if(F.col(a).isNull() & F.col(b).isNull()), "n_both_null")
    g = sums_of_products(df.select(*[F.col(c).isNull().cast("double").alias(c) for c in cols]), cols)
    return _pair_table(df, pairs, lambda a, b: int(round(g[a, b])), "n_both_null", "long")


def null_pattern_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """For every column pair a < b, the rows where exactly one is null."""
    pairs = _pairs(cols)
    if len(pairs) <= PAIR_BATCH:
        return _pair_agg(df, pairs, lambda a, b: F.count_if(F.col(a).isNull() != F.col(b).isNull()), "n_diff")
    g = sums_of_products(df.select(*[F.col(c).isNull().cast("double").alias(c) for c in cols]), cols)
    return _pair_table(df, pairs, lambda a, b: int(round(g[a, a] + g[b, b] - 2 * g[a, b])), "n_diff", "long")


def contingency(df: DataFrame, a: str, b: str, null_label: str = "NaN",
                max_values: int = 500) -> DataFrame:
    """Long contingency ``(a, b, n)`` of two categoricals, null shown
    as ``null_label``; refuses columns with more than ``max_values``. The
    limit is tested first, on at most ``max_values + 1`` values of each column."""
    for c in (a, b):
        if df.select(F.coalesce(F.col(c).cast("string"), F.lit(null_label)).alias(c)).distinct().limit(max_values + 1).count() > max_values:
            raise ValueError(f"{c}: more than {max_values} values for a contingency table")
    return (df.select(F.coalesce(F.col(a).cast("string"), F.lit(null_label)).alias(a),
                      F.coalesce(F.col(b).cast("string"), F.lit(null_label)).alias(b))
              .groupBy(a, b).agg(F.count(F.lit(1)).alias("n")))


def contingency_match(df: DataFrame, a: str, b: str) -> DataFrame:
    """``Π (row_max+1)/(row_sum+1)`` over values of ``a`` and the same
    over values of ``b`` (product as exp of a sum of logs)."""
    ct = contingency(df, a, b)
    rows = ct.groupBy(a).agg(F.max("n").alias("mx"), F.sum("n").alias("sm"))
    cols = ct.groupBy(b).agg(F.max("n").alias("mx"), F.sum("n").alias("sm"))
    rm = rows.agg(F.exp(F.sum(F.log((F.col("mx") + 1) / (F.col("sm") + 1)))).alias("row_match"))
    cm = cols.agg(F.exp(F.sum(F.log((F.col("mx") + 1) / (F.col("sm") + 1)))).alias("col_match")).first()[0]
    return rm.select("row_match", F.lit(cm).cast("double").alias("col_match"))


def onehot_match(df: DataFrame, a: str, b: str, threshold: float = 0.9) -> DataFrame:
    """For dummies ``a=v`` and ``b=w``, the share of rows where both
    are 1 among rows where either is 1 (``n_vw/(n_v+n_w-n_vw)``); pairs seen
    together at least once, with ``is_match`` above ``threshold``."""
    ct = contingency(df, a, b, null_label="nan").withColumnRenamed(a, "va").withColumnRenamed(b, "vb")
    na = ct.groupBy("va").agg(F.sum("n").alias("na"))
    nb = ct.groupBy("vb").agg(F.sum("n").alias("nb"))
    j = ct.join(F.broadcast(na), "va").join(F.broadcast(nb), "vb")  # <= 500 values each
    rate = F.col("n") / (F.col("na") + F.col("nb") - F.col("n"))
    return j.select(F.concat(F.lit(a + "__"), "va").alias("dummy_a"),
                    F.concat(F.lit(b + "__"), "vb").alias("dummy_b"),
                    rate.alias("rate"), (rate > threshold).alias("is_match"))


def pearson(df: DataFrame, cols: list[str], cols2: list[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson ``(col_a, col_b, r)``; with ``cols2``
    every (a in cols, b in cols2) pair, else the upper triangle. One scan:
    a ``corr`` for each of up to ``PAIR_BATCH`` pairs, else the moments of all
    columns (:mod:`stackyard.operators.moments`)."""
    pairs = _pairs(cols, cols2)
    if len(pairs) <= PAIR_BATCH:
        return _pair_agg(df, pairs, lambda a, b: F.corr(F.col(a).cast("double"), F.col(b).cast("double")), "r")
    m = pair_moments(df, list(dict.fromkeys([*cols, *(cols2 or [])])))
    r = m.correlations()
    return _pair_table(df, pairs, lambda a, b: None if np.isnan(r[m.at(a, b)]) else float(r[m.at(a, b)]), "r", "double")


def pearson_with(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """A15 matrix-vector: correlation of each column with ``target``."""
    return pearson(df, cols, [target]).select(F.col("col_a").alias("name"), "r")


def average_rank(df: DataFrame, col: str, name: str) -> DataFrame:
    """Average rank (ties share the mean of their positions, 1-based).
    Distinct values with counts get cumulative counts on range partitions;
    the rank table is joined back on the value, the rows of a value that
    many rows have by broadcast."""
    vals = df.groupBy(F.col(col).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    cum = cumulative_before(vals, "__v", "__c", name="__b")
    table = cum.select(F.col("__v").alias(col), (F.col("__b") + (F.col("__c") + 1) / 2.0).alias(name), F.col("__c").alias("__rows"))
    table, n = measured(table)
    return attach(df, table, col, "inner", n, "__rows")


def _null_patterns(df: DataFrame, cols: list[str]) -> dict[str, int | None]:
    """Columns that are null in the same rows have one number; None: never null."""
    g = sums_of_products(df.select(*[F.col(c).isNull().cast("double").alias(c) for c in cols]), cols)
    out: dict[str, int | None] = {}
    heads: list[str] = []
    for c in cols:
        if not g[c, c]:
            out[c] = None
            continue
        same = next((i for i, h in enumerate(heads) if g[h, h] == g[c, c] == g[h, c]), None)
        if same is None:
            same = len(heads)
            heads.append(c)
        out[c] = same
    return out


def spearman(df: DataFrame, pairs: list[tuple[str, str]], key: str = "id") -> DataFrame:
    """Rank match = Pearson of average ranks over rows where both
    columns are present (ranks within those rows).

    Every column is ranked once, over its distinct values with counts. For
    a partner with nulls the rank within the common rows is the rank less that
    among the rows where the partner is null; so the value table also counts,
    for each null pattern that a partner has, the rows that miss it, and one pass
    of running sums gives all ranks of a value. Rows travel once for each
    column (not for each pair) to meet their values' ranks and once back to their
    key; the rows of a common value meet them by broadcast."""
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    pattern = _null_patterns(df, cols)
    heads = [next(c for c in cols if pattern[c] == k) for k in range(len({p for p in pattern.values() if p is not None}))]
    missing = [F.col(h).isNull().cast("long").alias(f"z{k}") for k, h in enumerate(heads)]
    item = lambda i, c: F.struct(F.lit(i).alias("__col"), F.col(c).cast("double").alias("__v"))
    items = F.filter(F.array(*[item(i, c) for i, c in enumerate(cols)]), lambda x: x["__v"].isNotNull())
    long = df.select(F.col(key).alias("__key"), *missing, F.explode(items).alias("__it")).select("__key", "__it.*", *[f"z{k}" for k in range(len(heads))])
    vals = long.groupBy("__col", "__v").agg(F.count(F.lit(1)).alias("c"), *[F.sum(f"z{k}").alias(f"n{k}") for k in range(len(heads))])
    cum = running(vals, "__v", {"b": "c"} | {f"b{k}": f"n{k}" for k in range(len(heads))}, by=["__col"])
    rank = F.col("b") + (F.col("c") + 1) / 2.0
    ranks = [rank] + [rank - F.col(f"b{k}") - F.col(f"n{k}") / 2.0 for k in range(len(heads))]
    table, n = measured(cum.select("__col", "__v", F.array(*ranks).alias("__rk"), F.col("c").alias("__rows")))
    found = attach(long.select("__key", "__col", "__v"), table, ["__col", "__v"], "inner", n, "__rows")
    wide = found.groupBy("__key").agg(*[F.max(F.when(F.col("__col") == i, F.col("__rk"))).alias(f"r{i}") for i in range(len(cols))])

    def own(c: str, partner: str):
        k = pattern[partner]
        return F.col(f"r{cols.index(c)}")[0 if k is None else k + 1]

    out = None
    for i in range(0, len(pairs), PAIR_BATCH):
        chunk = pairs[i:i + PAIR_BATCH]
        row = wide.agg(*[F.corr(own(a, b), own(b, a)).alias(f"p{j}") for j, (a, b) in enumerate(chunk)])
        parts = ", ".join(f"'{a}', '{b}', p{j}" for j, (a, b) in enumerate(chunk))
        part = row.selectExpr(f"stack({len(chunk)}, {parts}) AS (col_a, col_b, rho)")
        out = part if out is None else out.unionByName(part)
    return out


def high_correlations(df: DataFrame, cols: list[str], threshold: float = 0.9) -> DataFrame:
    """Pairs with ``|r| > threshold``."""
    return pearson(df, cols).where(F.abs("r") > threshold)


def top_by_abs_corr(df: DataFrame, cols: list[str], target: str, k: int = 200) -> DataFrame:
    """O2: the ``k`` features most correlated with the target (by |r|,
    ties by name); the correlation table has one row per feature."""
    return (pearson_with(df, cols, target).where(F.col("r").isNotNull())
            .orderBy(F.desc(F.abs("r")), F.asc("name")).limit(k))


def anova_f(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """L1: F values ``(name, f_score)``, see :func:`_anova`."""
    return _anova(df, cols, label).select("name", "f_score")


def _anova(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """L1: one-way ANOVA F per feature against a class label, from the
    count, mean and variance of each class in one grouped aggregate. Class
    means are taken relative to one of them, so a feature far from zero loses
    no digits."""
    g = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        *[F.count(c).alias(f"n__{c}") for c in cols],
        *[F.avg(F.col(c).cast("double")).alias(f"m__{c}") for c in cols],
        *[F.var_pop(F.col(c).cast("double")).alias(f"v__{c}") for c in cols])
    parts = ", ".join(f"'{c}', `n__{c}`, `m__{c}`, `v__{c}`" for c in cols)
    lg = g.selectExpr(label, f"stack({len(cols)}, {parts}) AS (name, __n, m, v)").where(F.col("__n") > 0)
    lg = lg.withColumn("d", F.col("m") - F.max("m").over(Window.partitionBy("name")))  # a row per class
    per = lg.groupBy("name").agg(
        F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("__n") * F.col("d")).alias("t1"), F.sum(F.col("__n") * F.col("d") * F.col("d")).alias("t2"),
        F.sum(F.col("__n") * F.col("v")).alias("within"))
    ss_between = F.col("t2") - F.pow("t1", 2) / F.col("n")
    ss_within = F.col("within")
    f = F.try_divide(ss_between / (F.col("k") - 1), ss_within / (F.col("n") - F.col("k")))
    return per.select("name", "n", "k", f.alias("f_score"))


# ------------------------------------------------------------ selection by F

#: Steps of the continued fraction of the incomplete beta function at most.
BETA_STEPS = 300


def _ln_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0: Stirling's series at x + 8."""
    z = x + 8.0
    shift = reduce(operator.mul, [x + float(k) for k in range(1, 8)], x)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, 5)) - 1 / (1680 * F.pow(z, 7))
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(shift)


def _beta_fraction(x: Column, a: Column, b: Column) -> Column:
    """Lentz's continued fraction of the incomplete beta function."""
    tiny = 1e-300
    safe = lambda v: F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)
    d0 = 1 / safe(1 - (a + b) * x / (a + 1))
    state = F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))

    def step(s, m):
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d1, c1 = 1 / safe(1 + even * s["d"]), safe(1 + even / s["c"])
        d2, c2 = 1 / safe(1 + odd * d1), safe(1 + odd / c1)
        return F.struct(c2.alias("c"), d2.alias("d"), (s["h"] * d1 * c1 * d2 * c2).alias("h"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(BETA_STEPS)), state, step, lambda s: s["h"])


def incomplete_beta(x: Column, a: Column, b: Column) -> Column:
    """Regularised incomplete beta function I_x(a, b), as an expression."""
    front = F.exp(_ln_gamma(a + b) - _ln_gamma(a) - _ln_gamma(b) + a * F.log(x) + b * F.log(1 - x))
    near = x < (a + 1) / (a + b + 2)
    value = F.when(near, front * _beta_fraction(x, a, b) / a).otherwise(1 - front * _beta_fraction(1 - x, b, a) / b)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(value)


def anova_table(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(name, f_score, p_value): the chance of an F at least as large if the
    classes do not differ, I_x(d2/2, d1/2) at x = d2 / (d2 + d1 F)."""
    f = _anova(df, cols, label).select("name", "f_score", (F.col("k") - 1).cast("double").alias("d1"),
                                       (F.col("n") - F.col("k")).cast("double").alias("d2"))
    x = F.col("d2") / (F.col("d2") + F.col("d1") * F.col("f_score"))
    p = incomplete_beta(x, F.col("d2") / 2, F.col("d1") / 2)
    return f.select("name", "f_score", F.when(F.col("f_score").isNotNull(), p).alias("p_value"))


def select_features(df: DataFrame, cols: list[str], label: str, k: int | str | None = None,
                    percentile: float | None = None) -> DataFrame:
    """L1: (name, f_score, p_value, rank, selected). ``k`` keeps the k largest
    F values ('all': every feature), ``percentile`` that share of the features
    (rounded down, one at least). Ties by name; a feature without an F (no
    spread within and between classes) comes last and is kept only by 'all'."""
    if (k is None) == (percentile is None):
        raise ValueError("give k or percentile")
    n = len(cols)
    keep = n if k == "all" else int(k) if k is not None else max(1, int(n * percentile / 100))
    # a row for each feature: the ranking window holds no more than the columns
    order = Window.orderBy(F.col("f_score").desc_nulls_last(), "name")
    ranked = anova_table(df, cols, label).withColumn("rank", F.row_number().over(order))
    chosen = F.lit(True) if k == "all" else (F.col("rank") <= keep) & F.col("f_score").isNotNull()
    return ranked.withColumn("selected", chosen)


def selected_columns(df: DataFrame, cols: list[str], label: str, **how) -> list[str]:
    """The names that :func:`select_features` keeps, in the order of ``cols``."""
    kept = {r["name"] for r in select_features(df, cols, label, **how).where("selected").select("name").collect()}
    return [c for c in cols if c in kept]


def onehot_target_corr(df: DataFrame, col: str, target: str, prefix_sep: str = "_") -> DataFrame:
    """A15 (one-hot vs target, closed form): Pearson of each dummy
    ``col = v`` with a numeric target without building the dummy columns,
    from one grouped aggregate: with ``n`` rows where the target is present,
    ``n_v`` rows of value v, target mean ``m`` and variance ``s²``, and mean
    ``m_v`` over value v, ``r = n_v (m_v - m) / sqrt(n_v (n - n_v) · s²)``.
    Null values form their own dummy only if present (``nan``)."""
    src = df.where(F.col(target).isNotNull()).select(
        F.coalesce(F.col(col).cast("string"), F.lit("nan")).alias("__v"),
        F.col(target).cast("double").alias("__y"))
    tot = src.agg(F.count(F.lit(1)).alias("n"), F.avg("__y").alias("m"), F.var_pop("__y").alias("v")).first()  # scalars
    n, m, v = float(tot["n"]), float(tot["m"] or 0.0), float(tot["v"] or 0.0)
    g = src.groupBy("__v").agg(F.count(F.lit(1)).alias("nv"), F.avg("__y").alias("mv"))
    num = F.col("nv") * (F.col("mv") - F.lit(m))
    den = F.sqrt(F.col("nv") * (F.lit(n) - F.col("nv")) * F.lit(v))
    return g.select(F.concat(F.lit(col + prefix_sep), F.col("__v")).alias("name"),
                    F.when(den > 0, num / den).alias("r"))


def top_dummies_by_target_corr(df: DataFrame, cols: list[str], target: str, k: int = 200) -> list[tuple]:
    """O2 on categoricals: the ``k`` dummies ``(column, value)`` most
    correlated with the target (by |r|, ties by name), found from grouped
    counts without building any dummy column; at most ``k`` rows reach the
    driver."""
    parts = None
    for c in cols:
        r = onehot_target_corr(df, c, target, "\u0001").select(
            F.lit(c).alias("col"), F.split(F.col("name"), "\u0001").getItem(1).alias("value"), "r")
        parts = r if parts is None else parts.unionByName(r)
    top = (parts.where(F.col("r").isNotNull())
                .orderBy(F.desc(F.abs("r")), F.asc("col"), F.asc("value")).limit(k).collect())
    return [(t["col"], t["value"]) for t in top]
