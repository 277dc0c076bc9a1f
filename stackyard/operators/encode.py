"""Categorical encoders (E1-E17) and missing-value operators (M1-M6).

Fitting produces either a small per-value table (codes, counts, target
statistics) whose row count is measured before it is joined back, or a
bounded Python list of values (one-hot), collected only after the distinct
count was checked against the encoder's limit.
"""

from __future__ import annotations

import datetime
import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.ml import Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from stackyard.operators.joins import attach, measured
from stackyard.operators.ordering import range_bounds, row_index
from stackyard.session import shuffle_partitions


# ---------------------------------------------------------------- helpers

def distinct_counts(df: DataFrame, cols: list[str], count_null: bool = True) -> dict[str, int]:
    """Exact distinct count per column in one job (null counted as a value
    when ``count_null``). Values are unpivoted and de-duplicated map-side."""
    if not cols:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.name", "kv.value")
    if not count_null:
        long = long.where(F.col("value").isNotNull())
    rows = long.distinct().groupBy("name").count().collect()  # one row per column
    out = {r["name"]: r["count"] for r in rows}
    return {c: out.get(c, 0) for c in cols}


def bounded_values(df: DataFrame, col: str, limit: int, where: Column | None = None) -> list | None:
    """Sorted non-null distinct values if there are at most ``limit`` of
    them, else ``None``; never moves more than ``limit + 1`` rows."""
    src = df if where is None else df.where(where)
    vals = (src.where(F.col(col).isNotNull()).select(col).distinct()
               .limit(limit + 1).collect())
    if len(vals) > limit:
        return None
    return sorted(r[0] for r in vals)


def _dummy_name(col: str, value, sep: str = "_") -> str:
    return f"{col}{sep}{value}"


def dummies(col: str, values: list, sep: str = "_", null_col: bool = False,
            dtype: str = "int") -> list[Column]:
    """One column per listed value: 1 where equal, else 0 (null → 0)."""
    out = [F.coalesce((F.col(col) == F.lit(v)).cast(dtype), F.lit(0).cast(dtype))
           .alias(_dummy_name(col, v, sep)) for v in values]
    if null_col:
        out.append(F.col(col).isNull().cast(dtype).alias(_dummy_name(col, "nan", sep)))
    return out


def replace_cols(df: DataFrame, col: str, new_cols: list[Column], drop: bool = True) -> DataFrame:
    """Insert ``new_cols`` at the position of ``col`` (kept unless ``drop``)."""
    sel = []
    for c in df.columns:
        if c == col:
            if not drop:
                sel.append(F.col(c))
            sel.extend(new_cols)
        else:
            sel.append(F.col(c))
    return df.select(*sel)


# ---------------------------------------------------------------- codes

@dataclass
class Codes:
    """Fitted value → code table (one row per category)."""
    col: str
    table: DataFrame
    n: int
    missing_code: int | None = None

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        out = out or self.col
        rows = "__rows" if "__rows" in self.table.columns else None
        j = attach(df, self.table.withColumnRenamed("code", "__code"), self.col, "left", self.n, rows)
        code = F.col("__code")
        if self.missing_code is not None:
            code = F.coalesce(code, F.lit(self.missing_code))
        return j.select(*[code.alias(out) if c == self.col and out == self.col else F.col(c)
                          for c in df.columns],
                        *([code.alias(out)] if out != self.col else []))


def fit_first_seen(df: DataFrame, col: str, order_col: str = "id", where: Column | None = None,
                   start: int = 0, step: int = 1, missing_code: int | None = -1) -> Codes:
    """Codes in order of first appearance (smallest ``order_col``).

    Each value's first key is a map-side-combined ``min``; the distinct set is
    then numbered with a range-partitioned index (no single-task window)."""
    src = df if where is None else df.where(where)
    firsts = (src.where(F.col(col).isNotNull())
                 .groupBy(col).agg(F.min(order_col).alias("__first"), F.count(F.lit(1)).alias("__rows"))
                 .persist())
    # one job sizes the value table and cuts its key into ranges
    st = firsts.agg(F.count(F.lit(1)).alias("n"),
                    range_bounds(F.col("__first"), shuffle_partitions(df.sparkSession)).alias("b")).first()
    idx = row_index(firsts, ["__first"], name="__k", bounds=list(st["b"] or []))
    table = idx.select(col, (F.col("__k") * step + start).alias("code"), "__rows").persist()
    return Codes(col, table, st["n"], missing_code)


def fit_sorted_codes(df: DataFrame, col: str, missing_code: int | None = None) -> Codes:
    """Label encoding in sorted value order (0-based), fit on all rows."""
    vals = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__rows")).persist()
    n = vals.count()  # sizes the code table
    idx = row_index(vals, [col], name="code")
    return Codes(col, idx.persist(), n, missing_code)


def strided_codes(df: DataFrame, col: str, fill: str = "-9999", order_col: str = "id",
                  start: int = 1000, step: int = 5, out: str | None = None) -> DataFrame:
    """Fill nulls with the literal ``fill`` (it counts as a value), then
    code ``start + step·k`` by first appearance over all rows."""
    filled = df.withColumn(col, F.coalesce(F.col(col), F.lit(fill)))
    codes = fit_first_seen(filled, col, order_col, start=start, step=step, missing_code=None)
    res = codes.transform(filled, out or f"{col}_vect_")
    return res.withColumn(col, F.col(col))


# ---------------------------------------------------------------- one-hot

def onehot_all(df: DataFrame, col: str, max_values: int = 150, sep: str = "_",
               drop: bool = True) -> DataFrame:
    """E5: one column per value when there are fewer than ``max_values``
    distinct non-null values; otherwise the column is left as is."""
    vals = bounded_values(df, col, max_values - 1)
    if vals is None:
        return df
    return replace_cols(df, col, dummies(col, vals, sep), drop)


def onehot_drop_last(df: DataFrame, col: str, max_values: int = 1000, sep: str = "_") -> DataFrame:
    """Dummies of sorted values plus a null column, last one dropped
    (the null column is last, so one column per non-null value remains).
    Above ``max_values`` values the dummies are the slots of one sparse vector."""
    vals = bounded_values(df, col, max_values)
    if vals is None:
        return apply_sparse_onehot(df, col, sparse_onehot(df, col))
    cols = dummies(col, vals, sep, null_col=True)[:-1]
    return replace_cols(df, col, cols)


def to_onehot(df: DataFrame, cols: list[str], max_values: int = 500, sep: str = "__") -> DataFrame:
    """Columns with 2 < distinct (null counted) <= ``max_values`` become
    dummies, with a ``nan`` column only when nulls occur; others pass.
    Two jobs for all columns: distinct counts, then the value lists of the
    qualifying columns (bounded by ``max_values`` each)."""
    counts = distinct_counts(df, cols)
    chosen = [c for c in cols if 2 < counts[c] <= max_values]
    if not chosen:
        return df
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"),
                 F.col(c).isNull().alias("isnull")) for c in chosen])).alias("kv")).select("kv.*")
    rows = long.distinct().collect()  # <= len(chosen) * max_values rows
    types = dict(df.dtypes)
    out = df
    for c in chosen:
        present = [r for r in rows if r["name"] == c]
        vals = sorted({type_cast(r["value"], types[c]) for r in present if not r["isnull"]})
        has_null = any(r["isnull"] for r in present)
        out = replace_cols(out, c, dummies(c, vals, sep, null_col=has_null))
    return out


def type_cast(v: str, dtype: str):
    """A value collected as text back to the column's Python type."""
    if dtype in ("int", "bigint", "smallint", "tinyint"):
        return int(v)
    if dtype in ("double", "float"):
        return float(v)
    if dtype == "boolean":
        return v == "true"
    if dtype == "date":
        return datetime.date.fromisoformat(v)
    if dtype.startswith("timestamp"):
        return datetime.datetime.fromisoformat(v)
    if dtype.startswith("decimal"):
        return Decimal(v)
    return v


def sparse_onehot(df: DataFrame, col: str, where: Column | None = None) -> Model:
    """A fitted one-hot encoder into one sparse vector ``<col>_vec`` (a slot for
    each value in text order; null and unseen values have none): the form
    for columns with more values than a table should have columns."""
    src = df if where is None else df.where(where)
    text = SQLTransformer(statement=f"SELECT *, CAST(`{col}` AS STRING) AS __value FROM __THIS__")
    code = StringIndexer(inputCol="__value", outputCol="__code", handleInvalid="keep", stringOrderType="alphabetAsc")
    vector = OneHotEncoder(inputCol="__code", outputCol=f"{col}_vec", dropLast=True)
    return Pipeline(stages=[text, code, vector]).fit(src.where(F.col(col).isNotNull()))


def apply_sparse_onehot(df: DataFrame, col: str, model: Model) -> DataFrame:
    """``col`` replaced, in its place, by the sparse vector of :func:`sparse_onehot`."""
    out = model.transform(df)
    return out.select(*[F.col(f"{col}_vec") if c == col else F.col(c) for c in df.columns])


def onehot_if_same_max(df: DataFrame, col: str, side: str = "is_train", max_limit: int = 1000,
                       check_width: bool = True, sep: str = "_") -> DataFrame:
    """One-hot (last dummy dropped) when the train maximum equals the
    test maximum and is below ``max_limit``; with ``check_width`` also the
    number of distinct values must agree on both sides."""
    st = df.groupBy().agg(
        F.max(F.when(F.col(side), F.col(col))).alias("mx_tr"),
        F.max(F.when(~F.col(side), F.col(col))).alias("mx_te"),
        F.count_distinct(F.when(F.col(side), F.col(col))).alias("n_tr"),
        F.count_distinct(F.when(~F.col(side), F.col(col))).alias("n_te")).first()
    if st["mx_tr"] is None or st["mx_tr"] != st["mx_te"] or not st["mx_tr"] < max_limit:
        return df
    if check_width and st["n_tr"] != st["n_te"]:
        return df
    vals = bounded_values(df, col, max(st["n_tr"], st["n_te"]), F.col(side))
    return replace_cols(df, col, dummies(col, vals, sep)[:-1])


def onehot_fit(df: DataFrame, col: str, max_values: int = 1000, where: Column | None = None) -> list | Model:
    """E10 fit: the train value list, or above ``max_values`` values a fitted
    sparse encoder; :func:`binarize` takes either."""
    vals = bounded_values(df, col, max_values, where)
    return sparse_onehot(df, col, where) if vals is None else vals


def binarize(df: DataFrame, col: str, values: list | Model, sep: str = "_") -> DataFrame:
    """E11/E10 transform: dummies against a fixed list, column cast to
    string first; values absent from the list give all zeros. Listed values
    that are not text become text as the column's own values do."""
    if isinstance(values, Model):
        return apply_sparse_onehot(df, col, values)
    kind = dict(df.dtypes)[col]
    text = F.coalesce(F.col(col).cast("string"), F.lit("nan"))
    same = lambda v: F.lit(v) if isinstance(v, str) else F.lit(v).cast(kind).cast("string")
    cols = [(text == same(v)).cast("int").alias(_dummy_name(col, v, sep)) for v in values]
    return replace_cols(df, col, cols)


def value_lists(df: DataFrame, cols: list[str], limit: int) -> dict[str, list | None]:
    """Sorted non-null values of each column, None above ``limit`` of them; two
    jobs for all columns: an estimate of the distinct counts, then the
    values of the columns that may be within the limit."""
    about = df.agg(*[F.approx_count_distinct(F.col(c).cast("string")).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    small = [c for c, n in zip(cols, about) if n <= 2 * limit]  # the estimate errs by some percent
    out: dict[str, list | None] = dict.fromkeys(cols)
    if not small:
        return out
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in small])).alias("kv"))
    rows = long.select("kv.*").where(F.col("value").isNotNull()).distinct().collect()
    types = dict(df.dtypes)
    for c in small:
        vals = sorted(type_cast(r["value"], types[c]) for r in rows if r["name"] == c)
        out[c] = vals if len(vals) <= limit else None
    return out


def onehot_in_place(df: DataFrame, cols: list[str], max_values: int = 1000, sep: str = "_") -> DataFrame:
    """Listed columns replaced by their dummies at the same position."""
    out = df
    for c, vals in value_lists(df, cols, max_values).items():
        if vals is None:
            out = apply_sparse_onehot(out, c, sparse_onehot(df, c))
        else:
            out = replace_cols(out, c, dummies(c, vals, sep))
    return out


# ---------------------------------------------------------------- counts / targets

def frequency_bucket(df: DataFrame, col: str, side: str = "is_train", missing: str = "C0",
                     unseen_count: int = 1) -> DataFrame:
    """Null → ``missing``; value → ``C<train count>``; unseen → C1."""
    filled = df.withColumn(col, F.coalesce(F.col(col), F.lit(missing)))
    counts, n = measured(filled.where(F.col(side)).groupBy(col).agg(F.count(F.lit(1)).alias("__cnt"))
                         .withColumn("__rows", F.col("__cnt")))
    j = attach(filled, counts, col, "left", n, "__rows")
    code = F.format_string("C%d", F.coalesce(F.col("__cnt"), F.lit(unseen_count)))
    return j.select(*[code.alias(c) if c == col else F.col(c) for c in df.columns])


@dataclass
class TargetStats:
    col: str
    table: DataFrame
    n: int

    def transform(self, df: DataFrame, drop: bool = True) -> DataFrame:
        j = attach(df, self.table, self.col, "left", self.n, "__rows")
        keep = [c for c in df.columns if not (drop and c == self.col)]
        return j.select(*keep, f"{self.col}_avg", f"{self.col}_std")


def fit_target_stats(df: DataFrame, col: str, target: str = "target", side: str = "is_train",
                     min_support: int = 50) -> TargetStats:
    """A1/A2/A5: train mean and sample std of the target per category, kept
    where the category has at least ``min_support`` train rows. Partial
    aggregation combines a hot category map-side before the shuffle."""
    g = (df.where(F.col(side)).groupBy(col)
           .agg(F.count(F.lit(1)).alias("__n"),
                F.avg(target).alias(f"{col}_avg"),
                F.stddev_samp(target).alias(f"{col}_std"))
           .where(F.col("__n") >= min_support).withColumnRenamed("__n", "__rows"))
    table, n = measured(g)
    return TargetStats(col, table, n)


@dataclass
class TargetEncoding:
    """Fitted E15 state: per raw value → category statistics (measured), and
    the null category's statistics as scalars."""
    col: str
    table: DataFrame
    n: int
    null_avg: float | None
    null_std: float | None

    def transform(self, df: DataFrame) -> DataFrame:
        col = self.col
        j = attach(df, self.table.where(F.col(col).isNotNull()), col, "left", self.n, "__rows")
        avg = F.when(F.col(col).isNull(), F.lit(self.null_avg).cast("double")).otherwise(F.col(f"{col}_avg"))
        std = F.when(F.col(col).isNull(), F.lit(self.null_std).cast("double")).otherwise(F.col(f"{col}_std"))
        keep = [c for c in df.columns if c != col]
        return j.select(*keep, avg.alias(f"{col}_avg"), std.alias(f"{col}_std"))


def fit_target_encoding(df: DataFrame, col: str, target: str = "target", side: str = "is_train",
                        min_support: int = 50, orphan: str = "Orphans",
                        missing: str = "Missing") -> TargetEncoding:
    """E15 fit in one scan: values seen on one side only become ``orphan``,
    null becomes ``missing``, then train mean and sample std of the target
    per resulting category, kept with at least ``min_support`` train rows.

    One aggregate per raw value collects side flags and the train count,
    mean and variance (combined map-side, so a hot value is cheap);
    relabelling and merging run on that per-value table, around the overall
    mean, so a target far from zero loses no digits. The table is measured
    (one job that also reads the null category's statistics)."""
    y = F.col(target).cast("double")
    tr = F.col(side)
    per = df.groupBy(col).agg(
        F.count(F.lit(1)).alias("__rows"),
        F.max(tr.cast("int")).alias("__tr"), F.min(tr.cast("int")).alias("__te"),
        F.count(F.when(tr, y)).alias("__n"), F.avg(F.when(tr, y)).alias("__m"),
        F.var_pop(F.when(tr, y)).alias("__v"))
    label = (F.when(F.col(col).isNull(), F.lit(missing))
              .when((F.col("__tr") == 1) & (F.col("__te") == 0), F.col(col).cast("string"))
              .otherwise(F.lit(orphan)))
    per = per.withColumn("__lab", label).persist()
    mid = per.agg(F.sum(F.col("__n") * F.col("__m")) / F.sum("__n")).first()[0] or 0.0
    off = F.col("__m") - F.lit(mid)
    grp = per.groupBy("__lab").agg(F.sum("__n").alias("n"), F.sum(F.col("__n") * off).alias("s1"),
                                   F.sum(F.col("__n") * (F.col("__v") + off * off)).alias("s2"))
    mean = F.lit(mid) + F.col("s1") / F.col("n")
    var = F.try_divide(F.col("s2") - F.col("s1") * F.col("s1") / F.col("n"), F.col("n") - 1)
    grp = grp.where(F.col("n") >= min_support).select(
        "__lab", mean.alias(f"{col}_avg"),
        F.when(F.col("n") > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias(f"{col}_std"))
    table = per.select(col, "__rows", "__lab").join(grp, "__lab", "left").drop("__lab").persist()
    m = table.agg(F.count(F.lit(1)).alias("n"),
                  F.max(F.when(F.col(col).isNull(), F.col(f"{col}_avg"))).alias("na"),
                  F.max(F.when(F.col(col).isNull(), F.col(f"{col}_std"))).alias("ns")).first()
    return TargetEncoding(col, table, m["n"], m["na"], m["ns"])


def target_stats_encode(df: DataFrame, col: str, target: str = "target", side: str = "is_train",
                        min_support: int = 50, orphan: str = "Orphans", missing: str = "Missing",
                        key: str = "id") -> DataFrame:
    """Fit on ``df`` and replace ``col`` by ``<col>_avg``, ``<col>_std``."""
    return fit_target_encoding(df, col, target, side, min_support, orphan, missing).transform(df)


def target_weight(df: DataFrame, col: str, target: str = "target", side: str = "is_train",
                  unseen: float = 0.5, out: str | None = None) -> DataFrame:
    """E16 (A3): per-category ``p = sum/count`` on train rows;
    weight ``.5 + .5p`` when positives outnumber negatives, else ``.5p``;
    categories without train rows (and nulls) get ``unseen``."""
    g = (df.where(F.col(side) & F.col(col).isNotNull()).groupBy(col)
           .agg(F.sum(target).alias("__s"), F.count(F.lit(1)).alias("__c")))
    w = (F.when(F.col("__s") > F.col("__c") - F.col("__s"), 0.5 + 0.5 * F.col("__s") / F.col("__c"))
          .otherwise(0.5 + 0.5 * (F.col("__s") - F.col("__c")) / F.col("__c")))
    table, n = measured(g.select(col, w.alias("__w"), F.col("__c").alias("__rows")))
    j = attach(df, table, col, "left", n, "__rows")
    return j.select(*df.columns, F.coalesce(F.col("__w"), F.lit(unseen)).alias(out or f"{col}weight"))


def bernoulli_nb_encode(df: DataFrame, col: str, target: str = "target", side: str = "is_train",
                        alpha: float = 1.0, out: str | None = None) -> DataFrame:
    """Bernoulli naive Bayes on the one-hot of one column, closed form.

    With exactly one active indicator per row, the class score is
    ``ln prior_y + Σ_v ln(1-θ_vy) + ln θ_xy - ln(1-θ_xy)`` with
    ``θ_vy = (n_vy + α)/(n_y + 2α)`` over the train values; a value not
    seen on train activates nothing. Output is ``P(y=1 | value)``.
    Null is the string ``'nan'`` (the column is cast to string first)."""
    s = df.withColumn("__v", F.coalesce(F.col(col).cast("string"), F.lit("nan")))
    tr = s.where(F.col(side))
    # class totals and the per-class constant are scalar aggregates
    ny = tr.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(target)).alias("n1")).first()
    n_all, n1 = float(ny["n"]), float(ny["n1"] or 0)
    nv = tr.groupBy("__v").agg(F.sum(F.col(target)).alias("c1"),
                               F.sum(1 - F.col(target)).alias("c0"),
                               F.count(F.lit(1)).alias("__rows"))
    th = nv.select("__v", "__rows",
                   ((F.col("c0") + alpha) / (n_all - n1 + 2 * alpha)).alias("t0"),
                   ((F.col("c1") + alpha) / (n1 + 2 * alpha)).alias("t1")).persist()
    sums = th.agg(F.sum(F.log(1 - F.col("t0"))).alias("s0"), F.sum(F.log(1 - F.col("t1"))).alias("s1"),
                  F.count(F.lit(1)).alias("n")).first()  # also sizes the per-value table
    if not 0 < n1 < n_all:  # one class only (or no train row): its share is certain
        p = float("nan") if not n_all else n1 / n_all
        return s.select(*[F.lit(p).alias(out or col) if c == col else F.col(c) for c in df.columns])
    k0 = math.log((n_all - n1) / n_all) + sums["s0"]
    k1 = math.log(n1 / n_all) + sums["s1"]
    per_val = th.select(
        "__v", "__rows",
        (F.lit(k0) + F.log(F.col("t0")) - F.log(1 - F.col("t0"))).alias("l0"),
        (F.lit(k1) + F.log(F.col("t1")) - F.log(1 - F.col("t1"))).alias("l1"))
    j = attach(s, per_val, "__v", "left", sums["n"], "__rows")
    l0 = F.coalesce(F.col("l0"), F.lit(k0))
    l1 = F.coalesce(F.col("l1"), F.lit(k1))
    p1 = 1.0 / (1.0 + F.exp(l0 - l1))
    return j.select(*[p1.alias(out or col) if c == col else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- leave-fold-out statistics

#: The fold of rows without one (the test side): nothing is left out for them.
NO_FOLD = -1


def _fold_keys(df: DataFrame, col: str, fold: str) -> DataFrame:
    """Value and fold as keys without nulls."""
    return df.select("*", F.col(col).isNull().alias("__none"), F.coalesce(F.col(col).cast("string"), F.lit("")).alias("__v"),
                     F.coalesce(F.col(fold).cast("int"), F.lit(NO_FOLD)).alias("__f"))


_KEYS = ["__none", "__v", "__f"]


def _attach_fold_table(keyed: DataFrame, table: DataFrame) -> DataFrame:
    """Joins a fitted (value, fold) table onto the keyed rows."""
    table, n = measured(table)
    return attach(keyed, table, _KEYS, "left", n, "__rows")


def target_stats_by_fold(df: DataFrame, col: str, fold: str, target: str = "target", side: str = "is_train",
                         min_support: int = 50, orphan: str = "Orphans", missing: str = "Missing") -> DataFrame:
    """E15 without leaks: a train row gets its category's mean and sample
    deviation over the train rows of the other folds, a test row over all of them;
    ``min_support`` counts the rows used. Categories are those of E15 (values
    of one side only are ``orphan``, null is ``missing``).

    One grouped pass over (value, fold) serves all folds: what a fold leaves is
    the total less its own partial sums.
    """
    keyed = _fold_keys(df, col, fold)
    y = F.when(F.col(side), F.col(target).cast("double"))
    per = keyed.groupBy(*_KEYS).agg(
        F.count(F.lit(1)).alias("__rows"), F.max(F.col(side).cast("int")).alias("__tr"), F.min(F.col(side).cast("int")).alias("__te"),
        F.count(y).alias("n"), F.avg(y).alias("m"), F.var_pop(y).alias("v")).persist()
    mid = per.agg(F.sum(F.col("n") * F.col("m")) / F.sum("n")).first()[0] or 0.0
    value = Window.partitionBy("__none", "__v")  # a row for each fold
    both = (F.max("__tr").over(value) == 1) & (F.min("__te").over(value) == 0)
    label = F.when(F.col("__none"), F.lit(missing)).when(both, F.col("__v")).otherwise(F.lit(orphan))
    off = F.coalesce(F.col("m") - F.lit(mid), F.lit(0.0))
    lab = per.select(*_KEYS, "__rows", "n", label.alias("__lab"), (F.col("n") * off).alias("s1"),
                     (F.col("n") * (F.coalesce("v", F.lit(0.0)) + off * off)).alias("s2"))
    grp = lab.groupBy("__lab", "__f").agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2")])
    whole = Window.partitionBy("__lab")
    own = lambda c: F.when(F.col("__f") == NO_FOLD, F.lit(0)).otherwise(F.col(c))
    left = grp.select("__lab", "__f", *[(F.sum(c).over(whole) - own(c)).alias(c) for c in ("n", "s1", "s2")])
    mean = F.lit(mid) + F.col("s1") / F.col("n")
    var = F.try_divide(F.col("s2") - F.col("s1") * F.col("s1") / F.col("n"), F.col("n") - 1)
    stats = left.where(F.col("n") >= max(min_support, 1)).select(
        "__lab", "__f", mean.alias(f"{col}_avg"), F.when(F.col("n") > 1, F.sqrt(F.greatest(var, F.lit(0.0)))).alias(f"{col}_std"))
    table = lab.select(*_KEYS, "__rows", "__lab").join(stats, ["__lab", "__f"], "left").drop("__lab")
    out = _attach_fold_table(keyed, table)
    return out.select(*[c for c in df.columns if c != col], f"{col}_avg", f"{col}_std")


def target_weight_by_fold(df: DataFrame, col: str, fold: str, target: str = "target", side: str = "is_train",
                          unseen: float = 0.5, out: str | None = None) -> DataFrame:
    """E16 without leaks: the weight of the category over the train rows of the
    other folds (test rows: of all); categories without such rows get ``unseen``."""
    keyed = _fold_keys(df, col, fold)
    y = F.when(F.col(side), F.col(target))
    per = keyed.where(~F.col("__none")).groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("__rows"), F.coalesce(F.sum(y), F.lit(0)).alias("s"), F.count(y).alias("c"))
    value = Window.partitionBy("__none", "__v")
    own = lambda c: F.when(F.col("__f") == NO_FOLD, F.lit(0)).otherwise(F.col(c))
    left = per.select(*_KEYS, "__rows", *[(F.sum(c).over(value) - own(c)).alias(c) for c in ("s", "c")])
    s, c = F.col("s"), F.col("c")
    w = F.when(c == 0, F.lit(None)).when(s > c - s, 0.5 + 0.5 * s / c).otherwise(0.5 + 0.5 * (s - c) / c)
    j = _attach_fold_table(keyed, left.select(*_KEYS, "__rows", w.alias("__w")))
    return j.select(*df.columns, F.coalesce(F.col("__w"), F.lit(unseen)).alias(out or f"{col}weight"))


def bernoulli_nb_by_fold(df: DataFrame, col: str, fold: str, target: str = "target", side: str = "is_train",
                         alpha: float = 1.0, out: str | None = None) -> DataFrame:
    """E17 without leaks: each fold's rows are encoded by the naive Bayes of the
    other folds' train rows (test rows: of all), in the closed form of
    :func:`bernoulli_nb_encode`. The class totals of each fold are scalars; the
    value table has a row for each (value, fold)."""
    text = df.withColumn("__text", F.coalesce(F.col(col).cast("string"), F.lit("nan")))
    keyed = _fold_keys(text, "__text", fold)
    y = F.when(F.col(side), F.col(target))
    sizes = keyed.groupBy("__f").agg(F.count(y).alias("n"), F.coalesce(F.sum(y), F.lit(0)).alias("n1")).collect()  # a row for each fold
    n, n1 = sum(r["n"] for r in sizes), sum(r["n1"] for r in sizes)
    left = {r["__f"]: (n - r["n"], n1 - r["n1"]) if r["__f"] != NO_FOLD else (n, n1) for r in sizes}
    per = keyed.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("__rows"), F.coalesce(F.sum(y), F.lit(0)).alias("c1"), F.count(y).alias("c")).persist()
    totals = per.groupBy("__none", "__v").agg(F.sum("c1").alias("t1"), F.sum("c").alias("t"),
                                             F.map_from_entries(F.collect_list(F.struct("__f", F.struct("c1", "c", "__rows")))).alias("own"))
    folds = F.explode(F.array(*[F.struct(F.lit(f).alias("__f"), F.lit(a).alias("n"), F.lit(b).alias("n1")) for f, (a, b) in left.items()]))
    cells = totals.select("__none", "__v", "t1", "t", "own", folds.alias("f")).select("__none", "__v", "t1", "t", "own", "f.*")
    mine = F.element_at("own", F.col("__f"))
    out_of = lambda c: F.when(F.col("__f") == NO_FOLD, F.lit(0)).otherwise(F.coalesce(mine[c], F.lit(0)))
    cells = cells.select(*_KEYS, "n", "n1", (F.col("t1") - out_of("c1")).alias("c1"), (F.col("t") - out_of("c")).alias("c"),
                         F.coalesce(mine["__rows"], F.lit(0)).alias("__rows"))
    t0 = (F.col("c") - F.col("c1") + alpha) / (F.col("n") - F.col("n1") + 2 * alpha)
    t1 = (F.col("c1") + alpha) / (F.col("n1") + 2 * alpha)
    cells = cells.select(*_KEYS, "__rows", "c", t0.alias("t0"), t1.alias("t1"))
    seen = F.col("c") > 0
    sums = {r["__f"]: (r["s0"] or 0.0, r["s1"] or 0.0) for r in cells.where(seen).groupBy("__f").agg(
        F.sum(F.log(1 - F.col("t0"))).alias("s0"), F.sum(F.log(1 - F.col("t1"))).alias("s1")).collect()}
    certain = {f: (b / a if a else float("nan")) for f, (a, b) in left.items() if not 0 < b < a}
    k0 = {f: math.log((a - b) / a) + sums.get(f, (0, 0))[0] for f, (a, b) in left.items() if f not in certain}
    k1 = {f: math.log(b / a) + sums.get(f, (0, 0))[1] for f, (a, b) in left.items() if f not in certain}

    def of_fold(values: dict) -> Column:
        expr = F.lit(None).cast("double")
        for f, v in values.items():
            expr = F.when(F.col("__f") == f, F.lit(float(v))).otherwise(expr)
        return expr

    odds = F.when(seen, F.log(F.col("t0")) - F.log(1 - F.col("t0")) - F.log(F.col("t1")) + F.log(1 - F.col("t1")))
    j = _attach_fold_table(keyed, cells.where(F.col("__rows") > 0).select(*_KEYS, "__rows", odds.alias("__odds")))
    p = 1.0 / (1.0 + F.exp(of_fold(k0) - of_fold(k1) + F.coalesce("__odds", F.lit(0.0))))
    p = F.coalesce(of_fold(certain), p)
    return j.select(*[p.alias(out or col) if c == col else F.col(c) for c in df.columns])


# ---------------------------------------------------------------- top-k categories

def top_k_or_null(df: DataFrame, col: str, k: int = 20) -> DataFrame:
    """O3: keep the ``k`` most frequent values (ties → smaller value), the
    rest become null. The count table is ranked with a bounded top-k."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__c"))
    keep = counts.orderBy(F.desc("__c"), F.asc(col)).limit(k).select(col, F.lit(True).alias("__keep"))
    j = df.join(F.broadcast(keep), col, "left")
    return j.select(*[F.when(F.col("__keep"), F.col(c)).alias(c) if c == col else F.col(c)
                      for c in df.columns])


# ---------------------------------------------------------------- missing values

def fill_constant(df: DataFrame, value, cols: list[str] | None = None) -> DataFrame:
    """M1: constant fill (numeric columns for a number, strings for text)."""
    return df.fillna(value, subset=cols)


def fill_mean(df: DataFrame, cols: list[str], where: Column | None = None) -> DataFrame:
    """M2: fill with the column mean (one aggregate for all columns)."""
    src = df if where is None else df.where(where)
    means = src.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
    return df.select(*[F.coalesce(F.col(c), F.lit(means[c])).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def column_modes(df: DataFrame, cols: list[str], where: Column | None = None) -> DataFrame:
    """Most frequent non-null value per column, tie → smallest value
    (numbers by value, other types by text). Long form ``(name, value, n)``
    aggregated map-side; one row per column."""
    src = df if where is None else df.where(where)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    number = lambda c: F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
    long = src.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"), number(c).alias("num")) for c in cols
    ])).alias("kv")).select("kv.*").where(F.col("value").isNotNull())
    cnt = long.groupBy("name", "value", "num").agg(F.count(F.lit(1)).alias("n"))
    key = F.struct((-F.col("n")).alias("a"), F.col("num").alias("b"), F.col("value").alias("c"))
    return cnt.groupBy("name").agg(F.min_by("value", key).alias("value"),
                                   F.max("n").alias("n"))


def fill_mode(df: DataFrame, cols: list[str], where: Column | None = None) -> DataFrame:
    """M3: fill each column with its train mode (values cast back)."""
    modes = {r["name"]: r["value"] for r in column_modes(df, cols, where).collect()}
    types = dict(df.dtypes)
    return df.select(*[F.coalesce(F.col(c), F.lit(modes.get(c)).cast(types[c])).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def null_indicators(df: DataFrame, cols: list[str], suffix: str = "_nan_",
                    dtype: str = "double") -> DataFrame:
    """M4: ``1.0`` where the column is null."""
    return df.select("*", *[F.col(c).isNull().cast(dtype).alias(f"{c}{suffix}") for c in cols])


def null_count_row(cols: list[str]) -> Column:
    """Number of null cells in the row."""
    return sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))


def named_missing(df: DataFrame, cols: list[str], label: str = "Missing") -> DataFrame:
    """M6: a named category for missing values."""
    return df.select(*[F.coalesce(F.col(c), F.lit(label)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def route_encode(df: DataFrame, cols: list[str], max_categories: int = 20,
                 target: str = "target", side: str = "is_train") -> DataFrame:
    """Per column, by distinct count over all rows (null counted):
    fewer than ``max_categories`` → dummies with a ``nan`` column; numeric →
    fill ``m = int(min) - 2`` plus ``<col>_na``, then ``(x - m)/(max - m)``;
    text → top ``max_categories`` values kept, dummies, and a target weight.
    """
    from pyspark.sql import types as T
    counts = distinct_counts(df, cols)
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    scaled_cols = [c for c in cols if counts[c] >= max_categories and c in numeric]
    ranges = df.agg(*[F.min(c).alias(f"lo__{c}") for c in scaled_cols],
                    *[F.max(c).alias(f"hi__{c}") for c in scaled_cols]).first() if scaled_cols else {}
    out = df
    for c in cols:
        if counts[c] < max_categories:
            vals = bounded_values(df, c, max_categories)
            out = replace_cols(out, c, dummies(c, vals, "_", null_col=True))
        elif c in numeric:
            lo, hi = ranges[f"lo__{c}"], ranges[f"hi__{c}"]
            m = int(lo) - 2
            x = F.coalesce(F.col(c).cast("double"), F.lit(float(m)))
            scaled = F.try_divide(x - F.lit(m), F.lit(float(hi) - m))
            out = replace_cols(out, c, [scaled.alias(c),
                                        (x == F.lit(float(m))).cast("int").alias(f"{c}_na")])
        else:
            kept = top_k_or_null(out, c, max_categories)
            vals = bounded_values(kept, c, max_categories)
            kept = target_weight(kept, c, target, side)
            out = replace_cols(kept, c, dummies(c, vals, "_", null_col=True))
    return out
