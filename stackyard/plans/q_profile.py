"""Queries for aggregations and column profiling (A1-A11, A20, A25-A28,
P14-P18, P20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackyard.operators import assoc as AS
from stackyard.operators import encode as E
from stackyard.operators import profile as PR
from stackyard.plans.common import r6
from stackyard.plans.fixture_sql import FX1, FX2, FX5, FX7, with_
from stackyard.sources import fixtures as fx

QUERIES, SQL = {}, {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


NUM1 = ["o_totalprice", "c_acctbal", "c_nationkey"]
ALL1 = ["o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment", "c_nationkey"]


@q("a1_group_mean", with_(FX1) + """
SELECT c_mktsegment, round(avg(target), 6) AS target_mean FROM fx1
WHERE is_train AND c_mktsegment IS NOT NULL GROUP BY c_mktsegment""")
def a1_group_mean(spark, sf):
    d = fx.claims(spark, sf).where("is_train AND c_mktsegment IS NOT NULL")
    return d.groupBy("c_mktsegment").agg(r6(F.avg("target"), "target_mean"))


@q("a2_group_std", with_(FX1) + """
SELECT c_nationkey, round(stddev_samp(target), 6) AS target_std FROM fx1
WHERE is_train GROUP BY c_nationkey""")
def a2_group_std(spark, sf):
    d = fx.claims(spark, sf).where("is_train")
    return d.groupBy("c_nationkey").agg(r6(F.stddev_samp("target"), "target_std"))


@q("a3_group_sum_count", with_(FX1) + """
SELECT c_nationkey, CAST(sum(target) AS BIGINT) AS target_sum, count(*) AS n FROM fx1
WHERE is_train GROUP BY c_nationkey""")
def a3_group_sum_count(spark, sf):
    d = fx.claims(spark, sf).where("is_train")
    return d.groupBy("c_nationkey").agg(F.sum("target").cast("bigint").alias("target_sum"),
                                        F.count(F.lit(1)).alias("n"))


@q("a4_value_counts", with_(FX1) + """
SELECT o_orderpriority, count(*) AS n FROM fx1 WHERE o_orderpriority IS NOT NULL GROUP BY 1""")
def a4_value_counts(spark, sf):
    d = fx.claims(spark, sf).where(F.col("o_orderpriority").isNotNull())
    return PR.value_counts(d, "o_orderpriority")


@q("a5_having_support", with_(FX2) + """
SELECT cust, count(*) AS n FROM fx2 WHERE cust IS NOT NULL GROUP BY cust HAVING count(*) >= 15""")
def a5_having_support(spark, sf):
    d = fx.high_card(spark, sf).where(F.col("cust").isNotNull())
    return d.groupBy("cust").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 15)


@q("a6_distinct_count", with_(FX1) + """
SELECT name, n_distinct, n_distinct + has_null AS n_distinct_nan FROM (
  SELECT 'o_totalprice' AS name, count(DISTINCT o_totalprice) AS n_distinct, CAST(count_if(o_totalprice IS NULL) > 0 AS BIGINT) AS has_null FROM fx1
  UNION ALL SELECT 'c_acctbal', count(DISTINCT c_acctbal), CAST(count_if(c_acctbal IS NULL) > 0 AS BIGINT) FROM fx1
  UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority), CAST(count_if(o_orderpriority IS NULL) > 0 AS BIGINT) FROM fx1
  UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment), CAST(count_if(c_mktsegment IS NULL) > 0 AS BIGINT) FROM fx1
  UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey), CAST(count_if(c_nationkey IS NULL) > 0 AS BIGINT) FROM fx1)""")
def a6_distinct_count(spark, sf):
    d = fx.claims(spark, sf)
    a = PR.distinct_per_column(d, ALL1)
    b = PR.distinct_per_column(d, ALL1, count_null=True).withColumnRenamed("n_distinct", "n_distinct_nan")
    return a.join(b, "name")


def _union_sql(cols, expr):
    return " UNION ALL ".join(expr.format(c=c) for c in cols)


@q("a7_column_profile", with_(FX1) + _union_sql(NUM1, """
SELECT '{c}' AS name, round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max,
  round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std FROM fx1"""))
def a7_column_profile(spark, sf):
    p = PR.column_profile(fx.claims(spark, sf), NUM1)
    return p.select("name", *[r6(c) for c in ("min", "max", "mean", "std")])


@q("a8_null_count", with_(FX1) + _union_sql(ALL1, """
SELECT '{c}' AS name, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM fx1"""))
def a8_null_count(spark, sf):
    return PR.null_counts(fx.claims(spark, sf), ALL1)


@q("a9_describe_categorical", with_(FX1) + _union_sql(["o_orderpriority", "c_mktsegment"], """
SELECT * FROM (SELECT '{c}' AS name, sum(n) AS count, count(*) AS unique,
  arg_min(v, struct_pack(a := -n, b := v)) AS top, max(n) AS freq
  FROM (SELECT {c} AS v, count(*) AS n FROM fx1 WHERE {c} IS NOT NULL GROUP BY 1))""").replace(
    "sum(n) AS count", "CAST(sum(n) AS BIGINT) AS count"))
def a9_describe_categorical(spark, sf):
    return PR.describe_categorical(fx.claims(spark, sf), ["o_orderpriority", "c_mktsegment"])


@q("a10_histogram", with_(FX1, """mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM fx1),
b AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n
  FROM fx1, mm WHERE o_totalprice IS NOT NULL GROUP BY 1)""") + """
SELECT CAST(g.bin AS INTEGER) AS bin, round(lo + g.bin * ((hi - lo) / 20), 6) AS lo,
       round(lo + (g.bin + 1) * ((hi - lo) / 20), 6) AS hi, coalesce(b.n, 0) AS n
FROM mm, range(0, 20) g(bin) LEFT JOIN b ON g.bin = b.bin""")
def a10_histogram(spark, sf):
    h = PR.histogram(fx.claims(spark, sf), "o_totalprice", 20)
    return h.select("bin", r6("lo"), r6("hi"), "n")


@q("a11_percentiles", with_(FX1, """p AS (SELECT quantile_cont(o_totalprice, [""" + ", ".join(
    f"{i / 100}" for i in range(1, 100)) + """]) AS v FROM fx1)""") + """
SELECT round(i / 100.0, 6) AS q, round(v[i], 6) AS value FROM p, range(1, 100) t(i)""")
def a11_percentiles(spark, sf):
    p = PR.percentiles(fx.claims(spark, sf), "o_totalprice", [i / 100 for i in range(1, 100)])
    return p.select(r6("q"), r6("value"))


@q("a12_contingency", with_(FX1) + """
SELECT coalesce(o_orderpriority, 'NaN') AS o_orderpriority, coalesce(c_mktsegment, 'NaN') AS c_mktsegment,
       count(*) AS n FROM fx1 GROUP BY 1, 2""")
def a12_contingency(spark, sf):
    from stackyard.operators.assoc import contingency
    return contingency(fx.claims(spark, sf), "o_orderpriority", "c_mktsegment")


@q("a20_mode", with_(FX1) + _union_sql(["o_orderpriority", "c_mktsegment", "c_nationkey"], """
SELECT * FROM (SELECT '{c}' AS name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM fx1
  WHERE is_train AND {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} LIMIT 1)"""))
def a20_mode(spark, sf):
    d = fx.claims(spark, sf)
    return E.column_modes(d, ["o_orderpriority", "c_mktsegment", "c_nationkey"], F.col("is_train"))


@q("a25_class_balance", with_(FX1) + """
SELECT round(avg(target), 6) AS mean, min(target) AS min, max(target) AS max,
       count(DISTINCT target) AS n_labels FROM fx1 WHERE is_train""")
def a25_class_balance(spark, sf):
    b = PR.class_balance(fx.claims(spark, sf).where("is_train"))
    return b.select(r6("mean"), "min", "max", "n_labels")


@q("a26_global_min_max", with_(FX1, """mm AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM fx1)""") + """
SELECT id, round((o_totalprice - lo) / (hi - lo), 6) AS o_totalprice_scaled FROM fx1, mm""")
def a26_global_min_max(spark, sf):
    d = fx.claims(spark, sf)
    mm = PR.global_min_max(d, "o_totalprice").first()  # scalar aggregate
    lo, hi = F.lit(mm["o_totalprice_min"]), F.lit(mm["o_totalprice_max"])
    return d.select("id", r6(F.try_divide(F.col("o_totalprice") - lo, hi - lo), "o_totalprice_scaled"))


PAIRS1 = [(a, b) for i, a in enumerate(ALL1) for b in ALL1[i + 1:]]


@q("a28_null_pattern_pairs", with_(FX1) + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(count_if(({a} IS NULL) <> ({b} IS NULL)) AS BIGINT) AS n_diff FROM fx1"
    for a, b in PAIRS1))
def a28_null_pattern_pairs(spark, sf):
    return AS.null_pattern_pairs(fx.claims(spark, sf), ALL1)


@q("j5_column_pairs", with_(FX1) + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(count_if({a} IS NULL AND {b} IS NULL) AS BIGINT) AS n_both_null FROM fx1"
    for a, b in PAIRS1))
def j5_column_pairs(spark, sf):
    """All column pairs with the rows where both are null."""
    return AS.column_pairs_long(fx.claims(spark, sf), ALL1)


# ------------------------------------------------------------ P14-P18, P20

@q("p14_zero_variance", with_(FX1) + """
SELECT id, round(o_totalprice, 6) AS o_totalprice, round(c_acctbal, 6) AS c_acctbal FROM fx1""")
def p14_zero_variance(spark, sf):
    d = fx.claims(spark, sf).select("id", "o_totalprice", "c_acctbal",
                                    F.lit(1.0).alias("const_a"),
                                    (F.col("c_nationkey") * 0).alias("const_b"))
    drop = PR.zero_variance_columns(d, ["o_totalprice", "c_acctbal", "const_a", "const_b"])
    return d.drop(*drop).select("id", r6("o_totalprice"), r6("c_acctbal"))


@q("p15_low_variance", with_(FX5) + """
SELECT * FROM (
  SELECT 'l_quantity' AS name, round(var_pop(l_quantity), 6) AS var, var_pop(l_quantity) > 0.001 AS keep FROM fx5 WHERE l_orderkey % 10 < 7
  UNION ALL SELECT 'l_tax', round(var_pop(l_tax), 6), var_pop(l_tax) > 0.001 FROM fx5 WHERE l_orderkey % 10 < 7
  UNION ALL SELECT 'l_price_e5', round(var_pop(l_extendedprice / 100000.0), 6), var_pop(l_extendedprice / 100000.0) > 0.001 FROM fx5 WHERE l_orderkey % 10 < 7)""")
def p15_low_variance(spark, sf):
    d = fx.assoc(spark, sf).withColumn("l_price_e5", F.col("l_extendedprice") / 100000.0)
    v = PR.low_variance_columns(d, ["l_quantity", "l_tax", "l_price_e5"], 0.001,
                                F.col("l_orderkey") % 10 < 7)
    return v.select("name", r6("var"), "keep")


@q("p16_duplicate_columns", with_(FX1, """d AS (SELECT *, o_totalprice AS price_copy, c_mktsegment AS seg_copy,
  CASE WHEN id % 2 = 0 THEN c_acctbal END AS acct_half FROM fx1)""") + """
SELECT col_drop, col_keep FROM (
  SELECT 'o_totalprice' AS col_drop, 'price_copy' AS col_keep, count_if(o_totalprice IS DISTINCT FROM price_copy) AS n FROM d
  UNION ALL SELECT 'c_acctbal', 'acct_half', count_if(c_acctbal IS DISTINCT FROM acct_half) FROM d
  UNION ALL SELECT 'c_mktsegment', 'seg_copy', count_if(c_mktsegment IS DISTINCT FROM seg_copy) FROM d
  UNION ALL SELECT 'o_orderpriority', 'seg_copy', count_if(o_orderpriority IS DISTINCT FROM seg_copy) FROM d
  UNION ALL SELECT 'o_orderpriority', 'c_mktsegment', count_if(o_orderpriority IS DISTINCT FROM c_mktsegment) FROM d
  UNION ALL SELECT 'o_totalprice', 'c_acctbal', count_if(o_totalprice IS DISTINCT FROM c_acctbal) FROM d
  UNION ALL SELECT 'o_totalprice', 'acct_half', count_if(o_totalprice IS DISTINCT FROM acct_half) FROM d
  UNION ALL SELECT 'c_acctbal', 'price_copy', count_if(c_acctbal IS DISTINCT FROM price_copy) FROM d
  UNION ALL SELECT 'price_copy', 'acct_half', count_if(price_copy IS DISTINCT FROM acct_half) FROM d) WHERE n = 0""")
def p16_duplicate_columns(spark, sf):
    d = fx.claims(spark, sf).select(
        "*", F.col("o_totalprice").alias("price_copy"), F.col("c_mktsegment").alias("seg_copy"),
        F.when(F.col("id") % 2 == 0, F.col("c_acctbal")).alias("acct_half"))
    cols = ["o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment", "price_copy", "seg_copy",
            "acct_half"]
    return PR.duplicate_columns(d, cols)


@q("p17_null_indicator_distance", with_(FX1) + """
SELECT name, round(dist, 6) AS dist FROM (
  SELECT 'c_acctbal_na' AS name, sqrt(sum(pow(CAST(c_acctbal IS NULL AS DOUBLE) - CAST(o_totalprice IS NULL AS DOUBLE), 2))) AS dist FROM fx1
  UNION ALL SELECT 'o_orderpriority_na', sqrt(sum(pow(CAST(o_orderpriority IS NULL AS DOUBLE) - CAST(o_totalprice IS NULL AS DOUBLE), 2))) FROM fx1
  UNION ALL SELECT 'c_mktsegment_na', sqrt(sum(pow(CAST(c_mktsegment IS NULL AS DOUBLE) - CAST(o_totalprice IS NULL AS DOUBLE), 2))) FROM fx1)
WHERE dist >= 8""")
def p17_null_indicator_distance(spark, sf):
    cols = ["o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment"]
    d = E.null_indicators(fx.claims(spark, sf), cols, suffix="_na", dtype="double")
    dist = PR.euclid_pairs(d, "o_totalprice_na", ["c_acctbal_na", "o_orderpriority_na", "c_mktsegment_na"])
    # columns closer than 8 to the reference indicator are pruned; the kept ones are returned
    return dist.where(F.col("dist") >= 8).select("name", r6("dist"))


BANDS = [("g3", 0.12, 1.01), ("g2", 0.085, 0.12), ("g1", 0.065, 0.085), ("g4", -0.01, 0.065)]


@q("p18_null_bands", with_(FX1) + _union_sql(ALL1, """
SELECT '{c}' AS name, CAST(count_if({c} IS NULL) AS BIGINT) AS n_null,
  CASE WHEN count_if({c} IS NULL) / count(*) > 0.12 AND count_if({c} IS NULL) / count(*) < 1.01 THEN 'g3'
       WHEN count_if({c} IS NULL) / count(*) > 0.085 AND count_if({c} IS NULL) / count(*) < 0.12 THEN 'g2'
       WHEN count_if({c} IS NULL) / count(*) > 0.065 AND count_if({c} IS NULL) / count(*) < 0.085 THEN 'g1'
       WHEN count_if({c} IS NULL) / count(*) > -0.01 AND count_if({c} IS NULL) / count(*) < 0.065 THEN 'g4' END AS band
FROM fx1"""))
def p18_null_bands(spark, sf):
    return PR.null_bands(fx.claims(spark, sf), ALL1, BANDS)


@q("s8_column_groups", with_(FX1, """b AS (""" + _union_sql(ALL1, """
SELECT '{c}' AS name,
  CASE WHEN count_if({c} IS NULL) / count(*) > 0.12 THEN 'g3'
       WHEN count_if({c} IS NULL) / count(*) > 0.085 THEN 'g2'
       WHEN count_if({c} IS NULL) / count(*) > 0.065 THEN 'g1' ELSE 'g4' END AS band FROM fx1""") + ")") + """
SELECT band AS "group", string_agg(name, ',' ORDER BY name) AS columns FROM b GROUP BY band""")
def s8_column_groups(spark, sf):
    from stackyard.sources.sinks import column_groups
    bands = PR.null_bands(fx.claims(spark, sf), ALL1, BANDS)
    g = column_groups(bands, "band", "name")
    return g.select("group", F.array_join("columns", ",").alias("columns"))


@q("p20_sparse_dummies", with_(FX7) + _union_sql([f"src{i}" for i in range(20)], """
SELECT 'source_{c}' AS name, CAST(count_if(source = '{c}') AS BIGINT) AS total,
  count_if(source = '{c}') >= 10 AS keep FROM fx7 WHERE is_train"""))
def p20_sparse_dummies(spark, sf):
    d = fx.labelled_docs(spark, sf)
    oh = E.onehot_all(d.select("id", "is_train", "source"), "source", 150)
    cols = [c for c in oh.columns if c.startswith("source_")]
    return PR.sparse_columns(oh, cols, 10, F.col("is_train"))


@q("a23_fold_summary", with_(FX1.replace("fx1 AS", "fx1x AS"), """f AS (
  SELECT o_orderkey % 5 AS fold, CASE WHEN o_orderkey % 10 < 7 THEN CAST(o_orderstatus = 'F' AS INTEGER) END AS y,
         greatest(least((o_orderkey * 3) % 1009 / 1009.0, 1 - 1e-15), 1e-15) AS p FROM orders),
l AS (SELECT fold, -avg(y * ln(p) + (1 - y) * ln(1 - p)) AS loss FROM f WHERE y IS NOT NULL GROUP BY fold)""") + """
SELECT round(avg(loss), 6) AS mean, round(stddev_pop(loss), 6) AS std, round(max(loss), 6) AS max FROM l""")
def a23_fold_summary(spark, sf):
    from stackyard.operators.metrics import log_loss
    d = fx.predictions(spark, sf).where("target IS NOT NULL").withColumn("fold", F.col("id") % 5)
    per = log_loss(d, "target", "m3", by=["fold"])
    s = PR.fold_summary(per, "logloss", [])
    return s.select(r6("mean"), r6("std"), r6("max"))
