"""Queries for associations, folds, metrics and blends (A13-A19, A21,
A22, A24, A27, O2, L1, W2, W4, W5, V4, T7, B1-B5, K10, S12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackyard.functions import rowwise as RW
from stackyard.operators import assoc as AS
from stackyard.operators import blend as BL
from stackyard.operators import folds as FO
from stackyard.operators import metrics as ME
from stackyard.plans.common import r6
from stackyard.plans.fixture_sql import FX1, FX4, FX5, FX8, with_
from stackyard.sources import fixtures as fx

QUERIES, SQL = {}, {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


MODELS = ["m3", "m7", "m11", "m13", "m17"]


def _ordinal_frame(spark, sf):
    """FX4 with a synthetic ordinal score derived from the part size."""
    d = fx.ordinal(spark, sf)
    return d.select("id", F.col("response").alias("y"), "is_train",
                    (F.col("p_size") * 0.16 + ((F.col("id") % 5) - 2) * 0.3).alias("pred"))


@q("a13_contingency_match", with_(FX1, """ct AS (SELECT coalesce(o_orderpriority, 'NaN') AS a, coalesce(c_mktsegment, 'NaN') AS b,
  count(*) AS n FROM fx1 GROUP BY 1, 2),
r AS (SELECT a, max(n) AS mx, sum(n) AS sm FROM ct GROUP BY a),
c AS (SELECT b, max(n) AS mx, sum(n) AS sm FROM ct GROUP BY b)""") + """
SELECT round((SELECT exp(sum(ln((mx + 1) / (sm + 1)))) FROM r) * 1e6, 6) AS row_match_e6,
       round((SELECT exp(sum(ln((mx + 1) / (sm + 1)))) FROM c) * 1e6, 6) AS col_match_e6""")
def a13_contingency_match(spark, sf):
    m = AS.contingency_match(fx.claims(spark, sf), "o_orderpriority", "c_mktsegment")
    return m.select(r6(F.col("row_match") * 1e6, "row_match_e6"), r6(F.col("col_match") * 1e6, "col_match_e6"))


@q("a14_onehot_match", with_(FX1, """ct AS (SELECT coalesce(o_orderpriority, 'nan') AS va, coalesce(c_mktsegment, 'nan') AS vb,
  count(*) AS n FROM fx1 GROUP BY 1, 2),
na AS (SELECT va, sum(n) AS na FROM ct GROUP BY va), nb AS (SELECT vb, sum(n) AS nb FROM ct GROUP BY vb)""") + """
SELECT 'o_orderpriority__' || ct.va AS dummy_a, 'c_mktsegment__' || ct.vb AS dummy_b,
       round(n / (na + nb - n), 6) AS rate, n / (na + nb - n) > 0.9 AS is_match
FROM ct JOIN na ON ct.va = na.va JOIN nb ON ct.vb = nb.vb""")
def a14_onehot_match(spark, sf):
    m = AS.onehot_match(fx.claims(spark, sf), "o_orderpriority", "c_mktsegment", 0.9)
    return m.select("dummy_a", "dummy_b", r6("rate"), "is_match")


NUMC = ["o_totalprice", "c_acctbal", "c_nationkey", "target"]
PAIRS = [(a, b) for i, a in enumerate(NUMC) for b in NUMC[i + 1:]]


@q("a15_pearson", with_(FX1) + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS r FROM fx1"
    for a, b in PAIRS))
def a15_pearson(spark, sf):
    return AS.pearson(fx.claims(spark, sf), NUMC).select("col_a", "col_b", r6("r"))


SP_PAIRS = [("o_totalprice", "c_acctbal"), ("o_totalprice", "c_nationkey"), ("c_acctbal", "c_nationkey")]


def _spearman_sql(a, b):
    return f"""SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(ra, rb), 6) AS rho FROM (
  SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
         rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb
  FROM fx1 WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


@q("a16_spearman", with_(FX1) + " UNION ALL ".join(_spearman_sql(a, b) for a, b in SP_PAIRS))
def a16_spearman(spark, sf):
    return AS.spearman(fx.claims(spark, sf), SP_PAIRS).select("col_a", "col_b", r6("rho"))


@q("w2_average_rank", with_(FX1) + """
SELECT id, rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS price_rank
FROM fx1 WHERE o_totalprice IS NOT NULL""")
def w2_average_rank(spark, sf):
    d = fx.claims(spark, sf).select("id", "o_totalprice").where(F.col("o_totalprice").isNotNull())
    return AS.average_rank(d, "o_totalprice", "price_rank").select("id", F.col("price_rank").cast("double"))


NUM5 = ["l_extendedprice", "l_quantity", "l_discount", "l_tax", "target", "price_unit"]


@q("a27_high_corr_pairs", with_(FX5, """d AS (SELECT *, l_extendedprice / l_quantity AS price_unit FROM fx5)""") + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM d"
    for i, a in enumerate(NUM5) for b in NUM5[i + 1:]) + ") WHERE abs(r) > 0.7")
def a27_high_corr_pairs(spark, sf):
    d = fx.assoc(spark, sf).withColumn("price_unit", F.col("l_extendedprice") / F.col("l_quantity"))
    return AS.high_correlations(d, NUM5, 0.7).select("col_a", "col_b", r6("r"))


PRI = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEG = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _feature_frame(spark, sf):
    from stackyard.operators.encode import dummies
    d = fx.claims(spark, sf)
    return d.select("id", "target", "is_train", "o_totalprice", "c_acctbal", "c_nationkey",
                    *dummies("o_orderpriority", PRI), *dummies("c_mktsegment", SEG))


FEATS = ["o_totalprice", "c_acctbal", "c_nationkey"] + [f"o_orderpriority_{v}" for v in PRI] + \
        [f"c_mktsegment_{v}" for v in SEG]
FEAT_SQL = with_(FX1, """feat AS (SELECT id, target, is_train, o_totalprice, c_acctbal, c_nationkey, """ + ", ".join(
    [f"""CAST(coalesce(o_orderpriority = '{v}', false) AS INTEGER) AS "o_orderpriority_{v}\"""" for v in PRI]
    + [f"""CAST(coalesce(c_mktsegment = '{v}', false) AS INTEGER) AS "c_mktsegment_{v}\"""" for v in SEG])
    + " FROM fx1)")


@q("o2_top_abs_corr", FEAT_SQL + """SELECT name, round(r, 6) AS r FROM (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS name, corr(CAST("{c}" AS DOUBLE), CAST(target AS DOUBLE)) AS r FROM feat""" for c in FEATS)
    + ") WHERE r IS NOT NULL ORDER BY abs(r) DESC, name LIMIT 200")
def o2_top_abs_corr(spark, sf):
    # top-k report
    return AS.top_by_abs_corr(_feature_frame(spark, sf), FEATS, "target", 200).select("name", r6("r"))


def _anova_sql(c):
    return f"""SELECT '{c}' AS name, round(((sum(n * m * m) - sum(n * m) * sum(n * m) / sum(n)) / (count(*) - 1))
  / ((sum(s2) - sum(n * m * m)) / (sum(n) - count(*))), 6) AS f_score FROM (
  SELECT target, count("{c}") AS n, avg(CAST("{c}" AS DOUBLE)) AS m, sum(CAST("{c}" AS DOUBLE) * CAST("{c}" AS DOUBLE)) AS s2
  FROM feat WHERE target IS NOT NULL GROUP BY target)"""


@q("l1_anova_f", FEAT_SQL + " UNION ALL ".join(_anova_sql(c) for c in FEATS))
def l1_anova_f(spark, sf):
    d = _feature_frame(spark, sf).where("target IS NOT NULL")
    return AS.anova_f(d, FEATS, "target").select("name", r6("f_score"))


# ------------------------------------------------------------ folds

@q("w4_stratified_kfold", with_(FX1) + """
SELECT id, CAST(ntile(4) OVER (PARTITION BY target ORDER BY id) - 1 AS INTEGER) AS fold FROM fx1 WHERE is_train""")
def w4_stratified_kfold(spark, sf):
    d = fx.claims(spark, sf).where("is_train").select("id", "target")
    return FO.stratified_kfold(d, "target", 4).select("id", "fold")


@q("w5_positional_holdout", with_(FX1) + """
SELECT id, row_number() OVER (ORDER BY id) <= floor(0.75 * count(*) OVER ()) AS is_fit FROM fx1""")
def w5_positional_holdout(spark, sf):
    return FO.positional_holdout(fx.claims(spark, sf).select("id"), 0.75)


@q("v1_random_split", with_(FX1) + f"""
SELECT id, CAST('0x' || substr(md5('2017:' || id), 1, 15) AS BIGINT) < {int(round(0.7 * 16 ** 15))} AS is_fit FROM fx1""")
def v1_random_split(spark, sf):
    return FO.random_split(fx.claims(spark, sf).select("id"), 0.7, seed=2017)


@q("v2_stratified_split", with_(FX1) + """
SELECT id, target, row_number() OVER (PARTITION BY target ORDER BY CAST('0x' || substr(md5('2017:' || id), 1, 15) AS BIGINT), id) - 1
       < floor(count(*) OVER (PARTITION BY target) * CAST(0.8 AS DOUBLE)) AS is_fit FROM fx1 WHERE is_train""")
def v2_stratified_split(spark, sf):
    d = fx.claims(spark, sf).where("is_train").select("id", "target")
    return FO.stratified_split(d, "target", 0.8, seed=2017)


@q("v3_shuffled_kfold", with_(FX1) + """
SELECT id, target, CAST(ntile(5) OVER (PARTITION BY target ORDER BY CAST('0x' || substr(md5('2017:' || id), 1, 15) AS BIGINT), id) - 1 AS INTEGER) AS fold
FROM fx1 WHERE is_train""")
def v3_shuffled_kfold(spark, sf):
    d = fx.claims(spark, sf).where("is_train").select("id", "target")
    return FO.shuffled_stratified_kfold(d, "target", 5, seed=2017)


@q("v4_ordinal_labels", with_(FX4) + "SELECT id, " + ", ".join(
    f"CAST(response <= {k + 1} AS INTEGER) AS label_{k}" for k in range(7)) + " FROM fx4 WHERE is_train")
def v4_ordinal_labels(spark, sf):
    d = fx.ordinal(spark, sf).where("is_train")
    return d.select("id", *FO.ordinal_labels("response", 8))


# ------------------------------------------------------------ metrics

@q("a17_log_loss", with_(FX8) + " UNION ALL ".join(
    f"""SELECT '{m}' AS model, round(-avg(target * ln(greatest(least({m}, 1 - 1e-15), 1e-15))
       + (1 - target) * ln(1 - greatest(least({m}, 1 - 1e-15), 1e-15))), 6) AS logloss FROM fx8 WHERE target IS NOT NULL"""
    for m in MODELS))
def a17_log_loss(spark, sf):
    d = fx.predictions(spark, sf)
    long = d.select("id", "target", F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("p")) for m in MODELS])).alias("kv")).select(
        "id", "target", "kv.*")
    return ME.log_loss(long, "target", "p", by=["model"]).select("model", r6("logloss"))


KAPPA_FX = with_(FX4, """k AS (SELECT id, response AS y, CAST(p_size AS DOUBLE) * CAST(0.16 AS DOUBLE) + ((id % 5) - 2) * CAST(0.3 AS DOUBLE) AS pred FROM fx4 WHERE is_train),
rng AS (SELECT min(y) AS lo, max(y) AS hi FROM k),
r AS (SELECT y, CAST(least(greatest(round_even(pred, 0), lo), hi) AS INTEGER) AS a FROM k, rng)""")


@q("a18_kappa", KAPPA_FX + """, conf AS (SELECT a, y, count(*) AS o FROM r GROUP BY a, y),
ha AS (SELECT a, count(*) AS n FROM r GROUP BY a), hb AS (SELECT y, count(*) AS n FROM r GROUP BY y),
tot AS (SELECT count(*) AS n FROM r),
num AS (SELECT sum(o * (a - y) * (a - y)) AS v FROM conf),
den AS (SELECT sum(ha.n * hb.n * (ha.a - hb.y) * (ha.a - hb.y)) / (SELECT n FROM tot) AS v FROM ha, hb)
SELECT round(1 - (SELECT v FROM num) / (SELECT v FROM den), 6) AS kappa""")
def a18_kappa(spark, sf):
    d = _ordinal_frame(spark, sf).where("is_train")
    return ME.kappa(d, "y", "pred").select(r6("kappa"))


@q("t7_balanced_weights", with_(FX1, """c AS (SELECT target, count(*) AS n FROM fx1 WHERE target IS NOT NULL GROUP BY target)""") + """
SELECT f.id, round((SELECT sum(n) FROM c) / (2.0 * c.n), 6) AS weight FROM fx1 f JOIN c ON f.target = c.target""")
def t7_balanced_weights(spark, sf):
    d = fx.claims(spark, sf).where("target IS NOT NULL").select("id", "target")
    return ME.balanced_weights(d, "target").select("id", r6("weight"))


# ------------------------------------------------------------ blends and reports

WEAK = "m3, m7, m11, m13, m17"


def _weak_sql():
    return """b AS (SELECT id, list_sort([m3, m7, m11, m13, m17]) AS s, (m3 + m7 + m11 + m13 + m17) / 5 AS avg FROM fx8),
w AS (SELECT id, avg, s, CASE WHEN avg > 0.95 THEN (s[2] + s[3] + s[4] + s[5]) / 4 ELSE avg END AS e1 FROM b),
w2 AS (SELECT id, avg, s, CASE WHEN e1 < 0.5 THEN (s[1] + s[2]) / 2 ELSE e1 END AS e2 FROM w),
weak AS (SELECT id, CASE WHEN avg < 0.15 THEN s[1] ELSE e2 END AS weak FROM w2)"""


@q("b1_weak_blend", with_(FX8, _weak_sql()) + "SELECT id, round(weak, 6) AS weak FROM weak")
def b1_weak_blend(spark, sf):
    d = fx.predictions(spark, sf)
    return BL.weak_blend_df(d, MODELS, "weak", top_k=4, bottom_k=2).select("id", r6("weak"))


@q("b2_strong_blend", with_(FX8, _weak_sql(), """s AS (SELECT f.id, list_sort([f.m3, f.m7, w.weak]) AS s,
  (f.m3 + f.m7 + w.weak) / 3 AS avg FROM fx8 f JOIN weak w ON f.id = w.id),
s1 AS (SELECT id, avg, s, CASE WHEN avg > 0.97 THEN 0.4 * s[2] + 0.6 * s[3] ELSE avg END AS e1 FROM s),
s2 AS (SELECT id, avg, s, CASE WHEN e1 < 0.5 THEN 0.6 * s[1] + 0.4 * s[2] ELSE e1 END AS e2 FROM s1)""") + """
SELECT id, round(CASE WHEN avg < 0.15 THEN s[1] ELSE e2 END, 6) AS strong FROM s2""")
def b2_strong_blend(spark, sf):
    d = fx.predictions(spark, sf)
    w = BL.weak_blend_df(d, MODELS, "weak", top_k=4, bottom_k=2).select("id", "m3", "m7", "weak")
    return BL.strong_blend_df(w, ["m3", "m7", "weak"], "strong").select("id", r6("strong"))


OFFS_SQL = with_(FX4, """k AS (SELECT id, response AS y, CAST(p_size AS DOUBLE) * CAST(0.16 AS DOUBLE) + ((id % 5) - 2) * CAST(0.3 AS DOUBLE) AS pred, is_train FROM fx4),
qq AS (SELECT quantile_cont(pred, [0.10, 0.21, 0.23, 0.25, 0.35, 0.54, 0.68]) AS v FROM k WHERE NOT is_train),
off AS (SELECT cls, CAST(c AS DOUBLE) AS c, i FROM (VALUES (0, 1.5, 1), (1, 2.5, 2), (2, 3.5, 3), (3, 4.5, 4), (5, 5.5, 5), (6, 6.5, 6), (7, 7.5, 7)) t(cls, c, i))""")


@q("b3_initial_offsets", OFFS_SQL + """
SELECT cls, round(-(v[i] - c), 6) AS offset FROM off, qq
UNION ALL SELECT 4, CAST(0.0 AS DOUBLE)""")
def b3_initial_offsets(spark, sf):
    d = _ordinal_frame(spark, sf)
    offs = BL.initial_offsets(d.where("NOT is_train"), "pred")
    t = BL.offsets_table(spark, offs)
    return t.select("cls", r6("offset"))


@q("b4_apply_offsets", OFFS_SQL + """, o AS (SELECT cls, -(v[i] - c) AS offset FROM off, qq UNION ALL SELECT 4, CAST(0.0 AS DOUBLE))
SELECT k.id, CAST(round_even(least(greatest(k.pred + coalesce(o.offset, 0.0), 1.0), 8.0), 0) AS INTEGER) AS label
FROM k LEFT JOIN o ON CAST(trunc(k.pred) AS INTEGER) = o.cls WHERE NOT k.is_train""")
def b4_apply_offsets(spark, sf):
    d = _ordinal_frame(spark, sf)
    test = d.where("NOT is_train")
    offs = BL.initial_offsets(test, "pred")
    return BL.apply_offsets(test, offs, "pred").select("id", "label")


@q("b5_tune_offsets")
def b5_tune_offsets(spark, sf):
    """Offsets tuned for kappa on the train side, class by class."""
    d = _ordinal_frame(spark, sf)
    offs = BL.initial_offsets(d.where("NOT is_train"), "pred")
    tuned = BL.tune_offsets(d.where("is_train"), offs, "y", "pred", span=1.0)
    return BL.offsets_table(spark, tuned).select("cls", r6("offset"))


@q("a21_rowwise_stats", with_(FX8) + """
SELECT id, round(m3 + m7 + m11 + m13 + m17, 6) AS row_sum, round((m3 + m7 + m11 + m13 + m17) / 5, 6) AS row_mean,
       round(least(m3, m7, m11, m13, m17), 6) AS row_min, round(greatest(m3, m7, m11, m13, m17), 6) AS row_max,
       round(greatest(m3, m7, m11, m13, m17) - least(m3, m7, m11, m13, m17), 6) AS row_range, 0 AS row_nulls FROM fx8""")
def a21_rowwise_stats(spark, sf):
    d = fx.predictions(spark, sf)
    return d.select("id", r6(RW.row_sum(MODELS), "row_sum"), r6(RW.row_mean(MODELS), "row_mean"),
                    r6(RW.row_min(MODELS), "row_min"), r6(RW.row_max(MODELS), "row_max"),
                    r6(RW.row_range(MODELS), "row_range"), RW.row_nulls(MODELS).alias("row_nulls"))


@q("a22_row_k_means", with_(FX8) + """
SELECT id, round((list_sort([m3, m7, m11, m13, m17])[1] + list_sort([m3, m7, m11, m13, m17])[2]) / 2, 6) AS small2mean,
       round((list_sort([m3, m7, m11, m13, m17])[3] + list_sort([m3, m7, m11, m13, m17])[4]
             + list_sort([m3, m7, m11, m13, m17])[5]) / 3, 6) AS large3mean,
       round(list_sort([m3, m7, m11])[2], 6) AS middle3 FROM fx8""")
def a22_row_k_means(spark, sf):
    d = fx.predictions(spark, sf)
    return d.select("id", r6(RW.mean_of_smallest(MODELS, 2), "small2mean"),
                    r6(RW.mean_of_largest(MODELS, 3), "large3mean"), r6(RW.middle(["m3", "m7", "m11"]), "middle3"))


@q("a24_mean_of_sets", with_(FX8) + """
SELECT id, round((m3 + m7 + m11 + m13 + m17) / 5, 6) AS pred FROM fx8""")
def a24_mean_of_sets(spark, sf):
    long = fx.prediction_sets(spark, sf)
    return BL.mean_over_sets(long, ["id"]).select("id", r6("pred"))


@q("k10_side_by_side", with_(FX8) + """
SELECT id, round(m3, 6) AS m3, round(m7, 6) AS m7, round(m11, 6) AS m11, round((m3 + m7 + m11) / 3, 6) AS avg,
       round(least(m3, m7, m11), 6) AS min, round(greatest(m3, m7, m11), 6) AS max,
       round(greatest(m3, m7, m11) - least(m3, m7, m11), 6) AS diff FROM fx8""")
def k10_side_by_side(spark, sf):
    d = fx.predictions(spark, sf).select("id", "m3", "m7", "m11")
    s = BL.side_by_side(d, ["m3", "m7", "m11"])
    return s.select("id", *[r6(c) for c in ("m3", "m7", "m11", "avg", "min", "max", "diff")])


@q("a19_disagreement_counts", with_(FX8) + """
SELECT CAST(i AS INTEGER) AS step, CAST(count_if(greatest(m3, m7, m11) - least(m3, m7, m11) > i / 10) AS BIGINT) AS n
FROM fx8, range(0, 10) t(i) GROUP BY i""")
def a19_disagreement_counts(spark, sf):
    d = BL.side_by_side(fx.predictions(spark, sf).select("id", "m3", "m7", "m11"), ["m3", "m7", "m11"])
    return BL.disagreement_counts(d).select(F.col("step").cast("int"), "n")


@q("s12_disagreement_report", with_(FX8) + """
SELECT id AS "ID", round((m3 + m7 + m11) / 3, 6) AS "PredictedProb",
       round(greatest(m3, m7, m11) - least(m3, m7, m11), 6) AS diff FROM fx8""")
def s12_disagreement_report(spark, sf):
    d = BL.side_by_side(fx.predictions(spark, sf).select("id", "m3", "m7", "m11"), ["m3", "m7", "m11"])
    return d.select(F.col("id").alias("ID"), r6("avg", "PredictedProb"), r6("diff"))


@q("a15_onehot_target_corr", with_(FX1) + " UNION ALL ".join(
    f"""SELECT 'o_orderpriority_{v}' AS name, round(corr(CAST(coalesce(o_orderpriority = '{v}', false) AS DOUBLE),
       CAST(target AS DOUBLE)), 6) AS r FROM fx1 WHERE target IS NOT NULL""" for v in PRI)
    + """ UNION ALL SELECT 'o_orderpriority_nan', round(corr(CAST(o_orderpriority IS NULL AS DOUBLE),
       CAST(target AS DOUBLE)), 6) FROM fx1 WHERE target IS NOT NULL""")
def a15_onehot_target_corr(spark, sf):
    """Correlation of every dummy of a categorical with the target in one
    grouped pass (no dummy columns are built)."""
    r = AS.onehot_target_corr(fx.claims(spark, sf), "o_orderpriority", "target")
    return r.select("name", r6("r"))
