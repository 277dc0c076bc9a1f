"""Queries for encoders, target statistics and missing-value operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackyard.operators import encode as E
from stackyard.operators.joins import orphan_values
from stackyard.plans.common import r6
from stackyard.plans.fixture_sql import FX1, FX2, FX4, FX6, FX7, with_
from stackyard.sources import fixtures as fx

QUERIES, SQL = {}, {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# E15 on a high-cardinality key (FX2): orphans, missing, support >= 8.
@q("e15_target_stats_high_card", with_(FX2, """sides AS (
  SELECT cust, max(CAST(is_train AS INT)) AS tr, min(CAST(is_train AS INT)) AS te FROM fx2 GROUP BY cust),
prep AS (
  SELECT f.id, f.target, f.is_train,
         CASE WHEN f.cust IS NULL THEN 'Missing'
              WHEN s.tr = 1 AND s.te = 0 THEN f.cust ELSE 'Orphans' END AS cust
  FROM fx2 f LEFT JOIN sides s ON f.cust = s.cust),
st AS (
  SELECT cust, avg(target) AS a, stddev_samp(target) AS s FROM prep WHERE is_train
  GROUP BY cust HAVING count(*) >= 8)""") + """
SELECT p.id, p.is_train, round(st.a, 6) AS cust_avg, round(st.s, 6) AS cust_std
FROM prep p LEFT JOIN st ON p.cust = st.cust""")
def e15_target_stats_high_card(spark, sf):
    d = E.target_stats_encode(fx.high_card(spark, sf), "cust", min_support=8)
    return d.select("id", "is_train", r6("cust_avg"), r6("cust_std"))


@q("e15_target_stats", with_(FX1, """p AS (
  SELECT id, target, is_train, coalesce(o_orderpriority, 'Missing') AS pr,
         coalesce(c_mktsegment, 'Missing') AS sg FROM fx1),
a AS (SELECT pr, avg(target) AS a, stddev_samp(target) AS s FROM p WHERE is_train GROUP BY pr HAVING count(*) >= 50),
b AS (SELECT sg, avg(target) AS a, stddev_samp(target) AS s FROM p WHERE is_train GROUP BY sg HAVING count(*) >= 50)""") + """
SELECT p.id, round(a.a, 6) AS o_orderpriority_avg, round(a.s, 6) AS o_orderpriority_std,
       round(b.a, 6) AS c_mktsegment_avg, round(b.s, 6) AS c_mktsegment_std
FROM p LEFT JOIN a ON p.pr = a.pr LEFT JOIN b ON p.sg = b.sg""")
def e15_target_stats(spark, sf):
    base = fx.claims(spark, sf).select("id", "target", "is_train", "o_orderpriority", "c_mktsegment")
    fitted = [E.fit_target_encoding(base, c) for c in ("o_orderpriority", "c_mktsegment")]
    d = base
    for f in fitted:
        d = f.transform(d)
    return d.select("id", *[r6(c) for c in ("o_orderpriority_avg", "o_orderpriority_std",
                                            "c_mktsegment_avg", "c_mktsegment_std")])


@q("e1_label_encode", with_(FX4) + """
SELECT id, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand,
       CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS p_type FROM fx4""")
def e1_label_encode(spark, sf):
    base = fx.ordinal(spark, sf).select("id", "p_brand", "p_type")
    fitted = [E.fit_sorted_codes(base, c) for c in ("p_brand", "p_type")]  # fit on the base frame
    d = base
    for f in fitted:
        d = f.transform(d)
    return d


@q("e2_factorize_train", with_(FX2, """codes AS (
  SELECT cust, row_number() OVER (ORDER BY min(id)) - 1 AS code FROM fx2
  WHERE is_train AND cust IS NOT NULL GROUP BY cust)""") + """
SELECT f.id, CAST(coalesce(c.code, -1) AS BIGINT) AS cust FROM fx2 f LEFT JOIN codes c ON f.cust = c.cust""")
def e2_factorize_train(spark, sf):
    d = fx.high_card(spark, sf)
    codes = E.fit_first_seen(d, "cust", where=F.col("is_train"), missing_code=-1)
    return codes.transform(d).select("id", F.col("cust").cast("bigint"))


@q("e3_factorize_union", with_(FX1, """a AS (SELECT o_orderpriority v, row_number() OVER (ORDER BY min(id)) - 1 AS code
  FROM fx1 WHERE o_orderpriority IS NOT NULL GROUP BY 1),
b AS (SELECT c_mktsegment v, row_number() OVER (ORDER BY min(id)) - 1 AS code
  FROM fx1 WHERE c_mktsegment IS NOT NULL GROUP BY 1)""") + """
SELECT f.id, CAST(coalesce(a.code, -9999) AS BIGINT) AS o_orderpriority,
       CAST(coalesce(b.code, -9999) AS BIGINT) AS c_mktsegment
FROM fx1 f LEFT JOIN a ON f.o_orderpriority = a.v LEFT JOIN b ON f.c_mktsegment = b.v""")
def e3_factorize_union(spark, sf):
    base = fx.claims(spark, sf).select("id", "o_orderpriority", "c_mktsegment")
    fitted = [E.fit_first_seen(base, c, missing_code=-9999) for c in ("o_orderpriority", "c_mktsegment")]
    d = base
    for f in fitted:
        d = f.transform(d)
    return d.select("id", *[F.col(c).cast("bigint") for c in ("o_orderpriority", "c_mktsegment")])


@q("e4_strided_codes", with_(FX1, """f AS (SELECT id, coalesce(c_mktsegment, '-9999') AS v FROM fx1),
c AS (SELECT v, 1000 + 5 * (row_number() OVER (ORDER BY min(id)) - 1) AS code FROM f GROUP BY v)""") + """
SELECT f.id, CAST(c.code AS BIGINT) AS c_mktsegment_vect_ FROM f JOIN c ON f.v = c.v""")
def e4_strided_codes(spark, sf):
    d = fx.claims(spark, sf).select("id", "c_mktsegment")
    d = E.strided_codes(d, "c_mktsegment")
    return d.select("id", F.col("c_mktsegment_vect_").cast("bigint"))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _dummy_sql(col, values, sep="_", quote=True):
    lit = (lambda v: f"'{v}'") if quote else str
    return ", ".join(f'CAST(coalesce({col} = {lit(v)}, false) AS INTEGER) AS "{col}{sep}{v}"'
                     for v in values)


@q("e5_onehot_all", with_(FX1) + f"SELECT id, {_dummy_sql('o_orderpriority', PRIORITIES)} FROM fx1")
def e5_onehot_all(spark, sf):
    d = fx.claims(spark, sf).select("id", "o_orderpriority")
    return E.onehot_all(d, "o_orderpriority", max_values=150)


@q("e6_onehot_drop_last", with_(FX1) + f"SELECT id, {_dummy_sql('c_mktsegment', SEGMENTS)} FROM fx1")
def e6_onehot_drop_last(spark, sf):
    d = fx.claims(spark, sf).select("id", "c_mktsegment")
    return E.onehot_drop_last(d, "c_mktsegment")


@q("e7_to_onehot", with_(FX1) + "SELECT id, "
   + _dummy_sql("o_orderpriority", PRIORITIES, "__")
   + ', CAST(o_orderpriority IS NULL AS INTEGER) AS "o_orderpriority__nan", '
   + _dummy_sql("c_nationkey", range(25), "__", quote=False) + ", target FROM fx1")
def e7_to_onehot(spark, sf):
    # target has 2 values (+ null = 3 > 2, so it is encoded unless excluded): keep it raw
    d = fx.claims(spark, sf).select("id", "o_orderpriority", "c_nationkey", "target")
    return E.to_onehot(d, ["o_orderpriority", "c_nationkey"])


@q("e8_onehot_same_max", with_(FX1) + "SELECT id, "
   + _dummy_sql("c_nationkey", range(24), quote=False) + " FROM fx1")
def e8_onehot_same_max(spark, sf):
    d = fx.claims(spark, sf).select("id", "is_train", "c_nationkey")
    return E.onehot_if_same_max(d, "c_nationkey").drop("is_train")


@q("e9_route_encode", with_(FX1, """mm AS (SELECT CAST(trunc(min(o_totalprice)) AS INTEGER) - 2 AS m1, max(o_totalprice) AS x1,
  CAST(trunc(min(c_nationkey)) AS INTEGER) - 2 AS m2, max(c_nationkey) AS x2 FROM fx1)""") + "SELECT id, "
   + _dummy_sql("o_orderpriority", PRIORITIES)
   + ', CAST(o_orderpriority IS NULL AS INTEGER) AS "o_orderpriority_nan", '
   + """round((coalesce(o_totalprice, m1) - m1) / (x1 - m1), 6) AS o_totalprice,
   CAST(coalesce(o_totalprice, m1) = m1 AS INTEGER) AS o_totalprice_na,
   round((coalesce(c_nationkey, m2) - m2) / (x2 - m2), 6) AS c_nationkey,
   CAST(coalesce(c_nationkey, m2) = m2 AS INTEGER) AS c_nationkey_na
FROM fx1, mm""")
def e9_route_encode(spark, sf):
    d = fx.claims(spark, sf).select("id", "target", "is_train", "o_orderpriority", "o_totalprice",
                                    "c_nationkey")
    out = E.route_encode(d, ["o_orderpriority", "o_totalprice", "c_nationkey"])
    return out.drop("target", "is_train").select(
        *[r6(c) if c in ("o_totalprice", "c_nationkey") else F.col(c) for c in
          out.drop("target", "is_train").columns])


SOURCES = [f"src{i}" for i in range(20)]


@q("e10_onehot_fit_train", with_(FX7, """tr AS (SELECT DISTINCT source FROM fx7 WHERE is_train)""") + """
SELECT id, """ + ", ".join(
    f"""CAST(coalesce(source = '{v}' AND '{v}' IN (SELECT source FROM tr), false) AS INTEGER) AS "source_{v}\""""
    for v in SOURCES) + " FROM fx7")
def e10_onehot_fit_train(spark, sf):
    d = fx.labelled_docs(spark, sf).select("id", "is_train", "source")
    vals = E.onehot_fit(d, "source", where=F.col("is_train"))
    return E.binarize(d, "source", vals).drop("is_train")


@q("e11_binarize_list", with_(FX7) + "SELECT id, " + _dummy_sql("lang", ["de", "en", "es"]) + " FROM fx7")
def e11_binarize_list(spark, sf):
    d = fx.labelled_docs(spark, sf).select("id", "lang")
    return E.binarize(d, "lang", ["de", "en", "es"])


@q("e12_onehot_in_place", with_(FX1) + "SELECT id, round(o_totalprice, 6) AS o_totalprice, "
   + _dummy_sql("o_orderpriority", PRIORITIES) + ", round(c_acctbal, 6) AS c_acctbal, "
   + _dummy_sql("c_mktsegment", SEGMENTS) + " FROM fx1")
def e12_onehot_in_place(spark, sf):
    d = fx.claims(spark, sf).select("id", "o_totalprice", "o_orderpriority", "c_acctbal", "c_mktsegment")
    d = E.onehot_in_place(d, ["o_orderpriority", "c_mktsegment"])
    return d.select(*[r6(c) if c in ("o_totalprice", "c_acctbal") else F.col(c) for c in d.columns])


@q("e14_frequency_bucket", with_(FX2, """f AS (SELECT id, is_train, coalesce(cust, 'C0') AS cust FROM fx2),
cnt AS (SELECT cust, count(*) AS n FROM f WHERE is_train GROUP BY cust)""") + """
SELECT f.id, 'C' || CAST(coalesce(cnt.n, 1) AS VARCHAR) AS cust FROM f LEFT JOIN cnt ON f.cust = cnt.cust""")
def e14_frequency_bucket(spark, sf):
    d = fx.high_card(spark, sf)
    return E.frequency_bucket(d, "cust").select("id", "cust")


@q("e16_target_weight", with_(FX2, """g AS (SELECT cust, sum(target) AS s, count(*) AS c FROM fx2
  WHERE is_train AND cust IS NOT NULL GROUP BY cust)""") + """
SELECT f.id, round(coalesce(CASE WHEN g.s > g.c - g.s THEN 0.5 + 0.5 * g.s / g.c
  ELSE 0.5 + 0.5 * (g.s - g.c) / g.c END, 0.5), 6) AS custweight
FROM fx2 f LEFT JOIN g ON f.cust = g.cust""")
def e16_target_weight(spark, sf):
    d = fx.high_card(spark, sf)
    return E.target_weight(d, "cust").select("id", r6("custweight"))


@q("e17_bernoulli_nb", with_(FX1, """f AS (SELECT id, target, is_train, coalesce(o_orderpriority, 'nan') AS v FROM fx1),
ny AS (SELECT count(*) AS n, sum(target) AS n1 FROM f WHERE is_train),
nv AS (SELECT v, sum(target) AS c1, sum(1 - target) AS c0 FROM f WHERE is_train GROUP BY v),
th AS (SELECT v, (c0 + 1.0) / (n - n1 + 2.0) AS t0, (c1 + 1.0) / (n1 + 2.0) AS t1 FROM nv, ny),
k AS (SELECT ln((SELECT (n - n1) * 1.0 / n FROM ny)) + sum(ln(1 - t0)) AS k0,
             ln((SELECT n1 * 1.0 / n FROM ny)) + sum(ln(1 - t1)) AS k1 FROM th)""") + """
SELECT f.id, round(1.0 / (1.0 + exp(coalesce(k.k0 + ln(th.t0) - ln(1 - th.t0), k.k0)
                                 - coalesce(k.k1 + ln(th.t1) - ln(1 - th.t1), k.k1))), 6) AS o_orderpriority
FROM f LEFT JOIN th ON f.v = th.v, k""")
def e17_bernoulli_nb(spark, sf):
    d = fx.claims(spark, sf).select("id", "target", "is_train", "o_orderpriority")
    return E.bernoulli_nb_encode(d, "o_orderpriority").select("id", r6("o_orderpriority"))


@q("o3_top20_categories", with_(FX2, """c AS (SELECT cust, count(*) AS n FROM fx2 WHERE cust IS NOT NULL GROUP BY cust),
k AS (SELECT cust FROM c ORDER BY n DESC, cust ASC LIMIT 20)""") + """
SELECT f.id, CASE WHEN k.cust IS NOT NULL THEN f.cust END AS cust FROM fx2 f LEFT JOIN k ON f.cust = k.cust""")
def o3_top20_categories(spark, sf):
    return E.top_k_or_null(fx.high_card(spark, sf), "cust", 20).select("id", "cust")


@q("j4_orphans", with_(FX2, """s AS (SELECT cust, max(CAST(is_train AS INT)) AS tr, min(CAST(is_train AS INT)) AS te
  FROM fx2 GROUP BY cust)""") + """
SELECT f.id, CASE WHEN f.cust IS NULL THEN NULL WHEN s.tr = 1 AND s.te = 0 THEN f.cust ELSE 'Orphans' END AS cust
FROM fx2 f LEFT JOIN s ON f.cust = s.cust""")
def j4_orphans(spark, sf):
    return orphan_values(fx.high_card(spark, sf), "cust").select("id", "cust")


@q("j6_code_lookup", with_(FX7, """codes AS (SELECT source, row_number() OVER (ORDER BY min(id)) - 1 AS code
  FROM fx7 WHERE is_train GROUP BY source)""") + """
SELECT f.id, CAST(coalesce(c.code, -1) AS BIGINT) AS source FROM fx7 f LEFT JOIN codes c ON f.source = c.source
WHERE NOT f.is_train""")
def j6_code_lookup(spark, sf):
    d = fx.labelled_docs(spark, sf)
    codes = E.fit_first_seen(d, "source", where=F.col("is_train"), missing_code=-1)
    return codes.transform(d.where(~F.col("is_train"))).select("id", F.col("source").cast("bigint"))


@q("w3_first_seen_codes", with_(FX6, """c AS (SELECT word, row_number() OVER (ORDER BY min(id)) - 1 AS code
  FROM fx6 GROUP BY word)""") + """
SELECT f.id, CAST(c.code AS BIGINT) AS word FROM fx6 f JOIN c ON f.word = c.word""")
def w3_first_seen_codes(spark, sf):
    d = fx.letters(spark, sf)
    return E.fit_first_seen(d, "word").transform(d).select("id", F.col("word").cast("bigint"))


@q("m1_fill_constant", with_(FX1) + """
SELECT id, round(coalesce(o_totalprice, -997), 6) AS o_totalprice, round(coalesce(c_acctbal, -997), 6) AS c_acctbal,
       coalesce(o_orderpriority, '-997') AS o_orderpriority FROM fx1""")
def m1_fill_constant(spark, sf):
    d = fx.claims(spark, sf).select("id", "o_totalprice", "c_acctbal", "o_orderpriority")
    d = E.fill_constant(d, -997, ["o_totalprice", "c_acctbal"])
    d = E.fill_constant(d, "-997", ["o_orderpriority"])
    return d.select("id", r6("o_totalprice"), r6("c_acctbal"), "o_orderpriority")


@q("m2_fill_mean", with_(FX1) + """
SELECT id, round(coalesce(o_totalprice, (SELECT avg(o_totalprice) FROM fx1)), 6) AS o_totalprice,
       round(coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM fx1)), 6) AS c_acctbal FROM fx1""")
def m2_fill_mean(spark, sf):
    d = fx.claims(spark, sf).select("id", "o_totalprice", "c_acctbal")
    d = E.fill_mean(d, ["o_totalprice", "c_acctbal"])
    return d.select("id", r6("o_totalprice"), r6("c_acctbal"))


@q("m3_fill_mode", with_(FX1, """a AS (SELECT o_orderpriority AS v FROM fx1 WHERE is_train AND o_orderpriority IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1),
b AS (SELECT c_mktsegment AS v FROM fx1 WHERE is_train AND c_mktsegment IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)""") + """
SELECT id, coalesce(o_orderpriority, (SELECT v FROM a)) AS o_orderpriority,
       coalesce(c_mktsegment, (SELECT v FROM b)) AS c_mktsegment FROM fx1""")
def m3_fill_mode(spark, sf):
    d = fx.claims(spark, sf).select("id", "is_train", "o_orderpriority", "c_mktsegment")
    return E.fill_mode(d, ["o_orderpriority", "c_mktsegment"], F.col("is_train")).drop("is_train")


@q("m4_null_indicators", with_(FX1) + """
SELECT id, CAST(o_totalprice IS NULL AS DOUBLE) AS o_totalprice_nan_, CAST(c_acctbal IS NULL AS DOUBLE) AS c_acctbal_nan_,
       CAST(o_orderpriority IS NULL AS DOUBLE) AS o_orderpriority_nan_,
       CAST(c_mktsegment IS NULL AS DOUBLE) AS c_mktsegment_nan_ FROM fx1""")
def m4_null_indicators(spark, sf):
    cols = ["o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment"]
    d = fx.claims(spark, sf).select("id", *cols)
    return E.null_indicators(d, cols).drop(*cols)


@q("m5_null_count_row", with_(FX1) + """
SELECT id, CAST(o_totalprice IS NULL AS INTEGER) + CAST(c_acctbal IS NULL AS INTEGER)
   + CAST(o_orderpriority IS NULL AS INTEGER) + CAST(c_mktsegment IS NULL AS INTEGER)
   + CAST(c_nationkey IS NULL AS INTEGER) AS null_count FROM fx1""")
def m5_null_count_row(spark, sf):
    cols = ["o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment", "c_nationkey"]
    d = fx.claims(spark, sf)
    return d.select("id", E.null_count_row(cols).alias("null_count"))


@q("m6_named_missing", with_(FX1) + """
SELECT id, coalesce(o_orderpriority, 'ZZZZZ') AS o_orderpriority, coalesce(c_mktsegment, 'ZZZZZ') AS c_mktsegment FROM fx1""")
def m6_named_missing(spark, sf):
    d = fx.claims(spark, sf).select("id", "o_orderpriority", "c_mktsegment")
    return E.named_missing(d, ["o_orderpriority", "c_mktsegment"], "ZZZZZ")
