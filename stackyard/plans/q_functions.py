"""Queries for scalar functions, scale recovery, projections, set
operations, sorts and sinks (F*, W1, W6, P1-P13, P19, P21, U*, O1, O4-O6,
J1-J3, S1-S5, S9-S12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stackyard.functions import rowwise as RW
from stackyard.functions import scalar as SF
from stackyard.operators import columns as C
from stackyard.operators import encode as E
from stackyard.operators import scale as SC
from stackyard.operators.joins import join_on_id
from stackyard.plans.common import r6
from stackyard.plans.fixture_sql import FX1, FX6, FX8, with_
from stackyard.sources import fixtures as fx
from stackyard.session import shared_folder
from stackyard.sources import sinks as SK
from stackyard.sources.tables import load, read_csv_table

QUERIES, SQL = {}, {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ scalar functions

@q("f1_az_to_int", with_(FX6) + """
SELECT id, CASE WHEN word = '' THEN 0 ELSE list_reduce(list_transform(string_split(lower(word), ''),
  lambda c: CAST(ascii(c) AS BIGINT) - 96), lambda a, x: a * 26 + x) END AS word_int FROM fx6""")
def f1_az_to_int(spark, sf):
    return fx.letters(spark, sf).select("id", SF.az_to_int("word").alias("word_int"))


@q("f2_padded_codes", with_(FX6, """p AS (SELECT id, CASE WHEN length(word) >= 4 THEN substr(word, 1, 4)
  ELSE repeat('@', 4 - length(word)) || word END AS s FROM fx6)""") + """
SELECT id, ascii(substr(s, 1, 1)) AS "word-1", ascii(substr(s, 2, 1)) AS "word-2",
       ascii(substr(s, 3, 1)) AS "word-3", ascii(substr(s, 4, 1)) AS "word-4" FROM p""")
def f2_padded_codes(spark, sf):
    cs = SF.padded_codes("word")
    return fx.letters(spark, sf).select("id", *[c.alias(f"word-{i + 1}") for i, c in enumerate(cs)])


@q("f3_first_second_char", with_(FX6, """p AS (SELECT id, word, substr(word, 1, 1) AS c1, substr(word, 2, 1) AS c2 FROM fx6),
a AS (SELECT c1, row_number() OVER (ORDER BY min(id)) - 1 AS k FROM p GROUP BY c1),
b AS (SELECT c2, row_number() OVER (ORDER BY min(id)) - 1 AS k FROM p GROUP BY c2)""") + """
SELECT p.id, p.c1 AS word_char, p.c2 AS word_num, CAST(a.k AS BIGINT) AS word_char_code, CAST(b.k AS BIGINT) AS word_num_code
FROM p JOIN a ON p.c1 = a.c1 JOIN b ON p.c2 = b.c2""")
def f3_first_second_char(spark, sf):
    d = fx.letters(spark, sf).select("id", SF.char_at("word", 1).alias("word_char"),
                                     SF.char_at("word", 2).alias("word_num"))
    d = d.withColumn("word_char_code", F.col("word_char")).withColumn("word_num_code", F.col("word_num"))
    fitted = [E.fit_first_seen(d, c) for c in ("word_char_code", "word_num_code")]
    for f in fitted:
        d = f.transform(d)
    return d.select("id", "word_char", "word_num", F.col("word_char_code").cast("bigint"),
                    F.col("word_num_code").cast("bigint"))


@q("f4_concat_pair", with_(FX1) + """
SELECT coalesce(o_orderpriority, 'NaN') || '__' || coalesce(c_mktsegment, 'NaN') AS pair, count(*) AS n
FROM fx1 GROUP BY 1""")
def f4_concat_pair(spark, sf):
    d = fx.claims(spark, sf)
    return d.groupBy(SF.concat_pair("o_orderpriority", "c_mktsegment").alias("pair")).agg(
        F.count(F.lit(1)).alias("n"))


@q("f5_format_count", with_(FX1) + """
SELECT c_nationkey, 'C' || CAST(count(*) AS VARCHAR) AS label FROM fx1 GROUP BY 1""")
def f5_format_count(spark, sf):
    g = fx.claims(spark, sf).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return g.select("c_nationkey", SF.count_label("n").alias("label"))


@q("f6_capitals", """
SELECT o_orderkey, regexp_replace(o_orderpriority, '[^A-Z]', '', 'g') AS caps FROM orders""")
def f6_capitals(spark, sf):
    o = load(spark, sf, "orders", ["o_orderkey", "o_orderpriority"])
    return o.select("o_orderkey", SF.capitals("o_orderpriority").alias("caps"))


@q("f7_power", with_(FX1) + """
SELECT id, round(pow(o_totalprice, 0.125), 6) AS o_totalprice,
       round(CASE WHEN c_acctbal < 0 THEN NULL ELSE pow(c_acctbal, 0.125) END, 6) AS c_acctbal FROM fx1""")
def f7_power(spark, sf):
    d = fx.claims(spark, sf)
    return d.select("id", r6(SF.power("o_totalprice"), "o_totalprice"), r6(SF.power("c_acctbal"), "c_acctbal"))


@q("f8_snap_zero", with_(FX1, """p AS (SELECT id, (o_totalprice - 250000) / 1e10 AS x FROM fx1)""") + """
SELECT id, round(CASE WHEN round_even(x, 5) = 0 THEN 0.0 ELSE x END * 1e6, 6) AS x_e6 FROM p""")
def f8_snap_zero(spark, sf):
    d = fx.claims(spark, sf).select("id", ((F.col("o_totalprice") - 250000) / 1e10).alias("x"))
    return d.select("id", r6(SF.snap_zero("x") * 1e6, "x_e6"))


UNIT_SQL = """vals AS (
  SELECT DISTINCT name, v FROM (
    SELECT 'l_discount' AS name, round(l_discount, 8) AS v FROM lineitem
    UNION ALL SELECT 'l_tax', round(l_tax, 8) FROM lineitem
    UNION ALL SELECT 'l_quantity', round(l_quantity, 8) FROM lineitem) WHERE v IS NOT NULL),
gaps AS (SELECT name, round(v - lag(v) OVER (PARTITION BY name ORDER BY v), 8) AS gap FROM vals),
cnt AS (SELECT name, gap, count(*) AS n FROM gaps WHERE gap > 1e-6 GROUP BY 1, 2),
units AS (SELECT name, arg_min(gap, struct_pack(a := -n, b := gap)) AS unit FROM cnt GROUP BY name)"""


@q("w1_scale_unit", "WITH " + UNIT_SQL + "\nSELECT name, round(unit, 8) AS unit FROM units")
def w1_scale_unit(spark, sf):
    u = SC.scale_units(fx.scaled(spark, sf), ["l_discount", "l_tax", "l_quantity"])
    return u.select("name", F.round("unit", 8).alias("unit"))


@q("f9_rescale_units", "WITH " + UNIT_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate,
  round(CASE WHEN round_even(l_discount, 5) = 0 THEN 0.0 ELSE l_discount END * (1.0 / (SELECT unit FROM units WHERE name = 'l_discount')), 6) AS l_discount,
  round(CASE WHEN round_even(l_tax, 5) = 0 THEN 0.0 ELSE l_tax END * (1.0 / (SELECT unit FROM units WHERE name = 'l_tax')), 6) AS l_tax,
  round(CASE WHEN round_even(l_quantity, 5) = 0 THEN 0.0 ELSE l_quantity END * (1.0 / (SELECT unit FROM units WHERE name = 'l_quantity')), 6) AS l_quantity
FROM lineitem""")
def f9_rescale_units(spark, sf):
    d = fx.scaled(spark, sf)
    cols = ["l_discount", "l_tax", "l_quantity"]
    out = SC.rescale_by_units(d, SC.scale_units(d, cols)).withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))
    return out.select(*[r6(c) if c in cols else F.col(c) for c in out.columns])


@q("f10_slot_scale", with_(FX1, """mm AS (SELECT CAST(trunc(min(c_acctbal)) AS INTEGER) - 2 AS m, max(c_acctbal) AS hi FROM fx1)""") + """
SELECT id, round((coalesce(c_acctbal, m) - m) / (hi - m), 6) AS c_acctbal,
       CAST(coalesce(c_acctbal, m) = m AS INTEGER) AS c_acctbal_na FROM fx1, mm""")
def f10_slot_scale(spark, sf):
    d = fx.claims(spark, sf)
    st = d.agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi")).first()
    x, na = SF.slot_scale("c_acctbal", st["lo"], st["hi"])
    return d.select("id", r6(x, "c_acctbal"), na.alias("c_acctbal_na"))


@q("f11_stretch", with_(FX8, """mm AS (SELECT min(m3) AS lo, max(m3) AS hi FROM fx8)""") + """
SELECT id, round((m3 - lo) / (hi - lo), 6) AS m3 FROM fx8, mm""")
def f11_stretch(spark, sf):
    d = fx.predictions(spark, sf)
    mm = d.agg(F.min("m3").alias("lo"), F.max("m3").alias("hi")).first()  # scalar aggregate
    return d.select("id", r6(SF.stretch("m3", F.lit(mm["lo"]), F.lit(mm["hi"])), "m3"))


@q("f12_clip", with_(FX8) + """
SELECT id, round(least(greatest(m3, 0.01), 0.99), 6) AS m3_a, round(least(greatest(m7, 0.0), 1.0), 6) AS m7_b,
       round(least(greatest(m11 * 10, 1.0), 8.0), 6) AS m11_c FROM fx8""")
def f12_clip(spark, sf):
    d = fx.predictions(spark, sf)
    return d.select("id", r6(SF.clip("m3", 0.01, 0.99), "m3_a"), r6(SF.clip("m7", 0.0, 1.0), "m7_b"),
                    r6(SF.clip(F.col("m11") * 10, 1.0, 8.0), "m11_c"))


@q("f13_standardise", with_(FX1, """st AS (SELECT avg(o_totalprice) AS m1, stddev_pop(o_totalprice) AS s1,
  avg(c_acctbal) AS m2, stddev_pop(c_acctbal) AS s2 FROM fx1 WHERE is_train)""") + """
SELECT id, round((o_totalprice - m1) / s1, 6) AS o_totalprice, round((c_acctbal - m2) / s2, 6) AS c_acctbal FROM fx1, st""")
def f13_standardise(spark, sf):
    d = fx.claims(spark, sf).select("id", "is_train", "o_totalprice", "c_acctbal")
    fit = SC.standardise_fit(d, ["o_totalprice", "c_acctbal"], F.col("is_train"))
    out = SC.standardise(d, fit)
    return out.select("id", r6("o_totalprice"), r6("c_acctbal"))


@q("f14_interactions", with_(FX1, """p AS (SELECT id, o_totalprice / 997.0 AS price_k, c_acctbal / 997.0 AS acct_k,
  CAST(c_nationkey AS DOUBLE) AS nation FROM fx1)""") + "SELECT id, " + ", ".join(
    f"round({f} * (price_k + acct_k), 6) AS {f}_x_price_k_acct_k, "
    f"round({f} * (price_k + nation), 6) AS {f}_x_price_k_nation, round({f} * (nation + acct_k), 6) AS {f}_x_nation_acct_k, "
    f"round({f} * price_k + {f} * acct_k + {f} * nation, 6) AS {f}_x_price_k_acct_k_nation"
    for f in ("price_k", "acct_k", "nation")) + " FROM p")
def f14_interactions(spark, sf):
    d = fx.claims(spark, sf).select("id", (F.col("o_totalprice") / 997.0).alias("price_k"),
                                    (F.col("c_acctbal") / 997.0).alias("acct_k"),
                                    F.col("c_nationkey").cast("double").alias("nation"))
    cols = SF.interactions(["price_k", "acct_k", "nation"], "price_k", "acct_k", "nation")
    out = d.select("id", *cols)
    return out.select("id", *[r6(c) for c in out.columns if c != "id"])


@q("f15_product", with_(FX1) + """
SELECT id, round(o_totalprice * c_acctbal / 1e6, 6) AS price_acct FROM fx1""")
def f15_product(spark, sf):
    d = fx.claims(spark, sf)
    return d.select("id", r6(SF.product("o_totalprice", "c_acctbal") / 1e6, "price_acct"))


@q("f16_round_log1p", with_(FX8) + """
SELECT id, round(round_even(m3 * 7.0 / 3.0, 5), 6) AS m3_r5, round(ln(1 + m7), 6) AS m7_log1p FROM fx8""")
def f16_round_log1p(spark, sf):
    d = fx.predictions(spark, sf)
    return d.select("id", r6(SF.round_even(F.col("m3") * 7.0 / 3.0, 5), "m3_r5"),
                    r6(SF.log1p("m7"), "m7_log1p"))


@q("f18_geometric_blend", with_(FX8) + """
SELECT id, round(pow(m3, 0.41) * pow(m7, 0.01) * pow(m11, 0.58), 6) AS blend FROM fx8""")
def f18_geometric_blend(spark, sf):
    d = fx.predictions(spark, sf)
    return d.select("id", r6(SF.geometric_blend(["m3", "m7", "m11"], [0.41, 0.01, 0.58]), "blend"))


@q("w6_unique_rows", """
SELECT l_returnflag, l_linestatus, l_quantity, min(CAST(l_orderkey AS BIGINT)) AS id FROM lineitem GROUP BY 1, 2, 3""")
def w6_unique_rows(spark, sf):
    d = fx.assoc(spark, sf).withColumn("id", F.col("l_orderkey").cast("bigint"))
    return SC.unique_rows(d, ["l_returnflag", "l_linestatus", "l_quantity"])


# ------------------------------------------------------------ rows and columns

@q("p1_drop_columns", with_(FX1) + "SELECT id, target, is_train, o_orderpriority, c_mktsegment FROM fx1")
def p1_drop_columns(spark, sf):
    return C.drop_columns(fx.claims(spark, sf), ["o_totalprice", "c_acctbal", "c_nationkey", "absent"])


@q("p2_keep_complement", with_(FX1) + "SELECT id, o_orderpriority, c_mktsegment, c_nationkey FROM fx1")
def p2_keep_complement(spark, sf):
    return C.keep_complement(fx.claims(spark, sf), ["target", "is_train", "o_totalprice", "c_acctbal"])


@q("p3_prefix_select", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders")
def p3_prefix_select(spark, sf):
    o = load(spark, sf, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select(*C.columns_matching(o, prefix="o_"))


@q("p4_dtype_select", with_(FX1) + "SELECT o_orderpriority, c_mktsegment FROM fx1")
def p4_dtype_select(spark, sf):
    d = fx.claims(spark, sf)
    return d.select(*C.columns_of_type(d, "string"))


@q("p5_test_rows", with_(FX1) + "SELECT id FROM fx1 WHERE target IS NULL")
def p5_test_rows(spark, sf):
    return C.test_rows(fx.claims(spark, sf)).select("id")


@q("p6_train_slice", with_(FX1) + "SELECT id, target FROM fx1 WHERE is_train")
def p6_train_slice(spark, sf):
    return fx.claims(spark, sf).where("is_train").select("id", "target")


@q("p7_null_filter", with_(FX1) + "SELECT id FROM fx1 WHERE o_totalprice IS NULL")
def p7_null_filter(spark, sf):
    return fx.claims(spark, sf).where(F.col("o_totalprice").isNull()).select("id")


@q("p8_mask_overwrite", with_(FX8) + """
SELECT id, round(CASE WHEN m3 > 0.95 THEN (m7 + m11) / 2 ELSE m3 END, 6) AS m3 FROM fx8""")
def p8_mask_overwrite(spark, sf):
    d = fx.predictions(spark, sf)
    return d.select("id", r6(C.overwrite_where("m3", F.col("m3") > 0.95, (F.col("m7") + F.col("m11")) / 2), "m3"))


@q("p9_membership", """
SELECT o_orderkey, 'in' AS side FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)
UNION ALL
SELECT o_orderkey, 'out' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 5)""")
def p9_membership(spark, sf):
    o = load(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    c = load(spark, sf, "customer", ["c_custkey", "c_nationkey"]).where("c_nationkey < 5")
    c = c.select(F.col("c_custkey").alias("o_custkey"))
    a = C.semi_filter(o, c, "o_custkey", True).select("o_orderkey", F.lit("in").alias("side"))
    b = C.semi_filter(o, c, "o_custkey", False).select("o_orderkey", F.lit("out").alias("side"))
    return a.unionByName(b)


@q("p10_rename", with_(FX1) + "SELECT id AS \"ID\", target AS label FROM fx1")
def p10_rename(spark, sf):
    return C.rename(fx.claims(spark, sf).select("id", "target"), {"id": "ID", "target": "label"})


@q("p11_cast", with_(FX1) + """
SELECT id, CAST(target AS DOUBLE) AS target, CAST(c_nationkey AS SMALLINT) AS c_nationkey,
       CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice FROM fx1""")
def p11_cast(spark, sf):
    d = fx.claims(spark, sf).select("id", "target", "c_nationkey", "o_totalprice")
    return C.cast_columns(d, {"target": "double", "c_nationkey": "smallint", "o_totalprice": "bigint"})


@q("p12_replace_code", with_(FX1) + """
SELECT id, CASE WHEN id % 9 = 0 THEN 2 ELSE c_nationkey END AS c_nationkey FROM fx1""")
def p12_replace_code(spark, sf):
    d = fx.claims(spark, sf).select("id", F.when(F.col("id") % 9 == 0, F.lit(-999999))
                                    .otherwise(F.col("c_nationkey")).alias("c_nationkey"))
    return C.replace_value(d, -999999, 2, ["c_nationkey"])


@q("p13_reconcile_schemas", with_(FX1) + "SELECT id, o_totalprice IS NULL AS price_missing, c_nationkey, is_train FROM fx1")
def p13_reconcile_schemas(spark, sf):
    d = fx.claims(spark, sf)
    train = d.where("is_train").select("id", "target", F.col("o_totalprice").isNull().alias("price_missing"),
                                       "c_nationkey", "o_orderpriority")
    test = d.where("NOT is_train").select("id", F.col("o_totalprice").isNull().alias("price_missing"),
                                          "c_nationkey", "c_acctbal")
    train2, test2 = C.common_columns(train, test)
    return train2.withColumn("is_train", F.lit(True)).unionByName(test2.withColumn("is_train", F.lit(False)))


@q("p19_row_number", with_(FX1) + "SELECT id, row_number() OVER (ORDER BY id) - 1 AS row FROM fx1")
def p19_row_number(spark, sf):
    return C.with_row_number(fx.claims(spark, sf).select("id"), "id", "row")


@q("p21_positional_slice", with_(FX1) + "SELECT target, is_train, o_totalprice, c_acctbal, o_orderpriority, c_mktsegment FROM fx1")
def p21_positional_slice(spark, sf):
    return C.slice_columns(fx.claims(spark, sf), 1, -1)


@q("u1_union_train_test", with_(FX1) + "SELECT id, target, o_orderpriority FROM fx1")
def u1_union_train_test(spark, sf):
    d = fx.claims(spark, sf)
    train = d.where("is_train").select("id", "target", "o_orderpriority")
    test = d.where("NOT is_train").select("id", "o_orderpriority")
    return C.union_train_test(train, test)


@q("u2_pseudo_labels", with_(FX8) + """
SELECT id, target FROM fx8 WHERE target IS NOT NULL
UNION ALL SELECT id, CAST(CAST(trunc(m3) AS TINYINT) AS INTEGER) AS target FROM fx8 WHERE target IS NULL""")
def u2_pseudo_labels(spark, sf):
    d = fx.predictions(spark, sf)
    train = d.where("target IS NOT NULL").select("id", "target")
    test = d.where("target IS NULL").select("id", "m3")
    return C.pseudo_label_union(train, test, "m3")


@q("u3_distinct", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def u3_distinct(spark, sf):
    return load(spark, sf, "lineitem", ["l_returnflag", "l_linestatus"]).distinct()


@q("u4_column_sets", with_(FX1) + "SELECT id, c_nationkey FROM fx1")
def u4_column_sets(spark, sf):
    d = fx.claims(spark, sf)
    a = d.select("id", "c_nationkey", "o_totalprice", "target")
    b = d.select("id", "c_nationkey", "c_acctbal")
    extra = C.column_difference(a, b)
    return a.drop(*extra)


# ------------------------------------------------------------ sorts

@q("o1_sort", with_(FX1) + "SELECT id, round(o_totalprice, 6) AS o_totalprice FROM fx1 WHERE o_totalprice IS NOT NULL ORDER BY o_totalprice DESC, id")
def o1_sort(spark, sf):
    d = fx.claims(spark, sf).where(F.col("o_totalprice").isNotNull())
    return d.orderBy(F.desc("o_totalprice"), "id").select("id", r6("o_totalprice"))


@q("o4_argmax", with_(FX1) + """
SELECT c_nationkey, count(*) AS n FROM fx1 GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 1""")
def o4_argmax(spark, sf):
    g = fx.claims(spark, sf).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    key = F.struct(F.col("n").alias("a"), (-F.col("c_nationkey")).alias("b"))
    return g.agg(F.max_by("c_nationkey", key).alias("c_nationkey"), F.max("n").alias("n"))


@q("o5_row_sort", with_(FX8) + """
SELECT id, round(list_sort([m3, m7, m11, m13, m17])[1], 6) AS lowest,
       round(list_sort([m3, m7, m11, m13, m17])[5], 6) AS highest FROM fx8""")
def o5_row_sort(spark, sf):
    d = fx.predictions(spark, sf)
    s = RW.row_sorted(["m3", "m7", "m11", "m13", "m17"])
    return d.select("id", r6(F.element_at(s, 1), "lowest"), r6(F.element_at(s, 5), "highest"))


@q("o6_shuffle_key", with_(FX1) + """
SELECT id, CAST('0x' || substr(md5('2017:' || id), 1, 15) AS BIGINT) AS shuffle_key,
       row_number() OVER (ORDER BY CAST('0x' || substr(md5('2017:' || id), 1, 15) AS BIGINT), id) - 1 AS shuffled_pos FROM fx1""")
def o6_shuffle_key(spark, sf):
    """Seeded reproducible row shuffle: a digest of seed and key
    (same result in any engine), positions by the distributed row index."""
    d = fx.claims(spark, sf).select("id")
    d = d.withColumn("shuffle_key", SF.seeded_shuffle_key("id", 2017))
    return C.with_row_number(d, "shuffle_key", "shuffled_pos").select("id", "shuffle_key", "shuffled_pos")


# ------------------------------------------------------------ joins

@q("j1_stats_join", with_(FX1, """g AS (SELECT c_mktsegment, avg(target) AS a FROM fx1 WHERE is_train GROUP BY 1)""") + """
SELECT f.id, round(g.a, 6) AS seg_mean FROM fx1 f LEFT JOIN g ON f.c_mktsegment = g.c_mktsegment""")
def j1_stats_join(spark, sf):
    from stackyard.operators.joins import attach, measured
    d = fx.claims(spark, sf)
    g, n = measured(d.where("is_train").groupBy("c_mktsegment").agg(F.avg("target").alias("seg_mean")))
    return attach(d, g, "c_mktsegment", "left", n).select("id", r6("seg_mean"))


@q("j2_id_join_chain", with_(FX1, FX8) + """
SELECT a.id, round(a.o_totalprice, 6) AS o_totalprice, round(b.m3, 6) AS m3, round(b.m7, 6) AS m7,
       round(b.m11, 6) AS m11, round(b.m13, 6) AS m13 FROM fx1 a JOIN fx8 b ON a.id = b.id""")
def j2_id_join_chain(spark, sf):
    feats = fx.claims(spark, sf).select("id", "o_totalprice")
    p = fx.predictions(spark, sf)
    parts = [p.select("id", m) for m in ("m3", "m7", "m11", "m13")]
    j = join_on_id([feats, *parts])
    return j.select("id", *[r6(c) for c in ("o_totalprice", "m3", "m7", "m11", "m13")])


@q("j3_column_concat", with_(FX1) + """
SELECT id, o_orderpriority, CAST(o_totalprice IS NULL AS INTEGER) AS price_na FROM fx1""")
def j3_column_concat(spark, sf):
    d = fx.claims(spark, sf)
    left = d.select("id", "o_orderpriority")
    right = d.select("id", F.col("o_totalprice").isNull().cast("int").alias("price_na"))
    return join_on_id([left, right])


# ------------------------------------------------------------ sources and sinks

ORDERS_CSV = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string, o_note string"


@q("s1_typed_scan", """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END AS o_orderpriority, CAST(NULL AS VARCHAR) AS o_note FROM orders""")
def s1_typed_scan(spark, sf):
    """Orders as CSV files in the shared folder, read by an explicit schema: the
    files' columns stand in another order, one is not in the schema, and one of
    the schema is in no file."""
    o = load(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    path = shared_folder(spark, "orders-csv")
    (o.select("o_orderpriority", "o_orderdate", "o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey", F.lit("x").alias("o_extra"))
      .withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
      .withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority")))
      .write.option("header", True).csv(path))
    return read_csv_table(spark, path, ORDERS_CSV).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@q("s2_keyed_scan", """SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_nationkey AS INTEGER) AS c_nationkey,
  CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal END AS c_acctbal, c_mktsegment FROM customer""")
def s2_keyed_scan(spark, sf):
    """Customers as CSV files with the key in the middle, read back key first; NaN in a file is null."""
    c = load(spark, sf, "customer", ["c_nationkey", "c_custkey", "c_acctbal", "c_mktsegment"]).withColumnRenamed("c_custkey", "id")
    path = shared_folder(spark, "customer-csv")
    bal = F.when(F.col("id") % 11 == 0, F.lit("NaN")).otherwise(F.col("c_acctbal").cast("string"))
    c.withColumn("c_acctbal", bal).write.option("header", True).csv(path)
    return read_csv_table(spark, path, "c_nationkey int, id long, c_acctbal double, c_mktsegment string", index_col="id")


@q("s3_projected_scan", "SELECT o_orderkey AS id FROM orders")
def s3_projected_scan(spark, sf):
    return load(spark, sf, "orders", ["o_orderkey"]).withColumnRenamed("o_orderkey", "id")


@q("s4_score_sink", with_(FX8) + 'SELECT id AS "ID", round(m3, 6) AS "PredictedProb" FROM fx8 WHERE target IS NULL')
def s4_score_sink(spark, sf):
    """The frame written by ``sinks.write_scores`` for the test side."""
    p = fx.predictions(spark, sf).where("target IS NULL")
    return p.select(F.col("id").alias("ID"), r6("m3", "PredictedProb"))


@q("s5_template_fill", with_(FX8) + """
SELECT id, round(CASE WHEN target IS NULL THEN m3 ELSE 0.0 END, 6) AS pred FROM fx8""")
def s5_template_fill(spark, sf):
    p = fx.predictions(spark, sf)
    template = p.select("id", F.lit(0.0).alias("pred"))
    preds = p.where("target IS NULL").select("id", F.col("m3").alias("pred"))
    return SK.fill_template(template, preds, "id", "pred").select("id", r6("pred"))


@q("s9_feature_map", with_(FX1) + """
SELECT * FROM (
  SELECT 0 AS pos, 'o_totalprice' AS name, 'q' AS kind, count(o_totalprice) AS n_present FROM fx1
  UNION ALL SELECT 1, 'c_acctbal', 'q', count(c_acctbal) FROM fx1
  UNION ALL SELECT 2, 'c_nationkey', 'q', count(c_nationkey) FROM fx1)""")
def s9_feature_map(spark, sf):
    """Feature map lines (position, name, type flag) with the number of
    rows where each feature is present."""
    from stackyard.operators.profile import wide_agg
    d = fx.claims(spark, sf)
    feats = [c for c in C.columns_of_type(d, "numeric") if c not in ("id", "target")]
    fm = SK.feature_map(spark, feats)
    present = wide_agg(d, feats, {"n_present": lambda c: F.count(c)})
    return (fm.join(F.broadcast(present), "name")  # one row per feature on both sides
              .select(F.col("pos").cast("int"), "name", "kind", "n_present"))


@q("s10_score_stamped", with_(FX8, """l AS (SELECT -avg(target * ln(greatest(least(m3, 1 - 1e-15), 1e-15))
  + (1 - target) * ln(1 - greatest(least(m3, 1 - 1e-15), 1e-15))) AS loss FROM fx8 WHERE target IS NOT NULL)""") + """
SELECT id, round(m3, 6) AS pred, 'm3' AS run_id, round(loss, 6) AS score FROM fx8, l WHERE target IS NULL""")
def s10_score_stamped(spark, sf):
    from stackyard.operators.metrics import log_loss
    p = fx.predictions(spark, sf)
    loss = log_loss(p, "target", "m3").first()[0]  # scalar aggregate
    out = p.where("target IS NULL").select("id", F.col("m3").alias("pred"))
    return out.select("id", r6("pred"), F.lit("m3").alias("run_id"), r6(F.lit(loss), "score"))


@q("s11_gather_predictions", with_(FX8) + """
SELECT id, round(m3, 6) AS m3, round(m7, 6) AS m7, round(m11, 6) AS m11, round(m13, 6) AS m13, round(m17, 6) AS m17 FROM fx8""")
def s11_gather_predictions(spark, sf):
    """Five score files in the shared folder, one for each model, gathered by file name."""
    wide = fx.predictions(spark, sf)
    root = shared_folder(spark, "scores")
    models = ["m3", "m7", "m11", "m13", "m17"]
    for m in models:
        SK.write_scores(wide, f"{root}/{m}", pred=m)
    out = SK.gather_predictions(spark, f"{root}/*", models=models)
    return out.select("id", *[r6(c) for c in models])


@q("s7_feature_table", with_(FX1, """a AS (SELECT o_orderpriority v, row_number() OVER (ORDER BY min(id)) - 1 AS code
  FROM fx1 WHERE o_orderpriority IS NOT NULL GROUP BY 1),
b AS (SELECT c_mktsegment v, row_number() OVER (ORDER BY min(id)) - 1 AS code
  FROM fx1 WHERE c_mktsegment IS NOT NULL GROUP BY 1)""") + """
SELECT f.id, coalesce(f.target, -1) AS target,
  CAST(f.o_totalprice IS NULL AS INTEGER) + CAST(f.c_acctbal IS NULL AS INTEGER) + CAST(f.o_orderpriority IS NULL AS INTEGER)
    + CAST(f.c_mktsegment IS NULL AS INTEGER) + CAST(f.c_nationkey IS NULL AS INTEGER) AS "nNAN",
  round(coalesce(pow(f.o_totalprice, 0.125), -9999), 6) AS o_totalprice,
  CAST(coalesce(a.code, -1) AS BIGINT) AS o_orderpriority, CAST(coalesce(b.code, -1) AS BIGINT) AS c_mktsegment,
  f.c_nationkey
FROM fx1 f LEFT JOIN a ON f.o_orderpriority = a.v LEFT JOIN b ON f.c_mktsegment = b.v""")
def s7_feature_table(spark, sf):
    """The materialised feature table of the preprocessing stage (the frame
    ``sinks.materialise`` writes): null count, codes, power, fill, drop."""
    cols = ["o_totalprice", "c_acctbal", "o_orderpriority", "c_mktsegment", "c_nationkey"]
    d = fx.claims(spark, sf)
    d = d.select("*", E.null_count_row(cols).alias("nNAN"))
    fitted = [E.fit_first_seen(d, c, missing_code=-1) for c in ("o_orderpriority", "c_mktsegment")]
    for f in fitted:
        d = f.transform(d)
    d = d.withColumn("o_totalprice", SF.power("o_totalprice"))
    d = C.drop_columns(d, ["c_acctbal", "is_train"])
    d = E.fill_constant(d, -9999, ["o_totalprice"]).fillna(-1, subset=["target"])
    return d.select("id", "target", "nNAN", r6("o_totalprice"), F.col("o_orderpriority").cast("bigint"),
                    F.col("c_mktsegment").cast("bigint"), "c_nationkey")
