"""Modelling fixtures derived from the provided tables.

Each builder reads the given tables and returns one keyed ``DataFrame`` with
an explicit ``id`` key, a nullable target (null on the test side) and an
``is_train`` flag, so every workload grows with the input. Missing values are
injected by key modulo so that an independent SQL engine can reproduce them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackyard.sources.tables import load

# Model multipliers and the modulus of the synthetic
# prediction sets (FX8), and the train/test convention (key % 10 < 7).
PRED_MULTIPLIERS = (3, 7, 11, 13, 17)
PRED_MODULUS = 1009
TRAIN_MOD, TRAIN_CUT = 10, 7


def _null_when(key: str, mod: int, col: str):
    return F.when(F.col(key) % mod == 0, F.lit(None)).otherwise(F.col(col))


def is_train(key: str = "id"):
    return F.col(key) % TRAIN_MOD < TRAIN_CUT


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1 binary claims: orders joined with customer."""
    o = load(spark, sf_dir, "orders",
             ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"])
    c = load(spark, sf_dir, "customer", ["c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey"])
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = "o_orderkey"
    return j.select(
        F.col(k).cast("bigint").alias("id"),
        F.when(is_train(k), (F.col("o_orderstatus") == "F").cast("int")).alias("target"),
        is_train(k).alias("is_train"),
        _null_when(k, 7, "o_totalprice").alias("o_totalprice"),
        _null_when(k, 11, "c_acctbal").alias("c_acctbal"),
        _null_when(k, 13, "o_orderpriority").alias("o_orderpriority"),
        _null_when(k, 17, "c_mktsegment").alias("c_mktsegment"),
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
    )


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX1's rows with the order status as a label of three classes (0 F, 1 O, 2 P; null on the test side)."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    k = "o_orderkey"
    return o.select(F.col(k).cast("bigint").alias("id"), is_train(k).alias("is_train"),
                    F.when(is_train(k), F.instr(F.lit("FOP"), F.col("o_orderstatus")) - 1).cast("double").alias("label"),
                    _null_when(k, 13, "o_orderpriority").alias("o_orderpriority"))


def high_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX2: orders with the customer key as a high-cardinality category."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus"])
    k = "o_orderkey"
    return o.select(
        F.col(k).cast("bigint").alias("id"),
        F.when(is_train(k), (F.col("o_orderstatus") == "F").cast("int")).alias("target"),
        is_train(k).alias("is_train"),
        F.when(F.col(k) % 19 == 0, F.lit(None))
         .otherwise(F.col("o_custkey").cast("string")).alias("cust"),
    )


def scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX3: lineitem numeric columns stored in hidden units."""
    return load(spark, sf_dir, "lineitem",
                ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                 "l_shipdate", "l_discount", "l_tax", "l_quantity"])


def ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4: part with ``p_size`` cut into 8 ordered bands (1..8)."""
    p = load(spark, sf_dir, "part", ["p_partkey", "p_size", "p_retailprice", "p_brand", "p_type"])
    k = "p_partkey"
    return p.select(
        F.col(k).cast("bigint").alias("id"),
        F.when(is_train(k), F.ceil(F.col("p_size") * 8 / 50.0).cast("int")).alias("response"),
        is_train(k).alias("is_train"),
        F.col("p_retailprice"), F.col("p_brand"), F.col("p_type"), F.col("p_size"),
    )


def assoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX5: lineitem measures and flags for association studies."""
    li = load(spark, sf_dir, "lineitem",
              ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
               "l_extendedprice", "l_discount", "l_tax", "l_quantity",
               "l_returnflag", "l_linestatus"])
    return li.withColumn("target", (F.col("l_returnflag") == "R").cast("int"))


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX6: first word of the part name."""
    p = load(spark, sf_dir, "part", ["p_partkey", "p_name"])
    return p.select(F.col("p_partkey").cast("bigint").alias("id"),
                    F.split_part(F.col("p_name"), F.lit(" "), F.lit(1)).alias("word"))


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX7: documents with their quality label; unlabelled docs are test."""
    d = load(spark, sf_dir, "documents", ["doc_id", "n_chars", "lang", "source"])
    lab = load(spark, sf_dir, "labels", ["doc_id", "quality"])
    j = d.join(lab, "doc_id", "left")
    return j.select(F.col("doc_id").cast("bigint").alias("id"),
                    F.col("quality").cast("int").alias("target"),
                    F.col("quality").isNotNull().alias("is_train"),
                    F.col("n_chars").cast("double").alias("n_chars"),
                    "lang", "source")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX8: five synthetic model scores per order, wide."""
    o = load(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    k = "o_orderkey"
    cols = [((F.col(k) * p) % PRED_MODULUS / float(PRED_MODULUS)).alias(f"m{p}")
            for p in PRED_MULTIPLIERS]
    return o.select(
        F.col(k).cast("bigint").alias("id"),
        F.when(is_train(k), (F.col("o_orderstatus") == "F").cast("int")).alias("target"),
        *cols)


def prediction_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX8 in long form ``(id, model, pred)``: one row per gathered file row."""
    o = load(spark, sf_dir, "orders", ["o_orderkey"])
    k = F.col("o_orderkey").cast("bigint")
    models = F.array(*[F.lit(p) for p in PRED_MULTIPLIERS])
    return (o.select(k.alias("id"), F.explode(models).alias("p"))
             .select("id", F.concat(F.lit("m"), F.col("p").cast("string")).alias("model"),
                     ((F.col("id") * F.col("p")) % PRED_MODULUS / float(PRED_MODULUS)).alias("pred")))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX9: event rows with a purchase target."""
    e = load(spark, sf_dir, "events", ["event_id", "event_type", "value", "user_id"])
    k = "event_id"
    return e.select(F.col(k).cast("bigint").alias("id"),
                    F.when(is_train(k), (F.col("event_type") == "purchase").cast("int")).alias("target"),
                    is_train(k).alias("is_train"),
                    "value", "event_type", "user_id")
