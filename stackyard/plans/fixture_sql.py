"""The fixtures of ``stackyard.sources.fixtures`` written as SQL views for
the independent DuckDB oracle (same tables, same key-modulo rules)."""

FX1 = """fx1 AS (
  SELECT CAST(o.o_orderkey AS BIGINT) AS id,
         CASE WHEN o.o_orderkey % 10 < 7 THEN CAST(o.o_orderstatus = 'F' AS INTEGER) END AS target,
         o.o_orderkey % 10 < 7 AS is_train,
         CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_totalprice END AS o_totalprice,
         CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE c.c_acctbal END AS c_acctbal,
         CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE o.o_orderpriority END AS o_orderpriority,
         CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE c.c_mktsegment END AS c_mktsegment,
         CAST(c.c_nationkey AS INTEGER) AS c_nationkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

FX2 = """fx2 AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id,
         CASE WHEN o_orderkey % 10 < 7 THEN CAST(o_orderstatus = 'F' AS INTEGER) END AS target,
         o_orderkey % 10 < 7 AS is_train,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS cust
  FROM orders)"""

FX4 = """fx4 AS (
  SELECT CAST(p_partkey AS BIGINT) AS id,
         CASE WHEN p_partkey % 10 < 7 THEN CAST(ceil(p_size * 8 / 50.0) AS INTEGER) END AS response,
         p_partkey % 10 < 7 AS is_train,
         p_retailprice, p_brand, p_type, p_size
  FROM part)"""

FX5 = """fx5 AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_discount, l_tax,
         l_quantity, l_returnflag, l_linestatus, CAST(l_returnflag = 'R' AS INTEGER) AS target
  FROM lineitem)"""

FX6 = """fx6 AS (
  SELECT CAST(p_partkey AS BIGINT) AS id, split_part(p_name, ' ', 1) AS word FROM part)"""

FX7 = """fx7 AS (
  SELECT CAST(d.doc_id AS BIGINT) AS id, CAST(l.quality AS INTEGER) AS target,
         l.quality IS NOT NULL AS is_train, CAST(d.n_chars AS DOUBLE) AS n_chars, d.lang, d.source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

FX8 = """fx8 AS (
  SELECT CAST(o_orderkey AS BIGINT) AS id,
         CASE WHEN o_orderkey % 10 < 7 THEN CAST(o_orderstatus = 'F' AS INTEGER) END AS target,
         (o_orderkey * 3) % 1009 / 1009.0 AS m3,
         (o_orderkey * 7) % 1009 / 1009.0 AS m7,
         (o_orderkey * 11) % 1009 / 1009.0 AS m11,
         (o_orderkey * 13) % 1009 / 1009.0 AS m13,
         (o_orderkey * 17) % 1009 / 1009.0 AS m17
  FROM orders)"""

FX9 = """fx9 AS (
  SELECT CAST(event_id AS BIGINT) AS id,
         CASE WHEN event_id % 10 < 7 THEN CAST(event_type = 'purchase' AS INTEGER) END AS target,
         event_id % 10 < 7 AS is_train, value, event_type, user_id
  FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
