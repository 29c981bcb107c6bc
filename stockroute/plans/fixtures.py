"""Order lines and stock rows derived from the driver's TPC-H-style tables.

The driver ships no order or stock extract, so both inputs are derived by the
SQL below (FIXTURES.md §2). DuckDB runs the statements as written (they are
the leading CTEs of every oracle query). Spark runs statements that give the same
rows: order lines are joined and numbered with one exchange by order before their
columns are made, and stock rows expand each part with generators over the literal
location and plant lists instead of joining VALUES tables.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("lineitem", "orders", "customer", "part", "nation")

_ORDERS_SELECT = """
       CASE o.o_custkey % 8 WHEN 0 THEN 'Walmart' WHEN 1 THEN '  walmart ' WHEN 2 THEN 'CENCOSUD' WHEN 3 THEN 'Demart'
            WHEN 4 THEN 'DMart' WHEN 5 THEN 'TentA' WHEN 6 THEN c.c_name ELSE NULL END AS customer_name,
       CASE o.o_custkey % 6 WHEN 0 THEN '30279964' WHEN 1 THEN '30829327' WHEN 2 THEN NULL ELSE CAST(o.o_custkey AS STRING) END AS sold_to_party,
       CAST(c.c_custkey AS STRING) AS ship_to_party,
       CASE WHEN l.l_linenumber = 7 THEN NULL WHEN l.l_returnflag = 'R' THEN 'ZUCC' WHEN l.l_returnflag = 'A' THEN ' ztan ' ELSE 'ZTAN' END AS item_category,
       'UCC' || CAST(l.l_partkey AS STRING) AS material_ucc14,
       'DU' || CAST(l.l_partkey AS STRING) AS material_du,
       CASE l.l_suppkey % 3 WHEN 0 THEN 'PT12' WHEN 1 THEN '1000' ELSE 'PT11' END AS storage_location,
       CAST(l.l_linenumber AS STRING) AS line_item_ref,
       p.p_name AS material_description,
       o.o_orderpriority AS order_type,
       CASE WHEN l.l_suppkey % 7 = 0 THEN 'DN' || CAST(l.l_orderkey AS STRING) WHEN l.l_suppkey % 7 = 1 THEN '' WHEN l.l_suppkey % 7 = 2 THEN '  ' ELSE NULL END AS delivery_note,
       CASE WHEN l.l_partkey % 9 = 0 THEN 'R1' WHEN l.l_partkey % 9 = 1 THEN ' ' ELSE NULL END AS reason_for_rejection,
       CAST(CASE WHEN l.l_linenumber = 6 AND l.l_quantity = 1 THEN NULL ELSE l.l_quantity END AS DOUBLE) AS order_quantity,
       CAST(l.l_shipdate AS DATE) AS required_delivery_date,
       n.n_name AS country_code, c.c_mktsegment AS client_code,
       CASE WHEN l.l_partkey % 97 = 5 THEN NULL ELSE CAST(l.l_partkey AS STRING) END AS material_number,
       CASE o.o_orderstatus WHEN 'F' THEN 'Closed' WHEN 'P' THEN 'Partial' ELSE 'Open' END AS order_status,
       CASE WHEN l.l_suppkey % 10 = 3 THEN 'X' ELSE '' END AS blocking_indicator"""

_ORDERS_FROM = """
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
     JOIN part p ON l.l_partkey = p.p_partkey JOIN nation n ON c.c_nationkey = n.n_nationkey"""

# FIXTURES.md §2.1, verbatim.
FX_ORDERS_SQL = ("""SELECT CAST(l.l_orderkey AS STRING) AS sales_order_number,
       CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_shipdate) AS STRING) AS sales_order_line_item,"""
                 + _ORDERS_SELECT + _ORDERS_FROM)

# The same rows for Spark. Orders get their customers first, and the join of lines
# and orders and the numbering share one exchange by order. The join hashes the orders
# of a partition, so the only sort by order is the numbering's, over the columns as
# stored; the 21 columns are made above it. Sorting those made 36 million lines spill.
_ORDERS_MADE = re.sub(r"\b[locpn]\.(?=[locpn]_)", "", _ORDERS_SELECT)
FX_ORDERS_SPARK_SQL = f"""SELECT CAST(l_orderkey AS STRING) AS sales_order_number,
       CAST(line_number AS STRING) AS sales_order_line_item,{_ORDERS_MADE}
FROM (SELECT /*+ SHUFFLE_HASH(placed) */ *,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS line_number
      FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_returnflag, p_name
            FROM lineitem JOIN part ON l_partkey = p_partkey) AS lines
      JOIN (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, c_custkey, c_name, c_mktsegment, n_name
            FROM orders JOIN (SELECT c_custkey, c_name, c_mktsegment, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
                 ON o_custkey = c_custkey) AS placed
      ON l_orderkey = o_orderkey)"""

# FIXTURES.md §2.2, verbatim.
FX_STOCK_SQL = """SELECT CAST(p.p_partkey AS STRING) AS material_number, pl.plant AS plant, v.loc AS storage_location,
       CAST(CASE WHEN p.p_partkey % 20 = 8 THEN 0 ELSE (p.p_partkey * 31 + v.i * 17) % 60 + 5 END AS DOUBLE) AS available_stock_qty,
       CAST(CASE WHEN p.p_partkey % 20 = 8 THEN 0 WHEN (p.p_partkey * 7 + v.i * 13) % 11 = 0 THEN NULL
                 WHEN (p.p_partkey * 5 + v.i * 3) % 4 = 0 THEN 0 WHEN (p.p_partkey + v.i) % 37 = 0 THEN -70
                 ELSE (p.p_partkey * 31 + v.i * 17) % 45 END AS DOUBLE) AS allocable_stock_qty,
       CASE WHEN (p.p_partkey + v.i) % 2 = 0 THEN 'Carousel' ELSE 'Non Carousel' END AS warehouse_type,
       CASE p.p_partkey % 6 WHEN 0 THEN '10' WHEN 1 THEN '2.5' WHEN 2 THEN '0' WHEN 3 THEN 'PAL' WHEN 4 THEN NULL ELSE '4' END AS packaging_unit,
       CASE WHEN v.i = 0 THEN NULL ELSE 'Y' END AS palletization_indicator,
       CAST('2024-01-0' || CAST(v.i + 1 AS STRING) || ' 00:00:00' AS TIMESTAMP) AS stock_timing_timestamp
FROM part p CROSS JOIN (VALUES (0,'PT12'),(1,'1000'),(2,'PT11'),(3,'PT15'),(4,'XX99')) AS v(i, loc)
     JOIN (VALUES ('P1', 1), ('P2', 50)) AS pl(plant, k) ON p.p_partkey % pl.k = 0
WHERE p.p_partkey % 20 <> 7"""

# The same rows for Spark without a join: the five locations and two plants
# are literal lists, so each part row is expanded by generators (explode)
# instead of a cross join and a non-equi join against VALUES tables. A part gives up to
# ten wide rows, so the keys of a few file blocks are dealt out before they are expanded.
_STOCK_SELECT = FX_STOCK_SQL[:FX_STOCK_SQL.index("\nFROM part p")]
FX_STOCK_SPARK_SQL = _STOCK_SELECT + """
FROM (SELECT /*+ REPARTITION(p_partkey) */ p_partkey FROM part) p
LATERAL VIEW explode(array(named_struct('i', 0, 'loc', 'PT12'), named_struct('i', 1, 'loc', '1000'),
                           named_struct('i', 2, 'loc', 'PT11'), named_struct('i', 3, 'loc', 'PT15'),
                           named_struct('i', 4, 'loc', 'XX99'))) lv AS v
LATERAL VIEW explode(array(named_struct('plant', 'P1', 'k', 1), named_struct('plant', 'P2', 'k', 50))) lp AS pl
WHERE p.p_partkey % 20 <> 7 AND p.p_partkey % pl.k = 0"""

_SOURCES: dict[tuple, DataFrame] = {}


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The driver's parquet table (read once per session and directory; the
    files are read-only)."""
    key = (id(spark), os.path.abspath(sf_dir), table)
    df = _SOURCES.get(key)
    if df is None or df.sparkSession is not spark:  # ids can be reused after a stop
        df = _SOURCES[key] = spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))
    return df


def register_sources(spark: SparkSession, sf_dir: str, tables=SOURCE_TABLES) -> None:
    """Temp views over the driver's parquet files (names as in the SQL)."""
    for t in tables:
        source(spark, sf_dir, t).createOrReplaceTempView(t)


def fx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines (21 typed columns), one per lineitem row. Lines are numbered
    by a window per order; an order has at most seven lines."""
    register_sources(spark, sf_dir)
    return spark.sql(FX_ORDERS_SPARK_SQL)


def fx_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock rows: parts x locations x plants (9 typed columns)."""
    register_sources(spark, sf_dir, ("part",))
    return spark.sql(FX_STOCK_SPARK_SQL)
