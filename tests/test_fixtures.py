import datetime as dt
import re

import pytest

from stockroute.plans import fixtures
from stockroute.plans.catalog import QUERIES

from helpers import plan_text

DAY = dt.datetime(2024, 1, 2)
LINES = [(1, 10, 3, 1, 5.0, 9.5, "R"), (1, 11, 4, 1, 1.0, 9.5, "A"), (1, 11, 4, 1, 1.0, 9.5, "A"), (1, 12, 7, 6, 1.0, 2.0, "N"),
         (2, 10, 8, 7, None, 3.0, None), (2, 10, None, None, 2.0, None, "N"), (3, 10, 1, 1, 1.0, 1.0, "N"), (9, 10, 1, 1, 1.0, 1.0, "N"),
         (None, 10, 1, 1, 1.0, 1.0, "N"), (1, None, 1, 2, 1.0, 1.0, "N"), (1, 99, 1, 2, 1.0, 1.0, "N"), (4, 10, 1, 1, 1.0, 1.0, "N")]
ORDERS = [(1, 100, "F", "1-URGENT"), (2, 101, "P", None), (2, 101, "P", None), (3, None, "O", "x"), (4, 103, "O", "x"), (None, 100, "O", "x")]
CUSTOMERS = [(100, "Customer a", 1, "AUTO"), (100, "Customer a", 1, "AUTO"), (101, None, 2, None), (103, "Customer b", None, "AUTO")]
PARTS = [(10, "nut"), (11, None), (12, "bolt"), (12, "bolt"), (None, "none")]
NATIONS = [(1, "CHILE"), (2, "PERU"), (None, "none")]


@pytest.fixture
def odd_tables(spark, tmp_path):
    """Keys that repeat, are null or lack a partner."""
    tables = {
        "lineitem": spark.createDataFrame([(*r, DAY) for r in LINES], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                          "l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp"),
        "orders": spark.createDataFrame(ORDERS, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "customer": spark.createDataFrame(CUSTOMERS, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "part": spark.createDataFrame(PARTS, "p_partkey long, p_name string"),
        "nation": spark.createDataFrame(NATIONS, "n_nationkey int, n_name string")}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_order_lines_equal_the_stated_sql_with_odd_keys(spark, odd_tables):
    got = fixtures.fx_orders(spark, odd_tables)
    want = spark.sql(fixtures.FX_ORDERS_SQL)
    assert got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.count() == 14


def test_order_lines_are_sorted_once_as_stored(spark):
    plan = plan_text(fixtures.fx_orders(spark, "/root/testdata/sf0.001"))
    sorts = re.findall(r"Sort \[l_orderkey#\d+L? ", plan)
    assert len(sorts) == 1 and plan.count("Exchange hashpartitioning(l_orderkey") == 1
    # What is sorted has no made column yet.
    assert plan.index("sales_order_number") < plan.index(sorts[0])
    assert "sales_order_number" not in plan[plan.index(sorts[0]):]


@pytest.mark.parametrize("name", ["not_in_stock", "orders_clean", "orders_with_stock", "allocated"])
def test_queries_on_order_lines_sort_them_once_as_stored(spark, name):
    plan = plan_text(QUERIES[name](spark, "/root/testdata/sf0.001"))
    sorts = re.findall(r"Sort \[(?:l_orderkey|sales_order_number)#\d+L? ", plan)
    assert len(sorts) == 1 and plan.count("Exchange hashpartitioning(l_orderkey") == 1
    assert "sales_order_number" not in plan[plan.index(sorts[0]):]


def test_parts_are_dealt_out_before_they_are_expanded(spark):
    plan = plan_text(fixtures.fx_stock(spark, "/root/testdata/sf0.001"))
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning(p_partkey")
