"""Rules as tables and open locations, against the row-wise statement and the compiled rule."""

import itertools
import math
import random

import pytest
import rowwise_rule
from helpers import orders_df, plan_text, stock_df
from pyspark.sql import functions as F
from test_allocate import _grid

from stockroute.operators import allocate as al
from stockroute.operators import rule_tables as rt
from stockroute.operators import stock
from stockroute.plans import pipeline
from stockroute.plans.flow import Flow, TableFlow
from stockroute.rules import DEFAULT_RULES, Rules, rule_frames
from stockroute.schemas import ORDER_HEADERS, STOCK_HEADERS, STOCK_MAP
from stockroute.session import scratch_path
from stockroute.sources.csv import write_csv

TS = "2024-06-30T00:00:00"
FOUR = Rules(
    locations=("PT12", "PT11", "PT15", "PT20"),
    priority={"Default": ("PT12", "PT11", "PT15", "PT20"), "Walmart": ("PT20", "PT15", "PT11"), "Cencosud": ("PT15", "PT20")},
    requires_auth={"Default": {"PT11": True, "PT15": True, "PT20": False}, "Walmart": {"PT20": True, "PT15": False}})


def lines(spark, rows, locations):
    """Joined lines with a stock map from (id, group, qty, stocks..., rule, unit, start) rows."""
    names = "".join(f", s_{loc} double" for loc in locations)
    df = spark.createDataFrame(rows, f"id long, customer_group string, order_quantity double{names}, "
                                     "pallet_rule string, packaging_unit string, starting_location string")
    entry = lambda loc: F.struct(F.lit(loc), F.struct(F.col(f"s_{loc}").alias("quantity"), (F.col(f"s_{loc}") > 0).alias("has_stock")))
    df = df.withColumn(STOCK_MAP, F.map_from_entries(F.array(*[entry(loc) for loc in locations])))
    total = sum((F.col(f"s_{loc}") for loc in locations[1:]), F.col(f"s_{locations[0]}"))
    return df.withColumns({"total_stock": total, "available_locations_count": F.lit(0), "available_locations_list": F.lit("")}
                          | {f"{k}_{loc}": F.lit(v) for loc in ("PT12", "PT11", "PT15") for k, v in (("stock", 0.0), ("has_stock", False))})


def check(spark, rows, rules, frames=None):
    locations = rules.locations
    out = rt.allocate(lines(spark, rows, locations), frames or rule_frames(spark, rules), rules)
    got = {r[0]: tuple(r[1:]) for r in out.select("id", *al.ALLOCATION_COLUMNS).collect()}
    bad = []
    for i, group, qty, *rest in rows:
        at = dict(zip(locations, rest))
        rule, unit, start = rest[len(locations):]
        has = {k: v > 0 or math.isnan(v) for k, v in at.items()}
        want = rowwise_rule.decide(group, qty, at, has, rule, unit, start=start, rules=rules)
        if got[i] != want:
            bad.append((i, got[i], want))
    assert len(got) == len(rows) and bad == []


def test_equals_the_rowwise_statement_on_the_grid(spark):
    rows = list(_grid())
    assert len(rows) == 156_000
    check(spark, rows, DEFAULT_RULES)


def test_four_locations_equal_the_rowwise_statement(spark):
    grid = itertools.product(["Walmart", "Cencosud", "Default", "unknown", None], [4.0, 10.0, None], *[[0.0, 5.0, 20.0]] * 4,
                             ["FULL_PALLET_ONLY"], ["4", None], ["PT12", "PT20", "PT99"])
    check(spark, [(i, *x) for i, x in enumerate(grid)], FOUR)


def test_ten_thousand_groups(spark):
    """The plan does not grow with the rules, and each group has its own."""
    rng = random.Random(1)
    locations = tuple(f"L{i}" for i in range(40))
    groups = {f"g{i}": tuple(rng.sample(locations, 5)) for i in range(10_000)} | {"Default": locations[:3]}
    auth = {g: {loc: rng.random() < 0.5 for loc in seq[:4]} for g, seq in groups.items() if rng.random() < 0.9 or g == "Default"}
    rules = Rules(locations=locations, start_location="L0", location_alias={}, priority=groups, requires_auth=auth, customer_alias={})
    rows = [(i, f"g{i}", rng.choice([1.0, 30.0]), *[rng.choice([0.0, 0.0, 10.0, 50.0]) for _ in locations], "INCOMPLETE_OK", None, "L0")
            for i in range(0, 10_000, 7)]
    check(spark, rows, rules)
    small = plan_text(rt.allocate(lines(spark, rows[:5], locations), rule_frames(spark, Rules(
        locations=locations, start_location="L0", location_alias={}, priority={"Default": locations[:3]}, requires_auth={})), rules))
    large = plan_text(rt.allocate(lines(spark, rows[:5], locations), rule_frames(spark, rules), rules))
    assert len(large.splitlines()) <= len(small.splitlines()) + 5


def test_rule_tables_beyond_the_broadcast_size_are_joined(spark, monkeypatch):
    monkeypatch.setattr(rt.sized, "__defaults__", (0,))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, g, 4.0, a, b, 5.0, "INCOMPLETE_OK", None, "PT12")
                for i, (g, a, b) in enumerate(itertools.product(["Walmart", "Cencosud", None], [0.0, 9.0], [0.0, 9.0]))]
        check(spark, rows, DEFAULT_RULES)
        out = rt.allocate(lines(spark, rows, DEFAULT_RULES.locations), rule_frames(spark, DEFAULT_RULES))
        assert "Broadcast" not in plan_text(out).split("Subquery")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_repeated_rule_rows_do_not_repeat_lines(spark):
    frames = {k: v.union(v) for k, v in rule_frames(spark, DEFAULT_RULES).items()}
    orders = orders_df(spark, {"customer_name": " walmart", "sold_to_party": "30279964"}, {"customer_name": None, "sold_to_party": None})
    out = rt.enrich_orders(orders, frames).collect()
    assert sorted((r.customer_group, r.pallet_rule, r.starting_location) for r in out) == [
        ("Default", "INCOMPLETE_OK", "PT12"), ("Walmart", "FULL_PALLET_ONLY", "PT12")]
    prof = rt.stock_filtered(stock_df(spark, {"storage_location": "1000", "allocable_stock_qty": 3.0}), TS, frames).collect()
    assert [r.stock_PT12 for r in prof] == [3.0]


def some_stock(spark):
    rng = random.Random(8)
    rows = [{"material_number": rng.choice(["M1", "M2", "M3", None]), "plant": rng.choice(["P1", "P2", None]),
             "storage_location": rng.choice(["PT12", "1000", "PT11", "PT15", "PT20", None]), "allocable_stock_qty": rng.choice([0.1, 0.2, 5.0, -3.0, None]),
             "warehouse_type": rng.choice(["a", "b", None]), "packaging_unit": rng.choice(["4", None])} for _ in range(200)]
    return stock_df(spark, *rows)


def test_stored_columns_are_those_of_the_profile(spark):
    df = some_stock(spark)
    by_map = rt.stock_filtered(df, TS, rule_frames(spark, DEFAULT_RULES))
    by_column = stock.stock_filtered(df, TS)
    key = lambda r: str((r.material_number, r.plant))
    got = sorted(by_map.select(by_column.columns).collect(), key=key)
    assert got == sorted(by_column.collect(), key=key) and len(got) >= 5
    assert by_map.schema[STOCK_MAP].dataType.simpleString() == "map<string,struct<quantity:double,has_stock:boolean>>"


def test_stock_map_shuffles_twice(spark):
    plan = plan_text(rt.stock_map(stock_df(spark, {}), rule_frames(spark, DEFAULT_RULES)))
    assert plan.count("Exchange hashpartitioning(material_number") == 2


def test_fourth_location_end_to_end(spark):
    orders = orders_df(spark, *[{"sales_order_number": str(i), "customer_name": c, "order_quantity": q}
                                for i, (c, q) in enumerate(itertools.product(["Walmart", "Cencosud", "x"], [3.0, 30.0, 300.0]))])
    stock_rows = stock_df(spark, {"allocable_stock_qty": 5.0}, {"storage_location": "PT20", "allocable_stock_qty": 40.0},
                          {"storage_location": "PT15", "allocable_stock_qty": 31.0})
    src = scratch_path(spark, "test-open")
    write_csv(orders, f"{src}/orders", ORDER_HEADERS)
    write_csv(stock_rows, f"{src}/stock", STOCK_HEADERS)
    layout = pipeline.Layout(root=scratch_path(spark, "test-open-tables"))
    res = pipeline.run(spark, f"{src}/orders", f"{src}/stock", layout, run_ts=TS, rules=FOUR, frames=rule_frames(spark, FOUR))
    out = {(r.customer_name, r.order_quantity): r for r in layout.read(spark, "gold", "allocation_output").collect()}
    assert out["Walmart", 30.0].allocated_location == "PT20" and out["Walmart", 30.0].requires_auth
    assert out["Cencosud", 30.0].allocated_location == "PT15" and out["Cencosud", 30.0].requires_auth
    assert out["x", 3.0].case_number == "CASE_1" and out["x", 300.0].case_number == "CASE_3"
    assert out["x", 3.0].available_locations_list == "PT12,PT15,PT20" and out["x", 3.0].stock_PT15 == 31.0
    move = {r.sales_order_number: r for r in layout.read(spark, "gold", "allocation_feasibility_output").collect()}
    assert move["1"].available_quantity == 40.0 and res.metrics["allocation_feasibility_output"] == len(move) == 3


@pytest.mark.parametrize("column", ["allocation_output", "feasibility", "execution_delivery"])
def test_flow_with_tables_equals_the_compiled_flow(spark, column):
    orders = orders_df(spark, *[{"sales_order_number": str(i), "customer_name": c, "order_quantity": q, "material_number": m, "delivery_note": d}
                                for i, (c, q, m, d) in enumerate(itertools.product(["Walmart", "Cencosud", None], [0.1, 9.0, None],
                                                                                   ["M1", "M2", "no", None], [None, "DN"]))])
    a, b = getattr(Flow(orders, some_stock(spark), TS), column), getattr(TableFlow(orders, some_stock(spark), TS), column)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
