import itertools
import math

import rowwise_rule
from helpers import orders_df, plan_text, stock_df
from pyspark.sql import functions as F

from stockroute.functions import customer_group
from stockroute.operators import allocate as al
from stockroute.operators import enrich, output, stock
from stockroute.plans.flow import Flow

TS = "2024-06-30T00:00:00"
NAN = float("nan")


def test_customer_group_aliases_and_unicode_blanks(spark):
    names = ["Walmart", "  walmart ", " 　CENCOSUD\t", "Demart", "DMart", "tenta ",
             "Tesco", None, "", "WAL MART"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(customer_group(F.col("n"))).collect()]
    assert got == ["Walmart", "Walmart", "Cencosud", "DMart", "DMart", "TentA",
                   "Default", "Default", "Default", "Default"]


def test_pallet_rule_membership(spark):
    df = orders_df(spark, {"sold_to_party": "30279964"}, {"sold_to_party": "030279964"},
                   {"sold_to_party": None})
    got = [r.pallet_rule for r in enrich.enrich_orders(df).collect()]
    assert got == ["FULL_PALLET_ONLY", "INCOMPLETE_OK", "INCOMPLETE_OK"]


def _grid():
    groups = ["Walmart", "Cencosud", "TentA", "Default"]
    qtys = [None, 0.0, 4.0, 12.0, NAN, -4.0]
    stocks = [0.0, 5.0, 12.0, NAN, -3.0]
    rules = ["FULL_PALLET_ONLY", "INCOMPLETE_OK"]
    units = [None, "PAL", "4", "2.5", "nan", "-Inf", "-4", "10D", "5f", "10F", "1_0", "1__0", "\u00a04\t", ".5e1",
             "4.", "0x4", "", "1e", "+4", "4 4", "infinity"]
    starts = ["PT12", "PT11", "PT15", "PT99", None]
    for i, (g, q, s12, s11, s15, r, (u, start)) in enumerate(itertools.product(
            groups, qtys, stocks, stocks, stocks, rules,
            [(u, starts[k % 5]) for k, u in enumerate(units)] + [("4", x) for x in starts])):
        yield (i, g, q, s12, s11, s15, r, u, start)


def test_rule_matches_rowwise_statement_on_grid(spark):
    """Brute force: the compiled CASE against an independent row-wise Python
    statement of the rule over every combination of a value grid."""
    grid = list(_grid())
    df = spark.createDataFrame(grid, "id long, customer_group string, order_quantity double, "
                                     "stock_PT12 double, stock_PT11 double, stock_PT15 double, "
                                     "pallet_rule string, packaging_unit string, starting_location string")
    df = df.withColumns({f"has_stock_{loc}": F.col(f"stock_{loc}") > 0
                         for loc in ("PT12", "PT11", "PT15")})
    df = df.withColumns({"total_stock": F.col("stock_PT12") + F.col("stock_PT11")
                         + F.col("stock_PT15")})
    # allocate() also zero-fills these when no stock row matched.
    for c, t in (("plant", "string"), ("warehouse_type", "string"),
                 ("palletization_indicator", "string"), ("available_locations_count", "int"),
                 ("available_locations_list", "string")):
        df = df.withColumn(c, F.lit(None).cast(t))
    got = {r[0]: tuple(r[1:]) for r in
           al.allocate(df).select("id", *al.ALLOCATION_COLUMNS).collect()}
    mismatches = []
    for i, g, q, s12, s11, s15, rule, unit, start in grid:
        stocks = {"PT12": s12, "PT11": s11, "PT15": s15}
        has = {k: (v > 0 or math.isnan(v)) for k, v in stocks.items()}  # Spark: NaN > 0
        want = rowwise_rule.decide(g, q, stocks, has, rule, unit, start=start)
        if got[i] != want:
            mismatches.append((i, got[i], want))
    assert len(grid) == 4 * 6 * 125 * 2 * 26
    assert mismatches == []


def test_missing_quantity_counts_as_zero_and_not_found(spark):
    orders = enrich.enrich_orders(orders_df(
        spark, {"sales_order_number": "q0", "order_quantity": None},
        {"sales_order_number": "miss", "material_number": "NOPE"},
        {"sales_order_number": "nullmat", "material_number": None}))
    st = stock.stock_filtered(stock_df(spark, {"allocable_stock_qty": 1.0}), TS)
    out = {r.sales_order_number: r for r in al.allocate(al.join_stock(orders, st)).collect()}
    assert out["q0"].case_number == "CASE_1"
    for k in ("miss", "nullmat"):
        r = out[k]
        assert (r.case_number, r.case_reason) == ("CASE_3", "Material not found in stock data. Drop line.")
        assert (r.stock_PT12, r.total_stock, r.available_locations_list, r.plant) == (0.0, 0.0, "", None)


def test_two_plants_give_one_row_each(spark):
    orders = enrich.enrich_orders(orders_df(spark, {"order_quantity": 5.0}))
    st = stock.stock_filtered(stock_df(
        spark, {"plant": "P1", "allocable_stock_qty": 10.0},
        {"plant": "P2", "storage_location": "PT15", "allocable_stock_qty": 10.0}), TS)
    out = sorted((r.plant, r.case_number, r.allocated_location, r.requires_auth)
                 for r in al.allocate(al.join_stock(orders, st)).collect())
    assert out == [("P1", "CASE_1", "PT12", False), ("P2", "CASE_2", "PT15", True)]


def test_letter_suffix_is_no_pallet_size(spark):
    line = {"sold_to_party": "30279964", "order_quantity": 7.0}
    orders = enrich.enrich_orders(orders_df(spark, line))
    st = stock.stock_filtered(stock_df(spark, {"allocable_stock_qty": 100.0, "packaging_unit": "10D"}), TS)
    assert al.allocate(al.join_stock(orders, st)).first().case_number == "CASE_1"


def test_line_starts_where_it_says(spark):
    orders = enrich.enrich_orders(orders_df(spark, {})).withColumn("starting_location", F.lit("PT11"))
    st = stock.stock_filtered(stock_df(spark, {"storage_location": "PT11", "allocable_stock_qty": 100.0}), TS)
    r = al.allocate(al.join_stock(orders, st)).first()
    assert (r.case_number, r.allocated_location) == ("CASE_1", "PT11") and "at PT11" in r.case_reason


def test_allocation_plan_is_native_and_exceptions_skip_the_join(spark, tmp_path):
    """Stored valid lines and exceptions are each read once; the union puts the
    exceptions beside the join, not into it."""
    flow = Flow(orders_df(spark, {"sales_order_number": "a"}, {"sales_order_number": "b", "delivery_note": "DN"}),
                stock_df(spark, {"allocable_stock_qty": 30.0}))
    for name in ("valid_orders", "exceptions", "stock_filtered"):
        getattr(flow, name).write.parquet(str(tmp_path / name))
    valid, exc, st = (spark.read.parquet(str(tmp_path / n)) for n in ("valid_orders", "exceptions", "stock_filtered"))
    actions = output.allocate_with_actions(al.join_stock(enrich.enrich_orders(valid), st), TS)
    out = output.allocation_output(actions, exc, TS)
    plan = plan_text(out)
    assert "EvalPython" not in plan and plan.count("Join") == 1
    join_side, exception_side = plan[:plan.rindex("Project")], plan[plan.rindex("Project"):]
    assert plan.count("FileScan parquet") == 3  # valid lines, stock, exceptions: once each
    assert exception_side.count("FileScan parquet") == 1 and "Join" not in exception_side
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, flow.allocation_output.collect()), key=repr)
    assert sorted(r.case_number for r in out.collect()) == ["CASE_1", "EXCEPTION"]
