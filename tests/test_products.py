import re

from helpers import orders_df, stock_df

from stockroute.operators import products, summary
from stockroute.plans.flow import Flow

TS = "2024-06-30T00:00:00"


def _flow(spark):
    orders = orders_df(
        spark,
        *[{"sales_order_number": f"{n}", "sales_order_line_item": f"{l}",
           "customer_name": name, "order_quantity": q, "material_number": m}
          for n, (name, q, m) in enumerate([
              ("Walmart", 50.0, "M1"), ("TentA", 50.0, "M1"), ("Cencosud", 50.0, "M1"),
              ("DMart", 5.0, "M1"), ("Walmart", 500.0, "M1"), ("Other", 50.0, "M2")])
          for l in (1, 2)],
        {"sales_order_number": "X", "delivery_note": "DN"})
    st = stock_df(spark,
                  {"material_number": "M1", "storage_location": "PT12", "allocable_stock_qty": 10.0},
                  {"material_number": "M1", "storage_location": "PT11", "allocable_stock_qty": 60.0},
                  {"material_number": "M1", "storage_location": "PT15", "allocable_stock_qty": 60.0},
                  {"material_number": "M2", "storage_location": "PT15", "allocable_stock_qty": 60.0})
    return Flow(orders, st, TS)


def test_tickets_dense_unique_and_only_approval_lines(spark):
    flow = _flow(spark)
    t = flow.tickets.collect()
    ids = sorted(r.ticket_id for r in t)
    assert ids == [f"PEGA-OV-{i:05d}" for i in range(len(t))]
    # TentA at PT11, Cencosud at PT15 (no approval), Other at PT15 -> TentA x2 + Other x2
    assert sorted(r.sales_order_number_line_items for r in t) == ["1-1", "1-2", "5-1", "5-2"]
    assert all(re.fullmatch(r"Warehouse_Change_\d+\.pdf", r.attachment_file_name) for r in t)
    # ids follow the order key
    by_key = sorted(t, key=lambda r: r.sales_order_number_line_items)
    assert [r.ticket_id for r in by_key] == ids


def test_ticket_ids_pad_but_never_cut(spark):
    df = spark.range(100001).selectExpr(
        "CAST(id AS STRING) AS sales_order_number", "'1' AS sales_order_line_item",
        "'M' AS material_number", "'P1' AS plant", "'PT11' AS allocated_location",
        "'r' AS case_reason", "'PT12' AS starting_location", "'CASE_2' AS case_number",
        "true AS requires_auth")
    ids = {r.ticket_id for r in products.tickets(df, TS, partitions=8).select("ticket_id").collect()}
    assert len(ids) == 100001 and "PEGA-OV-100000" in ids and "PEGA-OV-00000" in ids


def test_feasibility_and_execution(spark):
    flow = _flow(spark)
    feas = {r.sales_order_number: r for r in flow.feasibility.collect()}
    assert set(feas) == {"0", "1", "2", "5"}
    assert feas["2"].available_quantity == 60.0 and feas["2"].client_authorization_needed == "No"
    assert feas["1"].client_specific_constraint_indicators == "TentA | INCOMPLETE_OK"
    ex = {(r.sales_order_number, r.sales_order_line_item): r for r in flow.execution_delivery.collect()}
    assert ex[("3", "1")].execution_status == "Proceed to raise a ticket"          # CASE_1
    assert ex[("1", "1")].execution_status == "Request for Auth"                   # CASE_2 + auth
    assert ex[("0", "1")].execution_status == "Change location, proceed to raise a ticket"
    assert ex[("4", "1")].execution_status == "Drop Line"                          # CASE_3
    assert ex[("X", "1")].execution_status == "Proceed to raise a ticket"          # exception
    assert ex[("X", "1")].warehouse_plant_executing_delivery == "PT12"
    assert flow.execution_delivery.count() == flow.allocation_output.count()


def test_summaries_and_metrics(spark):
    flow = _flow(spark)
    cases = {r.case_number: r["count"] for r in summary.case_summary(flow.allocated).collect()}
    assert cases == {"CASE_1": 2, "CASE_2": 8, "CASE_3": 2}
    metrics = {r.metric: r.value for r in flow.metrics().collect()}
    assert metrics["orders_raw"] == 13 and metrics["exceptions"] == 1
    assert metrics["tickets"] == 4 and metrics["allocation_output"] == 13
