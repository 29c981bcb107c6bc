"""Behaviours where the reference's description and its code differ
(SURVEY §2.14): the code is followed."""

from helpers import orders_df, stock_df

from stockroute.plans.flow import Flow

TS = "2024-06-30T00:00:00"


def _flow(spark, orders, stock):
    return Flow(orders_df(spark, *orders), stock_df(spark, *stock), TS)


def test_no_stock_is_consumed_between_lines(spark):
    # #5: two lines of 8 each see the full 10 at PT12
    f = _flow(spark, [{"sales_order_number": "a"}, {"sales_order_number": "b"}],
              [{"allocable_stock_qty": 10.0}])
    out = {r.sales_order_number: r.case_number for r in f.allocated.collect()}
    assert out == {"a": "CASE_1", "b": "CASE_1"}


def test_start_is_always_default_location_for_valid_lines(spark):
    # #3 and #13: valid lines start at PT12 whatever their own location;
    # exceptions keep their own (raw) storage location.
    f = _flow(spark, [{"sales_order_number": "v", "storage_location": "PT11"},
                      {"sales_order_number": "e", "storage_location": "1000",
                       "delivery_note": "DN"}],
              [{"allocable_stock_qty": 100.0}])
    out = {r.sales_order_number: r.starting_location for r in f.allocation_output.collect()}
    assert out == {"v": "PT12", "e": "1000"}


def test_execution_table_follows_code(spark):
    # #7: executing plant/location = starting location, quantity = ordered even
    # for CASE_3, delivery number = order number; #8: CASE_1 says "raise a ticket".
    f = _flow(spark, [{"sales_order_number": "big", "order_quantity": 1000.0},
                      {"sales_order_number": "ok", "order_quantity": 1.0}],
              [{"allocable_stock_qty": 10.0}])
    ex = {r.sales_order_number: r for r in f.execution_delivery.collect()}
    assert ex["big"].case_number == "CASE_3" and ex["big"].final_allocated_quantity == 1000.0
    assert ex["big"].delivery_number == "big" and ex["big"].allocated_storage_location == "PT12"
    assert ex["ok"].execution_status == "Proceed to raise a ticket"
    assert ex["ok"].sales_order_reference == "ok-1"


def test_listed_parties_get_full_pallet_only(spark):
    # #2: members of the party list must ship whole pallets
    f = _flow(spark, [{"sales_order_number": "p", "sold_to_party": "30724028",
                       "order_quantity": 6.0},
                      {"sales_order_number": "q", "sold_to_party": "123", "order_quantity": 6.0}],
              [{"allocable_stock_qty": 100.0, "packaging_unit": "4"}])
    out = {r.sales_order_number: (r.pallet_rule, r.case_number) for r in f.allocated.collect()}
    assert out == {"p": ("FULL_PALLET_ONLY", "CASE_3"), "q": ("INCOMPLETE_OK", "CASE_1")}


def test_every_non_ztan_line_is_dropped_without_exception(spark):
    # #10
    f = _flow(spark, [{"sales_order_number": "z", "item_category": "ZUCC"},
                      {"sales_order_number": "n", "item_category": None},
                      {"sales_order_number": "k", "item_category": "ZTAX"}], [{}])
    assert f.allocation_output.count() == 0
