"""Tiny typed frames for unit tests."""

import datetime as dt

from stockroute.schemas import ORDERS_SCHEMA, STOCK_SCHEMA

ORDER_DEFAULTS = {
    "sales_order_number": "1", "sales_order_line_item": "1", "customer_name": "Walmart",
    "sold_to_party": "1", "ship_to_party": "1", "item_category": "ZTAN",
    "material_ucc14": "U", "material_du": "D", "storage_location": "PT12",
    "line_item_ref": "1", "material_description": "thing", "order_type": "OR",
    "delivery_note": None, "reason_for_rejection": None, "order_quantity": 10.0,
    "required_delivery_date": dt.date(2024, 1, 1), "country_code": "CL",
    "client_code": "C", "material_number": "M1", "order_status": "Open",
    "blocking_indicator": None,
}

STOCK_DEFAULTS = {
    "material_number": "M1", "plant": "P1", "storage_location": "PT12",
    "available_stock_qty": 0.0, "allocable_stock_qty": 0.0, "warehouse_type": "Carousel",
    "packaging_unit": None, "palletization_indicator": None,
    "stock_timing_timestamp": dt.datetime(2024, 1, 1),
}


def orders_df(spark, *rows):
    data = [tuple({**ORDER_DEFAULTS, **r}[f.name] for f in ORDERS_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, ORDERS_SCHEMA)


def stock_df(spark, *rows):
    data = [tuple({**STOCK_DEFAULTS, **r}[f.name] for f in STOCK_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, STOCK_SCHEMA)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
