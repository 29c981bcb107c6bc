"""Column maps, typed input schemas, output column lists and fixed texts."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: export headers -> column names, in output order ---
ORDER_HEADERS = {
    "Sales Order Number": "sales_order_number",
    "Sales Order Line Item": "sales_order_line_item",
    "Customer Name": "customer_name",
    "Sold to Party": "sold_to_party",
    "Ship to Party": "ship_to_party",
    "Item Category": "item_category",
    "Material UCC14": "material_ucc14",
    "Material DU": "material_du",
    "Storage Location": "storage_location",
    "Line item": "line_item_ref",
    "Material Description": "material_description",
    "Order Type": "order_type",
    "Delivery Note": "delivery_note",
    "Reason for Rejection": "reason_for_rejection",
    "Order Quantity": "order_quantity",
    "Required Delivery Date": "required_delivery_date",
    "Country Code": "country_code",
    "Client Code": "client_code",
    "Material Number": "material_number",
    "Order Status": "order_status",
    "Blocking Indicators": "blocking_indicator",
}
STOCK_HEADERS = {
    "Material Number": "material_number",
    "Plant": "plant",
    "Storage Location": "storage_location",
    "Available Stock Quantity": "available_stock_qty",
    "Allocable Stock Quantity": "allocable_stock_qty",
    "Warehouse Type": "warehouse_type",
    "Packaging Unit / Pallet Unit": "packaging_unit",
    "Palletization Indicator": "palletization_indicator",
    "Stock Timing Timestamp": "stock_timing_timestamp",
}
# --- end of fixed values ---

# Explicit types instead of inference: every column is read as
# text and cast once, so a file whose location column holds only "1000" or
# whose material numbers look numeric gives the same types as any other file.
_ORDER_TYPES = {
    "order_quantity": T.DoubleType(),
    "required_delivery_date": T.DateType(),
}
_STOCK_TYPES = {
    "available_stock_qty": T.DoubleType(),
    "allocable_stock_qty": T.DoubleType(),
    "stock_timing_timestamp": T.TimestampType(),
}


def _schema(headers: dict[str, str], types: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(c, types.get(c, T.StringType()), True)
                         for c in headers.values()])


ORDERS_SCHEMA = _schema(ORDER_HEADERS, _ORDER_TYPES)
STOCK_SCHEMA = _schema(STOCK_HEADERS, _STOCK_TYPES)

# Columns without which an input cannot be processed; the rest become typed
# nulls when a file lacks them.
ORDERS_REQUIRED = ("sales_order_number", "sales_order_line_item", "item_category",
                   "material_number", "order_quantity")
STOCK_REQUIRED = ("material_number", "plant", "storage_location", "allocable_stock_qty")

AUDIT_COLUMNS = ("_ingestion_timestamp", "_source_file")

# --- fixed values: stock columns carried onto each order line by the stock join ---
STOCK_JOIN_COLUMNS = (
    "material_number", "plant",
    "stock_PT12", "stock_PT11", "stock_PT15",
    "has_stock_PT12", "has_stock_PT11", "has_stock_PT15",
    "available_locations_count", "available_locations_list",
    "warehouse_type", "packaging_unit", "palletization_indicator",
    "total_stock",
)
# --- end of fixed values ---

# Beside them where the rules are tables: location -> (quantity, has_stock).
STOCK_MAP = "stock_by_location"

# --- fixed values: the combined allocation table, in output order ---
ALLOCATION_OUTPUT_COLUMNS = (
    "sales_order_number", "sales_order_line_item", "material_number", "material_description",
    "customer_name", "customer_group", "sold_to_party", "ship_to_party",
    "order_quantity", "required_delivery_date", "item_category", "order_type",
    "country_code", "client_code", "pallet_rule",
    "starting_location", "plant", "warehouse_type", "packaging_unit", "palletization_indicator",
    "stock_PT12", "stock_PT11", "stock_PT15",
    "has_stock_PT12", "has_stock_PT11", "has_stock_PT15",
    "available_locations_count", "available_locations_list", "total_stock",
    "allocated_location", "location_changed", "requires_auth",
    "case_number", "case_reason", "sap_action",
    "pega_ticket_required", "pega_ticket_type",
    "approval_status", "dashboard_status",
    "validation_status", "_processed_timestamp",
)
# --- end of fixed values ---

# --- fixed values: status codes and texts written to the output tables ---
CATEGORY_KEPT = "ZTAN"
VALID = "VALID"
EXCEPTION = "EXCEPTION"
REASON_BOTH = "delivery_note not blank; reason_for_rejection not blank"
REASON_NOTE = "delivery_note not blank"
REASON_REJECTION = "reason_for_rejection not blank"

CASE_1 = "CASE_1"
CASE_2 = "CASE_2"
CASE_3 = "CASE_3"
FULL_PALLET_ONLY = "FULL_PALLET_ONLY"
INCOMPLETE_OK = "INCOMPLETE_OK"
NOT_APPLICABLE_GROUP = "N/A"

# case_reason templates; {start}, {loc} and {auth} are filled per row.
REASON_CASE_1 = "Order already at {start} and stock is sufficient. Auto-confirm, no change."
REASON_CASE_2 = ("Starting location {start} short on stock. Reallocated to {loc}. "
                 "Auth required: {auth}. PEGA ticket to be raised.")
REASON_CASE_3 = ("No location (including starting location {start}) has sufficient stock. "
                 "Drop line / requeue.")
REASON_NOT_IN_STOCK = "Material not found in stock data. Drop line."

SAP_AUTO_CONFIRM = "AUTO_CONFIRM_NO_CHANGE"
SAP_UPDATE_LOCATION = "UPDATE_STORAGE_LOCATION"
SAP_DROP_LINE = "DROP_LINE"
SAP_NO_ACTION = "NO_ACTION"
TICKET_TYPE_ORDER_VALIDATION = "ORDER_VALIDATION"
AUTO_APPROVED = "AUTO_APPROVED"
PENDING_APPROVAL = "PENDING_APPROVAL"
NOT_APPLICABLE = "NOT_APPLICABLE"
DASH_CASE_1 = "✅ Auto-Confirmed — No Change"
DASH_PENDING = "\U0001F510 Pending Approval — Ticket to PEGA"
DASH_CHANGED = "\U0001F4CB Location Changed — Ticket to PEGA"
DASH_DROP = "❌ Drop Line — No Stock"
DASH_EXCEPTION = "⚠️ Exception — No Change"

EXEC_PROCEED = "Proceed to raise a ticket"
EXEC_REQUEST_AUTH = "Request for Auth"
EXEC_CHANGE = "Change location, proceed to raise a ticket"
EXEC_DROP = "Drop Line"

# What follows from (case, approval needed), column by column; a missing entry
# is null.
OUTCOME_STATUS = {
    "sap_action": {
        (CASE_1, False): SAP_AUTO_CONFIRM, (CASE_2, False): SAP_UPDATE_LOCATION,
        (CASE_2, True): SAP_UPDATE_LOCATION, (CASE_3, False): SAP_DROP_LINE,
        (EXCEPTION, False): SAP_NO_ACTION},
    "pega_ticket_required": {
        (CASE_1, False): False, (CASE_2, False): True, (CASE_2, True): True,
        (CASE_3, False): False, (EXCEPTION, False): False},
    "pega_ticket_type": {
        (CASE_2, False): TICKET_TYPE_ORDER_VALIDATION, (CASE_2, True): TICKET_TYPE_ORDER_VALIDATION},
    "approval_status": {
        (CASE_1, False): AUTO_APPROVED, (CASE_2, False): AUTO_APPROVED,
        (CASE_2, True): PENDING_APPROVAL, (CASE_3, False): NOT_APPLICABLE,
        (EXCEPTION, False): NOT_APPLICABLE},
    "dashboard_status": {
        (CASE_1, False): DASH_CASE_1, (CASE_2, False): DASH_CHANGED,
        (CASE_2, True): DASH_PENDING, (CASE_3, False): DASH_DROP,
        (EXCEPTION, False): DASH_EXCEPTION},
}
EXECUTION_STATUS = {
    (CASE_1, False): EXEC_PROCEED, (CASE_2, False): EXEC_CHANGE, (CASE_2, True): EXEC_REQUEST_AUTH,
    (CASE_3, False): EXEC_DROP, (EXCEPTION, False): EXEC_PROCEED,
}

# The feasibility table, in output order.
FEASIBILITY_COLUMNS = (
    "sales_order_number", "sales_order_line_item", "material_number", "material_description",
    "allocation_feasibility_flag", "required_quantity", "available_quantity",
    "warehouse_selection_recommendation", "new_recommended_warehouse_location",
    "client_specific_constraint_indicators", "full_pallet_requirement_flag",
    "allowed_restricted_storage_locations", "client_authorization_needed",
    "exception_indicator", "approval_requirement_flag", "business_confirmation_status",
    "reason_for_non_feasibility", "_processed_timestamp",
)

TICKET_PREFIX = "PEGA-OV-"
TICKET_TYPE = "Order Validation"
TICKET_ATTACHMENT_PREFIX = "Warehouse_Change_"
TICKET_ATTACHMENT_SUFFIX = ".pdf"
TICKET_REQUESTOR = "WAREHOUSE_ALLOCATION_AGENT"
TICKET_ROUTING = "UL_APPROVAL_TEAM"
TICKET_STATUS = "Open"
# --- end of fixed values ---

# Every character Python's str.strip() removes (str.isspace()): the customer
# name match strips all of them, not only the space that SQL trim removes.
PY_WHITESPACE = "".join(chr(c) for c in (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
