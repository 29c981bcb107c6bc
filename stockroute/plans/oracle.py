"""DuckDB oracle SQL for every registered query.

The statements restate the rules relationally and independently of the
DataFrame code: the pivot is a grouped sum joined to a separate attribute
aggregate (as the reference shapes it), the allocation is one pass of plain
CASEs over the joined lines, and ticket ids come from a plain global
``row_number()``. Rule values stand here as their own literals, so a wrong value
in the engine does not pass. Every query starts from the FIXTURES.md views, so
it covers the whole driver tables.
"""

from __future__ import annotations

from .fixtures import FX_ORDERS_SQL, FX_STOCK_SQL
from .flow import QUERY_RUN_TS

TS = f"'{QUERY_RUN_TS}'"
# Blanks around a customer name (by code point).
WS = " || ".join(f"chr({c})" for c in (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
                                        8232, 8233, 8239, 8287, 12288))


# --- fixed values: full-pallet parties, and the allocation table's columns ---
PARTIES = ("'30279964', '30724028', '30597757', '30791641', "
           "'30280027', '30280062', '30280078', '30829327'")
OUT_COLS = """sales_order_number, sales_order_line_item, material_number, material_description,
       customer_name, customer_group, sold_to_party, ship_to_party, order_quantity,
       required_delivery_date, item_category, order_type, country_code, client_code, pallet_rule,
       starting_location, plant, warehouse_type, packaging_unit, palletization_indicator,
       stock_PT12, stock_PT11, stock_PT15, has_stock_PT12, has_stock_PT11, has_stock_PT15,
       available_locations_count, available_locations_list, total_stock, allocated_location,
       location_changed, requires_auth, case_number, case_reason, sap_action, pega_ticket_required,
       pega_ticket_type, approval_status, dashboard_status, validation_status, _processed_timestamp"""
# --- end of fixed values ---

ORDER_COLS = ("sales_order_number, sales_order_line_item, customer_name, sold_to_party, "
              "ship_to_party, item_category, material_ucc14, material_du, storage_location, "
              "line_item_ref, material_description, order_type, delivery_note, "
              "reason_for_rejection, order_quantity, required_delivery_date, country_code, "
              "client_code, material_number, order_status, blocking_indicator")


def _blank(c: str) -> str:
    return f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END AS {c}"


def _able(loc: str) -> str:
    return (f"coalesce(fits AND has_stock_{loc} AND NOT isnan(stock_{loc}) "
            f"AND stock_{loc} >= coalesce(order_quantity, 0.0), FALSE)")


CTES: list[tuple[str, str]] = [
    ("fx_orders", FX_ORDERS_SQL),
    ("fx_stock", FX_STOCK_SQL),
    ("name_alias", """SELECT * FROM (VALUES ('WALMART', 'Walmart'), ('CENCOSUD', 'Cencosud'), ('DEMART', 'DMart'),
                  ('DMART', 'DMart'), ('TENTA', 'TentA')) AS t(name_key, customer_group)"""),
    ("ztan", "SELECT * FROM fx_orders WHERE upper(trim(item_category)) = 'ZTAN'"),
    ("clean", "SELECT * REPLACE (" + ", ".join(_blank(c) for c in
                                               ("delivery_note", "reason_for_rejection",
                                                "blocking_indicator")) + ") FROM ztan"),
    ("valid", f"""SELECT *, 'VALID' AS validation_status, CAST(NULL AS VARCHAR) AS exception_reason,
                  {TS} AS _processed_timestamp
           FROM clean WHERE delivery_note IS NULL AND reason_for_rejection IS NULL"""),
    ("exc", f"""SELECT *, 'EXCEPTION' AS validation_status,
                  CASE WHEN delivery_note IS NOT NULL AND reason_for_rejection IS NOT NULL
                       THEN 'delivery_note not blank; reason_for_rejection not blank'
                       WHEN delivery_note IS NOT NULL THEN 'delivery_note not blank'
                       ELSE 'reason_for_rejection not blank' END AS exception_reason,
                  {TS} AS _processed_timestamp
           FROM clean WHERE NOT (delivery_note IS NULL AND reason_for_rejection IS NULL)"""),
    ("stock_norm", """SELECT * FROM (
             SELECT material_number, plant,
                    CASE WHEN storage_location = '1000' THEN 'PT12' ELSE storage_location END AS storage_location,
                    coalesce(available_stock_qty, 0.0) AS available_stock_qty,
                    coalesce(allocable_stock_qty, 0.0) AS allocable_stock_qty,
                    warehouse_type, packaging_unit, palletization_indicator, stock_timing_timestamp
             FROM fx_stock) s
           WHERE storage_location IN ('PT12', 'PT11', 'PT15')"""),
    ("by_loc", """SELECT material_number, plant, storage_location,
                  sum(allocable_stock_qty) AS allocable_stock_qty,
                  sum(available_stock_qty) AS available_stock_qty
           FROM stock_norm GROUP BY material_number, plant, storage_location"""),
    ("piv", """SELECT material_number, plant,
                  coalesce(max(CASE WHEN storage_location = 'PT12' THEN allocable_stock_qty END), 0.0) AS stock_PT12,
                  coalesce(max(CASE WHEN storage_location = 'PT11' THEN allocable_stock_qty END), 0.0) AS stock_PT11,
                  coalesce(max(CASE WHEN storage_location = 'PT15' THEN allocable_stock_qty END), 0.0) AS stock_PT15
           FROM by_loc GROUP BY material_number, plant"""),
    ("attrs", """SELECT material_number, plant, max(stock_timing_timestamp) AS stock_timing_timestamp,
                  first(warehouse_type ORDER BY r, warehouse_type) FILTER (WHERE warehouse_type IS NOT NULL) AS warehouse_type,
                  first(packaging_unit ORDER BY r, packaging_unit) FILTER (WHERE packaging_unit IS NOT NULL) AS packaging_unit,
                  first(palletization_indicator ORDER BY r, palletization_indicator) FILTER (WHERE palletization_indicator IS NOT NULL) AS palletization_indicator
           FROM (SELECT *, CASE storage_location WHEN 'PT12' THEN 0 WHEN 'PT11' THEN 1 ELSE 2 END AS r
                 FROM stock_norm) s
           GROUP BY material_number, plant"""),
    ("profile", """SELECT p.material_number, p.plant, p.stock_PT12, p.stock_PT11, p.stock_PT15,
                  a.stock_timing_timestamp, a.warehouse_type, a.packaging_unit, a.palletization_indicator
           FROM piv p LEFT JOIN attrs a
             ON p.material_number = a.material_number AND p.plant = a.plant"""),
    ("flags", """SELECT *, stock_PT12 > 0 AS has_stock_PT12, stock_PT11 > 0 AS has_stock_PT11,
                  stock_PT15 > 0 AS has_stock_PT15, stock_PT12 + stock_PT11 + stock_PT15 AS total_stock
           FROM profile"""),
    ("with_stock", "SELECT * FROM flags WHERE total_stock > 0"),
    ("tagged", f"""SELECT *,
                  CAST(has_stock_PT12 AS INTEGER) + CAST(has_stock_PT11 AS INTEGER) + CAST(has_stock_PT15 AS INTEGER) AS available_locations_count,
                  concat_ws(',', CASE WHEN has_stock_PT12 THEN 'PT12' END, CASE WHEN has_stock_PT11 THEN 'PT11' END,
                            CASE WHEN has_stock_PT15 THEN 'PT15' END) AS available_locations_list,
                  {TS} AS _processed_timestamp
           FROM with_stock"""),
    ("enriched", f"""SELECT v.*, coalesce(al.customer_group, 'Default') AS customer_group,
                  CASE WHEN coalesce(v.sold_to_party, '') IN ({PARTIES}) THEN 'FULL_PALLET_ONLY'
                       ELSE 'INCOMPLETE_OK' END AS pallet_rule,
                  'PT12' AS starting_location
           FROM valid v LEFT JOIN name_alias al ON al.name_key = upper(trim(v.customer_name, {WS}))"""),
    ("joined", """SELECT e.*, s.plant, s.stock_PT12, s.stock_PT11, s.stock_PT15,
                  s.has_stock_PT12, s.has_stock_PT11, s.has_stock_PT15,
                  s.available_locations_count, s.available_locations_list,
                  s.warehouse_type, s.packaging_unit, s.palletization_indicator, s.total_stock
           FROM enriched e LEFT JOIN tagged s ON e.material_number = s.material_number"""),
    # One pass over the joined lines: which locations can serve, then the first
    # of the group's sequence that does (the line's start, PT12, leads each).
    ("serving", f"""SELECT *,
                  CASE WHEN pallet_rule = 'FULL_PALLET_ONLY' AND TRY_CAST(packaging_unit AS DOUBLE) > 0
                            AND NOT isnan(TRY_CAST(packaging_unit AS DOUBLE))
                       THEN coalesce(order_quantity, 0.0) % TRY_CAST(packaging_unit AS DOUBLE) = 0
                       ELSE TRUE END
                  AND total_stock IS NOT NULL AND NOT isnan(coalesce(order_quantity, 0.0)) AS fits
           FROM joined"""),
    ("able", f"""SELECT * EXCLUDE (fits), {_able('PT12')} AS can_PT12, {_able('PT11')} AS can_PT11,
                  {_able('PT15')} AS can_PT15 FROM serving"""),
    ("picked", """SELECT * EXCLUDE (can_PT12, can_PT11, can_PT15),
                  CASE WHEN can_PT12 THEN 'PT12'
                       WHEN customer_group = 'Cencosud' AND can_PT15 THEN 'PT15'
                       WHEN can_PT11 THEN 'PT11'
                       WHEN can_PT15 THEN 'PT15' END AS hit
           FROM able"""),
    ("alloc_raw", """SELECT *,
                  CASE WHEN customer_group = 'Walmart' THEN hit = 'PT15'
                       WHEN customer_group = 'Cencosud' THEN hit = 'PT11'
                       ELSE hit <> 'PT12' END AS auth_at_hit
           FROM picked"""),
    ("allocated", """SELECT * EXCLUDE (hit, auth_at_hit) REPLACE (
                  CASE WHEN total_stock IS NULL THEN 0.0 ELSE stock_PT12 END AS stock_PT12,
                  CASE WHEN total_stock IS NULL THEN 0.0 ELSE stock_PT11 END AS stock_PT11,
                  CASE WHEN total_stock IS NULL THEN 0.0 ELSE stock_PT15 END AS stock_PT15,
                  CASE WHEN total_stock IS NULL THEN FALSE ELSE has_stock_PT12 END AS has_stock_PT12,
                  CASE WHEN total_stock IS NULL THEN FALSE ELSE has_stock_PT11 END AS has_stock_PT11,
                  CASE WHEN total_stock IS NULL THEN FALSE ELSE has_stock_PT15 END AS has_stock_PT15,
                  CASE WHEN total_stock IS NULL THEN 0 ELSE available_locations_count END AS available_locations_count,
                  CASE WHEN total_stock IS NULL THEN '' ELSE available_locations_list END AS available_locations_list,
                  CASE WHEN total_stock IS NULL THEN 0.0 ELSE total_stock END AS total_stock),
                  hit AS allocated_location,
                  CASE WHEN hit IS NOT NULL AND hit <> 'PT12' THEN auth_at_hit ELSE FALSE END AS requires_auth,
                  CASE WHEN hit IS NULL THEN 'CASE_3' WHEN hit = 'PT12' THEN 'CASE_1' ELSE 'CASE_2' END AS case_number,
                  CASE WHEN total_stock IS NULL THEN 'Material not found in stock data. Drop line.'
                       WHEN hit IS NULL THEN 'No location (including starting location PT12) has sufficient stock. Drop line / requeue.'
                       WHEN hit = 'PT12' THEN 'Order already at PT12 and stock is sufficient. Auto-confirm, no change.'
                       ELSE 'Starting location PT12 short on stock. Reallocated to ' || hit || '. Auth required: '
                            || CASE WHEN auth_at_hit THEN 'True' ELSE 'False' END || '. PEGA ticket to be raised.'
                  END AS case_reason,
                  coalesce(hit IS NOT NULL AND hit <> 'PT12', FALSE) AS location_changed
           FROM alloc_raw"""),
    ("actions", f"""SELECT * REPLACE ({TS} AS _processed_timestamp),
                  CASE case_number WHEN 'CASE_1' THEN 'AUTO_CONFIRM_NO_CHANGE'
                       WHEN 'CASE_2' THEN 'UPDATE_STORAGE_LOCATION' ELSE 'DROP_LINE' END AS sap_action,
                  case_number = 'CASE_2' AS pega_ticket_required,
                  CASE WHEN case_number = 'CASE_2' THEN 'ORDER_VALIDATION' END AS pega_ticket_type,
                  CASE WHEN case_number = 'CASE_1' THEN 'AUTO_APPROVED'
                       WHEN case_number = 'CASE_2' AND requires_auth THEN 'PENDING_APPROVAL'
                       WHEN case_number = 'CASE_2' THEN 'AUTO_APPROVED'
                       ELSE 'NOT_APPLICABLE' END AS approval_status,
                  CASE WHEN case_number = 'CASE_1' THEN '✅ Auto-Confirmed — No Change'
                       WHEN case_number = 'CASE_2' AND requires_auth THEN '\U0001F510 Pending Approval — Ticket to PEGA'
                       WHEN case_number = 'CASE_2' THEN '\U0001F4CB Location Changed — Ticket to PEGA'
                       ELSE '❌ Drop Line — No Stock' END AS dashboard_status
           FROM allocated"""),
    ("exc_gold", f"""SELECT sales_order_number, sales_order_line_item, material_number, material_description,
                  customer_name, 'N/A' AS customer_group, sold_to_party, ship_to_party,
                  order_quantity, required_delivery_date, item_category, order_type,
                  country_code, client_code, 'N/A' AS pallet_rule,
                  storage_location AS starting_location, CAST(NULL AS VARCHAR) AS plant,
                  CAST(NULL AS VARCHAR) AS warehouse_type, CAST(NULL AS VARCHAR) AS packaging_unit,
                  CAST(NULL AS VARCHAR) AS palletization_indicator,
                  CAST(NULL AS DOUBLE) AS stock_PT12, CAST(NULL AS DOUBLE) AS stock_PT11, CAST(NULL AS DOUBLE) AS stock_PT15,
                  CAST(NULL AS BOOLEAN) AS has_stock_PT12, CAST(NULL AS BOOLEAN) AS has_stock_PT11,
                  CAST(NULL AS BOOLEAN) AS has_stock_PT15,
                  CAST(NULL AS INTEGER) AS available_locations_count, CAST(NULL AS VARCHAR) AS available_locations_list,
                  CAST(NULL AS DOUBLE) AS total_stock,
                  CAST(NULL AS VARCHAR) AS allocated_location, FALSE AS location_changed, FALSE AS requires_auth,
                  'EXCEPTION' AS case_number, exception_reason AS case_reason, 'NO_ACTION' AS sap_action,
                  FALSE AS pega_ticket_required, CAST(NULL AS VARCHAR) AS pega_ticket_type,
                  'NOT_APPLICABLE' AS approval_status, '⚠️ Exception — No Change' AS dashboard_status,
                  validation_status, {TS} AS _processed_timestamp
           FROM exc"""),
    ("alloc_out", f"SELECT {OUT_COLS} FROM actions UNION ALL SELECT {OUT_COLS} FROM exc_gold"),
    # Four locations: the fourth second for Walmart (no approval), last for the others.
    ("open_by_loc", """SELECT material_number, plant, CASE WHEN storage_location = '1000' THEN 'PT12' ELSE storage_location END AS location,
                  sum(coalesce(allocable_stock_qty, 0.0)) AS quantity, first(packaging_unit) AS packaging_unit
           FROM fx_stock WHERE storage_location IN ('PT12', '1000', 'PT11', 'PT15', 'XX99') GROUP BY ALL"""),
    ("open_stock", """SELECT *, s12 + s11 + s15 + s99 AS total_stock,
                  CAST((s12 > 0)::INT + (s11 > 0)::INT + (s15 > 0)::INT + (s99 > 0)::INT AS INTEGER) AS available_locations_count,
                  concat_ws(',', CASE WHEN s12 > 0 THEN 'PT12' END, CASE WHEN s11 > 0 THEN 'PT11' END,
                            CASE WHEN s15 > 0 THEN 'PT15' END, CASE WHEN s99 > 0 THEN 'XX99' END) AS available_locations_list
           FROM (SELECT material_number, plant, any_value(packaging_unit) AS packaging_unit,
                        coalesce(max(quantity) FILTER (location = 'PT12'), 0.0) AS s12, coalesce(max(quantity) FILTER (location = 'PT11'), 0.0) AS s11,
                        coalesce(max(quantity) FILTER (location = 'PT15'), 0.0) AS s15, coalesce(max(quantity) FILTER (location = 'XX99'), 0.0) AS s99
                 FROM open_by_loc GROUP BY material_number, plant)
           WHERE s12 + s11 + s15 + s99 > 0"""),
    ("open_able", """SELECT e.*, s.* EXCLUDE (material_number), coalesce(order_quantity, 0.0) AS need,
                  CASE WHEN pallet_rule = 'FULL_PALLET_ONLY' AND TRY_CAST(packaging_unit AS DOUBLE) > 0
                       THEN coalesce(order_quantity, 0.0) % TRY_CAST(packaging_unit AS DOUBLE) = 0 ELSE TRUE END AS fits
           FROM enriched e LEFT JOIN open_stock s ON e.material_number = s.material_number"""),
    ("open_picked", """SELECT *, CASE WHEN NOT fits OR total_stock IS NULL THEN NULL
                       WHEN s12 > 0 AND s12 >= need THEN 'PT12'
                       WHEN customer_group = 'Walmart' AND s99 > 0 AND s99 >= need THEN 'XX99'
                       WHEN customer_group = 'Cencosud' AND s15 > 0 AND s15 >= need THEN 'PT15'
                       WHEN s11 > 0 AND s11 >= need THEN 'PT11'
                       WHEN s15 > 0 AND s15 >= need THEN 'PT15'
                       WHEN s99 > 0 AND s99 >= need THEN 'XX99' END AS hit
           FROM open_able"""),
    ("open_alloc", """SELECT *, CASE WHEN hit IS NULL OR hit = 'PT12' THEN FALSE WHEN customer_group = 'Walmart' THEN hit = 'PT15'
                       WHEN customer_group = 'Cencosud' THEN hit <> 'PT15' ELSE TRUE END AS requires_auth FROM open_picked"""),
]

_NAMES = [n for n, _ in CTES]
# Read by more than one later part: computed once.
SHARED = ("fx_orders", "fx_stock", "stock_norm", "tagged", "joined")


def with_ctes(final: str, upto: str) -> str:
    """``WITH`` every CTE up to and including ``upto``, then ``final``."""
    chosen = CTES[:_NAMES.index(upto) + 1]
    return "WITH " + ",\n".join(
        f"{n} AS {'MATERIALIZED ' if n in SHARED else ''}(\n{sql}\n)" for n, sql in chosen) + "\n" + final


def _nullif_text(cols: str, text_cols: set[str]) -> str:
    return ", ".join(f"NULLIF({c}, '') AS {c}" if c in text_cols else c
                     for c in (x.strip() for x in cols.split(",")))


_ORDER_TEXT = {c.strip() for c in ORDER_COLS.split(",")} - {"order_quantity",
                                                            "required_delivery_date"}
_STOCK_COLS = ("material_number, plant, storage_location, available_stock_qty, "
               "allocable_stock_qty, warehouse_type, packaging_unit, palletization_indicator, "
               "stock_timing_timestamp")
_STOCK_TEXT = {"material_number", "plant", "storage_location", "warehouse_type",
               "packaging_unit", "palletization_indicator"}

# Cells as the faulty extract holds them.
FAULTY = """(SELECT sales_order_number, sales_order_line_item,
        CASE sales_order_line_item WHEN '3' THEN '1,' || CAST(order_quantity AS VARCHAR) WHEN '5' THEN 'n/a'
             ELSE CAST(order_quantity AS VARCHAR) END AS q,
        CASE WHEN sales_order_line_item IN ('4', '5') THEN '31.12.2024' ELSE CAST(required_delivery_date AS VARCHAR) END AS d
 FROM fx_orders)"""
_BAD_Q, _BAD_D = "q IS NOT NULL AND TRY_CAST(q AS DOUBLE) IS NULL", "d IS NOT NULL AND TRY_CAST(d AS DATE) IS NULL"

FEASIBILITY = f"""SELECT sales_order_number, sales_order_line_item, material_number, material_description,
       'Yes' AS allocation_feasibility_flag, order_quantity AS required_quantity,
       CASE allocated_location WHEN 'PT12' THEN stock_PT12 WHEN 'PT11' THEN stock_PT11
            WHEN 'PT15' THEN stock_PT15 ELSE 0.0 END AS available_quantity,
       allocated_location AS warehouse_selection_recommendation,
       allocated_location AS new_recommended_warehouse_location,
       concat_ws(' | ', customer_group, pallet_rule) AS client_specific_constraint_indicators,
       CASE WHEN pallet_rule = 'FULL_PALLET_ONLY' THEN 'Yes' ELSE 'No' END AS full_pallet_requirement_flag,
       available_locations_list AS allowed_restricted_storage_locations,
       CASE WHEN requires_auth THEN 'Yes' ELSE 'No' END AS client_authorization_needed,
       CAST(NULL AS VARCHAR) AS exception_indicator,
       CASE WHEN requires_auth THEN 'Yes' ELSE 'No' END AS approval_requirement_flag,
       approval_status AS business_confirmation_status,
       CAST(NULL AS VARCHAR) AS reason_for_non_feasibility, _processed_timestamp
FROM alloc_out WHERE case_number = 'CASE_2'"""

TICKETS = f"""SELECT 'PEGA-OV-' || printf('%05d', row_number() OVER (
           ORDER BY sales_order_number NULLS FIRST, sales_order_line_item NULLS FIRST,
                    material_number NULLS FIRST, plant NULLS FIRST, allocated_location NULLS FIRST,
                    case_reason NULLS FIRST, starting_location NULLS FIRST) - 1) AS ticket_id,
       'Order Validation' AS ticket_type,
       concat_ws('-', sales_order_number, sales_order_line_item) AS sales_order_number_line_items,
       starting_location AS old_storage_location, allocated_location AS new_storage_location,
       material_number, case_reason AS reason_for_change,
       'Warehouse_Change_' || sales_order_number || '.pdf' AS attachment_file_name,
       'WAREHOUSE_ALLOCATION_AGENT' AS requestor_id_analyst_id, 'UL_APPROVAL_TEAM' AS routing_team,
       {TS} AS ticket_creation_timestamp, 'Open' AS ticket_status
FROM alloc_out WHERE case_number = 'CASE_2' AND requires_auth = TRUE"""

EXECUTION = f"""SELECT *, order_quantity AS final_allocated_quantity,
       sales_order_number AS delivery_number, {TS} AS delivery_creation_timestamp,
       starting_location AS warehouse_plant_executing_delivery,
       starting_location AS allocated_storage_location,
       concat_ws('-', sales_order_number, sales_order_line_item) AS sales_order_reference,
       CASE WHEN case_number = 'CASE_1' THEN 'Proceed to raise a ticket'
            WHEN case_number = 'CASE_2' AND requires_auth = TRUE THEN 'Request for Auth'
            WHEN case_number = 'CASE_2' AND requires_auth = FALSE THEN 'Change location, proceed to raise a ticket'
            WHEN case_number = 'CASE_3' THEN 'Drop Line'
            WHEN case_number = 'EXCEPTION' THEN 'Proceed to raise a ticket'
       END AS execution_status
FROM alloc_out"""

METRICS = """SELECT 'orders_raw' AS metric, CAST(count(*) AS BIGINT) AS value FROM fx_orders
UNION ALL SELECT 'orders_category_kept', CAST(count(*) AS BIGINT) FROM ztan
UNION ALL SELECT 'valid_orders', CAST(count(*) AS BIGINT) FROM valid
UNION ALL SELECT 'exceptions', CAST(count(*) AS BIGINT) FROM exc
UNION ALL SELECT 'stock_raw', CAST(count(*) AS BIGINT) FROM fx_stock
UNION ALL SELECT 'stock_profile_rows', CAST(count(*) AS BIGINT) FROM flags
UNION ALL SELECT 'stock_filtered', CAST(count(*) AS BIGINT) FROM tagged
UNION ALL SELECT 'allocation_output', CAST(count(*) AS BIGINT) FROM alloc_out
UNION ALL SELECT 'lines_without_stock', CAST(count(*) AS BIGINT) FROM alloc_out
          WHERE case_reason = 'Material not found in stock data. Drop line.'
UNION ALL SELECT 'feasibility', CAST(count(*) AS BIGINT) FROM alloc_out WHERE case_number = 'CASE_2'
UNION ALL SELECT 'tickets', CAST(count(*) AS BIGINT) FROM alloc_out
          WHERE case_number = 'CASE_2' AND requires_auth
UNION ALL SELECT 'execution_delivery', CAST(count(*) AS BIGINT) FROM alloc_out"""


def _count(frm: str, *keys: str) -> str:
    k = ", ".join(keys)
    return f"SELECT {k}, count(*) AS count FROM {frm} GROUP BY {k}"


ORACLE: dict[str, str] = {
    "allocated": with_ctes("SELECT * FROM allocated", "allocated"),
    "scan_csv_orders": with_ctes(f"SELECT {_nullif_text(ORDER_COLS, _ORDER_TEXT)} FROM fx_orders",
                                 "fx_orders"),
    "scan_csv_stock": with_ctes(f"SELECT {_nullif_text(_STOCK_COLS, _STOCK_TEXT)} FROM fx_stock",
                                "fx_stock"),
    "typed_orders": with_ctes(f"SELECT *, {TS} AS _ingestion_timestamp, 'fx_orders' AS _source_file "
                              "FROM fx_orders", "fx_orders"),
    "typed_stock": with_ctes(f"SELECT *, {TS} AS _ingestion_timestamp, 'fx_stock' AS _source_file "
                             "FROM fx_stock", "fx_stock"),
    "scan_mixed_headers": with_ctes(
        "SELECT " + _nullif_text(_STOCK_COLS, _STOCK_TEXT) + " FROM (SELECT * REPLACE (CASE WHEN plant = 'P1' THEN available_stock_qty END AS "
        "available_stock_qty, CASE WHEN plant = 'P1' THEN palletization_indicator END AS palletization_indicator) FROM fx_stock)", "fx_stock"),
    "scan_multiline_split": with_ctes(
        f"SELECT {_nullif_text(ORDER_COLS, _ORDER_TEXT)} FROM (SELECT * REPLACE (material_description || chr(10) || '\"checked\", by hand' || chr(10) "
        "|| sales_order_number AS material_description) FROM fx_orders)", "fx_orders"),
    "quarantined_orders": with_ctes(
        f"SELECT sales_order_number, sales_order_line_item, 'order_quantity' AS fault_column, q AS fault_text FROM {FAULTY} WHERE {_BAD_Q} "
        f"UNION ALL SELECT sales_order_number, sales_order_line_item, 'required_delivery_date', d FROM {FAULTY} WHERE {_BAD_D}", "fx_orders"),
    "quarantine_counts": with_ctes(
        f"SELECT unnest(['read', 'good', 'bad']) AS kind, unnest([count(*), count(*) - count(*) FILTER (bad), count(*) FILTER (bad)]) AS lines "
        f"FROM (SELECT ({_BAD_Q}) OR ({_BAD_D}) AS bad FROM {FAULTY})", "fx_orders"),
    "sink_roundtrip": with_ctes("SELECT * FROM tagged", "tagged"),
    "catalog_roundtrip": with_ctes("SELECT * FROM tagged", "tagged"),
    "category_filter": with_ctes("SELECT * FROM ztan", "ztan"),
    "orders_clean": with_ctes("SELECT * FROM clean", "clean"),
    "valid_orders": with_ctes("SELECT * FROM valid", "valid"),
    "exceptions": with_ctes("SELECT * FROM exc", "exc"),
    "stock_normalised": with_ctes("SELECT * FROM stock_norm", "stock_norm"),
    "stock_by_location": with_ctes("SELECT * FROM by_loc", "by_loc"),
    "stock_pivot": with_ctes("SELECT * FROM profile", "profile"),
    "stock_attributes": with_ctes("SELECT * FROM attrs", "attrs"),
    "stock_flags": with_ctes("SELECT * FROM flags", "flags"),
    "stock_with_stock": with_ctes("SELECT * FROM with_stock", "with_stock"),
    "stock_tagged": with_ctes("SELECT * FROM tagged", "tagged"),
    "customer_group": with_ctes("SELECT sales_order_number, sales_order_line_item, customer_name, "
                                "customer_group FROM enriched", "enriched"),
    "pallet_rule": with_ctes("SELECT sales_order_number, sales_order_line_item, sold_to_party, "
                             "pallet_rule FROM enriched", "enriched"),
    "orders_enriched": with_ctes("SELECT * FROM enriched", "enriched"),
    "orders_stock_join": with_ctes("SELECT * FROM joined", "joined"),
    "orders_without_stock": with_ctes(
        "SELECT * FROM enriched e WHERE NOT EXISTS (SELECT 1 FROM tagged s "
        "WHERE s.material_number = e.material_number)", "enriched"),
    "orders_with_stock": with_ctes("SELECT * FROM joined WHERE total_stock IS NOT NULL", "joined"),
    "allocated_by_rule_tables": with_ctes("SELECT * FROM allocated", "allocated"),
    "stock_open_locations": with_ctes(
        "SELECT s.material_number, s.plant, s.total_stock, s.available_locations_count, s.available_locations_list, "
        "b.location, b.quantity, b.quantity > 0 AS has_stock FROM open_stock s JOIN open_by_loc b "
        "ON s.material_number = b.material_number AND s.plant = b.plant", "open_stock"),
    "allocated_open_locations": with_ctes(
        "SELECT sales_order_number, sales_order_line_item, material_number, plant, customer_group, pallet_rule, order_quantity, "
        "coalesce(s12, 0.0) AS stock_PT12, coalesce(s11, 0.0) AS stock_PT11, coalesce(s15, 0.0) AS stock_PT15, "
        "coalesce(total_stock, 0.0) AS total_stock, coalesce(available_locations_count, 0) AS available_locations_count, "
        "coalesce(available_locations_list, '') AS available_locations_list, hit AS allocated_location, requires_auth, "
        "CASE WHEN hit IS NULL THEN 'CASE_3' WHEN hit = 'PT12' THEN 'CASE_1' ELSE 'CASE_2' END AS case_number, "
        "CASE WHEN total_stock IS NULL THEN 'Material not found in stock data. Drop line.' "
        "WHEN hit IS NULL THEN 'No location (including starting location PT12) has sufficient stock. Drop line / requeue.' "
        "WHEN hit = 'PT12' THEN 'Order already at PT12 and stock is sufficient. Auto-confirm, no change.' "
        "ELSE 'Starting location PT12 short on stock. Reallocated to ' || hit || '. Auth required: ' "
        "|| CASE WHEN requires_auth THEN 'True' ELSE 'False' END || '. PEGA ticket to be raised.' END AS case_reason, "
        "coalesce(hit <> 'PT12', FALSE) AS location_changed FROM open_alloc", "open_alloc"),
    "not_in_stock": with_ctes("SELECT * FROM allocated WHERE case_reason = "
                              "'Material not found in stock data. Drop line.'", "allocated"),
    "actions": with_ctes("SELECT * FROM actions", "actions"),
    "exceptions_gold": with_ctes("SELECT * FROM exc_gold", "exc_gold"),
    "allocation_output": with_ctes("SELECT * FROM alloc_out", "alloc_out"),
    "feasibility": with_ctes(FEASIBILITY, "alloc_out"),
    "tickets": with_ctes(TICKETS, "alloc_out"),
    "tickets_carried": with_ctes(TICKETS.replace(
        "ORDER BY sales_order_number", "ORDER BY coalesce(customer_group = 'Walmart', TRUE), sales_order_number", 1), "alloc_out"),
    "execution_delivery": with_ctes(EXECUTION, "alloc_out"),
    "summary_location_count": with_ctes(_count("tagged", "available_locations_count"), "tagged"),
    "summary_exceptions": with_ctes(_count("exc", "exception_reason"), "exc"),
    "summary_customer_group": with_ctes(_count("enriched", "customer_group"), "enriched"),
    "summary_case": with_ctes(_count("allocated", "case_number"), "allocated"),
    "summary_dashboard": with_ctes(_count("alloc_out", "case_number", "dashboard_status"),
                                   "alloc_out"),
    "pipeline_metrics": with_ctes(METRICS, "alloc_out"),
    "preview_orders": with_ctes(
        f"SELECT *, {TS} AS _ingestion_timestamp, 'fx_orders' AS _source_file FROM fx_orders "
        "ORDER BY sales_order_number, sales_order_line_item LIMIT 5", "fx_orders"),
}
