"""Registered queries: one per operator of the inventory.

Each query takes ``(spark, sf_dir)``, derives the order and stock inputs from
the whole driver tables in ``sf_dir`` and returns a DataFrame; no data is
collected. The CSV, sink and ticket queries store their intermediate files in
the shared folder when they are built. Column names equal those of the oracle SQL in ``plans.oracle``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import products, summary, ticket_ids
from ..rules import LOCATIONS, PRIORITY, REQUIRES_AUTH, Rules
from ..schemas import (ORDER_HEADERS, ORDERS_REQUIRED, ORDERS_SCHEMA, REASON_NOT_IN_STOCK, STOCK_HEADERS, STOCK_MAP,
                       STOCK_REQUIRED, STOCK_SCHEMA)
from ..session import scratch_path
from ..sources import csv as csv_source
from ..sources import csv_split
from ..sources.tables import ensure_database, read_table, write_split, write_table
from . import fixtures
from .flow import QUERY_RUN_TS, Flow, TableFlow

Query = Callable[[SparkSession, str], DataFrame]


def _flow(spark: SparkSession, sf_dir: str) -> Flow:
    return Flow.from_fixtures(spark, sf_dir)


def _attr(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_flow(spark, sf_dir), name)
    run.__name__ = name
    return run


def _as_export_text(df: DataFrame, header_map: dict[str, str]) -> DataFrame:
    """A typed frame as an extract would read: text columns named by header."""
    inverse = {v: k for k, v in header_map.items()}
    return df.select(*[F.col(c).cast("string").alias(inverse[c]) for c in df.columns])


def scan_csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract's first header starts with a byte-order mark, as exports do."""
    path = scratch_path(spark, "orders-csv")
    first, *others = ORDER_HEADERS.items()
    headers = {csv_source.BOM * 2 + first[0]: first[1], **dict(others)}
    csv_source.write_csv(fixtures.fx_orders(spark, sf_dir), path, headers)
    return csv_source.typed_orders(csv_source.read_csv(spark, path))


def scan_csv_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stock-csv")
    csv_source.write_csv(fixtures.fx_stock(spark, sf_dir), path, STOCK_HEADERS)
    return csv_source.typed_stock(csv_source.read_csv(spark, path))


def typed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _as_export_text(fixtures.fx_orders(spark, sf_dir), ORDER_HEADERS)
    return csv_source.with_audit(csv_source.typed_orders(text), QUERY_RUN_TS, "fx_orders")


def typed_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _as_export_text(fixtures.fx_stock(spark, sf_dir), STOCK_HEADERS)
    return csv_source.with_audit(csv_source.typed_stock(text), QUERY_RUN_TS, "fx_stock")


def scan_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock extracts of two plants in one directory: the second has its columns in
    another order and lacks two."""
    path = scratch_path(spark, "mixed-csv")
    stock = fixtures.fx_stock(spark, sf_dir)
    csv_source.write_csv(stock.where("plant = 'P1'"), f"{path}/first", STOCK_HEADERS)
    other = [c for c in reversed(stock.columns) if c not in ("available_stock_qty", "palletization_indicator")]
    csv_source.write_csv(stock.where("plant = 'P2'").select(*other), f"{path}/second", STOCK_HEADERS)
    mixed = csv_source.read_csv_mixed(spark, f"{path}/*", STOCK_HEADERS)
    return csv_source.apply_schema(mixed, STOCK_SCHEMA, STOCK_REQUIRED)


def scan_multiline_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order extracts whose descriptions hold line breaks, quotes and commas, read by
    byte ranges. They are stored with bzip2, the one codec whose files have such ranges."""
    path = scratch_path(spark, "split-csv")
    note = F.concat(F.col("material_description"), F.lit('\n"checked", by hand\n'), F.col("sales_order_number"))
    csv_source.write_csv(fixtures.fx_orders(spark, sf_dir).withColumn("material_description", note), path, ORDER_HEADERS,
                         compression="bzip2")
    return csv_source.typed_orders(csv_split.read_csv_split(spark, path))


def _labelled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order extracts some of whose numbers and dates are no such, read and labelled."""
    path = scratch_path(spark, "faulty-csv")
    line, quantity = F.col("sales_order_line_item"), F.col("order_quantity").cast("string")
    orders = fixtures.fx_orders(spark, sf_dir).withColumns({
        "order_quantity": F.when(line == "3", F.concat(F.lit("1,"), quantity)).when(line == "5", F.lit("n/a")).otherwise(quantity),
        "required_delivery_date": F.when(line.isin("4", "5"), F.lit("31.12.2024")).otherwise(F.col("required_delivery_date").cast("string"))})
    csv_source.write_csv(orders, path, ORDER_HEADERS)
    return csv_source.ingest_labelled(spark, path, QUERY_RUN_TS, ORDER_HEADERS, ORDERS_SCHEMA, ORDERS_REQUIRED)


def quarantined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells that do not type, a row for each, with their line's key."""
    bad = _labelled_orders(spark, sf_dir).where(F.col("row_status") == csv_source.BAD)
    return (bad.select("sales_order_number", "sales_order_line_item", F.explode("faults").alias("fault"))
            .select("sales_order_number", "sales_order_line_item", F.col("fault.column").alias("fault_column"),
                    F.col("fault.text").alias("fault_text")))


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, good and bad, after one write of both tables."""
    rows = _labelled_orders(spark, sf_dir)
    where, counts = write_split(rows, "row_status", {"good": csv_source.GOOD, "bad": csv_source.BAD}, "orders",
                                root=scratch_path(spark, "quarantine"), compression="zstd")
    stored = [spark.read.parquet(where[name]).select(F.lit(name).alias("kind")) for name in counts]
    kinds = stored[0].union(stored[1])
    return kinds.union(kinds.select(F.lit("read"))).groupBy("kind").agg(F.count("*").alias("lines"))


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the stock table to the shared scratch folder and scan it back."""
    root = scratch_path(spark, "sink")
    write_table(_flow(spark, sf_dir).stock_filtered, "stock_filtered", root=root)
    return read_table(spark, "stock_filtered", root=root)


def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the stock table to a database of the session catalog, twice (the
    second write replaces the first), and scan it back."""
    location = scratch_path(spark, "catalog")
    database = os.path.basename(location).replace("-", "_")
    ensure_database(spark, database, location)
    full = _flow(spark, sf_dir).stock_filtered
    write_table(full.limit(1).select("material_number"), "stock_filtered", database=database)
    write_table(full, "stock_filtered", database=database)
    return read_table(spark, "stock_filtered", database=database)


def customer_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flow(spark, sf_dir).orders_enriched.select(
        "sales_order_number", "sales_order_line_item", "customer_name", "customer_group")


def pallet_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flow(spark, sf_dir).orders_enriched.select(
        "sales_order_number", "sales_order_line_item", "sold_to_party", "pallet_rule")


def stock_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flow(spark, sf_dir).stock_profile.select(
        "material_number", "plant", "stock_timing_timestamp", "warehouse_type",
        "packaging_unit", "palletization_indicator")


def not_in_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid lines whose material has no stock row (forced CASE_3)."""
    return _flow(spark, sf_dir).allocated.filter(F.col("case_reason") == REASON_NOT_IN_STOCK)


#: A fourth location: second for one group, last for the others.
OPEN_RULES = Rules(
    locations=(*LOCATIONS, "XX99"),
    priority={g: ("PT12", "XX99", "PT11", "PT15") if g == "Walmart" else (*seq, "XX99") for g, seq in PRIORITY.items()},
    requires_auth=REQUIRES_AUTH | {"Walmart": REQUIRES_AUTH["Walmart"] | {"XX99": False}})
OPEN_COLUMNS = ("sales_order_number", "sales_order_line_item", "material_number", "plant", "customer_group", "pallet_rule",
                "order_quantity", "stock_PT12", "stock_PT11", "stock_PT15", "total_stock", "available_locations_count",
                "available_locations_list", "allocated_location", "requires_auth", "case_number", "case_reason", "location_changed")


def allocated_by_rule_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allocated lines with the shipped rules read from tables."""
    return TableFlow.from_fixtures(spark, sf_dir).allocated.drop(STOCK_MAP)


def stock_open_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock map of four locations, a row for each of its entries."""
    stock = TableFlow.from_fixtures(spark, sf_dir, rules=OPEN_RULES).stock_filtered
    return (stock.select("material_number", "plant", "total_stock", "available_locations_count", "available_locations_list",
                         F.explode(STOCK_MAP).alias("location", "entry"))
            .select("material_number", "plant", "total_stock", "available_locations_count", "available_locations_list",
                    "location", "entry.quantity", "entry.has_stock"))


def allocated_open_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The allocated lines with rules over four locations."""
    return TableFlow.from_fixtures(spark, sf_dir, rules=OPEN_RULES).allocated.select(*OPEN_COLUMNS)


def tickets_carried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one register: the first without the customers of one group, the
    second with all lines. The second run's tickets. The ticket lines are allocated
    and stored once."""
    root = scratch_path(spark, "register")
    output = _flow(spark, sf_dir).allocation_output
    write_table(products.ticket_candidates(output, "customer_group"), "candidates", root=root)
    stored = read_table(spark, "candidates", root=root)
    lines = stored.select(*products.TICKET_ORDER)
    first = stored.where("customer_group <> 'Walmart'").select(*products.TICKET_ORDER)
    write_table(ticket_ids.new_entries(first, ticket_ids.empty_register(spark)), "register", root=root)
    write_table(ticket_ids.new_entries(lines, read_table(spark, "register", root=root)), "register", root=root, append=True)
    known = ticket_ids.numbered(lines, read_table(spark, "register", root=root))
    return products.ticket_rows(known, F.col(ticket_ids.NUMBER), QUERY_RUN_TS)


def summary_location_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.location_count_summary(_flow(spark, sf_dir).stock_filtered)


def summary_exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.exception_summary(_flow(spark, sf_dir).exceptions)


def summary_customer_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.customer_group_summary(_flow(spark, sf_dir).orders_enriched)


def summary_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.case_summary(_flow(spark, sf_dir).allocated)


def summary_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.dashboard_summary(_flow(spark, sf_dir).allocation_output)


def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flow(spark, sf_dir).metrics()


def preview_orders(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    """The first ``n`` raw order lines by order and line number (a top-n)."""
    return (_flow(spark, sf_dir).orders_raw
            .orderBy("sales_order_number", "sales_order_line_item").limit(n))


QUERIES: dict[str, Query] = {
    "allocated": _attr("allocated"),
    "scan_csv_orders": scan_csv_orders,
    "scan_csv_stock": scan_csv_stock,
    "typed_orders": typed_orders,
    "typed_stock": typed_stock,
    "scan_mixed_headers": scan_mixed_headers,
    "scan_multiline_split": scan_multiline_split,
    "quarantined_orders": quarantined_orders,
    "quarantine_counts": quarantine_counts,
    "sink_roundtrip": sink_roundtrip,
    "catalog_roundtrip": catalog_roundtrip,
    "category_filter": _attr("category_kept"),
    "orders_clean": _attr("orders_clean"),
    "valid_orders": _attr("valid_orders"),
    "exceptions": _attr("exceptions"),
    "stock_normalised": _attr("stock_normalised"),
    "stock_by_location": _attr("stock_by_location"),
    "stock_pivot": _attr("stock_profile"),
    "stock_attributes": stock_attributes,
    "stock_flags": _attr("stock_flags"),
    "stock_with_stock": _attr("stock_with_stock"),
    "stock_tagged": _attr("stock_filtered"),
    "customer_group": customer_group,
    "pallet_rule": pallet_rule,
    "orders_enriched": _attr("orders_enriched"),
    "orders_stock_join": _attr("orders_stock_join"),
    "orders_without_stock": _attr("orders_without_stock"),
    "orders_with_stock": _attr("orders_with_stock"),
    "not_in_stock": not_in_stock,
    "actions": _attr("actions"),
    "exceptions_gold": _attr("exceptions_out"),
    "allocation_output": _attr("allocation_output"),
    "feasibility": _attr("feasibility"),
    "tickets": _attr("tickets"),
    "tickets_carried": tickets_carried,
    "execution_delivery": _attr("execution_delivery"),
    "allocated_by_rule_tables": allocated_by_rule_tables,
    "stock_open_locations": stock_open_locations,
    "allocated_open_locations": allocated_open_locations,
    "summary_location_count": summary_location_count,
    "summary_exceptions": summary_exceptions,
    "summary_customer_group": summary_customer_group,
    "summary_case": summary_case,
    "summary_dashboard": summary_dashboard,
    "pipeline_metrics": pipeline_metrics,
    "preview_orders": preview_orders,
}
