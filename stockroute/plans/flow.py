"""The allocation flow as one lazily built chain of DataFrames.

``Flow`` wires the operators together once; each attribute is a DataFrame of
the chain, built on first use. Nothing runs until an action, except that
building ``tickets`` stores the ticket lines for their numbering: Catalyst sees
the whole plan from the scans to each product and prunes and pushes down
across operator boundaries. ``plans.pipeline`` runs the same flow stage by
stage with stored tables in between.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import allocate as al
from ..operators import enrich, output, products, rule_tables, stock, summary, validate
from ..rules import DEFAULT_RULES, Rules, rule_frames
from ..schemas import CATEGORY_KEPT
from ..sources.csv import with_audit
from . import fixtures

# A fixed run time for repeatable query results (pipelines pass their own).
QUERY_RUN_TS = "2024-06-30T00:00:00"


class Flow:
    """``orders`` and ``stock_rows`` are typed input frames, or zero-argument
    callables returning them (built on first use)."""

    def __init__(self, orders, stock_rows, run_ts: str = QUERY_RUN_TS,
                 rules: Rules = DEFAULT_RULES, *, ignore_blocked_closed: bool = False,
                 ticket_partitions: int | None = None):
        self._orders = orders
        self._stock_rows = stock_rows
        self.run_ts = run_ts
        self.rules = rules
        self.ignore_blocked_closed = ignore_blocked_closed
        self.ticket_partitions = ticket_partitions

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, **kw) -> "Flow":
        return cls(lambda: fixtures.fx_orders(spark, sf_dir),
                   lambda: fixtures.fx_stock(spark, sf_dir), **kw)

    @cached_property
    def orders(self) -> DataFrame:
        return self._orders() if callable(self._orders) else self._orders

    @cached_property
    def stock_rows(self) -> DataFrame:
        return self._stock_rows() if callable(self._stock_rows) else self._stock_rows

    # ---- raw ----
    @cached_property
    def orders_raw(self) -> DataFrame:
        return with_audit(self.orders, self.run_ts, "fx_orders")

    @cached_property
    def stock_raw(self) -> DataFrame:
        return with_audit(self.stock_rows, self.run_ts, "fx_stock")

    # ---- order validation ----
    @cached_property
    def category_kept(self) -> DataFrame:
        return validate.keep_category(self.orders, CATEGORY_KEPT)

    @cached_property
    def orders_clean(self) -> DataFrame:
        return validate.prepare_orders(self.orders, ignore_blocked_closed=self.ignore_blocked_closed)

    @cached_property
    def valid_orders(self) -> DataFrame:
        return validate.valid_orders(self.orders_clean, self.run_ts)

    @cached_property
    def exceptions(self) -> DataFrame:
        return validate.exceptions(self.orders_clean, self.run_ts)

    # ---- stock ----
    @cached_property
    def stock_normalised(self) -> DataFrame:
        return stock.normalise_stock(self.stock_rows, self.rules)

    @cached_property
    def stock_by_location(self) -> DataFrame:
        return stock.stock_by_location(self.stock_normalised)

    @cached_property
    def stock_profile(self) -> DataFrame:
        return stock.stock_profile(self.stock_normalised, self.rules)

    @cached_property
    def stock_flags(self) -> DataFrame:
        return stock.flag_stock(self.stock_profile, self.rules)

    @cached_property
    def stock_with_stock(self) -> DataFrame:
        return stock.drop_zero_stock(self.stock_flags)

    @cached_property
    def stock_filtered(self) -> DataFrame:
        return stock.tag_availability(self.stock_with_stock, self.run_ts, self.rules)

    # ---- allocation ----
    @cached_property
    def orders_enriched(self) -> DataFrame:
        return enrich.enrich_orders(self.valid_orders, self.rules)

    @cached_property
    def orders_stock_join(self) -> DataFrame:
        return al.join_stock(self.orders_enriched, self.stock_filtered)

    @cached_property
    def orders_without_stock(self) -> DataFrame:
        keys = self.stock_filtered.select("material_number")
        return self.orders_enriched.join(keys, on="material_number", how="left_anti")

    @cached_property
    def orders_with_stock(self) -> DataFrame:
        right = self.stock_filtered.select(*al.STOCK_JOIN_COLUMNS)
        return self.orders_enriched.join(right, on="material_number", how="inner")

    @cached_property
    def allocated(self) -> DataFrame:
        return al.allocate(self.orders_stock_join, self.rules)

    @cached_property
    def actions(self) -> DataFrame:
        return output.allocate_with_actions(self.orders_stock_join, self.run_ts, self.rules)

    @cached_property
    def exceptions_out(self) -> DataFrame:
        return output.exceptions_to_output(self.exceptions, self.run_ts,
                                           output.align_columns(self.actions).schema)

    @cached_property
    def allocation_output(self) -> DataFrame:
        return output.allocation_output(self.actions, self.exceptions, self.run_ts)

    # ---- products ----
    @cached_property
    def feasibility(self) -> DataFrame:
        return products.feasibility(self.allocation_output, self.rules.locations)

    @cached_property
    def tickets(self) -> DataFrame:
        return products.tickets(self.allocation_output, self.run_ts, self.ticket_partitions)

    @cached_property
    def execution_delivery(self) -> DataFrame:
        return products.execution_delivery(self.allocation_output, self.run_ts)

    # ---- summaries ----
    def metrics(self) -> DataFrame:
        cleaned = validate.clean_blanks(self.orders)
        kept = F.upper(F.trim(F.col("item_category"))) == CATEGORY_KEPT
        return summary.pipeline_metrics(cleaned, self.stock_rows, self.stock_flags,
                                        self.allocation_output, category_kept=kept,
                                        valid_cond=validate.valid_condition())


class TableFlow(Flow):
    """The flow with its rules as tables: ``frames``, by default those of ``rules``."""

    frames: rule_tables.Frames | None = None

    @cached_property
    def rule_tables(self) -> rule_tables.Frames:
        return self.frames or rule_frames(self.orders.sparkSession, self.rules)

    @cached_property
    def stock_filtered(self) -> DataFrame:
        return rule_tables.stock_filtered(self.stock_rows, self.run_ts, self.rule_tables)

    @cached_property
    def orders_enriched(self) -> DataFrame:
        return rule_tables.enrich_orders(self.valid_orders, self.rule_tables, self.rules)

    @cached_property
    def orders_stock_join(self) -> DataFrame:
        return rule_tables.join_stock(self.orders_enriched, self.stock_filtered)

    @cached_property
    def allocated(self) -> DataFrame:
        return rule_tables.allocate(self.orders_stock_join, self.rule_tables, self.rules)

    @cached_property
    def actions(self) -> DataFrame:
        return rule_tables.allocate_with_actions(self.orders_stock_join, self.run_ts, self.rule_tables, self.rules)
