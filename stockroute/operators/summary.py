"""Summary counts. Every one is a grouped count with map-side partial
aggregation, so only one row per key and map task crosses the network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CASE_2, REASON_NOT_IN_STOCK


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def location_count_summary(stock_tagged: DataFrame) -> DataFrame:
    return count_by(stock_tagged, "available_locations_count").orderBy("available_locations_count")


def exception_summary(exceptions: DataFrame) -> DataFrame:
    return count_by(exceptions, "exception_reason").orderBy(F.desc("count"), "exception_reason")


def customer_group_summary(enriched: DataFrame) -> DataFrame:
    return count_by(enriched, "customer_group").orderBy("customer_group")


def case_summary(allocated: DataFrame) -> DataFrame:
    return count_by(allocated, "case_number").orderBy("case_number")


def dashboard_summary(output: DataFrame) -> DataFrame:
    return count_by(output, "case_number", "dashboard_status").orderBy("case_number",
                                                                       "dashboard_status")


def _metrics(df: DataFrame, **counts) -> DataFrame:
    """One aggregate pass -> long rows (metric, value)."""
    wide = df.agg(*[F.count_if(c).alias(name) if c is not None
                    else F.count(F.lit(1)).alias(name) for name, c in counts.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in counts)
    return wide.selectExpr(f"stack({len(counts)}, {stack}) AS (metric, value)")


def pipeline_metrics(orders: DataFrame, stock: DataFrame, profile_flags: DataFrame,
                     output: DataFrame, *, category_kept, valid_cond) -> DataFrame:
    """The stage and table row counts as (metric, value) rows, one aggregate
    pass per input."""
    kept = category_kept
    case = F.col("case_number")
    return (_metrics(orders, orders_raw=None, orders_category_kept=kept,
                     valid_orders=kept & valid_cond, exceptions=kept & ~valid_cond)
            .unionByName(_metrics(stock, stock_raw=None))
            .unionByName(_metrics(profile_flags, stock_profile_rows=None,
                                  stock_filtered=F.col("total_stock") > 0))
            .unionByName(_metrics(output, allocation_output=None,
                                  lines_without_stock=F.col("case_reason") == REASON_NOT_IN_STOCK,
                                  feasibility=case == CASE_2,
                                  tickets=(case == CASE_2) & F.col("requires_auth"),
                                  execution_delivery=None)))
