"""Actions and statuses, exception rows, and the combined allocation table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..rules import DEFAULT_RULES, Rules
from ..schemas import ALLOCATION_OUTPUT_COLUMNS, EXCEPTION, NOT_APPLICABLE_GROUP, STOCK_MAP
from . import allocate as al


def allocate_with_actions(joined: DataFrame, run_ts: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Allocated lines with the ERP action, ticket need and type, approval and
    dashboard status of their outcome."""
    return (al.allocate(joined, rules, al.ALLOCATION_COLUMNS + al.STATUS_COLUMNS)
            .withColumn("_processed_timestamp", F.lit(run_ts)))


def align_columns(df: DataFrame, columns=ALLOCATION_OUTPUT_COLUMNS,
                  schema: T.StructType | None = None) -> DataFrame:
    """Select ``columns`` in order; absent ones become typed nulls (string
    unless ``schema`` names a type)."""
    types = {f.name: f.dataType for f in schema.fields} if schema else {}
    return df.select(*[F.col(c) if c in df.columns
                       else F.lit(None).cast(types.get(c, T.StringType())).alias(c)
                       for c in columns])


def exceptions_to_output(exceptions: DataFrame, run_ts: str, schema: T.StructType) -> DataFrame:
    """Exception lines in the layout ``schema``: stated are the columns that have
    a value (the start location is the line's own storage location), all others
    are typed nulls."""
    stated = {"customer_group": NOT_APPLICABLE_GROUP, "pallet_rule": NOT_APPLICABLE_GROUP,
              "requires_auth": False, "location_changed": False, "case_number": EXCEPTION,
              "_processed_timestamp": run_ts} | al.status_values(EXCEPTION, False)
    named = exceptions.withColumns({k: F.lit(v) for k, v in stated.items() if v is not None}
                                   | {"starting_location": F.col("storage_location"),
                                      "case_reason": F.col("exception_reason")})
    return align_columns(named, schema.names, schema)


def allocation_output(actions: DataFrame, exceptions: DataFrame, run_ts: str) -> DataFrame:
    """Allocated lines UNION ALL exception lines, 41 columns (and the stock map if
    the lines carry it). Exceptions bypass the stock join."""
    left = align_columns(actions, ALLOCATION_OUTPUT_COLUMNS + ((STOCK_MAP,) if STOCK_MAP in actions.columns else ()))
    return left.unionByName(exceptions_to_output(exceptions, run_ts, left.schema))
