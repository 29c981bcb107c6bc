"""Broadcast hints behind a check of the measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Small tables up to this many bytes (as JSON text) are broadcast.
BROADCAST_BYTES = 8 << 20


def sized(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows have at most ``limit`` bytes;
    otherwise the join's strategy is Spark's choice."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 16), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= limit else df
