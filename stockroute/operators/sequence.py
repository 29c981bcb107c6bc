"""Dense, repeatable row numbers without a single-task window.

Rows are dealt to contiguous key ranges with ``repartitionByRange``, stored with
the number of their range, numbered inside each range, and shifted by the rows
of earlier ranges. The stored table fixes the ranges, so the numbers do not
depend on what is recomputed later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_RANGE = "_seq_range"


def row_number(df: DataFrame, order_by, *, output: str = "row_number",
               partitions: int | None = None) -> DataFrame:
    """``df`` plus ``output`` = 1-based row number in ``order_by`` order
    (ascending, nulls first). The key should be unique for the numbers to be
    repeatable. ``partitions`` (default: the session's shuffle partitions) sets
    the number of ranges and so what one task sorts; it follows the data's size
    as the cluster sets it, without a cap.

    Runs two jobs when called: sampling the range bounds and storing ``df``, so
    pass only the columns that are needed."""
    spark = df.sparkSession
    order_by = list(order_by)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranges")
    (df.repartitionByRange(n, *order_by).withColumn(_RANGE, F.spark_partition_id())
     .write.parquet(path))
    stored = spark.read.parquet(path)
    # One row per range: at most n rows, whatever the input size.
    earlier = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    shift = (stored.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("_n"))
             .select(_RANGE, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift")))
    place = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order_by))
    return (stored.withColumn("_place", place).join(F.broadcast(shift), _RANGE)
            .withColumn(output, F.col("_place") + F.col("_shift")).drop(_RANGE, "_place", "_shift"))
