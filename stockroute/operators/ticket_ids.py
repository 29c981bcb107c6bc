"""Ticket ids that survive reruns.

A register keeps (line key, copy, number) of every ticket given out. A run looks its
lines up there: known ones keep their number, new ones are numbered in ticket order
after the largest, and are appended. Lines alike in all key columns are copies 1,
2, ... of one key, so their order does not matter; a key's copies are counted with
partial aggregation, and spread over tasks by their copy number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .products import TICKET_ORDER
from .sequence import row_number

COPY, NUMBER = "line_copy", "ticket_number"
REGISTER_SCHEMA = T.StructType([*[T.StructField(c, T.StringType()) for c in TICKET_ORDER],
                                T.StructField(COPY, T.LongType()), T.StructField(NUMBER, T.LongType())])


def empty_register(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTER_SCHEMA)


def copies(candidates: DataFrame) -> DataFrame:
    """The candidates as key columns (as text) and copy number from 1."""
    return (candidates.groupBy(*[F.col(c).cast("string").alias(c) for c in TICKET_ORDER]).agg(F.count(F.lit(1)).alias("_n"))
            .withColumn(COPY, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).drop("_n"))


def _same(left: str, right: str):
    cond = F.col(f"{left}.{COPY}") == F.col(f"{right}.{COPY}")
    for c in TICKET_ORDER:
        cond = cond & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return cond


def new_entries(candidates: DataFrame, register: DataFrame, partitions: int | None = None) -> DataFrame:
    """Register rows of the lines that ``register`` lacks, numbered from its largest
    number + 1 (from 0 if it is empty) in ticket order. One number reaches the
    driver. The result is to be appended to the register."""
    top = register.agg(F.max(NUMBER)).first()[0]
    fresh = copies(candidates).alias("c").join(register.alias("r"), _same("c", "r"), "left_anti")
    numbered = row_number(fresh, [*TICKET_ORDER, COPY], output="_ticket_seq", partitions=partitions)
    start = 0 if top is None else top + 1
    return numbered.select(*TICKET_ORDER, COPY, (F.col("_ticket_seq") - 1 + F.lit(start)).cast("long").alias(NUMBER))


def numbered(candidates: DataFrame, register: DataFrame) -> DataFrame:
    """The lines (key columns and copy) with their numbers from a register that knows
    them all. Lines that are gone keep their numbers in the register alone."""
    return copies(candidates).alias("c").join(register.alias("r"), _same("c", "r")).select("c.*", f"r.{NUMBER}")
