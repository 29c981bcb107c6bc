"""Order-line validation: category filter, blank cleaning, valid / exception split.

All steps are narrow (filter and projection): no shuffle. Both outputs are
filters of the same cleaned frame, with complementary conditions that are
never null, so every kept line lands in exactly one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import blank_to_null
from ..schemas import (CATEGORY_KEPT, EXCEPTION, REASON_BOTH, REASON_NOTE, REASON_REJECTION,
                       VALID)

CLEANED_COLUMNS = ("delivery_note", "reason_for_rejection", "blocking_indicator")


def keep_category(orders: DataFrame, category: str = CATEGORY_KEPT) -> DataFrame:
    """Keep lines whose trimmed, upper-cased item category equals ``category``;
    null and any other category are dropped."""
    return orders.filter(F.upper(F.trim(F.col("item_category"))) == F.lit(category))


def clean_blanks(orders: DataFrame, columns=CLEANED_COLUMNS) -> DataFrame:
    """Blank and space-only text -> null, in place."""
    present = [c for c in columns if c in orders.columns]
    return orders.withColumns({c: blank_to_null(F.col(c)) for c in present})


def drop_blocked_closed(orders: DataFrame) -> DataFrame:
    """Optional: drop blocked lines and closed orders (stated in the process
    description, not applied by default)."""
    return orders.filter(F.col("blocking_indicator").isNull()
                         & ~F.coalesce(F.col("order_status") == "Closed", F.lit(False)))


def valid_condition() -> Column:
    return F.col("delivery_note").isNull() & F.col("reason_for_rejection").isNull()


def valid_orders(clean: DataFrame, run_ts: str) -> DataFrame:
    return (clean.filter(valid_condition())
            .withColumns({"validation_status": F.lit(VALID),
                          "exception_reason": F.lit(None).cast("string"),
                          "_processed_timestamp": F.lit(run_ts)}))


def exception_reason() -> Column:
    note = F.col("delivery_note").isNotNull()
    rejection = F.col("reason_for_rejection").isNotNull()
    return (F.when(note & rejection, F.lit(REASON_BOTH))
            .when(note, F.lit(REASON_NOTE))
            .otherwise(F.lit(REASON_REJECTION)))


def exceptions(clean: DataFrame, run_ts: str) -> DataFrame:
    return (clean.filter(~valid_condition())
            .withColumns({"validation_status": F.lit(EXCEPTION),
                          "exception_reason": exception_reason(),
                          "_processed_timestamp": F.lit(run_ts)}))


def label_orders(clean: DataFrame, run_ts: str) -> DataFrame:
    """Both outputs in one frame: every cleaned line with its validation
    status and reason, for a single pass over the raw lines (the valid lines
    and the exceptions are then its two ``validation_status`` values)."""
    ok = valid_condition()
    return clean.withColumns({
        "validation_status": F.when(ok, F.lit(VALID)).otherwise(F.lit(EXCEPTION)),
        "exception_reason": F.when(ok, F.lit(None).cast("string")).otherwise(exception_reason()),
        "_processed_timestamp": F.lit(run_ts),
    })


def prepare_orders(orders: DataFrame, *, category: str = CATEGORY_KEPT,
                   ignore_blocked_closed: bool = False) -> DataFrame:
    """Category filter and blank cleaning: the frame both outputs come from."""
    clean = clean_blanks(keep_category(orders, category))
    if ignore_blocked_closed:
        clean = drop_blocked_closed(clean)
    return clean


def validate(orders: DataFrame, run_ts: str, **options) -> tuple[DataFrame, DataFrame]:
    """(valid_orders, exceptions) from typed order lines."""
    clean = prepare_orders(orders, **options)
    return valid_orders(clean, run_ts), exceptions(clean, run_ts)
