"""Stock join and the allocation rule.

The rule (the line's start location first, then the customer group's priority list; a
location serves a line when it has stock, the stock covers the quantity and,
for full-pallet customers with a valid pallet size, the quantity is a whole
number of pallets) is compiled from ``Rules`` into one CASE expression whose
branches are literal outcome structs. Lines are independent, so allocation is
a row-local projection fused into the join's codegen stage: no Python worker,
no extra shuffle.

Lines whose material has no stock row are handled by the same left join
(``total_stock`` null) instead of a second join and a union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_number, is_whole_multiple, lenient_double, py_ge
from ..rules import DEFAULT_RULES, Rules
from ..schemas import (CASE_1, CASE_2, CASE_3, FULL_PALLET_ONLY, OUTCOME_STATUS, REASON_CASE_1,
                       REASON_CASE_2, REASON_CASE_3, REASON_NOT_IN_STOCK, STOCK_JOIN_COLUMNS)
from .stock import has_col, stock_col

ALLOCATION_COLUMNS = ("allocated_location", "requires_auth", "case_number", "case_reason",
                      "location_changed")
STATUS_COLUMNS = tuple(OUTCOME_STATUS)


def join_stock(enriched: DataFrame, stock: DataFrame, columns: tuple[str, ...] = STOCK_JOIN_COLUMNS) -> DataFrame:
    """Order lines LEFT JOIN the stock profile on material number: one row per
    matching plant, the line alone when nothing matches.

    The strategy is Spark's: a small stored stock table is broadcast by its
    file size, otherwise AQE decides from the shuffled sizes and splits hot
    materials. Lines without a material get spread keys that match nothing, so
    they do not meet in one task."""
    spread = F.concat(F.lit("\x00"), F.xxhash64("sales_order_number", "sales_order_line_item"))
    known = F.col("material_number").isNotNull()
    right = stock.select(*columns).withColumnRenamed("material_number", "_stock_key")
    lines = enriched.withColumn("_line_key", F.coalesce("material_number", spread))
    return (lines.join(right, (F.col("_line_key") == F.col("_stock_key")) & known, "left")
            .drop("_line_key", "_stock_key"))


_QTY, _PALLET_OK = "_alloc_qty", "_alloc_pallet_ok"


def quantity() -> Column:
    """The quantity to serve; a missing order quantity counts as zero."""
    return F.coalesce(F.col("order_quantity"), F.lit(0.0))


def pallet_ok(qty: Column) -> Column:
    """True unless the line is full-pallet-only with a positive, parseable
    pallet size that the quantity is not a whole multiple of. It does not
    depend on the location, so it is computed once per line."""
    size = lenient_double(F.col("packaging_unit"))
    applies = ((F.col("pallet_rule") == FULL_PALLET_ONLY) & is_number(size) & (size > 0))
    return F.when(applies, is_whole_multiple(qty, size)).otherwise(F.lit(True))


def serves(loc: str) -> Column:
    """Can location ``loc`` serve the line? (Python float semantics: NaN
    stock or quantity never qualifies.) Uses the per-line quantity and
    pallet columns added by ``allocate``."""
    qty = F.col(_QTY)
    stock = F.col(stock_col(loc))
    return (F.coalesce(F.col(has_col(loc)), F.lit(False))
            & py_ge(stock, qty) & F.col(_PALLET_OK))


def status_values(case: str, auth: bool) -> dict:
    """The statuses that follow from a case, for use in literals."""
    return {name: values.get((case, auth)) for name, values in OUTCOME_STATUS.items()}


def _outcome(location, auth: bool, case: str, reason: str) -> Column:
    """A literal struct with everything that a line's outcome decides."""
    fields = {"allocated_location": location, "requires_auth": auth, "case_number": case,
              "case_reason": reason, "location_changed": case == CASE_2} | status_values(case, auth)
    return F.struct(*[F.lit(v).cast("boolean" if isinstance(v, bool) else "string").alias(k)
                      for k, v in fields.items()])


def rule_profiles(rules: Rules = DEFAULT_RULES, start: str | None = None
                  ) -> list[tuple[list[str], list[tuple[str, bool]]]]:
    """Groups that share a fallback list and approval flags, with that list:
    [(groups, [(location, needs_auth), ...]), ...]; the default group last."""
    profiles: dict[tuple, list[str]] = {}
    for g in rules.groups():
        fallback = tuple((loc, rules.needs_auth(g, loc)) for loc in rules.search_order(g, start)[1:])
        profiles.setdefault(fallback, []).append(g)
    out = [(groups, list(fb)) for fb, groups in profiles.items()]
    out.sort(key=lambda p: rules.default_group in p[0])
    return out


def _case(branches: list[tuple[Column, Column]], otherwise: Column) -> Column:
    for cond, value in reversed(branches):
        otherwise = F.when(cond, value).otherwise(otherwise)
    return otherwise


def _from_start(start: str, rules: Rules) -> Column:
    """The rule for lines that start at ``start``: that location, then one
    fallback CASE per rule profile."""
    short = _outcome(None, False, CASE_3, REASON_CASE_3.format(start=start))

    def fallback(steps):
        return _case([(serves(loc), _outcome(loc, auth, CASE_2, REASON_CASE_2.format(
            start=start, loc=loc, auth=str(bool(auth))))) for loc, auth in steps], short)

    *others, (_, default) = rule_profiles(rules, start)
    by_group = _case([(F.col("customer_group").isin(*groups), fallback(steps)) for groups, steps in others],
                     fallback(default))
    return _case([(serves(start), _outcome(start, False, CASE_1, REASON_CASE_1.format(start=start)))], by_group)


def allocation(rules: Rules = DEFAULT_RULES) -> Column:
    """The whole rule as one CASE over literal outcome structs: by the line's
    starting location (unknown ones count as the default), then by group.
    Approval flags, texts and statuses are resolved when the plan is built, so
    each row evaluates at most a few comparisons."""
    others = [(F.col("starting_location") == loc, _from_start(loc, rules))
              for loc in rules.locations if loc != rules.start_location]
    missing = _outcome(None, False, CASE_3, REASON_NOT_IN_STOCK)
    return _case([(F.col("total_stock").isNull(), missing), *others], _from_start(rules.start_location, rules))


def allocate(joined: DataFrame, rules: Rules = DEFAULT_RULES,
             columns: tuple[str, ...] = ALLOCATION_COLUMNS) -> DataFrame:
    """Add the outcome's ``columns`` (by default allocated_location,
    requires_auth, case_number, case_reason and location_changed); lines without
    stock get CASE_3 and zeroed stock."""
    miss = F.col("total_stock").isNull()
    # Per-line inputs of the rule, computed once (a CASE branch cannot share
    # subexpressions with other branches).
    out = joined.withColumns({_QTY: quantity()})
    out = out.withColumns({_PALLET_OK: pallet_ok(F.col(_QTY))})
    out = out.withColumn("_alloc", allocation(rules))
    out = out.withColumns({c: F.col("_alloc")[c] for c in columns})
    # Lines without any stock row: zero stock, no flags, no attributes.
    zeroed = {stock_col(n): F.lit(0.0) for n in rules.locations}
    zeroed.update({has_col(n): F.lit(False) for n in rules.locations})
    zeroed.update({"available_locations_count": F.lit(0),
                   "available_locations_list": F.lit(""),
                   "total_stock": F.lit(0.0)})
    nulls = ("warehouse_type", "packaging_unit", "palletization_indicator", "plant")
    fixes = {c: F.when(miss, v).otherwise(F.col(c)) for c, v in zeroed.items()}
    fixes.update({c: F.when(~miss, F.col(c)) for c in nulls})
    return out.withColumns(fixes).drop("_alloc", _QTY, _PALLET_OK)
