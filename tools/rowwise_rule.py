"""An independent row-at-a-time statement of the allocation rule, in plain
Python floats. Used by the tests as a brute-force oracle over a value grid and
by the benchmark as the Python-UDF comparison point."""

from __future__ import annotations

import math

from stockroute.rules import DEFAULT_RULES, Rules
from stockroute.schemas import (CASE_1, CASE_2, CASE_3, FULL_PALLET_ONLY, REASON_CASE_1,
                                REASON_CASE_2, REASON_CASE_3, REASON_NOT_IN_STOCK)


def _as_float(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def decide(group, qty, stocks: dict, has: dict, pallet_rule, packaging_unit, found=True,
           rules: Rules = DEFAULT_RULES, start=None):
    """-> (allocated_location, requires_auth, case_number, case_reason, location_changed)."""
    start = start if start in rules.locations else rules.start_location
    if not found:
        return None, False, CASE_3, REASON_NOT_IN_STOCK, False
    need = 0.0 if qty is None else float(qty)
    size = _as_float(packaging_unit) if packaging_unit else None
    whole = pallet_rule == FULL_PALLET_ONLY and size is not None and size > 0

    def can(loc):
        s = stocks.get(loc)
        s = 0.0 if s is None else float(s)
        if not has.get(loc):
            return False
        if whole:
            return s >= need and math.fmod(need, size) == 0
        return s >= need

    for i, loc in enumerate(rules.search_order(group, start)):
        if can(loc):
            if i == 0:
                return loc, False, CASE_1, REASON_CASE_1.format(start=start), False
            auth = rules.needs_auth(group, loc)
            return (loc, auth, CASE_2,
                    REASON_CASE_2.format(start=start, loc=loc, auth=str(auth)), True)
    return None, False, CASE_3, REASON_CASE_3.format(start=start), False
