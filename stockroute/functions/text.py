"""Text column functions (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..rules import DEFAULT_RULES, Rules
from ..schemas import FULL_PALLET_ONLY, INCOMPLETE_OK, PY_WHITESPACE


def blank_to_null(c: Column) -> Column:
    """Null when the text is empty after trimming spaces; otherwise the
    original, untrimmed text."""
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def strip_unicode(c: Column) -> Column:
    """Remove every Unicode white-space character from both ends, as Python's
    ``str.strip()`` does (SQL ``trim`` removes spaces only)."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def customer_group(name: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """Customer name -> customer group: strip, upper-case, look up the alias;
    unknown and null names fall back to the default group."""
    key = F.upper(strip_unicode(name))
    expr = None
    for alias, group in rules.customer_alias.items():
        expr = (F.when(key == alias, F.lit(group)) if expr is None
                else expr.when(key == alias, F.lit(group)))
    if expr is None:
        return F.lit(rules.default_group)
    return expr.otherwise(F.lit(rules.default_group))


def pallet_rule(sold_to_party: Column, rules: Rules = DEFAULT_RULES) -> Column:
    """FULL_PALLET_ONLY for the listed sold-to parties, INCOMPLETE_OK else
    (null included)."""
    party = F.coalesce(sold_to_party.cast("string"), F.lit(""))
    return (F.when(party.isin(*rules.full_pallet_parties), F.lit(FULL_PALLET_ONLY))
            .otherwise(F.lit(INCOMPLETE_OK)))
