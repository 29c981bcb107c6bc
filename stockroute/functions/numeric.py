"""Numeric column functions with Python-style NaN and parse semantics.

Spark orders NaN above every number (``NaN >= x`` is true), while the rule
being reproduced compares Python floats, where any comparison with NaN is
false. These helpers make the difference explicit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_unicode

# What Python's float() accepts: digits with single underscores between them,
# no type suffix, and the names of infinity and NaN in any case.
_DIGITS = "[0-9]+(?:_[0-9]+)*"
FLOAT_TEXT = (rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
              r"|(?i:inf|infinity|nan))$")


def lenient_double(text: Column) -> Column:
    """Text -> double as Python's ``float()`` reads it (``1_0`` and blanks around
    it, but no ``10D``), null when it does not parse (``PAL``, blanks)."""
    bare = strip_unicode(text)
    return F.when(bare.rlike(FLOAT_TEXT), F.replace(bare, F.lit("_"), F.lit(""))).try_cast("double")


def is_number(x: Column) -> Column:
    """True for a non-null, non-NaN value."""
    return x.isNotNull() & ~F.isnan(x)


def py_ge(a: Column, b: Column) -> Column:
    """``a >= b`` as Python floats compare it: false whenever either is NaN."""
    return is_number(a) & is_number(b) & (a >= b)


def is_whole_multiple(qty: Column, size: Column) -> Column:
    """``qty % size == 0`` for a positive size (never raises)."""
    return F.try_mod(qty, size) == 0


#: Digits after the point of exact sums; a double below 100 may have more.
SUM_SCALE = 15
_FIXED = f"decimal(33,{SUM_SCALE})"


def fixed_point(x: Column) -> Column:
    """A double as a decimal (its shortest text, rounded to ``SUM_SCALE`` digits
    after the point); null for NaN, infinities and magnitudes from 1e18."""
    return x.try_cast(_FIXED)


def exact_sums(x: Column, name: str) -> dict[str, Column]:
    """Two aggregates whose result does not depend on the order in which partial
    sums meet: the values that fit fixed point in a decimal buffer, and the others
    (which make a sum NaN, infinite or too large for repeatable digits anyway)."""
    fixed = fixed_point(x)
    return {f"_fixed_{name}": F.sum(fixed), f"_wide_{name}": F.sum(F.when(fixed.isNull(), x))}


def exact_total(name: str, fixed: Column | None = None, wide: Column | None = None) -> Column:
    """The double that the two aggregates of :func:`exact_sums` stand for; null if
    nothing was summed."""
    fixed = F.col(f"_fixed_{name}") if fixed is None else fixed
    wide = F.col(f"_wide_{name}") if wide is None else wide
    total = F.coalesce(fixed.cast("double"), F.lit(0.0)) + F.coalesce(wide, F.lit(0.0))
    return F.when(fixed.isNotNull() | wide.isNotNull(), total)
