"""Column functions shared by the operators."""

from .numeric import exact_sums, exact_total, is_number, is_whole_multiple, lenient_double, py_ge
from .text import blank_to_null, customer_group, pallet_rule, strip_unicode

__all__ = ["blank_to_null", "customer_group", "exact_sums", "exact_total", "is_number",
           "is_whole_multiple", "lenient_double", "pallet_rule", "py_ge", "strip_unicode"]
