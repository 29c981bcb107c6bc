"""stockroute: order-line to storage-location allocation on Spark."""

from .rules import DEFAULT_RULES, Rules

__all__ = ["DEFAULT_RULES", "Rules"]
__version__ = "0.1.0"
