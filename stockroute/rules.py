"""Allocation rules: priority, approval, customer aliases, full-pallet parties.

By default the rules are configuration: a handful of customer groups times the
three storage locations. They are compiled into Catalyst ``CASE`` expressions
(see ``operators.allocate``), so applying them needs no join, no broadcast and
no Python worker; every executor evaluates them inside whole-stage codegen.
``rule_frames`` gives the same values as small DataFrames; rules kept as tables,
of any size and over any locations, are applied by ``operators.rule_tables``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values: must equal the business rules the pipeline reproduces ---
# Storage locations considered, in the order used for location lists.
LOCATIONS = ("PT12", "PT11", "PT15")
# Raw location codes that mean another location.
LOCATION_ALIAS = {"1000": "PT12"}
# Every line starts at the default location.
START_LOCATION = "PT12"
# Customer group used when a name is unknown or null.
DEFAULT_GROUP = "Default"
# Priority (fallback) sequence per customer group.
PRIORITY = {
    "Walmart": ("PT12", "PT11", "PT15"),
    "Cencosud": ("PT12", "PT15", "PT11"),
    "DMart": ("PT12", "PT11", "PT15"),
    "TentA": ("PT12", "PT11", "PT15"),
    "Default": ("PT12", "PT11", "PT15"),
}
# Approval needed for a customer group at a location.
REQUIRES_AUTH = {
    "Walmart": {"PT12": False, "PT11": False, "PT15": True},
    "Cencosud": {"PT12": False, "PT11": True, "PT15": False},
    "DMart": {"PT12": False, "PT11": True, "PT15": True},
    "TentA": {"PT12": False, "PT11": True, "PT15": True},
    "Default": {"PT12": False, "PT11": True, "PT15": True},
}
# Customer name (trimmed, upper-cased) -> customer group.
CUSTOMER_ALIAS = {
    "WALMART": "Walmart",
    "CENCOSUD": "Cencosud",
    "DEMART": "DMart",
    "DMART": "DMart",
    "TENTA": "TentA",
}
# Sold-to parties that must ship whole pallets.
FULL_PALLET_PARTIES = (
    "30279964", "30724028", "30597757", "30791641",
    "30280027", "30280062", "30280078", "30829327",
)
# --- end of fixed values ---


@dataclass(frozen=True)
class Rules:
    """One immutable rule set; ``DEFAULT_RULES`` holds the shipped values."""

    locations: tuple[str, ...] = LOCATIONS
    location_alias: dict[str, str] = field(default_factory=lambda: dict(LOCATION_ALIAS))
    start_location: str = START_LOCATION
    default_group: str = DEFAULT_GROUP
    priority: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(PRIORITY))
    requires_auth: dict[str, dict[str, bool]] = field(
        default_factory=lambda: {g: dict(m) for g, m in REQUIRES_AUTH.items()})
    customer_alias: dict[str, str] = field(default_factory=lambda: dict(CUSTOMER_ALIAS))
    full_pallet_parties: tuple[str, ...] = FULL_PALLET_PARTIES

    def __post_init__(self):
        if self.default_group not in self.priority:
            raise ValueError(f"priority rules lack the default group {self.default_group!r}")
        if self.start_location not in self.locations:
            raise ValueError(f"start location {self.start_location!r} is not a known location")
        for group, seq in self.priority.items():
            unknown = set(seq) - set(self.locations)
            if unknown:
                raise ValueError(f"group {group!r} lists unknown locations {sorted(unknown)}")

    def fixed_locations(self) -> "Rules":
        """These rules, if the stored columns have a place for each location; other
        sets of locations go with the stock map (``operators.rule_tables``)."""
        if sorted(self.locations) != sorted(LOCATIONS):
            raise ValueError(f"the stored columns are fixed: {LOCATIONS}")
        return self

    def groups(self) -> list[str]:
        return list(self.priority)

    def search_order(self, group: str, start: str | None = None) -> list[str]:
        """Locations in the order a line of ``group`` tries them: the line's
        start location (the default one if unknown) first, then the group's
        priority list without it."""
        start = start if start in self.locations else self.start_location
        seq = self.priority.get(group, self.priority[self.default_group])
        return [start] + [loc for loc in seq if loc != start]

    def needs_auth(self, group: str, location: str) -> bool:
        table = self.requires_auth.get(group, self.requires_auth.get(self.default_group, {}))
        return bool(table.get(location, True))


DEFAULT_RULES = Rules()


def rule_frames(spark: SparkSession, rules: Rules = DEFAULT_RULES) -> dict[str, DataFrame]:
    """The rule set as six small tables (FIXTURES §1.4, and the locations by rank)."""
    prio = [(g, i + 1, loc) for g, seq in rules.priority.items() for i, loc in enumerate(seq)]
    auth = [(g, loc, bool(v)) for g, m in rules.requires_auth.items() for loc, v in m.items()]
    return {
        "priority_rules": spark.createDataFrame(
            prio, "customer_group string, rank int, location string"),
        "auth_rules": spark.createDataFrame(
            auth, "customer_group string, location string, requires_auth boolean"),
        "customer_alias": spark.createDataFrame(
            list(rules.customer_alias.items()), "name_key string, customer_group string"),
        "full_pallet_parties": spark.createDataFrame(
            [(p,) for p in rules.full_pallet_parties],
            T.StructType([T.StructField("sold_to_party", T.StringType())])),
        "location_alias": spark.createDataFrame(
            list(rules.location_alias.items()), "raw string, location string"),
        "locations": spark.createDataFrame(
            [(loc, i) for i, loc in enumerate(rules.locations)], "location string, rank int"),
    }
