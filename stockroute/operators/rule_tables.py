"""Allocation with the rules kept as tables and any set of storage locations.

``operators.allocate`` compiles the shipped rules into the plan; here they are
data (the frames of ``rules.rule_frames``, or a user's own tables of that form), so
the plan has the same size for five groups and for ten thousand. Stock travels as a
map from location to quantity; a group's rules as an array of steps sorted by rank;
the first step that can serve a line is found by higher-order functions, row by
row in the JVM. Rule tables are broadcast when their measured size allows and
joined by Spark's own choice when not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sums, exact_total, py_ge, strip_unicode
from ..rules import DEFAULT_RULES, LOCATIONS, Rules
from ..schemas import (CASE_1, CASE_2, CASE_3, FULL_PALLET_ONLY, INCOMPLETE_OK, OUTCOME_STATUS, REASON_CASE_1,
                       REASON_CASE_2, REASON_CASE_3, REASON_NOT_IN_STOCK, STOCK_JOIN_COLUMNS, STOCK_MAP)
from ..sources.sized import sized
from . import allocate as al
from .stock import ATTRIBUTES, drop_zero_stock, has_col, stock_col


Frames = dict[str, DataFrame]


def _unique(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row a key (the smallest value), so that a look-up never repeats a line."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


# --- stock ---

def stock_map(stock: DataFrame, frames: Frames) -> DataFrame:
    """Typed stock rows -> one row per (material, plant): ``stock_by_location``
    (location -> quantity, has_stock, for the locations that have rows),
    total_stock, available_locations_count and _list in the order of the location
    table, the three stored locations' columns, the latest timestamp and the
    attributes as in ``stock.stock_profile``.

    Raw rows are reduced by hash first; the one exchange by material and plant then
    serves both further groupings, and an array holds at most one entry a location."""
    alias = _unique(frames["location_alias"], "raw", "location")
    known = _unique(frames["locations"], "location", "rank")
    named = (stock.join(sized(alias), F.col("storage_location") == F.col("raw"), "left")
             .withColumn("location", F.coalesce("location", "storage_location")).join(sized(known), "location"))
    sums = exact_sums(F.coalesce("allocable_stock_qty", F.lit(0.0)), "qty")
    time = F.max("stock_timing_timestamp").alias("stock_timing_timestamp")
    keys = ["material_number", "plant"]
    reduced = named.groupBy(*keys, "location", "rank", *ATTRIBUTES).agg(*[v.alias(k) for k, v in sums.items()], time)
    per_location = (reduced.repartition(*keys).groupBy(*keys, "location", "rank")
                    .agg(*[F.sum(k).alias(k) for k in sums], time, *[F.min(a).alias(a) for a in ATTRIBUTES])
                    .withColumn("qty", exact_total("qty")))
    first = lambda a: F.min(F.when(F.col(a).isNotNull(), F.struct("rank", "location", F.col(a).alias("v"))))["v"]
    profile = per_location.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("rank", "location", "qty"))).alias("entries"), time,
        *[first(a).alias(a) for a in ATTRIBUTES])
    has = lambda e: e["qty"] > 0
    value = lambda e: F.struct(e["location"], F.struct(e["qty"].alias("quantity"), has(e).alias("has_stock")))
    served = F.filter("entries", has)
    keyed = F.col("material_number").isNotNull() & F.col("plant").isNotNull()
    out = profile.select(
        *keys, F.map_from_entries(F.transform("entries", value)).alias(STOCK_MAP),
        F.aggregate("entries", F.lit(0.0), lambda a, e: a + e["qty"]).alias("total_stock"),
        F.size(served).alias("available_locations_count"),
        F.array_join(F.transform(served, lambda e: e["location"]), ",").alias("available_locations_list"),
        *[F.when(keyed, F.col(c)).alias(c) for c in ("stock_timing_timestamp", *ATTRIBUTES)])
    return out.withColumns(stored_columns())


def stored_columns() -> dict[str, Column]:
    """The stored locations' quantity and flag columns, read from the map."""
    at = {loc: F.try_element_at(STOCK_MAP, F.lit(loc)) for loc in LOCATIONS}
    return ({stock_col(loc): F.coalesce(x["quantity"], F.lit(0.0)) for loc, x in at.items()}
            | {has_col(loc): F.coalesce(x["has_stock"], F.lit(False)) for loc, x in at.items()})


def stock_filtered(stock: DataFrame, run_ts: str, frames: Frames) -> DataFrame:
    """The silver stock table with the map beside its usual columns."""
    return drop_zero_stock(stock_map(stock, frames)).withColumn("_processed_timestamp", F.lit(run_ts))


# --- order lines ---

def enrich_orders(valid: DataFrame, frames: Frames, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Customer group, pallet rule and start location, looked up in the tables."""
    alias = _unique(frames["customer_alias"], "name_key", "customer_group")
    party = frames["full_pallet_parties"].select(F.col("sold_to_party").alias("_party")).where("_party is not null").distinct()
    key = F.upper(strip_unicode(F.col("customer_name")))
    out = valid.join(sized(alias), key == F.col("name_key"), "left").drop("name_key")
    out = out.join(sized(party), F.col("sold_to_party").cast("string") == F.col("_party"), "left")
    return out.withColumns({
        "customer_group": F.coalesce("customer_group", F.lit(rules.default_group)),
        "pallet_rule": F.when(F.col("_party").isNotNull(), FULL_PALLET_ONLY).otherwise(INCOMPLETE_OK),
        "starting_location": F.lit(rules.start_location),
    }).drop("_party")


def join_stock(enriched: DataFrame, stock: DataFrame) -> DataFrame:
    """``allocate.join_stock`` with the map among the stock columns."""
    return al.join_stock(enriched, stock, (*STOCK_JOIN_COLUMNS, STOCK_MAP))


# --- rules ---

def group_steps(frames: Frames, default_group: str) -> DataFrame:
    """(customer_group, steps): each group's locations by rank with their approval
    need. A group without priorities has the default group's, one without approval
    rows the default group's; a location that an approval table lacks needs it."""
    priority = frames["priority_rules"]
    auth = (frames["auth_rules"].groupBy(F.col("customer_group").alias("_auth"), "location")
            .agg(F.max("requires_auth").alias("requires_auth")))
    spark = priority.sparkSession
    groups = (priority.select("customer_group").union(frames["auth_rules"].select("customer_group"))
              .union(frames["customer_alias"].select("customer_group"))
              .union(spark.createDataFrame([(default_group,)], "customer_group string")).where("customer_group is not null").distinct())
    listed = priority.select(F.col("customer_group").alias("_priority")).distinct()
    judged = auth.select(F.col("_auth").alias("_judged")).distinct()
    groups = (groups.join(listed, F.col("customer_group") == F.col("_priority"), "left")
              .join(judged, F.col("customer_group") == F.col("_judged"), "left")
              .select("customer_group", F.coalesce("_priority", F.lit(default_group)).alias("_priority"),
                      F.coalesce("_judged", F.lit(default_group)).alias("_auth")))
    steps = priority.select(F.col("customer_group").alias("_priority"), "rank", "location")
    return (groups.join(steps, "_priority").join(auth, ["_auth", "location"], "left")
            .groupBy("customer_group").agg(F.array_sort(F.collect_list(
                F.struct("rank", "location", F.coalesce("requires_auth", F.lit(True)).alias("requires_auth")))).alias("_steps")))


def _text(template: str, **values: Column) -> Column:
    """A text template with columns for its names."""
    places = {name: f"%{i}$s" for i, name in enumerate(values, 1)}
    return F.format_string(template.replace("%", "%%").format(**places), *values.values())


def allocate(joined: DataFrame, frames: Frames, rules: Rules = DEFAULT_RULES,
             columns: tuple[str, ...] = al.ALLOCATION_COLUMNS) -> DataFrame:
    """The rule of ``allocate.allocate`` on lines with a stock map: adds the
    outcome's ``columns``. Of ``rules`` only the default group and the default start
    location are used; a line whose start is no known location starts there, one whose
    group has no rules has the default group's."""
    known = _unique(frames["locations"], "location", "rank").select(F.col("location").alias("_known"))
    steps = group_steps(frames, rules.default_group)
    default = steps.where(F.col("customer_group") == rules.default_group).select("_steps").scalar()
    out = joined.join(sized(steps), "customer_group", "left").join(sized(known), F.col("starting_location") == F.col("_known"), "left")
    start = F.coalesce("_known", F.lit(rules.start_location))
    out = out.withColumns({al._QTY: al.quantity()})
    out = out.withColumns({al._PALLET_OK: al.pallet_ok(F.col(al._QTY)), "_start": start,
                           "_steps": F.coalesce("_steps", default)})

    def serves(location: Column) -> Column:
        at = F.try_element_at(STOCK_MAP, location)
        return (F.coalesce(at["has_stock"], F.lit(False)) & F.coalesce(py_ge(at["quantity"], F.col(al._QTY)), F.lit(False))
                & F.col(al._PALLET_OK))

    hit = F.get(F.filter("_steps", lambda s: (s["location"] != F.col("_start")) & serves(s["location"])), 0)
    miss = F.col("total_stock").isNull()
    at_start = serves(F.col("_start"))
    out = out.withColumn("_hit", F.when(~miss & ~at_start, hit)).withColumn("_at_start", ~miss & at_start)
    moved, need = F.col("_hit").isNotNull(), F.col("_hit.requires_auth")
    place = F.col("_start")
    made = {
        "allocated_location": F.when(F.col("_at_start"), place).otherwise(F.col("_hit.location")),
        "requires_auth": F.coalesce(need, F.lit(False)),
        "case_number": F.when(F.col("_at_start"), CASE_1).when(moved, CASE_2).otherwise(CASE_3),
        "case_reason": (F.when(miss, REASON_NOT_IN_STOCK).when(F.col("_at_start"), _text(REASON_CASE_1, start=place))
                        .when(moved, _text(REASON_CASE_2, start=place, loc=F.col("_hit.location"),
                                           auth=F.when(need, "True").otherwise("False")))
                        .otherwise(_text(REASON_CASE_3, start=place))),
        "location_changed": moved,
    }
    for name, values in OUTCOME_STATUS.items():
        for (case, auth), value in values.items():
            if case in (CASE_1, CASE_2, CASE_3):
                same = (made["case_number"] == case) & (made["requires_auth"] == auth)
                made[name] = made[name].when(same, F.lit(value)) if name in made else F.when(same, F.lit(value))
    out = out.withColumns({c: made[c] for c in columns})
    zeroed = {stock_col(n): F.lit(0.0) for n in LOCATIONS} | {has_col(n): F.lit(False) for n in LOCATIONS}
    zeroed |= {"available_locations_count": F.lit(0), "available_locations_list": F.lit(""), "total_stock": F.lit(0.0)}
    fixes = {c: F.when(miss, v).otherwise(F.col(c)) for c, v in zeroed.items()}
    return out.withColumns(fixes).drop("_steps", "_known", "_start", "_hit", "_at_start", al._QTY, al._PALLET_OK)


def allocate_with_actions(joined: DataFrame, run_ts: str, frames: Frames, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Allocated lines with the outcome's actions and statuses."""
    return allocate(joined, frames, rules, al.ALLOCATION_COLUMNS + al.STATUS_COLUMNS).withColumn("_processed_timestamp", F.lit(run_ts))
