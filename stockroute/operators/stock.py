"""Stock profile: one row per (material, plant) with stock per location.

The pivot, the attribute pick and their join become two grouped passes: raw
rows are reduced by hash per (material, plant, location, attributes) with
map-side partial aggregation, so a material holding a large share of the stock
rows is reduced in every map task; then conditional sums give the per-location
stock and ordered minima the attributes of the few rows left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import exact_sums, exact_total
from ..rules import DEFAULT_RULES, Rules

ATTRIBUTES = ("warehouse_type", "packaging_unit", "palletization_indicator")


def stock_col(loc: str) -> str:
    return f"stock_{loc}"


def has_col(loc: str) -> str:
    return f"has_stock_{loc}"


def normalise_location(loc: Column, rules: Rules = DEFAULT_RULES) -> Column:
    expr = None
    for raw, target in rules.location_alias.items():
        expr = (F.when(loc == raw, F.lit(target)) if expr is None
                else expr.when(loc == raw, F.lit(target)))
    return loc if expr is None else expr.otherwise(loc)


def normalise_stock(stock: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Alias raw location codes, null quantities -> 0.0, known locations only."""
    return (stock
            .withColumns({
                "storage_location": normalise_location(F.col("storage_location"), rules),
                "allocable_stock_qty": F.coalesce(F.col("allocable_stock_qty"), F.lit(0.0)),
                "available_stock_qty": F.coalesce(F.col("available_stock_qty"), F.lit(0.0)),
            })
            .filter(F.col("storage_location").isin(*rules.locations)))


def stock_by_location(norm: DataFrame) -> DataFrame:
    """Sums per (material, plant, location), in fixed-point buffers: the same bits
    whatever the order in which partial sums meet."""
    summed = ("allocable_stock_qty", "available_stock_qty")
    aggs = {k: v for c in summed for k, v in exact_sums(F.col(c), c).items()}
    keys = ("material_number", "plant", "storage_location")
    return (norm.groupBy(*keys).agg(*[v.alias(k) for k, v in aggs.items()])
            .select(*keys, *[exact_total(c).alias(c) for c in summed]))


def _location_rank(rules: Rules) -> Column:
    loc = F.col("storage_location")
    expr = None
    for i, name in enumerate(rules.locations):
        expr = (F.when(loc == name, F.lit(i)) if expr is None
                else expr.when(loc == name, F.lit(i)))
    return expr


def _first_by_location(attr: str, rank: Column) -> Column:
    """The attribute of the first location (in location order) that has one;
    among equals the smallest value. Deterministic, unlike ``first``."""
    a = F.col(attr)
    return F.min(F.when(a.isNotNull(), F.struct(rank.alias("r"), a.alias("v"))))["v"]


def stock_profile(norm: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per (material, plant): ``stock_<loc>`` (0.0 when absent), the
    latest stock timestamp and the three informational attributes."""
    loc = F.col("storage_location")
    rank = _location_rank(rules.fixed_locations())
    # Raw rows are first reduced by hash (sums and the timestamp have fixed-width
    # buffers); only the few rows left per material and plant meet the ordered
    # minima, which need sorted groups. Both passes keep fixed-point sums, so a
    # quantity has the same bits whatever the order in which rows meet.
    sums = exact_sums(F.col("allocable_stock_qty"), "qty")
    norm = (norm.groupBy("material_number", "plant", "storage_location", *ATTRIBUTES)
            .agg(*[v.alias(k) for k, v in sums.items()],
                 F.max("stock_timing_timestamp").alias("stock_timing_timestamp")))
    aggs = [F.coalesce(exact_total("qty", *[F.sum(F.when(loc == name, F.col(k))) for k in sums]), F.lit(0.0))
            .alias(stock_col(name)) for name in rules.locations]
    aggs.append(F.max("stock_timing_timestamp").alias("stock_timing_timestamp"))
    aggs += [_first_by_location(a, rank).alias(a) for a in ATTRIBUTES]
    prof = norm.groupBy("material_number", "plant").agg(*aggs)
    # A null key never matches an equi-join, so groups with a null material or
    # plant carry null attributes (the stock sums are kept).
    keyed = F.col("material_number").isNotNull() & F.col("plant").isNotNull()
    return prof.withColumns({c: F.when(keyed, F.col(c))
                             for c in ("stock_timing_timestamp",) + ATTRIBUTES})


def flag_stock(profile: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """``has_stock_<loc>`` (stock > 0) and ``total_stock``."""
    cols = {has_col(n): F.col(stock_col(n)) > 0 for n in rules.locations}
    total = None
    for n in rules.locations:
        total = F.col(stock_col(n)) if total is None else total + F.col(stock_col(n))
    cols["total_stock"] = total
    return profile.withColumns(cols)


def drop_zero_stock(flags: DataFrame) -> DataFrame:
    return flags.filter(F.col("total_stock") > 0)


def tag_availability(df: DataFrame, run_ts: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """How many locations carry stock, and which, in location order."""
    count = None
    for n in rules.locations:
        c = F.col(has_col(n)).cast("int")
        count = c if count is None else count + c
    listing = F.concat_ws(",", *[F.when(F.col(has_col(n)), F.lit(n)) for n in rules.locations])
    return df.withColumns({"available_locations_count": count,
                           "available_locations_list": listing,
                           "_processed_timestamp": F.lit(run_ts)})


def stock_filtered(stock: DataFrame, run_ts: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Typed stock rows -> the silver stock table."""
    prof = stock_profile(normalise_stock(stock, rules), rules)
    return tag_availability(drop_zero_stock(flag_stock(prof, rules)), run_ts, rules)
