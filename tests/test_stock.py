import math
import random
from decimal import Decimal

import pytest
from helpers import plan_text, stock_df
from pyspark.sql import functions as F

from stockroute.operators import stock

TS = "2024-06-30T00:00:00"


def test_normalise_aliases_location_and_zero_fills(spark):
    df = stock_df(spark,
                  {"storage_location": "1000", "allocable_stock_qty": None},
                  {"storage_location": "PT11"},
                  {"storage_location": "XX99"},
                  {"storage_location": None})
    out = stock.normalise_stock(df).collect()
    assert sorted(r.storage_location for r in out) == ["PT11", "PT12"]
    assert all(r.allocable_stock_qty == 0.0 and r.available_stock_qty == 0.0 for r in out)


def test_profile_sums_per_location_and_zero_for_absent(spark):
    df = stock_df(spark,
                  {"storage_location": "1000", "allocable_stock_qty": 5.0},
                  {"storage_location": "PT12", "allocable_stock_qty": 7.0},
                  {"storage_location": "PT15", "allocable_stock_qty": 3.0})
    (r,) = stock.stock_profile(stock.normalise_stock(df)).collect()
    assert (r.stock_PT12, r.stock_PT11, r.stock_PT15) == (12.0, 0.0, 3.0)


def test_attributes_first_non_null_in_location_order(spark):
    df = stock_df(spark,
                  {"storage_location": "PT15", "warehouse_type": "A", "packaging_unit": "9"},
                  {"storage_location": "PT11", "warehouse_type": "C", "packaging_unit": None},
                  {"storage_location": "PT12", "warehouse_type": None, "packaging_unit": None,
                   "palletization_indicator": "Y"},
                  {"storage_location": "1000", "warehouse_type": None, "packaging_unit": None})
    (r,) = stock.stock_profile(stock.normalise_stock(df)).collect()
    # PT12 has no warehouse type -> PT11's; only PT15 has a packaging unit.
    assert (r.warehouse_type, r.packaging_unit, r.palletization_indicator) == ("C", "9", "Y")


def test_null_keys_keep_stock_but_not_attributes(spark):
    df = stock_df(spark, {"plant": None, "allocable_stock_qty": 4.0, "warehouse_type": "W"})
    (r,) = stock.stock_profile(stock.normalise_stock(df)).collect()
    assert r.stock_PT12 == 4.0 and r.warehouse_type is None and r.stock_timing_timestamp is None


def test_zero_stock_removal_and_negative_hides_positive(spark):
    df = stock_df(spark,
                  {"material_number": "neg", "storage_location": "PT12", "allocable_stock_qty": -70.0},
                  {"material_number": "neg", "storage_location": "PT11", "allocable_stock_qty": 10.0},
                  {"material_number": "zero", "allocable_stock_qty": 0.0},
                  {"material_number": "pos", "storage_location": "PT15", "allocable_stock_qty": 2.0},
                  {"material_number": "pos", "storage_location": "PT11", "allocable_stock_qty": 1.0})
    out = {r.material_number: r for r in stock.stock_filtered(df, TS).collect()}
    assert set(out) == {"pos"}
    assert out["pos"].available_locations_count == 2
    assert out["pos"].available_locations_list == "PT11,PT15"


def test_nan_stock_counts_as_present(spark):
    df = stock_df(spark, {"allocable_stock_qty": float("nan")})
    (r,) = stock.flag_stock(stock.stock_profile(stock.normalise_stock(df))).collect()
    assert r.has_stock_PT12 is True and math.isnan(r.total_stock)


def test_profile_reduces_raw_rows_by_hash_first(spark):
    df = stock_df(spark, {"storage_location": "PT12"}, {"storage_location": "PT11"})
    plan = plan_text(stock.stock_filtered(df, TS))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan
    raw_side = plan[plan.index("Exchange hashpartitioning", plan.index("Exchange hashpartitioning") + 1):]
    assert "HashAggregate" in raw_side and "SortAggregate" not in raw_side and "Sort [" not in raw_side


def test_sums_have_the_same_bits_whatever_the_order(spark):
    """Quantities like 0.1, of mixed size and sign, over 1, 8 and 200 partitions."""
    rng = random.Random(4)
    rows = [{"material_number": f"M{i % 3}", "storage_location": rng.choice(["PT12", "1000", "PT11"]), "warehouse_type": rng.choice("ab"),
             "allocable_stock_qty": q, "available_stock_qty": -q}
            for i, q in enumerate(rng.choice([0.1, 0.2, 0.3, 1e15, -1e15, 7.7, 1e-9, 123456.789]) for _ in range(3000))]
    df = stock_df(spark, *rows)
    seen = set()
    for parts in (1, 8, 200):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            norm = stock.normalise_stock(df.orderBy(F.rand(parts)).repartition(parts))
            by_loc = sorted((r.material_number, r.storage_location, r.allocable_stock_qty.hex(), r.available_stock_qty.hex())
                            for r in stock.stock_by_location(norm).collect())
            prof = sorted((r.material_number, r.stock_PT12.hex(), r.stock_PT11.hex()) for r in stock.stock_profile(norm).collect())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
        seen.add((*by_loc, *prof))
    assert len(seen) == 1
    want = {}
    for r in rows:
        key = (r["material_number"], "PT12" if r["storage_location"] == "1000" else r["storage_location"])
        want[key] = want.get(key, 0) + Decimal(repr(r["allocable_stock_qty"]))
    assert {(m, loc): float.fromhex(q) for m, loc, q, _ in by_loc} == {k: float(v) for k, v in want.items()}


@pytest.mark.parametrize("values, total", [([0.1, 0.2], 0.3), ([1e300, 1.0], 1e300), ([math.inf, 1.0], math.inf), ([-math.inf, 5.0], -math.inf),
                                           ([math.nan, 1.0], math.nan), ([math.inf, -math.inf], math.nan), ([1e17, 0.25, -1e17], 0.25), ([0.0], 0.0)])
def test_sums_of_values_beyond_fixed_point(spark, values, total):
    df = stock_df(spark, *[{"allocable_stock_qty": v} for v in values])
    (r,) = stock.stock_by_location(df).collect()
    (p,) = stock.stock_profile(df).collect()
    for got in (r.allocable_stock_qty, p.stock_PT12):
        assert got == total or (math.isnan(got) and math.isnan(total))
