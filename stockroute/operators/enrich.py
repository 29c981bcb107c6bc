"""Order enrichment: customer group, pallet rule, starting location."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import customer_group, pallet_rule
from ..rules import DEFAULT_RULES, Rules


def enrich_orders(valid: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Narrow projection; the rule look-ups are literal CASE expressions."""
    return valid.withColumns({
        "customer_group": customer_group(F.col("customer_name"), rules),
        "pallet_rule": pallet_rule(F.col("sold_to_party"), rules),
        "starting_location": F.lit(rules.start_location),
    })
