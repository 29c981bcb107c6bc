"""A hot material (a third of all lines) and null materials (another third) in
the shuffle-join path: AQE splits the skewed order partitions, and lines without
a material are spread by keys of their own."""

from pyspark.sql import functions as F

from helpers import orders_df, stock_df

from stockroute.operators import allocate as al
from stockroute.operators import enrich, stock

TS = "2024-06-30T00:00:00"


def test_hot_material_partition_is_split(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        # a third on one material, a third without material, the rest spread
        lines = [{"sales_order_number": str(i),
                  "material_number": "HOT" if i % 3 == 0 else (None if i % 3 == 1 else f"M{i}")}
                 for i in range(3000)]
        orders = enrich.enrich_orders(orders_df(spark, *lines).repartition(8))
        st = stock.stock_filtered(stock_df(
            spark, *[{"material_number": m, "allocable_stock_qty": 100.0}
                     for m in ["HOT"] + [f"M{i}" for i in range(0, 3000, 7)]]), TS)
        df = al.allocate(al.join_stock(orders, st))
        assert df.count() == 3000
        rows = df.collect()
        missing = [r for r in rows if r.material_number is None]
        assert len(missing) == 1000 and all(r.case_number == "CASE_3" for r in missing)
        assert all(r.case_number == "CASE_1" for r in rows if r.material_number == "HOT")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        assert "isSkew=true" in plan or "skewed" in plan.lower()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_null_materials_are_spread_with_shipped_settings(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.coalescePartitions.enabled")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in zip(keys, ("-1", "-1", "false")):
            spark.conf.set(k, v)
        orders = enrich.enrich_orders(orders_df(spark, *[
            {"sales_order_number": str(i), "material_number": None if i % 2 else f"M{i}"} for i in range(4000)]))
        st = stock.stock_filtered(stock_df(spark, *[{"material_number": f"M{i}", "allocable_stock_qty": 9.0} for i in range(50)]), TS)
        joined = al.join_stock(orders, st).where("material_number is null")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 2000 and len(sizes) == 8 and max(sizes) < 2 * 2000 / 8
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
