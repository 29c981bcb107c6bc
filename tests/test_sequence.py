import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockroute.operators import sequence as seq

ORDER = ["s", "d", "i"]


def _frame(spark, n=3000):
    return spark.createDataFrame([(f"k{i % 13:02d}" if i % 3 else None, float(i % 7), i) for i in range(n)],
                                 "s string, d double, i long").repartition(5)


def _window(df):
    return {r.i: r.rn for r in df.withColumn("rn", F.row_number().over(Window.orderBy(*ORDER)))
            .select("i", "rn").collect()}


@pytest.mark.parametrize("partitions", [1, 2, 40, 600])
def test_equals_the_plain_window(spark, partitions):
    df = _frame(spark)
    out = seq.row_number(df, ORDER, output="rn", partitions=partitions)
    assert {r.i: r.rn for r in out.select("i", "rn").collect()} == _window(df)
    assert out.columns == [*df.columns, "rn"]


def test_default_partitions_and_range_source(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        out = seq.row_number(spark.range(5000).select((-F.col("id")).alias("k")), ["k"], output="rn")
        assert out.where(F.col("rn") != F.col("k") + 5000).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_key_on_a_third_of_the_rows(spark):
    df = spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i}", 0.0, i) for i in range(3000)],
                               "s string, d double, i long")
    assert {r.i: r.rn for r in seq.row_number(df, ORDER, output="rn", partitions=16).collect()} == _window(df)


def test_reading_twice_gives_the_same_numbers(spark):
    out = seq.row_number(_frame(spark), ORDER, output="rn", partitions=7)
    assert sorted(map(tuple, out.select("i", "rn").collect())) == sorted(map(tuple, out.select("i", "rn").collect()))


def test_empty_frame(spark):
    assert seq.row_number(_frame(spark, 1).limit(0), ORDER).count() == 0


def test_window_is_per_stored_range(spark):
    plan = seq.row_number(_frame(spark), ORDER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(_seq_range" in plan
