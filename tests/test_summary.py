"""Sort order of the reports (ties broken by name)."""

from helpers import orders_df

from stockroute.operators import summary, validate


def test_exception_counts_descend(spark):
    notes = [{"delivery_note": "D"}] * 2 + [{"reason_for_rejection": "R"}] * 3 + [{"delivery_note": "D", "reason_for_rejection": "R"}] * 2
    got = summary.exception_summary(validate.exceptions(orders_df(spark, *notes), "t")).collect()
    assert [r["count"] for r in got] == [3, 2, 2]
    assert [r.exception_reason for r in got[1:]] == sorted(r.exception_reason for r in got[1:])


def test_ascending_reports(spark):
    df = spark.createDataFrame([(3,), (1,), (2,), (1,)], "available_locations_count int")
    assert [(r[0], r[1]) for r in summary.location_count_summary(df).collect()] == [(1, 2), (2, 1), (3, 1)]
