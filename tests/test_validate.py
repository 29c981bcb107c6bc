from helpers import orders_df

from stockroute.operators import validate
from stockroute.schemas import REASON_BOTH, REASON_NOTE, REASON_REJECTION

TS = "2024-06-30T00:00:00"


def test_category_filter_trims_spaces_and_case(spark):
    df = orders_df(spark,
                   {"sales_order_number": "a", "item_category": "ZTAN"},
                   {"sales_order_number": "b", "item_category": " ztan "},
                   {"sales_order_number": "c", "item_category": "ZUCC"},
                   {"sales_order_number": "d", "item_category": None},
                   {"sales_order_number": "e", "item_category": "\tZTAN"})  # tab is not trimmed
    kept = {r[0] for r in validate.keep_category(df).select("sales_order_number").collect()}
    assert kept == {"a", "b"}


def test_blank_to_null_keeps_original_text(spark):
    df = orders_df(spark,
                   {"sales_order_number": "a", "delivery_note": "  ", "blocking_indicator": ""},
                   {"sales_order_number": "b", "delivery_note": " DN1 "})
    out = {r.sales_order_number: r for r in validate.clean_blanks(df).collect()}
    assert out["a"].delivery_note is None and out["a"].blocking_indicator is None
    assert out["b"].delivery_note == " DN1 "  # untrimmed


def test_valid_and_exceptions_are_complementary(spark):
    df = orders_df(spark,
                   {"sales_order_number": "ok"},
                   {"sales_order_number": "both", "delivery_note": "D", "reason_for_rejection": "R"},
                   {"sales_order_number": "note", "delivery_note": "D"},
                   {"sales_order_number": "rej", "reason_for_rejection": "R"},
                   {"sales_order_number": "blank", "delivery_note": " ", "reason_for_rejection": ""})
    valid, exc = validate.validate(df, TS)
    v = {r.sales_order_number: r for r in valid.collect()}
    e = {r.sales_order_number: r for r in exc.collect()}
    assert set(v) == {"ok", "blank"}
    assert {k: r.exception_reason for k, r in e.items()} == {
        "both": REASON_BOTH, "note": REASON_NOTE, "rej": REASON_REJECTION}
    assert all(r.validation_status == "VALID" and r.exception_reason is None for r in v.values())
    assert all(r.validation_status == "EXCEPTION" for r in e.values())
    assert all(r._processed_timestamp == TS for r in list(v.values()) + list(e.values()))
    assert valid.count() + exc.count() == validate.keep_category(df).count()


def test_blocked_and_closed_kept_by_default_dropped_on_option(spark):
    df = orders_df(spark,
                   {"sales_order_number": "blocked", "blocking_indicator": "X"},
                   {"sales_order_number": "closed", "order_status": "Closed"},
                   {"sales_order_number": "open"})
    default, _ = validate.validate(df, TS)
    assert default.count() == 3
    opt, _ = validate.validate(df, TS, ignore_blocked_closed=True)
    assert [r.sales_order_number for r in opt.collect()] == ["open"]
