import pytest

from stockroute.plans import pipeline
from stockroute.schemas import ORDERS_SCHEMA, STOCK_HEADERS, STOCK_REQUIRED, STOCK_SCHEMA
from stockroute.sources import csv as csv_source

BOM = "\ufeff"
HEADER = ["Sales Order Number", "Sales Order Line Item", "Customer Name", "Item Category",
          "Storage Location", "Delivery Note", "Order Quantity", "Material Number", "Extra Col"]


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_bom_extra_missing_multiline_and_quotes(spark, tmp_path):
    body = (BOM + BOM + ",".join(HEADER) + "\n"
            + '1,10,"Walmart ""Chile""\nSantiago",ZTAN,1000,,5,M1,x\n'
            + '2,20,DMart,ZTAN,1000,"",7.5,M2,y\n'
            + '3,30,TentA,ZTAN,1000, ,2,M3,z\n')
    d = tmp_path / "orders"
    d.mkdir()
    _write(d / "part-0.csv", body)
    df = csv_source.ingest_orders(spark, str(d), "TS", source="orders/", multi_line=True)
    assert df.columns[:3] == ["sales_order_number", "sales_order_line_item", "customer_name"]
    assert "Extra Col" not in df.columns and len(df.columns) == 21 + 2
    rows = {r.sales_order_number: r for r in df.collect()}
    assert rows["1"].customer_name == 'Walmart "Chile"\nSantiago'
    # unquoted and quoted empty cells are null; a single space survives
    assert rows["1"].delivery_note is None and rows["2"].delivery_note is None
    assert rows["3"].delivery_note == " "
    # a location column holding only 1000 stays text
    assert dict(df.dtypes)["storage_location"] == "string" and rows["1"].storage_location == "1000"
    assert rows["2"].order_quantity == 7.5
    # mapped columns absent from the file are typed nulls
    assert rows["1"].required_delivery_date is None and dict(df.dtypes)["order_quantity"] == "double"
    assert rows["1"]._source_file == "orders/" and rows["1"]._ingestion_timestamp == "TS"


def test_malformed_number_fails_strict_and_nulls_lenient(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    _write(d / "a.csv", ",".join(HEADER[:-1]) + '\n1,1,A,ZTAN,PT12,,"1,234",M1\n')
    with pytest.raises(Exception):
        csv_source.ingest_orders(spark, str(d), "TS").collect()
    (row,) = csv_source.ingest_orders(spark, str(d), "TS", strict=False).collect()
    assert row.order_quantity is None


def test_missing_required_column_raises(spark, tmp_path):
    d = tmp_path / "noqty"
    d.mkdir()
    _write(d / "a.csv", "Sales Order Number,Item Category\n1,ZTAN\n")
    with pytest.raises(ValueError, match="required"):
        csv_source.ingest_orders(spark, str(d), "TS")


def test_stock_timestamp_and_nan_parse(spark, tmp_path):
    d = tmp_path / "stock"
    d.mkdir()
    _write(d / "s.csv", "Material Number,Plant,Storage Location,Allocable Stock Quantity,"
                        "Stock Timing Timestamp,Packaging Unit / Pallet Unit\n"
                        "M1,P1,PT12,NaN,2024-01-02 03:04:05,PAL\n")
    (row,) = csv_source.ingest_stock(spark, str(d), "TS").collect()
    assert row.allocable_stock_qty != row.allocable_stock_qty  # NaN
    assert row.packaging_unit == "PAL" and row.stock_timing_timestamp.year == 2024


@pytest.mark.parametrize("multi_line", [False, True])
def test_file_with_another_column_order_raises(spark, tmp_path, multi_line):
    d = tmp_path / "two"
    d.mkdir()
    _write(d / "a.csv", "Material Number,Plant,Storage Location,Allocable Stock Quantity\nM1,P1,PT12,1\n")
    _write(d / "b.csv", "Plant,Material Number,Storage Location,Allocable Stock Quantity\nP2,M2,PT12,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_source.ingest_stock(spark, str(d), "TS", multi_line=multi_line).collect()


def test_each_file_is_read_under_its_own_header(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    _write(d / "a.csv", BOM + "Material Number,Plant,Storage Location,Allocable Stock Quantity\nM1,P1,PT12,1\nM2,P1,PT11,\n")
    _write(d / "b.csv", '"Allocable Stock Quantity",Other,Plant,"Storage Location","Packaging Unit / Pallet Unit",Material Number\n'
                        '2.5,"x, y",P2,PT12,4,M3\n')
    _write(d / "c.csv", "Plant,Material Number,Storage Location,Allocable Stock Quantity,Plant\n")  # no rows, a repeated header
    _write(d / "d.csv", "Plant,Material Number,Storage Location\nP4,M4,PT12\n")  # lacks a required column
    _write(d / "e.csv", "Material Number,Plant,Storage Location,Allocable Stock Quantity\nM5,P5,PT12,7,more\nM6,P5,PT12,x1\nM7\n")
    rows = {r.material_number: r for r in csv_source.ingest_labelled(
        spark, str(d), "TS", STOCK_HEADERS, STOCK_SCHEMA, STOCK_REQUIRED).collect()}
    assert sorted(rows) == ["M1", "M2", "M3", "M4", "M5", "M6", "M7"]
    assert [rows["M1"][c] for c in ("plant", "storage_location", "allocable_stock_qty", "packaging_unit")] == ["P1", "PT12", 1.0, None]
    assert [rows["M3"][c] for c in ("plant", "storage_location", "allocable_stock_qty", "packaging_unit")] == ["P2", "PT12", 2.5, "4"]
    assert {m: r.row_status for m, r in rows.items()} == {
        "M1": "GOOD", "M2": "GOOD", "M3": "GOOD", "M4": "BAD", "M5": "BAD", "M6": "BAD", "M7": "GOOD"}
    faults = {m: [tuple(f) for f in r.faults] for m, r in rows.items()}
    assert faults["M4"] == [("_corrupt", "no column allocable_stock_qty")] and faults["M5"] == [("_corrupt", "beyond the header: more")]
    assert faults["M6"] == [("allocable_stock_qty", "x1")] and '"material_number":"M6"' in rows["M6"].record and rows["M1"].record is None
    assert rows["M3"]._source_file.endswith("/mixed/b.csv") and rows["M1"]._source_file.endswith("/mixed/a.csv")
    assert rows["M2"].allocable_stock_qty is None and rows["M7"].plant is None


def test_headers_of_files_of_many_splits(spark, tmp_path):
    """The header is that of the file's first bytes, however many tasks read it."""
    d = tmp_path / "splits"
    d.mkdir()
    for k, header in enumerate(["Material Number,Plant,Storage Location,Allocable Stock Quantity", "Plant,Material Number,Allocable Stock Quantity,Storage Location"]):
        body = "".join((f"M{i},P{k},PT12,{i}\n" if k == 0 else f"P{k},M{i},{i},PT12\n") for i in range(4000))
        _write(d / f"{k}.csv", header + "\n" + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = csv_source.ingest_labelled(spark, str(d), "TS", STOCK_HEADERS, STOCK_SCHEMA, STOCK_REQUIRED)
        assert df.rdd.getNumPartitions() > 10
        got = sorted((r.plant, r.material_number, r.allocable_stock_qty, r.storage_location, r.row_status) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted((f"P{k}", f"M{i}", float(i), "PT12", "GOOD") for k in (0, 1) for i in range(4000))


def test_quarantine_in_the_pipeline(spark, tmp_path):
    (tmp_path / "orders").mkdir(), (tmp_path / "stock").mkdir()
    _write(tmp_path / "orders" / "a.csv", ",".join(HEADER) + '\n1,10,A,ZTAN,PT12,,5,M1,x\n2,10,A,ZTAN,PT12,,"1,5",M1,x\n')
    _write(tmp_path / "orders" / "b.csv", "Order Quantity,Material Number,Item Category,Sales Order Line Item,Sales Order Number\n3,M1,ZTAN,1,7\n")
    _write(tmp_path / "stock" / "s.csv", "Material Number,Plant,Storage Location,Allocable Stock Quantity\nM1,P1,PT12,9\n")
    for place in ({"root": str(tmp_path / "out")}, {"bronze": "q_bronze", "silver": "q_silver", "gold": "q_gold"}):
        layout = pipeline.Layout(quarantine=True, **place)
        try:
            res = pipeline.run(spark, str(tmp_path / "orders"), str(tmp_path / "stock"), layout, run_ts="TS")
            m = res.metrics
            assert (m["sales_orders_raw"], m["sales_orders_rejected"], m["stock_availability_raw"], m["stock_availability_rejected"]) == (2, 1, 1, 0)
            assert len(res.tables) == 11 and m["allocation_output"] == 2
            raw = layout.read(spark, "bronze", "sales_orders_raw")
            assert raw.columns == [*ORDERS_SCHEMA.names, "_ingestion_timestamp", "_source_file"]
            (bad,) = layout.read(spark, "bronze", "sales_orders_rejected").collect()
            assert [tuple(f) for f in bad.faults] == [("order_quantity", "1,5")] and '"sales_order_number":"2"' in bad.record
            assert layout.read(spark, "bronze", "stock_availability_rejected").count() == 0
        finally:
            for db in ("q_bronze", "q_silver", "q_gold"):
                spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_file_of_each_row(spark, tmp_path):
    d = tmp_path / "files"
    d.mkdir()
    for k in "ab":
        _write(d / f"{k}.csv", f"Material Number,Plant\n{k},P\n")
    rows = csv_source.read_csv(spark, str(d), with_file=True).collect()
    assert {r["Material Number"]: r[csv_source.FILE_COLUMN].rsplit("/", 1)[1] for r in rows} == {"a": "a.csv", "b": "b.csv"}
