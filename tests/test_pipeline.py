"""End to end: CSV extracts -> nine stored tables, and partition-count
independence of the results."""

import hashlib

import pytest
from helpers import orders_df, plan_text, stock_df
from pyspark.sql import functions as F

from stockroute.plans import pipeline
from stockroute.plans.flow import Flow
from stockroute.rules import Rules
from stockroute.schemas import ORDER_HEADERS, STOCK_HEADERS
from stockroute.session import scratch_path
from stockroute.sources.csv import write_csv
from stockroute.sources.tables import OPEN_FILES, write_split

TS = "2024-06-30T00:00:00"


def _inputs(spark):
    orders = orders_df(
        spark,
        *[{"sales_order_number": str(n), "sales_order_line_item": "1",
           "customer_name": c, "order_quantity": q, "material_number": m,
           "sold_to_party": p, "item_category": cat, "delivery_note": dn}
          for n, (c, q, m, p, cat, dn) in enumerate([
              ("Walmart", 4.0, "M1", "30279964", "ZTAN", None),
              ("Cencosud", 40.0, "M1", "1", " ztan ", None),
              ("TentA", 40.0, "M1", "1", "ZTAN", ""),
              ("DMart", 40.0, "M2", "1", "ZTAN", None),
              ("x", 1.0, None, "1", "ZTAN", None),
              ("x", 1.0, "M1", "1", "ZUCC", None),
              ("x", 1.0, "M1", "1", "ZTAN", "DN1")])])
    stock = stock_df(
        spark,
        {"material_number": "M1", "storage_location": "1000", "allocable_stock_qty": 10.0,
         "packaging_unit": "4"},
        {"material_number": "M1", "storage_location": "PT11", "allocable_stock_qty": 50.0},
        {"material_number": "M1", "storage_location": "PT15", "allocable_stock_qty": 50.0},
        {"material_number": "M1", "plant": "P2", "storage_location": "PT15",
         "allocable_stock_qty": 45.0})
    return orders, stock


def test_pipeline_writes_all_tables_consistently(spark):
    orders, stock = _inputs(spark)
    src = scratch_path(spark, "test-extracts")
    write_csv(orders, f"{src}/orders", ORDER_HEADERS)
    write_csv(stock, f"{src}/stock", STOCK_HEADERS)
    layout = pipeline.Layout(root=scratch_path(spark, "test-tables"))
    res = pipeline.run(spark, f"{src}/orders", f"{src}/stock", layout, run_ts=TS)
    m = res.metrics
    assert len(res.tables) == 9
    for name in ("valid_orders", "exceptions"):  # reference order: raw columns, audit, status
        assert layout.read(spark, "silver", name).columns == [
            *orders.columns, "_ingestion_timestamp", "_source_file", "validation_status", "exception_reason",
            "_processed_timestamp"]
    assert m["sales_orders_raw"] == 7 and m["stock_availability_raw"] == 4
    assert m["valid_orders"] + m["exceptions"] == 6          # ZUCC line dropped
    assert m["allocation_execution_delivery_output"] == m["allocation_output"]
    out = layout.read(spark, "gold", "allocation_output")
    assert out.filter("case_number = 'CASE_2' AND requires_auth").count() == \
        m["order_validation_ticket_pega"]
    assert out.filter("case_number = 'CASE_2'").count() == m["allocation_feasibility_output"]
    # same answers as the in-memory flow
    flow = Flow(orders, stock, TS)
    cols = sorted(out.columns)

    def digest(df):
        lines = sorted("|".join(str(r[c]) for c in cols) for r in df.select(*cols).collect())
        return hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert digest(out) == digest(flow.allocation_output)
    assert pipeline.collect_metrics(spark, layout) == m       # observed == recounted
    sums = {k: v.count() for k, v in pipeline.summaries(spark, layout).items()}
    assert sums["case"] == 3 and sums["exceptions"] == 1


def test_shuffle_join_gives_same_output(spark):
    orders, stock = _inputs(spark)
    src = scratch_path(spark, "test-extracts")
    write_csv(orders, f"{src}/orders", ORDER_HEADERS)
    write_csv(stock, f"{src}/stock", STOCK_HEADERS)
    a = pipeline.Layout(root=scratch_path(spark, "test-a"))
    b = pipeline.Layout(root=scratch_path(spark, "test-b"))
    pipeline.run(spark, f"{src}/orders", f"{src}/stock", a, run_ts=TS)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        pipeline.run(spark, f"{src}/orders", f"{src}/stock", b, run_ts=TS)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    for name in ("allocation_output", "order_validation_ticket_pega"):
        x = sorted(map(tuple, a.read(spark, "gold", name).collect()), key=repr)
        y = sorted(map(tuple, b.read(spark, "gold", name).collect()), key=repr)
        assert x == y


def test_catalog_tables_and_second_run(spark):
    """Databases of the session catalog are created, and a second run replaces
    every table."""
    orders, stock = _inputs(spark)
    src = scratch_path(spark, "test-extracts")
    write_csv(orders, f"{src}/orders", ORDER_HEADERS)
    write_csv(stock, f"{src}/stock", STOCK_HEADERS)
    layout = pipeline.Layout(bronze="t_bronze", silver="t_silver", gold="t_gold")
    try:
        first = pipeline.run(spark, f"{src}/orders", f"{src}/stock", layout, run_ts=TS)
        second = pipeline.run(spark, f"{src}/orders", f"{src}/stock", layout, run_ts="2025-01-01T00:00:00")
        assert first.metrics == second.metrics == pipeline.collect_metrics(spark, layout)
        names = {db: {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect() if not r.isTemporary} for db in ("t_bronze", "t_silver", "t_gold")}
        assert {k: len(v) for k, v in names.items()} == {"t_bronze": 2, "t_silver": 3, "t_gold": 4}
        stamps = spark.table("t_gold.allocation_output").select("_processed_timestamp").distinct().collect()
        assert [r[0] for r in stamps] == ["2025-01-01T00:00:00"]
    finally:
        for db in ("t_bronze", "t_silver", "t_gold"):
            spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_summaries_follow_the_runs_rules_and_are_sorted(spark):
    orders, stock = _inputs(spark)
    src = scratch_path(spark, "test-extracts")
    write_csv(orders, f"{src}/orders", ORDER_HEADERS)
    write_csv(stock, f"{src}/stock", STOCK_HEADERS)
    rules = Rules(customer_alias={"X": "Walmart", "TENTA": "TentA"})
    layout = pipeline.Layout(root=scratch_path(spark, "test-rules"))
    pipeline.run(spark, f"{src}/orders", f"{src}/stock", layout, run_ts=TS, rules=rules)
    got = {k: df.collect() for k, df in pipeline.summaries(spark, layout, rules).items()}
    assert [(r.customer_group, r["count"]) for r in got["customer_group"]] == [("Default", 3), ("TentA", 1), ("Walmart", 1)]
    for name, key in (("location_count", lambda r: r.available_locations_count), ("case", lambda r: r.case_number),
                      ("exceptions", lambda r: (-r["count"], r.exception_reason)),
                      ("dashboard", lambda r: (r.case_number, r.dashboard_status))):
        assert got[name] == sorted(got[name], key=key)


@pytest.mark.parametrize("parts", [1, 200])
def test_results_do_not_depend_on_shuffle_partitions(spark, parts):
    orders, stock = _inputs(spark)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        base = sorted(map(tuple, Flow(orders, stock, TS).tickets.collect()))
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        other = sorted(map(tuple, Flow(orders, stock, TS).tickets.collect()))
        out = Flow(orders, stock, TS).allocation_output.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert base == other and out == 9


def test_cli_runs_all_stages_and_prints_counts(spark, capsys):
    import json
    orders, stock = _inputs(spark)
    src = scratch_path(spark, "test-cli-extracts")
    write_csv(orders, f"{src}/orders", ORDER_HEADERS)
    write_csv(stock, f"{src}/stock", STOCK_HEADERS)
    root = scratch_path(spark, "test-cli-tables")
    pipeline.main(["--orders", f"{src}/orders", "--stock", f"{src}/stock", "--root", root,
                   "--run-ts", TS, "--summaries", "--silver-db", "silver_x"])
    report = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert report["metrics"]["allocation_output"] == 9
    assert report["tables"]["valid_orders"].endswith("silver_x/validated_orders/part=VALID")
    cases = {r["case_number"]: r["count"] for r in report["summaries"]["case"]}
    assert sum(cases.values()) == 8


def test_valid_lines_and_exceptions_come_from_one_scan(spark, monkeypatch):
    """One write makes both tables; the raw orders are scanned once in silver."""
    orders, stock = _inputs(spark)
    src = scratch_path(spark, "test-extracts")
    write_csv(orders, f"{src}/orders", ORDER_HEADERS)
    write_csv(stock, f"{src}/stock", STOCK_HEADERS)
    layout = pipeline.Layout(root=scratch_path(spark, "test-one-pass"))
    result = pipeline.RunResult()
    pipeline.bronze(spark, layout, f"{src}/orders", f"{src}/stock", TS, result=result)
    written = []
    for name in ("write_split", "write_table"):
        original = getattr(pipeline, name)
        monkeypatch.setattr(pipeline, name, lambda df, *a, _f=original, **kw: (written.append(plan_text(df)), _f(df, *a, **kw))[1])
    pipeline.silver(spark, layout, TS, Rules(), result=result)
    assert sum(plan.count("FileScan parquet [sales_order_number") for plan in written) == 1 and len(written) == 2
    flow = Flow(orders, stock, TS)
    cols = [c for c in layout.read(spark, "silver", "exceptions").columns if not c.startswith("_")]
    for name, want in (("valid_orders", flow.valid_orders), ("exceptions", flow.exceptions)):
        got = layout.read(spark, "silver", name)
        direct = spark.read.parquet(result.tables[name])
        assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
        assert got.count() == direct.count() == result.metrics[name] > 0 and direct.columns == got.columns
        assert got.inputFiles() and all("part=" in f for f in got.inputFiles())


@pytest.mark.parametrize("database", [None, "t_split"])
def test_split_write_with_a_status_without_rows(spark, database):
    place = {"database": database} if database else {"root": scratch_path(spark, "split")}
    df = spark.createDataFrame([(1, "a", None), (2, "a", "x")], "k long, s string, t string")
    try:
        for rows in (df, df.withColumn("s", F.lit("b")), df):
            where, counts = write_split(rows, "s", {"first": "a", "second": "b"}, "both", **place)
            read = {n: spark.table(w) if database else spark.read.parquet(w) for n, w in where.items()}
            assert {n: r.count() for n, r in read.items()} == counts
            assert all(r.columns == ["k", "s", "t"] for r in read.values())
        assert counts == {"first": 2, "second": 0}
        with pytest.raises(ValueError):
            write_split(df.withColumn("s", F.lit("c")), "s", {"first": "a", "second": "b"}, "other", **place)
    finally:
        if database:
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_split_write_keeps_its_files_open_instead_of_sorting(spark, monkeypatch):
    df = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("s"))
    writer, before, during = type(df.write), spark.conf.get(OPEN_FILES), []
    save = writer.save
    monkeypatch.setattr(writer, "save", lambda self, *a, **kw: (during.append(int(spark.conf.get(OPEN_FILES))), save(self, *a, **kw))[1])
    where, counts = write_split(df, "s", {"first": "a", "second": "b"}, "open", root=scratch_path(spark, "open"), compression="zstd")
    # Spark sorts a task's rows once as many files are open as it is told at most.
    assert during == [3] and spark.conf.get(OPEN_FILES) == before
    assert counts == {"first": 50, "second": 50}
    assert {r.id for r in spark.read.parquet(where["first"]).collect()} == set(range(0, 100, 2))
    assert all(f.endswith(".zstd.parquet") for w in where.values() for f in spark.read.parquet(w).inputFiles())
