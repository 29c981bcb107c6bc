from helpers import orders_df, stock_df, plan_text

from stockroute.operators import ticket_ids as ids
from stockroute.operators.products import TICKET_ORDER
from stockroute.plans import pipeline
from stockroute.schemas import ORDER_HEADERS, STOCK_HEADERS
from stockroute.sources import csv as csv_source
from stockroute.sources.tables import read_table, write_table

DDL = ", ".join(f"{c} string" for c in TICKET_ORDER)


def _lines(spark, *orders):
    return spark.createDataFrame([(o, "1", "M", "P", "PT11", "why", "PT12") for o in orders], DDL)


def _run(spark, root, lines, partitions=3):
    if not _run.known.get(root):
        write_table(ids.empty_register(spark), "register", root=root)
        _run.known[root] = True
    write_table(ids.new_entries(lines, read_table(spark, "register", root=root), partitions), "register", root=root, append=True)
    got = ids.numbered(lines, read_table(spark, "register", root=root))
    return {(r.sales_order_number, r[ids.COPY]): r[ids.NUMBER] for r in got.collect()}


_run.known = {}


def test_known_lines_keep_their_numbers(spark, tmp_path):
    root = str(tmp_path)
    first = _run(spark, root, _lines(spark, "b", "d", "d", None))
    assert first == {(None, 1): 0, ("b", 1): 1, ("d", 1): 2, ("d", 2): 3}
    second = _run(spark, root, _lines(spark, "a", "d", "d", "d", "c", None))
    assert second == {(None, 1): 0, ("d", 1): 2, ("d", 2): 3, ("a", 1): 4, ("c", 1): 5, ("d", 3): 6}
    # "b" was away for a run; running again gives nothing out anew.
    assert _run(spark, root, _lines(spark, "b", "a", "d")) == {("b", 1): 1, ("a", 1): 4, ("d", 1): 2}
    assert read_table(spark, "register", root=root).count() == 7
    assert _run(spark, root, _lines(spark, "b").limit(0)) == {}


def test_copies_of_one_line_spread_by_copy(spark, tmp_path):
    lines = _lines(spark, *["hot"] * 2000, *map(str, range(50)))
    got = _run(spark, str(tmp_path), lines, 8)
    assert sorted(got.values()) == list(range(2050))
    assert [got[("hot", i)] for i in range(1, 2001)] == list(range(50, 2050))
    plan = plan_text(ids.copies(lines))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan


def test_pipeline_reruns_keep_ids(spark, tmp_path):
    layout = pipeline.Layout(root=str(tmp_path / "out"), carry_tickets=True)
    csv_source.write_csv(stock_df(spark, {"storage_location": "PT11", "available_stock_qty": 50.0, "allocable_stock_qty": 50.0},
                                  {"storage_location": "PT15", "available_stock_qty": 50.0, "allocable_stock_qty": 50.0}),
                         str(tmp_path / "stock"), STOCK_HEADERS)
    seen = []
    for i, orders in enumerate((["5", "7"], ["5", "7"], ["1", "5", "6", "7"])):
        frame = orders_df(spark, *[{"sales_order_number": o, "customer_name": c} for o in orders for c in ("Walmart", "Cencosud", "DMart", "Tottus")])
        csv_source.write_csv(frame, str(tmp_path / f"orders{i}"), ORDER_HEADERS)
        pipeline.run(spark, str(tmp_path / f"orders{i}"), str(tmp_path / "stock"), layout, run_ts="T")
        table = layout.read(spark, "gold", "order_validation_ticket_pega").collect()
        seen.append(sorted((r.ticket_id, r.sales_order_number_line_items) for r in table))
    assert seen[0] and seen[0] == seen[1] and set(seen[0]) < set(seen[2])
    assert len({i for i, _ in seen[2]}) == len(seen[2]) == 2 * len(seen[0])
    assert min(i for i, _ in set(seen[2]) - set(seen[0])) > max(i for i, _ in seen[0])


def test_carried_tickets_are_allocated_once(spark):
    from stockroute.plans import catalog

    plan = plan_text(catalog.tickets_carried(spark, "/root/testdata/sf0.001"))
    assert "l_orderkey" not in plan
