import bz2
import itertools
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stockroute.sources import csv as csv_source
from stockroute.sources import csv_split


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _cell(rng):
    text = "".join(rng.choice(["a", "b ", "\n", '""', ",", "ü", "\n\n", "xyz"]) for _ in range(rng.randint(0, 12)))
    return f'"{text}"' if rng.random() < 0.6 else rng.choice(["", "plain", '5" pipe', "x y", "12", 'a"b"c'])


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_equals_multiline_over_many_splits(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    for name in ("one", "two"):
        rows = [f"{i},{_cell(rng)},{_cell(rng)},end{i}" for i in range(400)]
        (tmp_path / f"{name}.csv").write_text("﻿id,first,second,last\n" + "\n".join(rows) + "\n", encoding="utf-8", newline="")
    got = csv_split.read_csv_split(spark, str(tmp_path))
    assert csv_split._lines(spark, str(tmp_path)).select("_file", "_split").distinct().count() > 10
    want = csv_source.read_csv(spark, str(tmp_path), multi_line=True)
    assert got.columns == want.columns == ["id", "first", "second", "last"]
    assert _rows(got) == _rows(want) and got.count() == 800


def test_one_record_over_several_splits(spark, tmp_path, small_splits):
    body = "\n".join("line %d of the note, with a comma" % i for i in range(200))
    (tmp_path / "a.csv").write_text(f'id,note\n1,"{body}"\n2,short\n3,"{body}"\n', newline="")
    rows = {r.id: r.note for r in csv_split.read_csv_split(spark, str(tmp_path)).collect()}
    assert rows == {"1": body, "2": "short", "3": body}


def test_line_ends_blank_lines_and_files_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,note\r\n1,x\r\n\r\n2,"y"\r\n3,')
    (tmp_path / "b.csv").write_bytes(b"id,note\r\n")
    got = csv_split.read_csv_split(spark, str(tmp_path), with_file=True)
    assert sorted((r.id, r.note) for r in got.collect()) == [("1", "x"), ("2", "y"), ("3", None)]
    assert got.select("_file").first()[0].endswith("a.csv")


def test_another_header_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n1,x\n")
    (tmp_path / "b.csv").write_text("note,id\nx,1\n")
    with pytest.raises(Exception, match="another header"):
        csv_split.read_csv_split(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("line, after", [
    ("a,b", (0, 1)), ('"a', (1, 0)), ('a"', (0, 0)), ('a,"b', (1, 0)), ('"a","b', (1, 1)), ('""', (0, 1)), ('x"",y', (0, 1)),
    ('"a",b', (0, 0)), ('b",c', (0, 0)), ('b","c', (1, 1)), ('5" pipe,x', (0, 0)), ('"a""', (1, 0)),
])
def test_line_effect(spark, line, after):
    outside, inside = csv_split.line_effect(F.col("line"))
    (row,) = spark.createDataFrame([(line,)], "line string").select(outside, inside).collect()
    assert tuple(row) == after


def test_line_effect_of_every_short_line(spark):
    def ends(line, state):
        for c in line.replace('""', ""):
            if state == "in":
                state = "closed" if c == '"' else "in"
            elif c == ",":
                state = "start"
            elif state == "start":
                state = "in" if c == '"' else "text"
        return int(state == "in")

    lines = ["".join(x) for n in range(8) for x in itertools.product('a,"', repeat=n)]
    outside, inside = csv_split.line_effect(F.col("line"))
    got = spark.createDataFrame([(x,) for x in lines], "line string").select("line", outside, inside).collect()
    assert [tuple(r) for r in got if tuple(r)[1:] != (ends(r.line, "start"), ends(r.line, "in"))] == []


@pytest.mark.parametrize("size", ["7000", "31000"])
def test_bzip2_files_are_read_in_byte_ranges(spark, tmp_path, small_splits, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    rng = random.Random(1)
    rows = [f"{i},{_cell(rng)},{_cell(rng)},end{i}" for i in range(40_000)]
    text = ("id,first,second,last\n" + "\n".join(rows) + "\n").encode()
    for kind, content in (("bz2", bz2.compress(text, 1)), ("plain", text)):  # level 1: a block each 100 KB of text
        (tmp_path / kind).mkdir()
        (tmp_path / kind / ("a.csv" + ".bz2" * (kind == "bz2"))).write_bytes(content)
    assert csv_split._lines(spark, str(tmp_path / "bz2")).select("_split").distinct().count() > 5
    got = csv_split.read_csv_split(spark, str(tmp_path / "bz2"))
    want = csv_source.read_csv(spark, str(tmp_path / "plain"), multi_line=True)
    assert _rows(got) == _rows(want) and got.count() == 40_000


def test_query_stores_its_extract_compressed(spark, tmp_path, monkeypatch):
    from stockroute.plans import catalog, fixtures

    from helpers import orders_df
    orders = orders_df(spark, *[{"sales_order_number": str(i), "material_description": f"part {i % 50}"} for i in range(3000)])
    monkeypatch.setattr(fixtures, "fx_orders", lambda spark, sf_dir: orders)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, label: str(tmp_path / label))
    got = catalog.scan_multiline_split(spark, "none")
    want = orders.withColumn("material_description", F.concat("material_description", F.lit('\n"checked", by hand\n'), "sales_order_number"))
    assert _rows(got) == _rows(want.select(*got.columns))
    stored = [f.read_bytes() for f in Path(tmp_path, "split-csv").glob("part-*")]
    text = b"".join(bz2.decompress(b) if b[:3] == b"BZh" else b for b in stored)
    assert text.count(b"by hand") == 3000 and 4 * sum(map(len, stored)) < len(text)


def test_pipeline_reads_split_files(spark, tmp_path, small_splits):
    from stockroute.plans import pipeline
    from stockroute.schemas import ORDER_HEADERS, STOCK_HEADERS

    from helpers import orders_df, stock_df
    orders = orders_df(spark, *[{"sales_order_number": str(i), "material_description": f"one\ntwo, \"{i}\""} for i in range(60)])
    csv_source.write_csv(orders.coalesce(1), str(tmp_path / "orders"), ORDER_HEADERS)
    csv_source.write_csv(stock_df(spark, {"available_stock_qty": 50.0}), str(tmp_path / "stock"), STOCK_HEADERS)
    layout = pipeline.Layout(root=str(tmp_path / "out"))
    result = pipeline.run(spark, str(tmp_path / "orders"), str(tmp_path / "stock"), layout, run_ts="T", split_multi_line=True)
    assert result.metrics["sales_orders_raw"] == result.metrics["valid_orders"] == 60
    stored = layout.read(spark, "bronze", "sales_orders_raw")
    assert {r.material_description for r in stored.collect()} == {f'one\ntwo, "{i}"' for i in range(60)}


def test_lines_are_neither_shuffled_nor_sorted(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"x\ny"\n2,z\n')
    plan = csv_split.records(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("MapInArrow _whole_records"):]
    assert "Window" not in below[:below.index("Join LeftOuter")] and "rightHint=(strategy=broadcast)" in below


@pytest.mark.parametrize("seed", range(3))
def test_records_of_a_split_whatever_the_runs(seed):
    import numpy as np
    import pyarrow as pa

    rng = random.Random(seed)
    effects = [rng.choice([(0, 1), (0, 1), (1, 0), (0, 0), (1, 1)]) for _ in range(200)]
    texts = [b"%d" % i for i in range(200)]
    for before in (0, 1):
        state, pieces, starts = before, [[]] if before else [], before == 0
        for text, effect in zip(texts, effects):
            if state == 0:
                pieces.append([])
            pieces[-1].append(text)
            state = effect[state]
        pieces = [b"\n".join(p) for p in pieces]
        head = pieces.pop(0) if before else None
        tail = pieces.pop() if state and pieces else None
        cutter, got, at = csv_split._Cutter(before), [], 0
        while at < 200:
            n = rng.randint(1, 9)
            o, i = (np.array([e[k] for e in effects[at:at + n]], dtype=np.int32) for k in (0, 1))
            got += [t for a in cutter.add(pa.array(texts[at:at + n], pa.binary()), o, i) for t in a.to_pylist()]
            at += n
        assert got == pieces and cutter.ends() == (head, tail) and cutter.cut == len(got) and cutter.state == state
