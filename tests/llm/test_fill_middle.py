import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockroute.llm import fill_middle, queries

UNIT = re.compile("[ \x09-\x0D]*[^ \x09-\x0D]+|[ \x09-\x0D]+")
sha = lambda x: hashlib.sha256(x.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units, digest = UNIT.findall(text), sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, sha(text), sha(text)
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)
    return len(units), "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)


def texts():
    rng = random.Random(5)
    signs = ["a", "é", "𝔘", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1f", "\x0e", "\x08", "\x00", " ", "　", "<P", "<", "M>", "S>"]
    out = [None, "", " ", "\n\n", "x", " x", "x ", "<P>", "a <S> b", "<M", "a<M>", "<<S", "word " * 40_000, " " * 300_000, "é" * 300_000 + " x"]
    return out + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 40))) for _ in range(400)]


def test_equals_brute_force(spark, frame, saved):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "one two three"), (None, None), (20, "one two"), (20, "one two")]
    want = sorted((str(i), *map(str, brute(i, t))) for i, t in rows)
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    cols = ["n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    got = queries.op12_fill_middle(spark, saved(documents=frame(rows))).collect()
    assert sorted((str(r.doc_id), *(str(r[c]) for c in cols)) for r in got) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é𝔘\n\t\x0e\x08\x1f", max_size=30), max_size=8), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_cut_places(texts, x, y):
    n, p, m = fill_middle.cut_places(pa.array(texts, pa.string()), np.full(len(texts), x), np.full(len(texts), y))
    for i, text in enumerate(texts):
        units = UNIT.findall(text)
        a, b = sorted((x % (len(units) + 1), y % (len(units) + 1)))
        assert (n[i], p[i], m[i]) == (len(units), len("".join(units[:a])), len("".join(units[a:b])))


def test_every_byte_is_classed_as_its_value_says():
    data = np.arange(256, dtype=np.uint8)
    marks = fill_middle.gap_marks(fill_middle.packed(data)).view(np.uint8)[:256]
    assert [int(x) for x in np.flatnonzero(marks)] == [9, 10, 11, 12, 13, 32]
    starts = fill_middle.char_marks(fill_middle.packed(data)).view(np.uint8)[:256]
    assert [int(x) for x in np.flatnonzero(starts == 0)] == list(range(128, 192))


def test_rates_names_and_empty_tables(spark, frame):
    docs = frame([(i, f"t{i} of some words") for i in range(400)]).withColumn("n", F.lit("x")).withColumn("cut", F.lit(7)).withColumn("row", F.lit(8))
    made = fill_middle.fill_in_middle(docs, percent=100, suffix_first=0)
    assert made.columns == ["doc_id", "text", "lang", "source", "n_chars", "cut", "row", "n", "form", "prefix_chars", "middle_chars", "output"]
    rows = made.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    assert {r.form for r in rows} == {"psm"} and all(r.back == r.text and r.cut == 7 and r.row == 8 and r.n == 4 for r in rows)
    assert len({r.prefix_chars for r in rows}) > 3
    assert fill_middle.fill_in_middle(frame([])).collect() == []
    assert {r.form for r in fill_middle.fill_in_middle(docs, percent=0).collect()} == {"plain"}
