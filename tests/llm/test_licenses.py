import random
import re
import time

import pytest
from pyspark.sql import functions as F

from stockroute.llm import licenses, queries
from stockroute.llm.oracle import template_pattern

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def folded(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    """The query's columns by slices of the word list and regular expressions."""
    words = folded(text)
    base = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    joined = f" {' '.join(words)} "
    more = {label for label, t in licenses.TEMPLATES if re.search(template_pattern(t), joined)}
    places = [p for p, _ in base]
    names = {label for _, label in base}
    return (len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(names)),
            ",".join(sorted(names | more)), 1.0 if more else 0.5 if base else 0.0)


def plain(template, rng):
    """A text that the template accepts: optional regions in or out, some words for
    replaceable ones."""
    while (m := re.search(r"\[\[((?:(?!\[\[|\]\]).)*)\]\]", template, re.S)):
        template = template[:m.start()] + (m[1] if rng.random() < 0.5 else "") + template[m.end():]
    fill = lambda m: " ".join(rng.choice(["Ünal", "the", "ACME", "x9"]) for _ in range(rng.randint(int(m[1]), int(m[2]))))
    return re.sub(r"<<(\d+)\.\.(\d+)>>", fill, template)


def texts():
    rng = random.Random(3)
    out = [None, "", " \n", "mit license mit LICENSE", "MIT-License, apache\tlicense", "the mit  licenses", "General Public License " * 3,
           "é mit license é", "under the terms of the mit license", "under the term of the mit license", "Licensed under CC BY-NC 4.0.",
           "Licensed under the Apache License, Version 2.0.", "work is licensed under the GNU General Public License, version 3.", "İ MIT LICENSE ß"]
    for label, t in licenses.TEMPLATES:
        whole = plain(t, rng)
        words = whole.split()
        out += [f"Some code.\n{whole}\nMore of it.", whole.upper(), " ".join(words[:-1]), " ".join(words[:1] + ["not"] + words[1:]), "x " + whole * 2]
    return out + out[3:6] + ["mit license " * 30000 + "under the mit license"]


def test_equals_slices_and_regular_expressions(spark, frame, saved):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "mit license"), (3, "mit license")]
    want = sorted((str(i), *brute(t)) for i, t in rows)
    assert len({w[-2] for w in want}) > 12
    got = queries.op11_license_scan(spark, saved(documents=frame(rows))).collect()
    cols = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert sorted((str(r.doc_id), *(r[c] for c in cols)) for r in got) == want


def test_spans_and_own_templates(spark, frame):
    found = licenses.scan_licenses(F.col("text"), {"a b": "ab"}, [("t", "one [[two [[three]]]] <<0..2>> end"), ("u", "one")])
    rows = {r.doc_id: r.x for r in frame([(1, "one two three x end a b a b"), (2, "one three three end end"), (3, "one x y z end"), (4, "zero")])
            .select("doc_id", found.alias("x")).collect()}
    spans = {i: [tuple(s) for s in x.found] for i, x in rows.items()}
    assert spans == {1: [(0, 1, "u"), (0, 5, "t")], 2: [(0, 1, "u"), (0, 4, "t")], 3: [(0, 1, "u")], 4: []}
    assert [tuple(b) for b in rows[1].base] == [(5, "ab"), (7, "ab")]


@pytest.mark.parametrize("bad", ["[[a]] b", "<<0..2>> b", "a ]] b", "a [[ b", ""])
def test_templates_that_are_refused(bad):
    with pytest.raises(ValueError):
        licenses.Automaton(bad)


def test_long_texts_take_linear_time():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    began = time.time()
    n, base, found = scanner.scan("under the terms of the " * 200_000 + "mit license " * 100_000)
    assert n == 1_200_000 and len(base) == 100_000 and found and time.time() - began < 30


def test_empty_table_and_other_columns(spark, frame, saved):
    assert queries.op11_license_scan(spark, saved(documents=frame([]))).collect() == []
    named = frame([(1, "mit license")]).withColumn("n_words", F.lit("x")).withColumn("x", F.lit(0)).withColumn("labels", F.lit(1))
    row = queries.op11_license_scan(spark, saved(documents=named)).first()
    assert (row.n_words, row.labels) == (2, "mit")
