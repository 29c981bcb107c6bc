import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockroute.llm import lexical, queries

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, t, Counter(t)) for i, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t, _ in held)
    df = Counter(w for _, _, c in held for w in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, words, counts in held:
            m = 25 + 75 * len(words) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * counts[w] // (1000 * counts[w] + 8 * m))
                        for w in terms(text) if counts[w])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc, score))
        out += [(str(item), r, str(x[3]), x[4]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out)


def corpus():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(150)] + ["É", "ünal", "x9", "THE", "the", "𝔘"]
    weight = [1 / (i + 1) for i in range(len(vocabulary))]
    line = lambda n: " ".join(rng.choices(vocabulary, weight, k=n))
    docs = [(i, line(rng.randint(1, 60))) for i in range(300)]
    same = line(30)
    docs += [(1000 + i, same) for i in range(40)] + [(1000, same), (None, same), (None, None), (2000, None), (2001, ""), (2002, "-- !?"),
             (2003, "w1 " * 50_000 + "rare"), (2004, "[the]_the`THE{the}"), (5, docs[5][1])]
    items = [(i, line(rng.randint(1, 90))) for i in range(25)] + [(100, same), (101, None), (102, ""), (103, "nowhere found"), (104, "?!"),
             (105, "rare rare w1"), (None, "w3 w4"), (3, "x9 x9"), (100, same), (106, " ".join(vocabulary) + " w1 w2")]
    return docs, items


@pytest.mark.parametrize("block", [lexical.BLOCK_BYTES, 4000])
def test_equals_scoring_every_document(spark, frame, saved, monkeypatch, block):
    docs, items = corpus()
    monkeypatch.setattr(lexical.rank_documents, "__defaults__", (*lexical.rank_documents.__defaults__[:-1], block))
    path = saved(documents=frame(docs), benchmark=spark.createDataFrame(items, "item_id long, text string"))
    got = queries.op13_ranked_search(spark, path).collect()
    assert sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score) for r in got) == brute(docs, items)


def test_empty_tables_and_clashing_names(spark, frame, saved):
    items = spark.createDataFrame([(1, "w1", 5, 6)], "item_id long, text string, id int, rank int")
    none = spark.createDataFrame([], "item_id long, text string")
    assert queries.op13_ranked_search(spark, saved(documents=frame([]), benchmark=items)).collect() == []
    docs = frame([(1, "w1"), (2, "w2")]).withColumn("item_id", F.lit(9)).withColumn("score", F.lit("x")).withColumn("n", F.lit(0))
    assert queries.op13_ranked_search(spark, saved(documents=docs, benchmark=none)).collect() == []
    assert [tuple(r) for r in queries.op13_ranked_search(spark, saved(documents=docs, benchmark=items)).collect()] == \
        [tuple(x) for x in [(1, 1, 1, brute([(1, "w1"), (2, "w2")], [(1, "w1")])[0][3])]]


def index_batch(rng, docs, vocabulary):
    held = [np.sort(rng.choice(vocabulary, rng.integers(0, 30), replace=False)) for _ in range(docs)]
    return pa.RecordBatch.from_arrays([
        pa.array(np.arange(docs)), pa.array(rng.integers(30, 200, docs)), pa.array([h.tolist() for h in held], pa.list_(pa.int32())),
        pa.array([rng.integers(1, 4, len(h)).tolist() for h in held], pa.list_(pa.int32()))], ["id", "n", "terms", "tfs"])


def test_groups_are_left_out_only_when_they_cannot_win():
    rng = np.random.default_rng(1)
    batch = index_batch(rng, 4000, 400)
    postings = lexical.Postings(batch, 4000, 400_000)
    value = rng.integers(1, 9000, 70)
    wanted, gain, best = rng.choice(400, 70, replace=False), np.zeros(400, dtype=np.int64), lexical.Best(10)
    scored = lexical.search(postings, wanted, value, gain, best)
    gain[wanted] = value
    every = postings.scores(np.arange(4000), gain)
    order = np.lexsort((np.arange(4000), -every))[:10]
    assert best.id.tolist() == order.tolist() and best.score.tolist() == every[order].tolist()
    assert scored < 2000


def test_length_part_beyond_64_bits():
    n = np.array([5, 10**12])
    assert lexical.length_parts(n, 10**9, 10**13).tolist() == [25 + 75 * 5 * 10**9 // 10**13, 25 + 75 * 10**12 * 10**9 // 10**13]
