import random

import numpy as np
import pytest

from stockroute.llm import mixing, queries


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        t = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > cap * sizes[s]]
        if not over:
            return fixed | t
        fixed |= {s: cap * sizes[s] for s in over}


def test_mix_meets_targets(spark, frame, saved):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * (200 if i % 3 == 0 else rng.randint(1, 300))),
             "big" if i % 3 == 0 else rng.choice(["a", "é", "𝔘", None, "Z"])) for i in range(900)]
    rows += [(900, None, "a"), (901, "", "a"), (902, "one two", "tiny"), (903, None, "void"), (902, "one two", "tiny"), (None, "x y z", "a")]
    path = saved(documents=frame(rows))
    got = queries.op8_source_mix(spark, path).collect()
    again = queries.op8_source_mix(spark, path).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len(got) == len(rows)
    docs = mixing.mix_sources(spark.read.parquet(path + "/documents.parquet")).collect()
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    for s in sizes:
        mine = [r for r in docs if r.source == s]
        assert all(r.target == pytest.approx(want[s]) and r.source_size == sizes[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= (100 if s == "big" else 2)  # big has texts of 200 words only
    assert all(r.taken <= 3 * r["size"] and r.taken == r.copies * r["size"] for r in docs)
    assert sorted((r["size"], r.taken) for r in docs) == sorted((r["size"], r.taken) for r in got)


@pytest.mark.parametrize("seed", range(30))
def test_knapsack_is_near_and_bounded(seed):
    rng = np.random.default_rng(seed)
    lengths = np.unique(rng.integers(0, 500, rng.integers(1, 60)))
    counts = rng.integers(1, 50, len(lengths))
    total = int((lengths * counts).sum())
    budget = int(rng.integers(0, total + 1))
    take = mixing.fit_counts(lengths.astype(np.int64), counts.astype(np.int64), budget)
    assert ((0 <= take) & (take <= counts)).all()
    reach = 1
    for length, n in zip(lengths, counts):
        for _ in range(int(n)):
            reach |= reach << int(length)
    best = min(abs(s - budget) for s in range(total + 1) if reach >> s & 1)
    assert abs(int((take * lengths).sum()) - budget) <= max(best, min(x for x in lengths if x or len(lengths) == 1))


def test_empty_table(frame):
    assert mixing.mix_sources(frame([(1, "x")]).limit(0)).count() == 0
