import random
import re

import pytest

from stockroute.llm import near_dedup as nd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width, percent=80):
    """Component of every id by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    top = {i: i for i, _ in rows}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, (i, s) in enumerate(sets):
        for j, t in sets[a + 1:]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return {i: find(i) for i, _ in rows}, {i: len(s) for i, s in sets}


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = ["Wort", "wort", "éclair", "x", "yy"] + [f"w{i}" for i in range(200)]
    rows = []
    for g in range(n // 6):
        base = [rng.choice(vocab) for _ in range(rng.randint(1, 120))]
        for c in range(6):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 30]) if len(words) > 10 else 0):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            rows.append((rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    rows += [None, "", " \n", "solo", "SOLO", "a b", "b a", "a b"]
    rng.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed, width", [(1, 2), (2, 5)])
def test_equals_all_pairs(frame, seed, width):
    rows = corpus(seed)
    top, size = brute(rows, width)
    got = {r.doc_id: r for r in nd.near_duplicates(frame(rows), width=width).collect()}
    assert {i: r.n_shingles for i, r in got.items()} == size
    assert {i: r.component_id for i, r in got.items()} == top
    assert all(r.kept == (i == top[i]) for i, r in got.items())


def test_links_through_members_that_are_no_pivot(frame):
    """A chain in which each text is near the next one only."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[12 * i:12 * i + 220])) for i in range(12)]
    top, _ = brute(rows, 2)
    assert {r.doc_id: r.component_id for r in nd.near_duplicates(frame(rows), width=2).collect()} == top
    assert set(top.values()) == {0}


def test_large_group_of_borderline_copies(frame):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(150):
        words = list(base)
        for k in rng.sample(range(150), 4):
            words[k] = f"n{i}x{k}"
        rows.append((i, " ".join(words)))
    top, _ = brute(rows, 2)
    assert {r.doc_id: r.component_id for r in nd.near_duplicates(frame(rows), width=2).collect()} == top


def test_nulls_repeats_and_empty_table(frame):
    docs = frame([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (7, "a b c d"), (9, None)])
    got = sorted(nd.near_duplicates(docs, width=2).collect(), key=str)
    assert [(r.doc_id, r.component_id, r.kept) for r in got if r.doc_id == 5] == [(5, 5, True)] * 2
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert [(r.component_id, r.kept, r.n_shingles) for r in got if r.doc_id == 9] == [(9, True, 0)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id == 7] == [(5, False)]
    assert nd.near_duplicates(docs.limit(0), width=2).count() == 0


def test_template_texts_below_the_threshold(frame, monkeypatch):
    """Many texts of one template, dissimilar but for a few pairs: wide buckets."""
    monkeypatch.setattr(nd, "FEW", 3)
    monkeypatch.setattr(nd, "CELL_MEMBERS", 10)
    monkeypatch.setattr(nd, "CELL_OUTSIDERS", 4)
    rng = random.Random(8)
    rows = []
    for i in range(90):
        own = [f"n{i - i % 2 * (i % 10 == 1)}x{k}" for k in range(14)]
        rows.append((i, " ".join([f"w{k}" for k in range(100)] + own)))
    rows += [(100 + i, " ".join(f"w{k}" for k in range(i, 60 + i))) for i in range(5)]
    top, _ = brute(rows, 2)
    got = {r.doc_id: r.component_id for r in nd.near_duplicates(frame(rows), width=2).collect()}
    assert got == top
