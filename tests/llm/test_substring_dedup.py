import hashlib
import random
import re

import pytest

from stockroute.llm import queries, substring_dedup as sd

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width=20):
    """Kept words of every row by a dictionary of first windows."""
    words = [(1 << 63 if i is None else i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - width + 1):
            key = tuple(w[s:s + width])
            first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - width + 1):
            if first[tuple(w[s:s + width])] < (i, s):
                gone.update(range(s, s + width))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["é", "𝔘x", "The", "the"]
    passages = [[rng.choice(vocab) for _ in range(rng.choice([19, 20, 21, 35, 80]))] for _ in range(8)]
    rows = []
    for _ in range(n):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [rng.choice(vocab) for _ in range(rng.randint(0, 40))] + rng.choice(passages)
        rows.append(rng.choice([" ", "\n", " \t"]).join(w))
    rows += [None, "", " ", "a " * 70, "a " * 19, " ".join(passages[4]), rows[3], rows[3], "x y " * 30]
    ids = rng.sample(range(1000), len(rows))
    return list(zip(ids, rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, frame, saved, seed):
    rows = corpus(seed)
    want = {i: w for (i, _), w in zip(rows, brute(rows))}
    got = queries.op10_substring_dedup(spark, saved(documents=frame(rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        n, gone, kept = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())


def test_nulls_repeated_ids_and_empty_table(frame):
    base = " ".join(f"w{i}" for i in range(30))
    rows = [(5, base), (5, base), (5, "x " + base), (None, base), (None, base), (2, "q"), (9, base + " tail")]
    want = sorted((str(i), *w) for (i, _), w in zip(rows, brute(rows)))
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_text) for r in sd.remove_repeats(frame(rows)).collect())
    assert got == want
    assert sd.remove_repeats(frame(rows).limit(0)).count() == 0


def test_long_text(frame):
    rng = random.Random(4)
    w = [f"w{rng.randrange(5000)}" for _ in range(60000)]
    rows = [(1, " ".join(w)), (2, " ".join(w[30000:30500] + ["z"] + w[:100])), (3, " ".join(["same"] * 30000))]
    want = {i: b for (i, _), b in zip(rows, brute(rows))}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in sd.remove_repeats(frame(rows)).collect()} == want
