"""The pipeline on a small corpus, stage by stage against plain Python."""

import random

import public_tokenizers
import pytest

import corpus_pipeline
from stockroute.llm import bpe, pii, queries, stages as steps
from test_near_dedup import brute as components
from test_quality import brute as quality_rows


@pytest.fixture(scope="module")
def stages(spark, frame, saved):
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(3000)]
    text = lambda n: "\n".join(" ".join(rng.choice(vocab) for _ in range(rng.randint(3, 12))) for _ in range(n))
    rows = [(i, text(rng.randint(3, 9)), rng.choice(["a", "b", "c", None])) for i in range(150)]
    rows += [(200 + i, rows[i][1], rows[i][2]) for i in range(20)]  # exact copies
    rows += [(300 + i, rows[i][1] + " tail", "b") for i in range(20, 40)]  # near copies
    rows += [(400, None, "a"), (401, "too short", "a"), (402, "spam " * 60, "b"), (rows[60][0], rows[60][1], rows[60][2])]
    rows += [(500, text(4) + "\nmail me: jo.doe@example.org or +1 (234) 555-0100", "c")]
    path = saved(documents=frame(rows))
    docs = spark.read.parquet(path + "/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        at = saved(**{"documents": stage(spark, out[-1], path)})
        out.append(spark.read.parquet(at + "/documents.parquet"))
    return path, rows, out


def test_shape(stages):
    _, _, out = stages
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "pii_redaction", "source_mix", "bpe"]
    for df in out[1:-1]:
        assert df.dtypes == out[0].dtypes


def test_quality_stage(stages):
    _, rows, out = stages
    want = sorted(i for (i, _, _), r in zip(rows, quality_rows(rows)[0]) if r[-1])
    assert sorted(r.doc_id for r in out[1].collect()) == want
    assert all(r.n_chars == len(r.text) for r in out[1].collect())


def test_near_dedup_stage(stages):
    _, _, out = stages
    given = sorted({(r.doc_id, r.text) for r in out[1].collect()})
    top, _ = components(given, 5)
    assert sorted(r.doc_id for r in out[2].collect()) == sorted(set(top.values()))


def test_redaction_stage(stages):
    _, _, out = stages
    before = {r.doc_id: r.text for r in out[2].collect()}
    after = {r.doc_id: r.text for r in out[3].collect()}
    assert before.keys() == after.keys()
    assert after[500].endswith("mail me: [EMAIL] or [PHONE]")
    assert all(after[i] == before[i] for i in before if not pii.base_spans(before[i]) and not pii.candidates(before[i]))


def test_mix_stage(stages):
    _, _, out = stages
    size = {}
    for r in out[3].collect():
        size.setdefault(r.source, []).append(len(r.text.split()))
    taken, times = {}, {}
    for r in out[4].collect():
        taken[r.source] = taken.get(r.source, 0) + len(r.text.split())
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    total = sum(map(sum, size.values()))
    for k, s in enumerate(["a", "b", "c", None]):
        goal = total * (1, 2, 3, 1)[k] / 7
        assert goal <= 3 * sum(size[s]) and abs(taken[s] - goal) <= 3
    assert max(times.values()) <= 3


def test_tokens_and_whole_run(spark, stages):
    path, _, out = stages
    enc = bpe.encoder(open(public_tokenizers.path(queries.RANKS), "rb").read(), public_tokenizers.PATTERN)
    texts = sorted((r.doc_id, r.text) for r in out[4].collect())
    got = sorted((r.doc_id, enc.decode_bytes(memoryview(r.token_ids).cast("I").tolist()).decode(), r.n_tokens, r.round_trip) for r in out[5].collect())
    assert [(i, t) for i, t, _, _ in got] == texts and all(ok for *_, ok in got)
    run = corpus_pipeline.run(spark, path).collect()
    assert sorted((r.doc_id, bytes(r.token_ids)) for r in run) == sorted((r.doc_id, bytes(r.token_ids)) for r in out[5].collect())


def test_empty_documents(spark, frame, saved):
    path = saved(documents=frame([(1, "x")]).limit(0))
    assert corpus_pipeline.run(spark, path).count() == 0


def test_rows_that_share_an_id_but_not_the_text(spark, frame):
    rng = random.Random(21)
    a, b, c, d, e = (" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(5))
    rows = [(1, a), (5, a + " tail"), (5, b), (6, c), (6, d), (6, d), (7, d + " tail"), (8, b), (4, a), (9, e), (None, e), (None, e), (10, ""), (11, None)]
    got = sorted(((r.doc_id, r.text) for r in steps.near_duplicates(spark, frame(rows), "").collect()), key=str)
    assert got == sorted([(1, a), (5, b), (6, c), (6, d), (9, e), (None, e), (None, e), (10, ""), (11, None)], key=str)
