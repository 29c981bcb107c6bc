import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
import pytest

from stockroute.llm import bpe, queries

RAW = open(public_tokenizers.path(queries.RANKS), "rb").read()
ENC = bpe.encoder(RAW, public_tokenizers.PATTERN)


@pytest.mark.parametrize("seed", range(15))
def test_pieces_encode_like_the_whole(seed, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 7)
    rng = random.Random(seed)
    bits = ["a", "Zz", " ", "  ", "\n", "\t", "\r\n", "'s", "'", "1", "é", "𝔘", "\u00a0", "\u2003", "\u0085", "\x1c", "!", "<|endoftext|>", "。", "漢"]
    text = "".join(rng.choice(bits) for _ in range(400))
    assert "".join(bpe.pieces(text)) == text
    assert bpe.encode_text(ENC, text).tolist() == ENC.encode_ordinary(text)


def test_query_digests_and_round_trip(spark, frame, saved):
    texts = [None, "", " ", "Hello world's 12  end \n", "<|endoftext|>", "é漢𝔘" * 50, "word " * 60000, "x" * 30000, " " * 20000, "a\n" * 20000]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[5])]
    got = queries.op6_bpe(spark, saved(documents=frame(rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[5] if r.doc_id is None else texts[r.doc_id] or ""
        ids = ENC.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert queries.op6_bpe(spark, saved(documents=frame(rows).limit(0))).count() == 0


def test_encoder_is_the_library_s():
    ranks = ENC._mergeable_ranks
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert len(ranks) == 50256 and plain.encode_ordinary("some text, 1 2 3") == ENC.encode_ordinary("some text, 1 2 3")


@pytest.mark.parametrize("seed", range(10))
def test_blank_runs_encode_like_the_whole(seed, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_RUN", 3)
    monkeypatch.setattr(bpe, "_RUN", bpe.re.compile(bpe._RUN.pattern.replace("4096", "3")))
    rng = random.Random(seed)
    bits = ["a", " ", " ", "  \n", "\n", "\t", " ", " ", "\u0085", "\x1c", "!", "1", "é"]
    text = "".join(rng.choice(bits) for _ in range(500)) + rng.choice(["", "    "])
    assert "".join(x for x, _ in bpe.blank_runs(text)) == text and any(run for _, run in bpe.blank_runs(text))
    assert bpe.encode_text(ENC, text).tolist() == ENC.encode_ordinary(text)


def test_very_long_runs(spark, frame, saved):
    texts = [" " * 2_000_000, " \n\t " * 500_000 + "x", "x" + "\n" * 1_500_000 + " y", "ab" * 1_000_000, "!" * 2_000_000, "é " * 500_000]
    got = {r.doc_id: r for r in queries.op6_bpe(spark, saved(documents=frame(list(enumerate(texts))))).collect()}
    assert [got[i].decoded_sha256 for i in range(len(texts))] == [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    # A run's ids repeat those that the library gives a shorter one of the same kind.
    short = ENC.encode_ordinary(" " * 20_000)
    assert got[0].n_tokens == 100 * len(short)
