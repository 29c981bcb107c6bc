"""Byte-level BPE with the tiktoken library and a rank file on local disk.

Long texts are cut where the split pattern must begin a new match anyway
(before a blank that follows a non-blank), so pieces encode to the same ids as
the whole text. A long blank run, which the library's regular expression cannot
take, is merged as the one match that it is. Ids travel as little-endian unsigned 32-bit integers; decoding
works on raw bytes and never on characters.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: A rank file is broadcast whole, so its size is checked before that.
MAX_RANK_BYTES = 64_000_000
PIECE_CHARS = 1 << 15

# No match of a pattern that separates blanks from other characters can span
# from a non-blank to a following space or line feed.
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
# Blank runs this long (the characters of Unicode's White_Space) do not go through the pattern.
LONG_RUN = 4096
_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)
_BLANKS = r"\s+(?!\S)|\s+"
_ENCODERS: dict[str, tiktoken.Encoding] = {}


def rank_file(spark: SparkSession, path: str) -> Broadcast:
    """The rank file's bytes, read on the driver and broadcast (size checked)."""
    with open(path, "rb") as f:
        raw = f.read(MAX_RANK_BYTES + 1)
    if len(raw) > MAX_RANK_BYTES:
        raise ValueError("rank file above MAX_RANK_BYTES")
    return spark.sparkContext.broadcast(raw)


def encoder(raw: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, made once per Python worker; no special tokens."""
    key = hashlib.sha256(raw + pattern.encode()).hexdigest()
    if key not in _ENCODERS:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}
        _ENCODERS[key] = tiktoken.Encoding(key[:16], pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of about ``PIECE_CHARS``, cut only at safe boundaries;
    a stretch without one stays whole."""
    start = 0
    while len(text) - start > PIECE_CHARS:
        cut = _SAFE.search(text, start + PIECE_CHARS)
        if not cut:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def blank_runs(text: str) -> Iterator[tuple[str, bool]]:
    """The text in parts, and whether a part is one match of ``\\s+(?!\\S)``: a long
    blank run, but for its last blank if more follows (that one belongs to what
    follows). No match spans from a non-blank to a blank, so both cuts are safe."""
    start = 0
    for run in _RUN.finditer(text):
        end = run.end() - (run.end() < len(text))
        yield text[start:run.start()], False
        yield text[run.start():end], True
        start = end
    yield text[start:], False


def encode_text(enc: tiktoken.Encoding, text: str) -> np.ndarray:
    parts = [np.zeros(0, dtype="<u4")]
    # Patterns without the two blank alternatives at their end are the library's alone.
    for part, run in blank_runs(text) if enc._pat_str.endswith(_BLANKS) else [(text, False)]:
        if run:
            parts.append(np.asarray(enc._encode_single_piece(part), dtype="<u4"))
        else:
            parts += [np.asarray(enc.encode_ordinary(piece), dtype="<u4") for piece in pieces(part)]
    return np.concatenate(parts)


def encode(text: Column, ranks: Broadcast, pattern: str) -> Column:
    """Token ids of a text column as binary (4 little-endian bytes an id).
    Null and empty texts give empty binary; rows are independent. Texts are
    encoded whole, also very long ones and such of one long run."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        enc = encoder(ranks.value, pattern)
        return pa.array((encode_text(enc, t.as_py() or "").tobytes() for t in texts), pa.binary())

    return run(text)


def decode(ids: Column, ranks: Broadcast, pattern: str) -> Column:
    """The bytes that ids (binary as from :func:`encode`) stand for; null gives
    empty binary."""

    @F.arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        enc = encoder(ranks.value, pattern)
        return pa.array((enc.decode_bytes(np.frombuffer(x.as_py() or b"", dtype="<u4").tolist())
                         for x in column), pa.binary())

    return run(ids)
