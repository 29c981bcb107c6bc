"""Fill-in-middle transformation of texts, cut at white-space-led units.

A unit is a run of words' white space with the word after it, or the white space
that ends the text. Units are found on UTF-8 taken eight bytes at a time as
unsigned 64-bit words: arithmetic inside a word marks the high bit of every byte
that ends a unit, ``bitwise_count`` counts the marks of each word, a search over
the running counts finds the word of the k-th unit's end and a prefix sum inside
that word its byte. Only the cut places leave Python; texts are cut and joined by
Spark's own string functions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import SLICE_BYTES, text_buffers

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_1, _3, _7, _8, _56 = (np.uint64(x) for x in (1, 3, 7, 8, 56))


def packed(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian 64-bit words, zero-filled, at least one byte longer."""
    words = np.zeros(len(data) // 8 + 1, dtype="<u8")
    words.view(np.uint8)[:len(data)] = data
    return words


def gap_marks(words: np.ndarray) -> np.ndarray:
    """High bit of every byte that is a space or 0x09-0x0D; no carry leaves a byte."""
    low = words & _LOW7
    space = ~((low ^ (np.uint64(0x20) * _ONES)) + _LOW7)
    from_tab = low + np.uint64(0x80 - 0x09) * _ONES
    past_return = low + np.uint64(0x80 - 0x0E) * _ONES
    return (space | (from_tab & ~past_return)) & ~words & _HIGH


def unit_marks(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """High bit of every byte that ends a unit: one that is not white space before
    one that is, and the last byte of each text (text ``i`` has the bytes
    ``at[i]`` to ``at[i + 1]``)."""
    gaps = gap_marks(words)
    following = gaps >> _8
    following[:-1] |= gaps[1:] << _56
    marks = ~gaps & following & _HIGH
    last = (at[1:][at[1:] > at[:-1]] - 1).astype(np.uint64)
    np.bitwise_or.at(marks, (last >> _3).astype(np.int64), np.uint64(0x80) << ((last & _7) << _3))
    return marks


def char_marks(words: np.ndarray) -> np.ndarray:
    """High bit of every byte that begins a code point."""
    return ~(words & ~(words << _1)) & _HIGH


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.before = np.zeros(len(marks) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.before[1:], dtype=np.int64)

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Marks at bytes before ``place``."""
        word, byte = place >> 3, (place & 7).astype(np.uint64)
        below = (_1 << (byte << _3)) - _1
        return self.before[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte of the k-th mark (from 1)."""
        word = np.searchsorted(self.before, k, side="left") - 1
        within = (k - self.before[word]).astype(np.uint64)
        upto = (self.marks[word] >> _7) * _ONES  # marks up to each byte of the word
        reached = ((upto | _HIGH) - within * _ONES) & _HIGH
        return word * 8 + 8 - np.bitwise_count(reached).astype(np.int64)


def slices(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``SLICE_BYTES``; a longer text is alone."""
    first, n = 0, len(ends) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SLICE_BYTES, "right")) - 1)
        yield first, last
        first = last


def cut_places(texts: pa.Array, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text its number of units, and the code points before the first cut
    and between both; cuts are after ``one % (n + 1)`` and ``two % (n + 1)`` units."""
    raw, ends = text_buffers(texts)
    out = np.zeros((3, len(texts)), dtype=np.int64)
    for first, last in slices(ends):
        at = ends[first:last + 1] - ends[first]
        words = packed(raw[ends[first]:ends[last]])
        units, chars = Marks(unit_marks(words, at)), Marks(char_marks(words))
        before = units.rank(at)
        n = np.diff(before)
        x, y = one[first:last] % (n + 1), two[first:last] % (n + 1)
        place = [at[:-1]]
        for k in (np.minimum(x, y), np.maximum(x, y)):
            cut = at[:-1].copy()
            some = k > 0
            cut[some] = units.select(before[:-1][some] + k[some]) + 1
            place.append(cut)
        counted = [chars.rank(p) for p in place]
        out[:, first:last] = n, counted[1] - counted[0], counted[2] - counted[1]
    return out[0], out[1], out[2]


def cuts(text: Column, one: Column, two: Column) -> Column:
    """Struct (n, prefix_chars, middle_chars) by :func:`cut_places`."""
    @F.arrow_udf("struct<n:long,prefix_chars:long,middle_chars:long>")
    def run(texts: pa.Array, one: pa.Array, two: pa.Array) -> pa.Array:
        found = cut_places(texts, one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(x) for x in found], ["n", "prefix_chars", "middle_chars"])

    return run(text, one, two)


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four numbers below 2**32 from the sha256 of ``seed:id`` (a null id: ``seed:``)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 42, percent: int = 50, suffix_first: int = 80,
                   text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with n (units), form (plain, psm or spm), prefix_chars, middle_chars
    (code points; null if plain) and output, the transformed text.

    ``percent`` of the documents are transformed, ``suffix_first`` percent of those
    with the suffix before the prefix (spm); draws depend on the seed and the id
    alone, so reruns and repeated rows agree. Texts that are empty or hold one of
    the three signs stay plain, so :func:`restore` is exact.

    A null text counts as empty; a null id draws as an empty one. Texts are cut
    whole, whatever their length; a very long one is one slice. Input columns of
    the five names are replaced (the text, id and others stay); tables may be empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    one, two, three, four = draws(F.col(id_col), seed)
    plain = (text == "") | (three % 100 >= percent)
    for sign in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(text, F.lit(sign))
    form = F.when(plain, "plain").when(four % 100 < suffix_first, "spm").otherwise("psm")
    row = F.struct(*[F.col(c) for c in docs.columns])
    rows = docs.select(row.alias("row"), text.alias("text"), form.alias("form"), cuts(text, one, two).alias("cut"))
    head, middle = F.col("cut.prefix_chars").cast("int"), F.col("cut.middle_chars").cast("int")
    parts = {PREFIX: F.substr("text", F.lit(1), head), MIDDLE: F.substr("text", head + 1, middle),
             SUFFIX: F.substr("text", head + middle + 1)}
    joined = lambda *signs: F.concat(*[x for s in signs for x in (F.lit(s), parts[s])])
    output = (F.when(F.col("form") == "psm", joined(PREFIX, SUFFIX, MIDDLE))
              .when(F.col("form") == "spm", joined(SUFFIX, PREFIX, MIDDLE)).otherwise(F.col("text")))
    made = {"n": F.col("cut.n"), "form": F.col("form"),
            "prefix_chars": F.when(F.col("form") != "plain", F.col("cut.prefix_chars")),
            "middle_chars": F.when(F.col("form") != "plain", F.col("cut.middle_chars")), "output": output}
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in made],
                       *[v.alias(k) for k, v in made.items()])


def restore(output: Column, form: Column) -> Column:
    """The text that :func:`fill_in_middle` made ``output`` from."""
    upto = lambda x, sign: F.substring_index(x, sign, 1)
    after = lambda x, sign: F.substring_index(x, sign, -1)
    middle = after(output, MIDDLE)
    psm = F.concat(after(upto(output, SUFFIX), PREFIX), middle, after(upto(output, MIDDLE), SUFFIX))
    spm = F.concat(after(upto(output, MIDDLE), PREFIX), middle, after(upto(output, PREFIX), SUFFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
