"""Exact removal of repeated word runs, found by fixed-block anchors.

Every text is cut into blocks of half a window; the blocks are the index, and
every rolling run of a block's width probes it. A window that two places share
covers a whole block of either, so a hit lies inside each occurrence. Hits are
extended to whole windows, windows of one word sequence are compared in a second
exchange, all but the earliest are marked, and adjoining marked windows merge to
maximal repeats.

Hashes and places travel packed: one row holds what a batch of texts sends to
one part of the hash space (numpy arrays in binary columns), so an entry costs
4 bytes in the first exchange and 12 in the second; texts travel compressed by
bucket, in one exchange that both passes over them share. Parts of the hash space and
text buckets are ``PARTS`` for each shuffle partition, so what one task holds
follows the partition count that the cluster sets for the data's size. A phrase
that a third of all texts share is one entry per text in its part; no pairs of
places are formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import mix, text_buffers, window_hashes, word_hashes

#: Parts for each shuffle partition: more of them lower what one task holds and
#: repeat the texts' keys more often in the first exchange.
PARTS = 2
_TAG = np.uint64(34)  # a rolling hash keeps its top 30 bits inside its part
_LAST = (1 << 63) - 1  # the place of null ids: after all others


def _pack(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def _column(table: pa.Table, name: str, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), dtype=dtype) for x in table.column(name)]


def _joined(table: pa.Table, name: str, dtype: str) -> np.ndarray:
    parts = _column(table, name, dtype)
    return np.concatenate(parts) if parts else np.zeros(0, dtype=dtype)


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def _valid(bounds: np.ndarray, width: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs of ``width`` words inside one text of at least ``window``
    words, and the texts' numbers."""
    size = np.diff(bounds)
    text = np.repeat(np.arange(len(size)), size)
    start = np.arange(bounds[-1])
    good = (start + width <= bounds[1:][text]) & (size[text] >= window)
    return start[good], text[good]


def _probes(batch: pa.RecordBatch, window: int, parts: int) -> Iterator[dict]:
    """What a batch sends to each part: per text its rolling hashes' tags (30
    bits), whether one is an aligned block, and whether it occurs there again."""
    block = window // 2
    codes = []
    for first, _, bounds, hashes in word_hashes(batch.column("text")):
        start, text = _valid(bounds, block, window)
        if len(start):
            rolled = window_hashes(hashes, block)[start]
            aligned = ((start - bounds[text]) % block == 0).astype(np.uint64)
            codes.append((rolled % np.uint64(parts)) << np.uint64(45) | (text + first).astype(np.uint64) << np.uint64(31)
                         | (rolled >> _TAG) << np.uint64(1) | aligned)
    if not codes:
        return
    # One number per entry: part, text (14 bits), tag (30 bits), aligned (1 bit).
    code = np.sort(np.concatenate(codes))
    at = _runs(code >> np.uint64(1))
    ends = np.append(at[1:], len(code))
    last = code[ends - 1]
    flags = (last & np.uint64(1)) << np.uint64(1) | (ends - at > 1).astype(np.uint64)
    tags = ((last >> np.uint64(1) & np.uint64((1 << 30) - 1)) << np.uint64(2) | flags).astype(np.uint32)
    owner = last >> np.uint64(31)  # part and text
    texts = _runs(owner)
    counts = np.diff(np.append(texts, len(owner)))
    part = (owner[texts] >> np.uint64(14)).astype(np.int64)
    row = (owner[texts] & np.uint64((1 << 14) - 1)).astype(np.int64)
    keys = batch.column("key").to_numpy(zero_copy_only=False)
    buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
    edges = np.append(texts, len(owner))
    cuts = _runs(part)
    for a, b in zip(cuts, np.append(cuts[1:], len(part))):
        yield {"part": int(part[a]), "keys": _pack(keys[row[a:b]].astype("<i8")),
               "buckets": _pack(buckets[row[a:b]].astype("<i4")), "counts": _pack(counts[a:b].astype("<i4")),
               "tags": _pack(tags[edges[a]:edges[b]].astype("<u4"))}


def _anchored(table: pa.Table) -> Iterator[dict]:
    """One part of the hash space: the entries whose tag is a block's and occurs
    in two places, sent back to their texts' buckets."""
    part = table.column("part")[0].as_py()
    keys, buckets = _joined(table, "keys", "<i8"), _joined(table, "buckets", "<i4")
    counts, tags = _joined(table, "counts", "<i4"), _joined(table, "tags", "<u4")
    order = np.argsort(tags >> 2, kind="stable")
    ranked = tags[order]
    at = _runs(ranked >> 2)
    ends = np.append(at[1:], len(ranked))
    bits = np.bitwise_or.reduceat(ranked & 3, at)
    anchor = (bits & 2 > 0) & ((ends - at > 1) | (bits & 1 > 0))
    hit = np.zeros(len(tags), dtype=bool)
    hit[order] = np.repeat(anchor, ends - at)
    owner = np.repeat(np.arange(len(keys)), counts)[hit]
    found = tags[hit] >> 2
    order = np.argsort(buckets[owner], kind="stable")
    owner, found = owner[order], found[order]
    cuts = _runs(buckets[owner])
    for a, b in zip(cuts, np.append(cuts[1:], len(owner))):
        heads = _runs(owner[a:b])
        yield {"bucket": int(buckets[owner[a]]), "part": part, "keys": _pack(keys[owner[a:b][heads]].astype("<i8")),
               "counts": _pack(np.diff(np.append(heads, b - a)).astype("<i4")), "tags": _pack(found[a:b].astype("<u4"))}


def _packed_texts(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's texts by bucket, compressed together."""
    buckets = batch.column("bucket").to_numpy(zero_copy_only=False)
    order = np.argsort(buckets, kind="stable")
    for a, b in zip(cuts := _runs(buckets[order]), np.append(cuts[1:], len(order))):
        rows = batch.take(pa.array(order[a:b]))
        raw, ends = text_buffers(rows.column("text"))
        keys = rows.column("key").to_numpy(zero_copy_only=False)
        missing = rows.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        body = raw[ends[0]:ends[-1]].tobytes()
        yield {"bucket": int(buckets[order[a]]), "keys": _pack(keys.astype("<i8")), "missing": _pack(missing),
               "counts": _pack(np.diff(ends).astype("<i8")), "size": len(body),
               "texts": pa.compress(body, "zstd", asbytes=True) if body else b""}


def _unpacked(packed: pa.Table) -> pa.Table:
    """The texts of one bucket as rows (doc_id, key, bucket, text)."""
    keys, missing = _joined(packed, "keys", "<i8"), _joined(packed, "missing", "?")
    sizes = _joined(packed, "counts", "<i8")
    body = b"".join(pa.decompress(x.as_py(), n.as_py(), "zstd", asbytes=True) if n.as_py() else b""
                    for x, n in zip(packed.column("texts"), packed.column("size")))
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
    texts = pa.Array.from_buffers(pa.large_string(), len(keys), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(body)])
    bucket = np.full(len(keys), packed.column("bucket")[0].as_py() if len(packed) else 0, dtype=np.int32)
    return pa.table({"doc_id": pa.array(keys, pa.int64(), mask=missing), "key": keys, "bucket": bucket, "text": texts})


def _by_key(keys: np.ndarray, *columns: np.ndarray) -> dict[int, tuple[np.ndarray, ...]]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = _runs(keys)
    ends = np.append(at[1:], len(keys))
    columns = tuple(c[order] for c in columns)
    return {int(keys[a]): tuple(c[a:b] for c in columns) for a, b in zip(at, ends)}


def _mark(hashes: np.ndarray) -> int:
    """Tells texts under one id apart."""
    return int(mix(hashes + np.arange(len(hashes), dtype=np.uint64)).sum(dtype=np.uint64) >> np.uint64(1))


def _extended(docs: pa.Table, hits: pa.Table, window: int, parts: int) -> Iterator[dict]:
    """One bucket of texts: every window around a hit, by the part of its hash."""
    counts = _joined(hits, "counts", "<i4")
    per_row = [len(x) for x in _column(hits, "keys", "<i8")]
    part = np.repeat(np.asarray(hits.column("part").to_pylist(), dtype=np.uint64), per_row)
    code = np.repeat(part, counts) << np.uint64(32) | _joined(hits, "tags", "<u4").astype(np.uint64)
    found = _by_key(np.repeat(_joined(hits, "keys", "<i8"), counts), code)
    if not found:
        return
    block = window // 2
    keys = docs.column("key").to_numpy()
    owners, marks, places, hashes = [], [], [], []
    for first, _, bounds, words in word_hashes(docs.column("text")):
        for i in range(len(bounds) - 1):
            mine = found.get(int(keys[first + i]))
            own = words[bounds[i]:bounds[i + 1]]
            if mine is None or len(own) < window:
                continue
            rolled = window_hashes(own, block)
            hit = np.isin((rolled % np.uint64(parts)) << np.uint64(32) | rolled >> _TAG, mine[0])
            # Window s has a hit among its runs s .. s + window - block.
            seen = np.concatenate([[0], np.cumsum(hit)])
            n = len(own) - window + 1
            near = np.flatnonzero(seen[window - block + 1:window - block + 1 + n] > seen[:n])
            if len(near):
                owners.append(keys[first + i])
                marks.append(_mark(own))
                places.append(near)
                hashes.append(window_hashes(own, window)[near])
    if not owners:
        return
    text = np.repeat(np.arange(len(owners)), [len(p) for p in places])
    place, whole = np.concatenate(places), np.concatenate(hashes)
    owners, marks = np.array(owners, dtype="<i8"), np.array(marks, dtype="<i8")
    target = (whole % np.uint64(parts)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    target, text, place, whole = target[order], text[order], place[order], whole[order]
    cuts = _runs(target)
    for a, b in zip(cuts, np.append(cuts[1:], len(target))):
        heads = _runs(text[a:b])
        who = text[a:b][heads]
        yield {"part": int(target[a]), "bucket": docs.column("bucket")[0].as_py(), "keys": _pack(owners[who]),
               "marks": _pack(marks[who]), "counts": _pack(np.diff(np.append(heads, b - a)).astype("<i4")),
               "hashes": _pack(whole[a:b].astype("<u8")), "places": _pack(place[a:b].astype("<i4"))}


def _later(table: pa.Table) -> Iterator[dict]:
    """One part of the windows: those that start after an equal one, by bucket."""
    counts = _column(table, "counts", "<i4")
    all_counts = np.concatenate(counts)
    bucket = np.repeat(table.column("bucket").to_numpy(), [len(c) for c in counts])
    keys, marks = _joined(table, "keys", "<i8"), _joined(table, "marks", "<i8")
    owner = np.repeat(np.arange(len(keys)), all_counts)
    whole, place = _joined(table, "hashes", "<u8"), _joined(table, "places", "<i4")
    order = np.lexsort((place, keys[owner], whole))
    at = _runs(whole[order])
    first = np.repeat(order[at], np.diff(np.append(at, len(order))))
    late = np.sort(order[(keys[owner[order]] != keys[owner[first]]) | (place[order] != place[first])])
    owner, place = owner[late], place[late]
    order = np.argsort(bucket[owner], kind="stable")
    owner, place = owner[order], place[order]
    cuts = _runs(bucket[owner])
    for a, b in zip(cuts, np.append(cuts[1:], len(owner))):
        heads = _runs(owner[a:b])
        who = owner[a:b][heads]
        yield {"bucket": int(bucket[owner[a]]), "keys": _pack(keys[who]), "marks": _pack(marks[who]),
               "counts": _pack(np.diff(np.append(heads, b - a)).astype("<i4")), "places": _pack(place[a:b].astype("<i4"))}


def _cut(docs: pa.Table, late: pa.Table, window: int) -> pa.Table:
    """One bucket of texts without the words that marked windows cover."""
    counts = _joined(late, "counts", "<i4")
    found = _by_key(np.repeat(_joined(late, "keys", "<i8"), counts), np.repeat(_joined(late, "marks", "<i8"), counts),
                    _joined(late, "places", "<i4"))
    keys, ids = docs.column("key").to_numpy(), docs.column("doc_id")
    raw, ends = text_buffers(docs.column("text"))
    raw = raw.tobytes()
    n_words, n_removed, kept = [], [], []
    marked = {}
    if found:
        some = [i for i in range(len(keys)) if int(keys[i]) in found]
        for first, _, bounds, words in word_hashes(docs.column("text").take(pa.array(some, pa.int64()))):
            for i in range(len(bounds) - 1):
                marks, places = found[int(keys[some[first + i]])]
                marked[some[first + i]] = places[marks == _mark(words[bounds[i]:bounds[i + 1]])]
    for i in range(len(keys)):
        words = raw[ends[i]:ends[i + 1]].split()
        n_words.append(len(words))
        places = marked.get(i)
        if places is not None and len(places):
            cover = np.zeros(len(words) + 1, dtype=np.int32)
            np.add.at(cover, places, 1)
            np.add.at(cover, places + window, -1)
            words = [w for w, gone in zip(words, np.cumsum(cover[:-1]) > 0) if not gone]
        n_removed.append(n_words[-1] - len(words))
        kept.append(b" ".join(words))
    return pa.table({"doc_id": ids, "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                     "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})


def _table(rows: Iterator[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(list(rows), schema)


def _schema(**columns: str) -> tuple[pa.Schema, str]:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return (pa.schema([(c, kinds[k]) for c, k in columns.items()]), ", ".join(f"{c} {k}" for c, k in columns.items()))


def remove_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for every row of ``docs``: each word
    covered by a window of ``window`` (even) words whose sequence also starts
    earlier (smaller id, or same id and earlier place) is removed; kept words are
    joined by one space. Words are runs of characters other than space and
    0x09-0x0D, unchanged. Windows are judged on the input.

    Null texts count as empty; shorter texts keep all words. Null ids come after
    all others and count as one id. Rows that share an id are judged each by its
    own text; equal windows at the same place under one id are neither's earlier,
    so repeated rows agree. An empty table gives an empty result. Other columns
    are not read. Equality of windows is that of their 64-bit hashes.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be even")
    spark = docs.sparkSession
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    if parts >= 1 << 19:
        raise ValueError("more parts than the packed code has room for")
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), key.alias("key"),
                        F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("bucket"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    probe, probe_sql = _schema(part="int", keys="binary", buckets="binary", counts="binary", tags="binary")
    reply, reply_sql = _schema(bucket="int", part="int", keys="binary", counts="binary", tags="binary")
    whole, whole_sql = _schema(part="int", bucket="int", keys="binary", marks="binary", counts="binary", hashes="binary", places="binary")
    late, late_sql = _schema(bucket="int", keys="binary", marks="binary", counts="binary", places="binary")

    packed, packed_sql = _schema(bucket="int", keys="binary", missing="binary", counts="binary", size="long", texts="binary")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _packed_texts(batch):
                yield pa.RecordBatch.from_pylist([row], packed)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 1 << 14):
                for row in _probes(batch.slice(at, 1 << 14), window, parts):
                    yield pa.RecordBatch.from_pylist([row], probe)

    probes = texts.select("key", "bucket", "text").mapInArrow(send, probe_sql)
    hits = probes.groupBy("part").applyInArrow(lambda t: _table(_anchored(t), reply), reply_sql)
    dealt = texts.mapInArrow(pack, packed_sql)
    windows = dealt.groupBy("bucket").cogroup(hits.groupBy("bucket")).applyInArrow(
        lambda t, h: _table(_extended(_unpacked(t), h, window, parts) if len(t) and len(h) else iter(()), whole), whole_sql)
    repeats = windows.groupBy("part").applyInArrow(lambda t: _table(_later(t), late), late_sql)
    return dealt.groupBy("bucket").cogroup(repeats.groupBy("bucket")).applyInArrow(
        lambda t, r: _cut(_unpacked(t), r, window), "doc_id long, n_words long, n_removed long, kept_text string")
